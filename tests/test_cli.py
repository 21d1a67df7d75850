"""The command line, end to end over one invented project."""

from vellum import cli


def test_archives(spark, tmp_path, capsys):
    a, b, out = tmp_path / "a.txt", tmp_path / "b.txt", str(tmp_path / "xSA.ALD")
    a.write_bytes(b"hello")
    b.write_bytes("日本\n".encode("cp932"))
    assert cli.main(["ald", "create", out, str(a), str(b)]) == 0
    assert cli.main(["ald", "list", out]) == 0 and "b.txt" in capsys.readouterr().out
    assert cli.main(["ald", "-d", str(tmp_path / "x"), "extract", out, "--", "2"]) == 0 and (tmp_path / "x" / "b.txt").read_bytes() == b.read_bytes()
    assert cli.main(["ald", "-d", str(tmp_path / "x"), "-m", str(tmp_path / "x" / "m.txt"), "extract", out]) == 0
    assert (tmp_path / "x" / "m.txt").read_text() == "1,1,a.txt\n1,2,b.txt\n"
    assert cli.main(["ald", "-m", str(tmp_path / "x" / "m.txt"), "create", str(tmp_path / "ySA.ALD")]) == 0 and (tmp_path / "ySA.ALD").exists()
    assert cli.main(["ald", "dump", out, "--", "B.TXT"]) == 0 and "日本." in capsys.readouterr().out
    assert cli.main(["ald", "dump-index", out]) == 0 and "link 2" in capsys.readouterr().out
    assert cli.main(["ald", "compare", out, out]) == 0
    alk = str(tmp_path / "c.alk")
    assert cli.main(["alk", "create", alk, str(a)]) == 0 and cli.main(["alk", "list", alk]) == 0


def test_compile_decompile_and_text(spark, tmp_path, capsys):
    src = tmp_path / "src"
    src.mkdir()
    (src / "project.cfg").write_text("sys_ver = 3.8\nhed = s.hed\nald_basename = game\n")
    (src / "s.hed").write_text("#SYSTEM35\na.adv\nb.adv\n")
    (src / "a.adv").write_text("!X:1! {X=1: 'はい' R } else { ~f: }\n")
    (src / "b.adv").write_text("@end: **f: 'いいえ' ~0,X: *end:\n")
    one, two, three = str(tmp_path / "one"), str(tmp_path / "two"), str(tmp_path / "three")
    assert cli.main(["compile", "-p", str(src / "project.cfg"), "-o", one]) == 0
    assert cli.main(["decompile", one, "-o", two]) == 0
    cfg = tmp_path / "two" / "project.cfg"
    cfg.write_text(cfg.read_text().replace("3.9", "3.8") + "ald_basename = game\n")
    assert (tmp_path / "two" / "variables.txt").read_text().split() == ["VAR0"]
    assert cli.main(["compile", "-p", str(cfg), "-o", three]) == 0
    assert (tmp_path / "one" / "gameSA.ALD").read_bytes() == (tmp_path / "three" / "gameSA.ALD").read_bytes()
    assert cli.main(["text", "extract", two, "--output", str(tmp_path / "m"), "--candidates", str(tmp_path / "c")]) == 0
    assert '"main_entries": 2' in capsys.readouterr().out


def test_messages_go_through_the_side_file(spark, tmp_path):
    src, out, back = tmp_path / "src", tmp_path / "out", tmp_path / "back"
    src.mkdir()
    (src / "project.cfg").write_text("hed = s.hed\nald_basename = game\n")
    (src / "s.hed").write_text("#SYSTEM35\na.adv\n")
    (src / "a.adv").write_text("!X:1! 'はい' R 'いいえ'\n")
    assert cli.main(["compile", "-g", "-p", str(src / "project.cfg"), "-o", str(out)]) == 0
    assert {p.name for p in out.iterdir()} == {"gameSA.ALD", "System39.ain", "gameSA.ALD.symbols"}
    assert cli.main(["decompile", str(out), "-o", str(back)]) == 0
    assert (back / "a.adv").read_text() == (src / "a.adv").read_text()  # the symbols have it
    assert "variables.txt" in (back / "project.cfg").read_text()
    assert cli.main(["decompile", "-a", str(out), "-o", str(back)]) == 0
    text = (back / "a.adv").read_text()
    assert text != (src / "a.adv").read_text() and "'はい'" in text and "'いいえ'" in text and (back / "variables.txt").read_text().split() == ["X"]


def test_dumps_show_characters_across_rows():
    assert cli.gutters("0123456789abcde日本".encode("cp932") + b"\x81\0") == ["0123456789abcde日", " 本.."]
    assert cli.gutters(b"") == [] and cli.gutters(b"a\n") == ["a."]


def test_names_stay_in_their_folder(tmp_path):
    import pytest

    assert cli._inside("x", "a\\b.adv") == "x/a/b.adv"
    for bad in ("../a", "/a", "a/../../b", "..\\a", ""):
        with pytest.raises(ValueError, match="no file"):
            cli._inside("x", bad)
