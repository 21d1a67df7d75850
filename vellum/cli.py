"""Command line over the library: archives, images, pages, text catalogs and glossaries.

    python -m vellum.cli ald list game/*SA.ALD
    python -m vellum.cli decompile game/ -o sources/
    python -m vellum.cli compile -p sources/project.cfg
    python -m vellum.cli text extract sources/ --output main.jsonl --candidates rest.jsonl
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import re
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vellum.functions import charset
from vellum.lang import decoder, encoder
from vellum.sources import archive, binary, images, project
from vellum.text import catalog, glossary


#: The greatest number of a variable that a page can name.
MAX_VARIABLE = 0x3FFF


def _session() -> SparkSession:
    from vellum.session import local_session

    return SparkSession.getActiveSession() or local_session("*")


def _read(path: str, encoding: str = "utf-8") -> str:
    with open(path, encoding=encoding) as f:
        return f.read()


def _write(path: str, data: bytes) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _inside(folder: str, name: str) -> str:
    """The path of a file that a name from an archive asks for; names that lead out of the folder are errors."""
    parts = name.replace("\\", "/").split("/")
    if os.path.isabs(name) or ".." in parts or not parts[-1]:
        raise ValueError(f"{name!r} is no file of this folder")
    return os.path.join(folder, *parts)


def _split(words: list[str]) -> tuple[list[str], list[str]]:
    """Archives, and the members after --."""
    at = words.index("--") if "--" in words else len(words)
    return words[:at], words[at + 1 :]


def gutters(data: bytes) -> list[str]:
    """Text beside each 16 bytes of a dump: what can be shown, dots for the rest. A character of two bytes stands at the
    first one; where that is the last of its row, the next row begins with a space."""
    rows, at = [""] * -(-len(data) // 16), 0
    while at < len(data):
        pair = charset.is_lead(data[at]) and at + 1 < len(data) and charset.is_trail(data[at + 1])
        size = 2 if pair else 1
        shown = charset.decode(data[at : at + size], "�")
        rows[at // 16] += shown if shown.isprintable() and shown != "�" or shown == "\u3000" else "."
        if pair and at % 16 == 15:
            rows[at // 16 + 1] += " "
        at += size
    return rows


def ald(args: argparse.Namespace) -> int:
    spark = _session()
    paths, chosen = _split(args.words)
    if args.action == "create":
        members = paths[1:]
        if args.manifest:
            base = os.path.dirname(args.manifest)
            lines = spark.createDataFrame([(i, x) for i, x in enumerate(_read(args.manifest).splitlines())], "at int, line string")
            rows = [(r["volume"], r["name"].strip(), os.path.join(base, r["name"].strip())) for r in archive.parse_manifest(lines).orderBy("volume", "link_no").collect()]
        else:
            rows = [(1, os.path.basename(p), p) for p in members]
        made = []
        for i, (volume, name, path) in enumerate(rows, 1):
            with open(path, "rb") as f:
                made.append((i, volume, name, int(os.path.getmtime(path)), bytearray(f.read())))
        entries = spark.createDataFrame(made, "entry_index int, volume int, name string, s bigint, data binary").withColumn("mtime", F.timestamp_seconds("s"))
        for r in archive.encode_ald(entries).toLocalIterator():
            stem, letter = paths[0][:-5], chr(ord("A") + r["volume"] - 1)
            _write(paths[0] if not args.manifest else f"{stem}{letter}.ALD", r["content"])
        return 0
    if args.action == "dump-index":
        for path in paths:
            with open(path, "rb") as f:
                for place, (volume, number) in enumerate(archive.links(f.read())):
                    if volume:
                        print(f"{place + 1}: volume {volume}, link {number}")
        return 0
    if args.action == "compare":
        found = archive.compare(archive.read_ald(spark, paths[0]), archive.read_ald(spark, paths[1])).orderBy("entry_index").collect()
        for r in found:
            print(f"{r['entry_index']}: {r['state']}" + (f" at {r['at']}" if r["at"] is not None else ""))
        return int(bool(found))
    entries = archive.read_ald(spark, *paths, include_data=args.action != "list")
    for r in entries.where("warning is not null").select("warning").distinct().collect():
        print(f"warning: {r[0]}", file=sys.stderr)
    if args.action == "list":
        for r in archive.listing(entries).toLocalIterator():
            print(f"{r['entry_index']:4} {r['volume']:2} {r['mtime']:%Y-%m-%d %H:%M:%S} {r['size']:9} {r['name']}")
        return 0
    picked = [archive.find(entries, c) for c in chosen] or [entries.where("entry_index is not null")]
    for frame in picked:
        for r in frame.orderBy("entry_index").toLocalIterator():
            if args.action == "extract":
                _write(os.path.join(args.directory, r["name"]), r["data"])
            else:
                for i, beside in enumerate(gutters(bytes(r["data"]))):
                    print(f"{i * 16:08x}  {bytes(r['data'][i * 16 : i * 16 + 16]).hex(' '):47}  {beside}")
    if args.action == "extract" and args.manifest:
        lines = archive.manifest(entries).orderBy("entry_index").toLocalIterator()
        _write(args.manifest, "".join(f"{r['line']}\n" for r in lines).encode())
    return 0


def alk(args: argparse.Namespace) -> int:
    if args.action == "create":
        data = []
        for path in args.words[1:]:
            with open(path, "rb") as f:
                data.append(f.read())
        _write(args.words[0], archive.write_alk(data))
        return 0
    for r in archive.scan_alk(_session(), args.words[0]).orderBy("entry_index").toLocalIterator():
        if args.action == "list":
            print(f"{r['entry_index']:4} {r['size']:9} {r['ftype'] or '?'}")
        elif r["size"] and (not args.words[1:] or str(r["entry_index"]) in args.words[1:]):
            _write(os.path.join(args.directory, f"{r['entry_index']}.{r['ftype'] or 'bin'}"), r["data"])
    return 0


def image(args: argparse.Namespace) -> int:
    frame = _session().read.format("binaryFile").load(args.files).select("path", "content")
    old = getattr(args, "system2", False)
    if args.info:
        for r in images.image_info(frame, old=old).toLocalIterator():
            print(json.dumps({k: v for k, v in r.asDict().items() if v is not None}, default=str, sort_keys=True))
        return 0
    bad = 0
    for r in images.convert(frame, args.form if args.encode else None, old=old).toLocalIterator():
        if r["error"]:
            print(f"{r['path']}: {r['error']}", file=sys.stderr)
            bad = 1
            continue
        from vellum.functions.text import replace_suffix

        _write(args.output or replace_suffix(r["path"], args.form if args.encode else "png"), r["content"])
    return bad


def compile_(args: argparse.Namespace) -> int:
    base = os.path.dirname(args.project)
    config = project.read_config(_read(args.project))
    config.unicode, config.debug = config.unicode or args.unicode, config.debug or args.debug
    encoding = "cp932" if config.encoding == "sjis" else "utf-8"
    path = lambda name: os.path.join(base, name.replace("\\", "/"))
    hed = project.read_hed(_read(path(args.hed or config.hed), encoding))
    variables = project.read_variables(_read(path(config.variables), encoding)) if config.variables else []
    dlls = {h.rpartition(".")[0]: [] if h.lower().endswith(".dll") else project.read_hel(_read(path(h), encoding)) for h in hed.headers}
    sources = [(i, n, _read(path(n), encoding)) for i, n in enumerate(hed.sources)]
    spark = _session()
    made = encoder.compile_tables(spark.createDataFrame(sources, "page int, name string, text string"), config, variables, dlls)
    pages = made.pages.where("volume > 0")
    name = F.concat(F.regexp_replace(F.regexp_extract(F.replace("name", F.lit("\\"), F.lit("/")), "([^/]*)$", 1), r"\.[^.]*$", ""), F.lit(".SCO"))
    entries = pages.select((F.col("page") + 1).alias("entry_index"), "volume", name.alias("name"), F.timestamp_seconds(F.lit(0)).alias("mtime"), F.col("content").alias("data"))
    out = path(args.output or config.output_dir or ".")
    for r in archive.encode_ald(entries).toLocalIterator():
        _write(os.path.join(out, f"{os.path.basename(config.ald_basename or 'out')}S{chr(ord('A') + r['volume'] - 1)}.ALD"), r["content"])
    if config.sys_ver == "3.9":
        ain = binary.write_ain(encoder.side_file(made, config, dlls), not config.disable_ain_variable)
        _write(os.path.join(out, os.path.basename((config.output_ain or "System39.ain").replace("\\", "/"))), ain)
    if config.debug:
        told = encoder.symbols(made, [(n, t) for _, n, t in sources])
        _write(os.path.join(out, f"{os.path.basename(config.ald_basename or 'out')}SA.ALD.symbols"), binary.write_symbols(told))
    return 0


def decompile(args: argparse.Namespace) -> int:
    spark = _session()
    files = sorted(glob.glob(os.path.join(args.folder, "*")))
    paths = [p for p in files if p.upper().endswith(".ALD") and os.path.basename(p).upper()[-6:-5] == "S"]
    entries = archive.read_ald(spark, *paths).where("entry_index is not null")
    side = [p for p in files if p.lower().endswith(".ain")]
    debug = [p for p in files if p.upper().endswith("SA.ALD.SYMBOLS")]
    names, config = decoder.Names(), project.Config(disable_ain_message=True)
    if side:
        with open(side[0], "rb") as f:
            ain = binary.read_ain(f.read())
        text = lambda b: charset.decode(b, "�")
        places = {(p - 1, a): list(map(text, n)) for (p, a), n in binary.aliases(ain).items()}
        dlls = [(text(d), [(text(f), t) for f, t in fs]) for d, fs in ain.dlls.items()]
        names = decoder.Names(list(map(text, ain.variables)), {k: n[0] for k, n in places.items()}, ain.messages, dlls, {k: n[1:] for k, n in places.items() if n[1:]})
        config.disable_ain_message = not ain.messages
        if args.aindump:
            print(binary.ain_json(ain))
            return 0
    told = None
    if debug:
        with open(debug[0], "rb") as f:
            told = binary.read_symbols(f.read())
        names.variables = names.variables or [_decoded(v) for v in told.variables]
    texts, config = decoder.decompile_project(entries.select(F.col("data").alias("content"), "volume"), config, names)
    encoding = "cp932" if args.encoding == "sjis" else "utf-8"
    if told and told.sources and not args.address:  # the sources as they were
        sources = [_decoded(n) for n, _ in told.sources]
        for name, (_, text_of) in zip(sources, told.sources, strict=True):
            _write(_inside(args.output, name), text_of)
        encoding = "utf-8" if all(_is_utf8(t) for _, t in told.sources) else "cp932"
    else:
        found, most = {}, 0
        for r in texts.toLocalIterator():
            found[r["page"]] = r["name"]
            most = max([most, *[n + 1 for n in map(int, re.findall(r"\bVAR(\d{1,5})\b", r["text"])) if n <= MAX_VARIABLE]])
            _write(_inside(args.output, r["name"]), r["text"].encode(encoding))
        here = spark.createDataFrame([(p,) for p in found], "page int")
        for r in decoder.missing_pages(here, names).toLocalIterator():
            found[r["page"]] = f"_missing{r['page']}.adv"
            _write(os.path.join(args.output, found[r["page"]]), r["text"].encode(encoding))
        sources = [found[p] for p in sorted(found)]
        names.variables = [names.variable(i) for i in range(max(most, len(names.variables)))]
    config.encoding, config.hed = "sjis" if encoding == "cp932" else "utf8", "sources.hed"
    if names.variables:
        config.variables = "variables.txt"
        _write(os.path.join(args.output, config.variables), project.write_variables(names.variables).encode(encoding))
    _write(os.path.join(args.output, "project.cfg"), project.write_config(config).encode())
    _write(os.path.join(args.output, "sources.hed"), project.write_hed(project.Hed(sources)).encode(encoding))
    return 0


def _is_utf8(raw: bytes) -> bool:
    return charset.invalid_utf8_at(raw) < 0


def _decoded(raw: bytes) -> str:
    return raw.decode(errors="replace") if _is_utf8(raw) else charset.decode(raw, "�")


def text_(args: argparse.Namespace) -> int:
    spark = _session()
    if args.action == "extract":
        found = catalog.extract_project(spark, args.words[0])
        report = found.report()
        for e in report["parse_errors"]:
            print(f"{e['file']}: {e['error']}", file=sys.stderr)
        if report["parse_errors"]:
            return 1
        catalog.write_jsonl(found.main, args.output)
        catalog.write_jsonl(found.candidates, args.candidates)
    else:
        report = catalog.apply_catalog(spark, args.words[0], catalog.read_jsonl(spark, args.words[1]), args.output, args.allow_candidates)
    if args.report:
        _write(args.report, catalog.report_json(report).encode())
    print(json.dumps(report, ensure_ascii=False, sort_keys=True))
    return 0


def glossary_(args: argparse.Namespace) -> int:
    spark = _session()
    found = glossary.build_project(spark, args.project, catalog.read_jsonl(spark, args.catalog))
    print(json.dumps(glossary.write_outputs(found, args.output_dir), ensure_ascii=False, indent=2))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="vellum", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = top.add_subparsers(dest="tool", required=True)

    def tool(name: str, run, actions: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.set_defaults(run=run)
        if actions:
            p.add_argument("action", choices=actions)
        return p

    p = tool("ald", ald, ("list", "create", "extract", "dump", "dump-index", "compare"))
    p.add_argument("-d", "--directory", default=".")
    p.add_argument("-m", "--manifest")
    p.add_argument("words", nargs=argparse.REMAINDER)
    p = tool("alk", alk, ("list", "create", "extract"))
    p.add_argument("-d", "--directory", default=".")
    p.add_argument("words", nargs="+")
    for form in ("vsp", "pms", "qnt"):
        p = tool(form, image)
        p.set_defaults(form=form)
        p.add_argument("-e", "--encode", action="store_true")
        p.add_argument("-i", "--info", action="store_true")
        p.add_argument("-o", "--output")
        p.add_argument("files", nargs="+")
        if form == "pms":
            p.add_argument("--system2", action="store_true")
    p = tool("compile", compile_)
    p.add_argument("-p", "--project", default="project.cfg")
    p.add_argument("-i", "--hed")
    p.add_argument("-o", "--output")
    p.add_argument("-u", "--unicode", action="store_true")
    p.add_argument("-g", "--debug", action="store_true")
    p = tool("decompile", decompile)
    p.add_argument("folder")
    p.add_argument("-o", "--output", default=".")
    p.add_argument("-E", "--encoding", choices=("utf8", "sjis"), default="utf8")
    p.add_argument("-d", "--aindump", action="store_true")
    p.add_argument("-a", "--address", action="store_true", help="read the pages even where symbols have their sources")
    p = tool("text", text_, ("extract", "apply"))
    p.add_argument("words", nargs="+")
    p.add_argument("--output", required=True)
    p.add_argument("--candidates")
    p.add_argument("--report")
    p.add_argument("--allow-candidates", action="store_true")
    p = tool("glossary", glossary_)
    p.add_argument("project")
    p.add_argument("--catalog", required=True)
    p.add_argument("--output-dir", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(args)
    except (ValueError, OSError) as e:
        print(f"{args.tool}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
