"""Scripts arriving as files, and sessions in batch and stream."""

from pyspark.sql import functions as F

from vellum.streaming import scripts as S
from vellum.text.catalog import read_jsonl


def test_ingest(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for k, text in enumerate(["'one'", "'two' A 'three'"]):
        (folder / f"{k}.ADV").write_text(text)
        (folder / f"{k}.txt").write_text("'no'")
        S.ingest_catalogs(S.arriving_scripts(spark, str(folder)), out, str(tmp_path / "checkpoint")).awaitTermination(120)
    assert sorted(r.raw_source for r in read_jsonl(spark, f"{out}/batch=*").collect()) == ["'one'", "'three'", "'two' A"]


def test_sessions(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id")
    got = S.sessions(events, gap="1 hour")
    assert got.agg(F.sum("n")).first()[0] == events.count() and got.where("last < first").count() == 0
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    query = S.sessions(stream, gap="1 hour").writeStream.format("memory").queryName("s").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("s").exceptAll(got).count() == 0 and spark.table("s").count() == got.count()
