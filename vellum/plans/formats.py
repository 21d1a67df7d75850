"""Queries that take driver tables through the formats and back, with SQL for what must come out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.codecs import pms, qnt, vsp
from vellum.functions import arith, charset
from vellum.lang import decoder, encoder
from vellum.plans.catalogue import query
from vellum.sources import archive, binary
from vellum.sources.project import Config
from vellum.text import catalog


@query("benchmark", sql=r"SELECT item_id, sha256(regexp_replace(text, '[^\x00-\x7F]', '?', 'g')) AS h FROM benchmark")
def charset_roundtrip(benchmark: DataFrame) -> DataFrame:
    """Text to Shift_JIS and back; letters that it does not have are question marks."""
    back = charset.decode_column(charset.encode_column(F.col("text")))
    return benchmark.select("item_id", F.sha2(back, 256).alias("h"))


@query(
    "benchmark",
    sql="""SELECT CAST(row_number() OVER (ORDER BY item_id) AS INTEGER) AS entry_index, CAST(item_id % 3 + 1 AS INTEGER) AS volume,
CAST(row_number() OVER (PARTITION BY item_id % 3 ORDER BY item_id) AS INTEGER) AS link_no, concat(CAST(item_id AS VARCHAR), '.txt') AS name, CAST(strlen(text) AS INTEGER) AS size, sha256(text) AS h FROM benchmark""",
)
def archive_roundtrip(benchmark: DataFrame) -> DataFrame:
    """Texts as members of three volumes, written and read."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy("item_id"))  # an archive's index is one order over at most 65,535 members
    entries = benchmark.select(
        place.alias("entry_index"), (F.col("item_id") % 3 + 1).cast("int").alias("volume"), F.concat(F.col("item_id").cast("string"), F.lit(".txt")).alias("name"),
        F.timestamp_seconds(F.lit(850_953_600)).alias("mtime"), F.encode("text", "UTF-8").alias("data"),
    )
    files = archive.encode_ald(entries).select(F.concat(F.lit("gameS"), F.char(F.col("volume") + 64), F.lit(".ALD")).alias("path"), "content")
    return archive.parse_ald(files).select("entry_index", "volume", "link_no", "name", "size", F.sha2("data", 256).alias("h"))


@query("benchmark", sql="SELECT item_id, sha256(text) AS pms, sha256(text) AS qnt, sha256(text) AS vsp FROM benchmark")
def codec_roundtrip(benchmark: DataFrame) -> DataFrame:
    """Text bytes as samples of each image form, encoded and decoded: palette places, alpha, and two nibbles a byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            out: list[list[bytes]] = [[], [], []]
            for raw in rb.column(1).to_pylist():
                samples = np.frombuffer(raw, np.uint8)[:, None]
                out[0].append(pms.decode(pms.encode(pms.Pms(0, 0, samples.astype(np.uint16), np.zeros((256, 3), np.uint8)))).pixels.astype(np.uint8).tobytes())
                out[1].append(qnt.decode(qnt.encode(qnt.Qnt(0, 0, None, samples))).alpha.tobytes())
                halves = np.stack([samples[:, 0] >> 4, samples[:, 0] & 15], 1).ravel()
                back = []
                for at in range(0, len(halves), 3200):  # at most 400 rows of eight an image
                    part = np.pad(halves[at : at + 3200], (0, -len(halves[at : at + 3200]) % 8)).reshape(-1, 8)
                    back.append(vsp.decode(vsp.encode(vsp.Vsp(0, 0, 0, np.zeros((16, 3), np.uint8), part))).pixels.ravel())
                nibbles = np.concatenate(back or [halves])[: len(halves)].reshape(-1, 2)
                out[2].append((nibbles[:, 0] << 4 | nibbles[:, 1]).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([rb.column(0), *[pa.array(x, pa.binary()) for x in out]], names=["item_id", "pms", "qnt", "vsp"])

    made = benchmark.select("item_id", F.encode("text", "UTF-8").alias("data")).mapInArrow(run, "item_id bigint, pms binary, qnt binary, vsp binary")
    return made.select("item_id", *[F.sha2(c, 256).alias(c) for c in ("pms", "qnt", "vsp")])


@query(
    "nation",
    sql="""SELECT CAST(n_nationkey AS INTEGER) AS page, CAST(n_regionkey % 3 + 1 AS INTEGER) AS volume,
concat('218', '0', printf('%02x', n_nationkey + 64), '7f', '7b', '80', '7f', printf('%02x', 32 + 17), '000000', '41', '40', printf('%02x', 32 + 17), '000000') AS code, TRUE AS same FROM nation""",
)
def compile_roundtrip(nation: DataFrame) -> DataFrame:
    """A page for each nation, compiled, read back, and compiled again; and so with a message in the side file."""
    text = F.format_string("!V:%d! {V: A} pragma ald_volume %d:", "n_nationkey", F.col("n_regionkey") % 3 + 1)
    sources = nation.select(F.col("n_nationkey").cast("int").alias("page"), F.format_string("p%02d.adv", "n_nationkey").alias("name"), text.alias("text"))
    config = Config(sys_ver="3.8", disable_ain_message=True)
    compiled = encoder.compile_project(sources, config, ["V"])
    texts, told = decoder.decompile_project(compiled, Config(sys_ver="3.8", disable_ain_message=True), decoder.Names(["V"]))
    again = encoder.compile_project(texts.select("page", "name", "text"), told, ["V"]).select("page", F.col("content").alias("again"))
    pages = binary.scan_pages(compiled.select("volume", F.col("page").alias("entry_index"), F.col("content").alias("data"))).select(F.col("entry_index").alias("page"), "code")
    both = compiled.join(again, "page").join(pages, "page").join(_message_roundtrip(nation), "page")
    return both.select("page", "volume", F.lower(F.hex("code")).alias("code"), ((F.col("content") == F.col("again")) & F.col("told")).alias("same"))


def _message_roundtrip(nation: DataFrame) -> DataFrame:
    """(page, told): whether a page of 3.9 and its message come back from pages and side file."""
    text = F.concat(F.lit("!V:"), F.col("n_nationkey").cast("string"), F.lit("! '"), F.col("n_name"), F.lit("' R"))
    sources = nation.select(F.col("n_nationkey").cast("int").alias("page"), F.format_string("p%02d.adv", "n_nationkey").alias("name"), text.alias("text"))
    made = encoder.compile_tables(sources, Config(), ["V"])
    ain = binary.read_ain(binary.write_ain(encoder.side_file(made, Config())))
    names = decoder.Names([charset.decode(v) for v in ain.variables], messages=ain.messages)
    texts, told = decoder.decompile_project(made.pages, Config(), names)
    again = encoder.compile_tables(texts.select("page", "name", "text"), told, ["V"])
    kept = sources.sparkSession.createDataFrame(list(enumerate(map(bytearray, ain.messages))), "id bigint, kept binary")
    messages = made.messages.join(kept, "id").join(again.messages.select("id", F.col("data").alias("back")), "id").join(nation.select(F.col("n_nationkey").alias("page"), F.encode("n_name", "UTF-8").alias("said")), "page")
    right = messages.select("page", ((F.col("kept") == F.col("said")) & (F.col("data") == F.col("said")) & (F.col("back") == F.col("said"))).alias("right"))
    both = made.pages.select("page", "content").join(again.pages.select("page", F.col("content").alias("again")), "page").join(right, "page", "left")
    return both.select("page", ((F.col("content") == F.col("again")) & F.coalesce("right", F.lit(False))).alias("told"))


@query(
    "conversations",
    sql="""SELECT concat('c', CAST(conv_id AS VARCHAR), '.adv:message-chain:', lpad(CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS VARCHAR), 6, '0')) AS id,
concat('t', CAST(max(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS VARCHAR)) AS label, regexp_replace(text, '\\n', ' ', 'g') AS source FROM conversations WHERE length(trim(text)) > 0""",
)
def script_catalog(conversations: DataFrame) -> DataFrame:
    """A script for each conversation, a labelled message for each turn, and the catalog of them."""
    plain = F.replace("text", F.lit("\n"), F.lit(" "))
    escaped = F.regexp_replace(plain, r"([\\<'])", r"\\$1")
    line = F.concat(F.lit("*t"), F.col("turn").cast("string"), F.lit(":\n'"), escaped, F.lit("'A\n"))
    rows = conversations.where("length(trim(text)) > 0").select("conv_id", F.struct("turn", line.alias("line")).alias("s"))
    scripts = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["line"]), "").alias("text"))
    files = scripts.select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit(".adv")).alias("file"), F.encode("text", "UTF-8").alias("content"))
    found = catalog.extract(files).main.where("type = 'message-chain'")
    return found.select("id", "label", F.regexp_replace("source", "⟦ADV:\\d+⟧$", "").alias("source"))


@query("events", sql="SELECT event_id, CAST(make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS TIMESTAMP) AS t FROM events")
def filetime_roundtrip(events: DataFrame) -> DataFrame:
    return events.select("event_id", arith.from_filetime(arith.to_filetime(F.col("ts"))).cast("timestamp_ntz").alias("t"))
