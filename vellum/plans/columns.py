"""Queries through byte layouts, runs and edits, which are column expressions only, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import runs
from vellum.operators import edits
from vellum.plans.catalogue import query
from vellum.sources.layouts import LINK, Field, Layout, padded

_HEAD = Layout(Field("mark", "text", 4), Field("n", "u16le"), Field("place", "u32be"))
_ORDER = Layout(Field("key", "u32le"), Field("cents", "i64be"), Field("less", "i32le"), Field("status", "text", 3), Field("gap", "pad", 2), Field("day", "u24le"))


@query(
    "orders",
    sql="""SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT) AS record, 'ORDS' AS mark, o_orderkey AS key, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
100 - o_orderkey AS less, o_orderstatus AS status, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS day FROM orders""",
)
def layout_records(orders):
    """A file for each customer, of a header and a record for each order, packed and read back: the header's count and place
    say where the records are."""
    record = _ORDER.pack(
        key=F.col("o_orderkey"), cents=F.round(F.col("o_totalprice") * 100).cast("bigint"), less=100 - F.col("o_orderkey"), status=F.col("o_orderstatus"), day=F.datediff("o_orderdate", F.lit("1970-01-01"))
    )
    lines = orders.select("o_custkey", F.struct("o_orderkey", F.hex(record).alias("r")).alias("s")).groupBy("o_custkey").agg(F.array_sort(F.collect_list("s")).alias("s"))
    body = F.unhex(F.array_join(F.transform("s", lambda x: x["r"]), ""))
    files = lines.select("o_custkey", padded(F.concat(_HEAD.pack(mark=F.lit("ORDS"), n=F.size("s"), place=F.lit(_HEAD.size)), body), 16).alias("data"))
    told = files.select("o_custkey", "data", *_HEAD.unpack(F.col("data")))
    return _ORDER.records(told, "data", F.col("n"), F.col("place")).select("o_custkey", "record", "mark", "key", "cents", "less", "status", "day")


@query(
    "lineitem",
    sql="""SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS BIGINT) AS entry, CAST(l_suppkey % 26 + 1 AS BIGINT) AS volume, CAST(l_partkey % 65536 AS BIGINT) AS pointer FROM lineitem""",
)
def link_table(lineitem):
    """An order's lines as records of a volume's link table (one byte, and two with the low one first), padded and read back."""
    rows = lineitem.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("s")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list("s")).alias("s"))
    record = lambda x: F.hex(LINK.pack(volume=x["l_suppkey"] % 26 + 1, pointer=x["l_partkey"] % 65536))
    tables = rows.select("l_orderkey", F.size("s").alias("n"), padded(F.unhex(F.array_join(F.transform("s", record), "")), 256).alias("data"))
    return LINK.records(tables, "data", F.col("n"), number="entry").select("l_orderkey", "entry", "volume", "pointer")


@query(
    "documents",
    sql="""SELECT doc_id, CAST(CASE WHEN len(b) = 0 THEN 0 ELSE 1 + len(list_filter(list_zip(b[:-2], b[2:]), lambda x: x[1] <> x[2])) END AS BIGINT) AS n_runs, sha256(text) AS h
FROM (SELECT doc_id, text, regexp_extract_all(hex(encode(text)), '..') AS b FROM documents)""",
)
def document_runs(documents):
    """The runs of equal bytes of each text, and the hash of the text that they make again."""
    found = documents.select("doc_id", runs.run_lengths(F.encode("text", "UTF-8")).alias("r"))
    return found.select("doc_id", F.size("r").cast("bigint").alias("n_runs"), F.sha2(runs.from_runs(F.col("r")), 256).alias("h"))


_EDITS = """e AS (
  SELECT doc_id, k, (doc_id * 7 + k * 13) % 60 AS s, (doc_id * 7 + k * 13) % 60 + (doc_id + k) % 15 AS z, concat('<', k, '>') AS new, CASE WHEN k = 1 AND doc_id % 5 = 0 THEN 'zzz' END AS expected
  FROM documents, range(3) r(k))"""


@query(
    "documents",
    sql=f"""WITH {_EDITS}, t AS (
  SELECT e.*, text, CASE WHEN z > length(text) THEN 'out of range' WHEN expected <> substr(text, CAST(s + 1 AS BIGINT), CAST(z - s AS BIGINT)) THEN 'changed' WHEN k = 2 AND doc_id % 11 = 0 THEN 'not allowed' END AS error
  FROM e JOIN documents USING (doc_id)
), c AS (
  SELECT *, coalesce(error, CASE WHEN max(CASE WHEN error IS NULL THEN z END) OVER (PARTITION BY doc_id ORDER BY s, z, new ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > s THEN 'overlap' END) AS bad FROM t
), p AS (
  SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY s, z, new), 0) AS b FROM c
)
SELECT doc_id, CAST(CASE WHEN count(bad) = 0 THEN 3 ELSE 0 END AS BIGINT) AS n_edits, coalesce(string_agg(bad, ',' ORDER BY k), '') AS errors,
  sha256(CASE WHEN count(bad) = 0 THEN concat(string_agg(concat(substr(text, CAST(b + 1 AS BIGINT), CAST(s - b AS BIGINT)), new), '' ORDER BY s, z, new), substr(any_value(text), CAST(max(z) + 1 AS BIGINT))) ELSE any_value(text) END) AS h
FROM p GROUP BY doc_id""",
)
def edit_documents(documents):
    """Three edits of each text by spans, some of them out of range, changed, not allowed or overlapping: all of a text's or none."""
    at = (F.col("doc_id") * 7 + F.col("k") * 13) % 60
    asked = documents.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")).select(
        "doc_id", "k", at.alias("start"), (at + (F.col("doc_id") + F.col("k")) % 15).alias("end"), F.format_string("<%d>", "k").alias("new"),
        F.when((F.col("k") == 1) & (F.col("doc_id") % 5 == 0), "zzz").alias("expected"),
    )
    told = edits.checked(asked, documents, "doc_id", rules=[("not allowed", (F.col("k") == 2) & (F.col("doc_id") % 11 == 0))])
    made = edits.applied(documents.select("doc_id", "text"), told, "doc_id")
    errors = told.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("k", "error")))), lambda x: x["error"]), ",").alias("errors"))
    return made.join(errors, "doc_id").select("doc_id", "n_edits", "errors", F.sha2("text", 256).alias("h"))
