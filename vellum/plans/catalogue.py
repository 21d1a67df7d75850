"""The relational queries over the driver's tables, each through its operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import arith, text
from vellum.operators import reach, rules, scans, spans, tables
from vellum.sources import archive
from vellum.text import glossary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(*names: str, sql: str | None = None):
    """Registers a function of the named tables under its own name."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[_table(spark, sf_dir, n) for n in names])
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---- functions


@query("documents", sql="SELECT doc_id, sha256(text) AS h FROM documents")
def source_hash(documents):
    return documents.select("doc_id", text.sha256_text("text").alias("h"))


@query("part", sql="SELECT p_partkey, concat(p_brand, ':', substr(sha256(concat(p_brand, chr(0), p_name)), 1, 12)) AS id FROM part")
def stable_id(part):
    return part.select("p_partkey", text.stable_id(F.col("p_brand"), F.col("p_name")).alias("id"))


@query(
    "pages",
    sql="""SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'pms' WHEN 1 THEN 'pms' WHEN 2 THEN 'qnt' WHEN 3 THEN 'jpeg' WHEN 4 THEN 'bmp' WHEN 5 THEN '' END AS t,
CAST(length(html) AS BIGINT) AS n FROM pages""",
)
def type_sniff(pages):
    """Pages behind the first bytes of each member type, without bytes (5), behind almost such bytes (6), and as they are (7)."""
    heads = [F.unhex(F.lit(digits)) for digits, _ in text.MAGIC]
    body = F.col("html").cast("binary")
    data = F.when(F.col("page_id") % 8 == 5, F.lit("").cast("binary")).when(F.col("page_id") % 8 == 6, F.concat(F.unhex(F.lit("504D0300")), body))
    for k, head in enumerate(heads):
        data = data.when(F.col("page_id") % 8 == k, F.concat(head, body))
    return pages.select("page_id", text.sniff(data.otherwise(body)).alias("t"), F.length("html").cast("bigint").alias("n"))


@query("pages", sql="SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS b, regexp_extract(url, '^(.*)/[^/]*$', 1) AS d FROM pages")
def path_parts(pages):
    return pages.select("page_id", text.basename(F.col("url")).alias("b"), text.dirname(F.col("url")).alias("d"))


@query(
    "benchmark",
    sql=r"""SELECT item_id, CAST(16 * i AS BIGINT) AS "offset", lower(substr(hex(encode(text)), CAST(32 * i + 1 AS BIGINT), 32)) AS hx
FROM (SELECT item_id, text, unnest(range(0, CAST(ceil(strlen(text) / 16.0) AS BIGINT))) AS i FROM benchmark)""",
)
def hex_dump(benchmark):
    rows = text.hex_rows(benchmark.select("item_id", F.encode("text", "UTF-8").alias("data")), "data")
    return rows.select("item_id", F.col("offset").cast("bigint").alias("offset"), F.col("hex").alias("hx"))


@query(
    "documents",
    sql=r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '⟦ADV:\d+⟧', '', 'g'), '[\r\n]', ' ', 'g'), '[ \t　]+', ' ', 'g'), concat(' ', chr(9), '　:：')) AS term
FROM documents""",
)
def clean_terms(documents):
    return documents.select("doc_id", text.clean_term(F.col("text")).alias("term"))


@query(
    "benchmark",
    sql=r"""SELECT item_id, replace(replace(replace(text, chr(92), repeat(chr(92), 2)), '"', concat(chr(92), '"')), '<', concat(chr(92), '<')) AS escaped FROM benchmark""",
)
def escape_script(benchmark):
    return benchmark.select("item_id", text.escape_script(F.col("text"), '"').alias("escaped"))


@query("events", sql="SELECT event_id, epoch_us(ts) * 10 + 116444736000000000 AS ft FROM events")
def filetime(events):
    return events.select("event_id", arith.to_filetime(F.col("ts")).alias("ft"))


@query(
    "lineitem",
    sql="""SELECT l_orderkey, l_linenumber, least(p + q, 65535) AS plus, least(p * q, 65535) AS m, greatest(q - 30, 0) AS sub,
CASE WHEN n <> 0 THEN p // n END AS quot, CASE WHEN n <> 0 THEN p % n END AS rem, CAST(q & 12 AS BIGINT) AS conj, CAST(q < 25 AS INTEGER) AS low
FROM (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS p, CAST(floor(l_quantity) AS BIGINT) AS q, CAST(l_linenumber - 3 AS BIGINT) AS n FROM lineitem)
""",
)
def saturating_math(lineitem):
    p, q, n = F.floor("l_extendedprice").cast("bigint"), F.floor("l_quantity").cast("bigint"), (F.col("l_linenumber") - 3).cast("bigint")
    return lineitem.select(
        "l_orderkey", "l_linenumber", arith.add(p, q).alias("plus"), arith.mul(p, q).alias("m"), arith.sub(q, F.lit(30)).alias("sub"),
        arith.div(p, n).alias("quot"), arith.mod(p, n).alias("rem"), arith.bits("&", q, F.lit(12).cast("bigint")).alias("conj"), arith.compare("<", q, F.lit(25)).alias("low"),
    )


@query(
    "orders",
    sql="""SELECT o_orderkey, lower(CASE WHEN n <= 51 THEN printf('%02X', n + 64) WHEN n <= 16383 THEN printf('%04X', n)
ELSE concat(repeat('3FFF', CAST(n // 16383 AS BIGINT)), CASE WHEN n % 16383 = 0 THEN '' WHEN n % 16383 <= 51 THEN printf('%02X', n % 16383 + 64) ELSE printf('%04X', n % 16383) END,
  repeat('79', CAST(n // 16383 - CASE WHEN n % 16383 > 0 THEN 0 ELSE 1 END AS BIGINT))) END) AS number,
lower(CASE WHEN v <= 63 THEN printf('%02X', v + 128) WHEN v <= 255 THEN concat('C0', printf('%02X', v)) WHEN v <= 16383 THEN printf('%04X', v + 49152) END) AS variable
FROM (SELECT o_orderkey, o_orderkey * 37 % 65536 AS n, o_custkey % 16384 AS v FROM orders)""",
)
def encode_number(orders):
    n, v = F.col("o_orderkey") * 37 % 65536, F.col("o_custkey") % 16384
    return orders.select("o_orderkey", F.lower(F.hex(arith.encode_number(n))).alias("number"), F.lower(F.hex(arith.encode_variable(v))).alias("variable"))


# ---- positions


_LABEL_SQL = """SELECT event_id, lbl FROM (SELECT event_id, event_type, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS)
OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lbl FROM events) WHERE event_type <> 'error'"""


@query("events", sql=_LABEL_SQL)
def nearest_label(events):
    told = spans.carry_forward(events, F.when(F.col("event_type") == "error", F.col("event_id")), ["user_id"], ["ts", "event_id"], "lbl")
    return told.where(F.col("event_type") != "error").select("event_id", "lbl")


@query(
    "orders",
    "events",
    sql="""SELECT o.o_orderkey, (SELECT max(e.value) FROM events e WHERE e.user_id = o.o_custkey AND e.event_id = (SELECT max(x.event_id) FROM events x WHERE x.user_id = o.o_custkey AND x.event_id <= o.o_orderkey)) AS last_value
FROM orders o""",
)
def asof_value(orders, events):
    """As-of join: the value of a customer's last event numbered at or below the order."""
    points = orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("at"))
    marks = events.select(F.col("user_id").alias("k"), F.col("event_id").alias("at"), "value")
    return spans.nearest_preceding(points, marks, ["k"], "at", "value", "last_value").select(F.col("at").alias("o_orderkey"), "last_value")


_CHAIN_SQL = """WITH b AS (SELECT conv_id, turn, role, CASE WHEN lag(role) OVER w = 'assistant' OR lag(role) OVER w IS NULL THEN 1 ELSE 0 END AS brk FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
i AS (SELECT *, sum(brk) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS isl FROM b)
SELECT conv_id, CAST(isl AS BIGINT) AS isl, min(turn) AS t0, max(turn) AS t1, count(*) AS n, string_agg(role, '>' ORDER BY turn) AS roles FROM i GROUP BY conv_id, isl"""


@query("conversations", sql=_CHAIN_SQL)
def message_chain(conversations):
    before = spans.previous("role", ["conv_id"], ["turn"])
    told = conversations.withColumn("brk", before.isNull() | (before == "assistant"))
    runs = spans.islands(told, F.col("brk"), ["conv_id"], ["turn"], "isl")
    roles = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">")
    return runs.groupBy("conv_id", "isl").agg(F.min("turn").alias("t0"), F.max("turn").alias("t1"), F.count("*").alias("n"), roles.alias("roles"))


@query("conversations", sql="SELECT conv_id, turn, lag(text, 2) OVER w AS b2, lag(text, 1) OVER w AS b1, lead(text, 1) OVER w AS a1, lead(text, 2) OVER w AS a2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def context_lines(conversations):
    return spans.context(conversations, "text", ["conv_id"], ["turn"]).select("conv_id", "turn", "b2", "b1", "a1", "a2")


@query(
    "events",
    sql="""SELECT e.event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'error'
AND e.ts >= x.ts AND e.ts < x.ts + INTERVAL 60 SECOND AND x.event_id <> e.event_id)""",
)
def interval_exclusion(events):
    return spans.within_after(events, F.col("event_type") == "error", 60, ["user_id"], "ts", "event_id").select("event_id")


@query(
    "orders",
    "lineitem",
    sql="""WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey % 100000 AS a, l_partkey % 100000 + CAST(l_quantity AS BIGINT) AS z, l_suppkey FROM lineitem)
SELECT l_orderkey, l_linenumber FROM s WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey % 10 = s.l_suppkey % 10 AND o.o_orderstatus = 'P' AND s.a < o.o_custkey * 3 + 5 AND s.z > o.o_custkey * 3)""",
)
def span_overlap_exclusion(orders, lineitem):
    s = lineitem.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 10).alias("k"), (F.col("l_partkey") % 100000).alias("start"), (F.col("l_partkey") % 100000 + F.col("l_quantity").cast("bigint")).alias("end"))
    t = orders.where("o_orderstatus = 'P'").select((F.col("o_orderkey") % 10).alias("k"), (F.col("o_custkey") * 3).alias("start"), (F.col("o_custkey") * 3 + 5).alias("end"))
    return spans.exclude_overlapping(s, t, ["k"]).select("l_orderkey", "l_linenumber")


@query("documents", sql="SELECT doc_id, CAST(sum((n_chars + 255) // 256) OVER w AS BIGINT) AS sector, CAST(row_number() OVER w AS BIGINT) AS link_no FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)")
def sector_offsets(documents):
    size = F.floor((F.col("n_chars") + 255) / 256)
    return spans.running_offsets(documents.select("doc_id", "source", "n_chars"), size, ["source"], ["doc_id"]).select("doc_id", "sector", "link_no")


@query("conversations", sql="SELECT concat(role, ':', lpad(CAST(row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS VARCHAR), 6, '0')) AS id, conv_id, turn FROM conversations")
def record_ids(conversations):
    return spans.numbered_ids(conversations, ["role"], ["conv_id", "turn"], F.col("role")).select("id", "conv_id", "turn")


@query(
    "documents",
    sql="""SELECT doc_id, CAST(pos AS BIGINT) AS pos, CAST(length(p) - length(replace(p, chr(10), '')) + 1 AS BIGINT) AS line
FROM (SELECT doc_id, instr(text, 'the') AS pos, substr(text, 1, instr(text, 'the') - 1) AS p FROM documents WHERE instr(text, 'the') > 1)""",
)
def line_location(documents):
    found = documents.select("doc_id", "text", F.instr("text", "the").alias("pos")).where("pos > 1")
    return found.select("doc_id", F.col("pos").cast("bigint").alias("pos"), spans.line_of(F.col("text"), F.col("pos")).alias("line"))


@query(
    "documents",
    sql="""SELECT doc_id, CAST(length(head) - length(replace(head, chr(10), '')) + 1 AS BIGINT) AS line, CAST(strpos(concat(reverse(head), chr(10)), chr(10)) AS BIGINT) AS "column", pos AS "at"
FROM (SELECT doc_id, pos, substr(text, 1, CAST(pos - 1 AS BIGINT)) AS head FROM (
  SELECT doc_id, text, CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) + 4 * (k - 1) + 1 AS BIGINT) AS pos
  FROM (SELECT doc_id, text, p, unnest(range(1, len(p))) AS k FROM (SELECT doc_id, text, string_split(text, 'tion') AS p FROM documents))))""",
)
def line_hits(documents):
    """Line, column and place of every hit in a text."""
    return spans.all_hits(documents, ["doc_id"], "text", "tion")


@query("events", sql="SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS place, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1, 2")
def line_map_last(events):
    """Of the events of one user and hour, as of lines that give one address, the last one wins."""
    rows = events.select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("place"), "event_id", "event_type")
    return spans.last_of_place(rows, ["user_id"], ["place"], ["event_id"])


_RULES = [(1, "event_type", "error", "alert"), (2, "user_id", "7", "watched"), (3, "event_type", "purchase", "sale"), (3, "user_id", "8", "watched"), (4, "event_type", "error", "never"), (9, None, None, "other")]


@query(
    "events",
    sql="""SELECT event_id, CASE WHEN event_type = 'error' THEN 'alert' WHEN user_id = 7 THEN 'watched' WHEN event_type = 'purchase' THEN 'sale' WHEN user_id = 8 THEN 'watched' ELSE 'other' END AS route FROM events""",
)
def routed_events(events):
    """Events routed by the first of the rules, kept as rows, that they meet."""
    table = events.sparkSession.createDataFrame(_RULES, "rank int, field string, value string, result string")
    return rules.routed(events, table, ["event_id"], ["event_type", "user_id"]).select("event_id", "route")


@query("events", sql="SELECT event_id FROM (SELECT event_id, ts, lag(ts + INTERVAL 60 SECOND) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pe FROM events) WHERE pe > ts")
def overlap_check(events):
    return spans.overlapping_previous(events, F.col("ts"), F.col("ts") + F.expr("INTERVAL 60 SECONDS"), ["user_id"], ["ts", "event_id"]).select("event_id")


@query("events", sql="SELECT event_id FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR p <> event_type")
def line_map_compress(events):
    return spans.changed_rows(events, "event_type", ["user_id"], ["ts", "event_id"]).select("event_id")


@query("conversations", sql="SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM conversations")
def section_carry(conversations):
    return spans.carry_forward(conversations, F.when(F.col("role") == "user", F.col("turn")), ["conv_id"], ["turn"], "s").select("conv_id", "turn", "s")


@query(
    "lineitem",
    sql="""WITH r AS (SELECT *, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS run FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(coalesce(first_value(CASE WHEN l_returnflag = 'R' THEN l_partkey END) OVER w, 0) + row_number() OVER w - CASE WHEN run > 0 THEN 1 ELSE 0 END AS INTEGER) AS link
FROM r WINDOW w AS (PARTITION BY l_suppkey, run ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice)""",
)
def link_fill(lineitem):
    given = lineitem.withColumn("given", F.when(F.col("l_returnflag") == "R", F.col("l_partkey")))
    return spans.fill_links(given, "given", ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_suppkey", "link")


@query(
    "orders",
    "lineitem",
    sql="""WITH s AS (SELECT l_orderkey, l_linenumber, l_suppkey % 10 AS k, l_partkey % 1000 AS a, l_partkey % 1000 + l_linenumber AS z FROM lineitem),
o AS (SELECT o_orderkey % 10 AS k, o_custkey % 1000 AS a, o_custkey % 1000 + 4 AS z FROM orders WHERE o_orderstatus = 'P')
SELECT l_orderkey, l_linenumber, EXISTS (SELECT 1 FROM o WHERE o.k = s.k AND s.a >= o.a AND s.z <= o.z) AS inside FROM s""",
)
def span_containment(orders, lineitem):
    """Which spans lie inside a statement's span: the semi-join's rows, and the anti-join's."""
    s = lineitem.select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 10).alias("k"), (F.col("l_partkey") % 1000).alias("start"), (F.col("l_partkey") % 1000 + F.col("l_linenumber")).alias("end"))
    o = orders.where("o_orderstatus = 'P'").select((F.col("o_orderkey") % 10).alias("k"), (F.col("o_custkey") % 1000).alias("start"), (F.col("o_custkey") % 1000 + 4).alias("end"))
    inside, outside = spans.contained(s, o, ["k"]), spans.exclude_contained(s, o, ["k"])
    return inside.withColumn("inside", F.lit(True)).unionByName(outside.withColumn("inside", F.lit(False))).select("l_orderkey", "l_linenumber", "inside")


@query(
    "lineitem",
    sql="""WITH RECURSIVE e AS (SELECT DISTINCT l_partkey * 2 AS a, l_suppkey * 2 + 1 AS b FROM lineitem WHERE l_quantity >= 49),
way AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(node, round) AS (
  SELECT (SELECT min(l_suppkey) * 2 + 1 FROM lineitem), CAST(0 AS BIGINT) UNION SELECT way.b, r.round + 1 FROM r JOIN way ON way.a = r.node WHERE r.round < 30)
SELECT node, CAST(min(round) AS BIGINT) AS round FROM r GROUP BY node""",
)
def reachable_parts(lineitem):
    """From the first supplier, by lines of 49 pieces and more: the parts that it sells, their other suppliers, and so on."""
    e = lineitem.where("l_quantity >= 49").select((F.col("l_partkey") * 2).alias("source"), (F.col("l_suppkey") * 2 + 1).alias("target"))
    both = e.unionByName(e.select(F.col("target").alias("source"), F.col("source").alias("target")))
    seeds = lineitem.agg((F.min("l_suppkey") * 2 + 1).alias("node"))
    return reach.reachable(seeds, both)


_HELD_SQL = """WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
s AS (
  SELECT user_id, event_id, rn, {set_v} AS v, {set_c} AS c, CAST(NULL AS BIGINT) AS taken_v, CAST(NULL AS BIGINT) AS taken_c FROM (SELECT *, CAST(NULL AS BIGINT) AS pv, CAST(NULL AS BIGINT) AS pc FROM e WHERE rn = 1)
  UNION ALL
  SELECT user_id, event_id, rn, CASE WHEN closes THEN NULL ELSE {set_v} END, CASE WHEN closes THEN NULL ELSE {set_c} END, CASE WHEN closes THEN pv END, CASE WHEN closes THEN pc END
  FROM (SELECT e.*, s.v AS pv, s.c AS pc, (e.event_type = 'purchase' AND s.v IS NOT NULL) OR (e.event_type = 'error' AND s.c IS NOT NULL) AS closes FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1)
)
SELECT user_id, event_id, taken_v, taken_c FROM s WHERE taken_v IS NOT NULL OR taken_c IS NOT NULL""".format(
    set_v="CASE WHEN event_type = 'view' THEN event_id ELSE pv END", set_c="CASE WHEN event_type = 'click' THEN event_id ELSE pc END"
)


@query("events", sql=_HELD_SQL)
def held_events(events):
    """A user's last view and click are held until a purchase that finds a view, or an error that finds a click, takes both."""
    field = F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1)
    closer = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "error", 1)
    taken = scans.held_fields(events, ["user_id"], "event_id", field=field, value=F.col("event_id"), closer=closer, leads=[0, 1], fields=2)
    return taken.select("user_id", "event_id", F.col("taken")[0]["value"].alias("taken_v"), F.col("taken")[1]["value"].alias("taken_c"))


# ---- keys


@query(
    "documents",
    "labels",
    sql="""SELECT coalesce(a.doc_id, b.doc_id) AS entry_index, CASE WHEN a.doc_id IS NULL THEN 'only_right' WHEN b.doc_id IS NULL THEN 'only_left' WHEN b.quality = 0 THEN 'name' ELSE 'data' END AS state,
CASE WHEN a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL AND b.quality <> 0 THEN CAST(strlen(a.text) AS INTEGER) END AS at
FROM (SELECT doc_id, text FROM documents WHERE lang <> 'fr') a
FULL OUTER JOIN (SELECT l.doc_id, l.quality, l.toxic FROM labels l JOIN documents d ON d.doc_id = l.doc_id) b ON a.doc_id = b.doc_id
WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR b.quality = 0 OR b.toxic = 1""",
)
def archive_compare(documents, labels):
    """Two archives of texts: names differ in case only, or by a letter where quality is 0; toxic ones have a byte more."""
    name, data = F.concat("lang", F.lit(".txt")), F.col("text").cast("binary")
    left = documents.where("lang <> 'fr'").select(F.col("doc_id").alias("entry_index"), name.alias("name"), data.alias("data"))
    other = F.upper(F.concat(name, F.when(F.col("quality") == 0, F.lit("x")).otherwise(F.lit(""))))
    more = F.concat(data, F.when(F.col("toxic") == 1, F.lit("!").cast("binary")).otherwise(F.lit("").cast("binary")))
    right = labels.join(documents, "doc_id").select(F.col("doc_id").alias("entry_index"), other.alias("name"), more.alias("data"))
    return archive.compare(left, right)


@query(
    "documents",
    "labels",
    sql="""SELECT coalesce(a.doc_id, b.doc_id) AS id, CASE WHEN a.doc_id IS NULL THEN 'only_right' WHEN b.doc_id IS NULL THEN 'only_left' WHEN a.n_chars = b.n_chars THEN 'same' ELSE 'differ' END AS st
FROM (SELECT doc_id, n_chars FROM documents WHERE lang <> 'fr') a FULL OUTER JOIN (SELECT l.doc_id, d.n_chars + l.toxic AS n_chars FROM labels l JOIN documents d ON d.doc_id = l.doc_id) b ON a.doc_id = b.doc_id""",
)
def table_compare(documents, labels):
    left = documents.where("lang <> 'fr'").select("doc_id", "n_chars")
    right = labels.join(documents, "doc_id").select("doc_id", (F.col("n_chars") + F.col("toxic")).alias("n_chars"))
    return tables.compare(left, right, "doc_id", "n_chars")


@query(
    "documents",
    "labels",
    sql="""SELECT l.doc_id, CASE WHEN d.doc_id IS NULL THEN 'missing' WHEN d.n_chars <> length(d.text) THEN 'len' WHEN d.lang <> 'en' THEN 'lang' ELSE 'ok' END AS st
FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id""",
)
def catalog_validate(documents, labels):
    current = documents.select("doc_id", "n_chars", "lang", F.length("text").alias("n"))
    return tables.validate(labels.select("doc_id"), current, "doc_id", [("len", F.col("n_chars") != F.col("n")), ("lang", F.col("lang") != "en")]).select("doc_id", "st")


@query("documents", sql="SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_guard(documents):
    return tables.duplicates(documents, text.sha256_text("text"))


@query("documents", sql="SELECT lang, source, count(*) AS n, CAST(count_if(n_chars < 100) AS BIGINT) AS short FROM documents GROUP BY lang, source")
def type_counts(documents):
    return documents.groupBy("lang", "source").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") < 100).alias("short"))


@query(
    "events",
    sql="""SELECT event_type, CAST(user_id % 7 AS INTEGER) AS reason, count(*) AS n, CAST(grouping(event_type) * 2 + grouping(CAST(user_id % 7 AS INTEGER)) AS BIGINT) AS level
FROM events GROUP BY GROUPING SETS ((event_type), (CAST(user_id % 7 AS INTEGER)), ())""",
)
def reason_counts(events):
    e = events.select("event_type", (F.col("user_id") % 7).cast("int").alias("reason"))
    sets = e.groupingSets([[F.col("event_type")], [F.col("reason")], []], "event_type", "reason")
    return sets.agg(F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level"))


@query(
    "events",
    sql="""WITH t AS (SELECT event_type AS k, CAST(event_id AS VARCHAR) AS ex, event_id AS seq, user_id AS u FROM events)
SELECT k, count(*) AS occ, arg_min(u, seq) AS firstu, array_to_string(list_slice(list(ex ORDER BY seq), 1, 3), '|') AS ex FROM t GROUP BY k""",
)
def merge_terms(events):
    t = events.select(F.col("event_type").alias("k"), F.col("event_id").cast("string").alias("example"), F.col("event_id").alias("seq"), F.col("user_id").alias("firstu"), F.lit(1).alias("occ"))
    merged = tables.merge_first_seen(t, ["k"], "seq", first=["firstu"], sums=["occ"], examples="example")
    return merged.select("k", "occ", "firstu", F.array_join("examples", "|").alias("ex"))


_TERMS = "[A-Z][a-z]{3,18}(?:tion|ing)"


@query(
    "documents",
    sql=f"SELECT lower(w) AS term, count(*) AS n, count(DISTINCT doc_id) AS files FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{_TERMS}', 0)) AS w FROM documents) GROUP BY lower(w) HAVING count(*) >= 3",
)
def mine_terms(documents):
    found = documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_TERMS), F.lit(0))).alias("w"))
    return tables.frequent(found, F.lower("w"), 3, "doc_id")


@query("part", "lineitem", sql="SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def stopword_filter(part, lineitem):
    return tables.without(part, lineitem.where("l_quantity > 45"), "p_partkey", "l_partkey").select("p_partkey")


@query(
    "part",
    sql="""SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'title_or_world_term' WHEN 1 THEN 'organization_candidate' WHEN 2 THEN 'facility_candidate' WHEN 3 THEN 'location_candidate'
WHEN 4 THEN 'title_or_world_term' WHEN 5 THEN 'organization_candidate' WHEN 6 THEN 'location_candidate' ELSE 'named_phrase_candidate' END AS c FROM part""",
)
def suffix_class(part):
    """Names with endings of every class; 4: of two classes, the first wins; 7: an ending that is not last; 8: none."""
    endings = F.array(*[F.lit(x) for x in ("将軍", "教団", "研究所", "神殿", "の女神", "帝国", "大都市", "森の", "")])
    value = F.concat("p_name", F.element_at(endings, (F.col("p_partkey") % 9 + 1).cast("int")))
    return part.select("p_partkey", glossary.classify_suffix(value).alias("c"))


@query("part", sql="SELECT p_brand, p_partkey, CAST(rn AS BIGINT) AS rn FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn FROM part) WHERE rn <= 3")
def rank_sort_topk(part):
    return tables.top_per_group(part, ["p_brand"], [F.desc("p_size"), "p_partkey"], 3).select("p_brand", "p_partkey", "rn")


@query("orders", sql="SELECT CAST(o_custkey % 26 + 1 AS BIGINT) AS vol, count(*) AS n FROM orders GROUP BY 1")
def volume_buckets(orders):
    return tables.buckets(orders, (F.col("o_custkey") % 26 + 1).cast("bigint"))


@query("lineitem", sql="SELECT l_orderkey, CAST(bit_or(1 << CAST(l_suppkey % 26 + 1 AS INTEGER)) AS BIGINT) AS mask FROM lineitem GROUP BY l_orderkey")
def volume_mask(lineitem):
    return lineitem.groupBy("l_orderkey").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("l_suppkey") % 26 + 1).cast("int"))).alias("mask"))


@query(
    "lineitem",
    sql="""WITH a AS (SELECT l_orderkey, l_suppkey % 5 AS k, list(l_linenumber ORDER BY l_linenumber) AS s FROM lineitem GROUP BY ALL),
e AS (SELECT l_orderkey, k, s, unnest(range(1, len(s) + 1)) AS n FROM a),
x AS (SELECT l_orderkey, k, array_to_string(list_slice(s, -n, len(s)), ',') AS t, n FROM e),
g AS (SELECT l_orderkey, count(DISTINCT k) AS ks FROM a GROUP BY 1),
m AS (SELECT x.l_orderkey, t, max(n) AS n FROM x JOIN g ON x.l_orderkey = g.l_orderkey GROUP BY x.l_orderkey, t, ks HAVING count(DISTINCT k) = ks)
SELECT g.l_orderkey, coalesce(arg_max(m.t, m.n), '') AS suffix FROM g LEFT JOIN m ON g.l_orderkey = m.l_orderkey GROUP BY g.l_orderkey""",
)
def common_suffix(lineitem):
    seqs = lineitem.groupBy("l_orderkey", (F.col("l_suppkey") % 5).alias("k")).agg(F.array_sort(F.collect_list("l_linenumber")).alias("s"))
    return tables.common_suffix(seqs, ["l_orderkey"], "s").select("l_orderkey", F.array_join("suffix", ",").alias("suffix"))
