r"""Secret scans by multipart credential linking, in DataFrame functions only.

Base spans are what the fixed patterns match. The method adds weak parts (identifiers, short, standalone, keyed or
bearer secrets, endpoints): each is reported only where at most SCOPE code points lie between it and a
complementary part of the same text. Parts meet in an interval join: a part and its scope are dealt to the buckets of SCOPE + 1 code points that they cover, and each bucket is first
reduced to the least start and the greatest end of each role, so a bucket of many parts makes no pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import columns_of, materialize, table, with_columns_replaced

SCOPE = 400
#: Join keys that the rows of a hot text are dealt to.
SALTS = 32
#: Rows that make a text hot at least, whatever the table's size.
HOT_ROWS = 1_000
_CHUNK = 256
_VALUE = "[A-Za-z0-9+/_.=-]+"


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _assigned(words: list[str], value: str) -> str:
    return "(" + "|".join(map(_any_case, words)) + ")" + r"""["']?[ ]*[:=][ ]*["']?""" + f"({value})"


_TOKEN = "[A-Za-z0-9+/_-]"
_KEYED = ["password", "passwd", "secret", "token", "api_?key"]
#: kind, pattern, group whose length counts, least length, role. In the order that spans of one start are listed.
BASE = (
    ("assign", _assigned(_KEYED, _VALUE), 2, 8, "secret"),
    ("access", "AKIA[A-Z0-9]+", 0, 16, "identifier"),
    ("hex", "[0-9a-f]{32,}", 0, 32, "secret"),
)
_FIRST = (
    ("identifier", _assigned(["access_?key_?id", "client_?id", "user_?name", "user_?id", "account"], "[A-Za-z0-9@._-]+"), 2, 3, "identifier"),
    ("weak", _assigned(["pass_?phrase", "pwd", "access_?key", "auth", "credential", "bearer"], _VALUE), 2, 6, "secret"),
    ("endpoint", "[a-z][a-z0-9+]{0,15}://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+", 0, 8, "endpoint"),
)
WEAK = (
    *_FIRST,
    ("short", _assigned(_KEYED, "[A-Za-z0-9+/_.=-]{1,7}(?![A-Za-z0-9+/_.=-])"), 2, 3, "secret"),
    # Letters of both cases and digits stand for a high entropy.
    ("standalone", f"(?<!{_TOKEN})(?={_TOKEN}{{32}})(?={_TOKEN}*[a-z])(?={_TOKEN}*[A-Z])(?={_TOKEN}*[0-9])[A-Za-z0-9]{_TOKEN}+={{0,2}}", 0, 32, "secret"),
    ("key", "(?<![A-Za-z0-9_-])[A-Za-z0-9][A-Za-z0-9_-]*(?:(?<![Aa][Pp][Ii])(?<![Aa][Cc][Cc][Ee][Ss][Ss])_|-)[Kk][Ee][Yy]" + rf"""["']?[ ]*[:=][ ]*["']?({_VALUE})""", 1, 6, "secret"),
    ("bearer", "(?<![A-Za-z0-9_])[Bb][Ee][Aa][Rr][Ee][Rr][ ]+([A-Za-z0-9+/_.~=-]+)", 1, 6, "secret"),
)
KINDS = tuple(x[0] for x in (*BASE, *WEAK))
#: The roles that make a weak part of a role worth reporting.
COMPLEMENTS = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}


_SPAN = "array<struct<start:bigint,ord:int,end:bigint,kind:string,role:string>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _walk(items: Column, begin: Column, ends: Callable[[Column, Column], Column], step: Callable[[Column, Column, Column], Column], empty: Column) -> Column:
    """The arrays that a walk over items makes, joined. begin is the place it starts from, ends(place, items) the place
    after some items; step(place, accumulated array, items) are the items' own results. An array that grows is copied
    at each step, so items are walked _CHUNK at a time, which keeps many matches in one text near linear."""

    def chunk(items_: Column, acc: Column, i: Column) -> Column:
        return _bound(
            F.slice(items_, i * _CHUNK + 1, F.lit(_CHUNK)),
            lambda own: F.struct(ends(acc["at"], own).alias("at"), F.concat(acc["out"], F.array(step(acc["at"], empty, own))).alias("out")),
        )

    start = F.struct(begin.alias("at"), F.array(empty).alias("out"))
    return _bound(
        items,
        lambda items_: F.flatten(
            F.aggregate(F.sequence(F.lit(0), F.floor((F.size(items_) - 1) / _CHUNK).cast("int")), start, lambda acc, i: chunk(items_, acc, i), lambda acc: acc["out"])
        ),
    )


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, role: str) -> Column:
    """array<struct<start, ord, end, kind, role>> of one pattern's matches, in code points, in order."""
    p, zero = F.lit(pattern), F.lit(0).cast("long")
    whole = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    found = F.arrays_zip(
        F.transform(between, lambda x: F.length(x).cast("long")).alias("gap"),
        F.transform(whole, lambda x: F.length(x).cast("long")).alias("size"),
        F.transform(value, lambda x: F.length(x).cast("long")).alias("value"),
    )
    none = F.array().cast(_SPAN)

    def ends(at: Column, own: Column) -> Column:
        return F.aggregate(own, at, lambda acc, x: acc + x["gap"] + F.coalesce(x["size"], zero))

    def spans(at: Column, empty: Column, own: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("ord"), (start + x["size"]).alias("end"), F.lit(kind).alias("kind"), F.lit(role).alias("role"))
            return F.struct(
                (start + F.coalesce(x["size"], zero)).alias("at"),
                F.when(x["value"] >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
            )

        return F.aggregate(own, F.struct(at.alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    return F.when(text.rlike(pattern), _walk(found, zero, ends, spans, none)).otherwise(none)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan(docs: DataFrame, text_col: str = "text", *, scope: int = SCOPE, keep: list[str] | None = None) -> DataFrame:
    """docs with n_assign, n_access, n_hex (bigint), base_sha256, spans (strings) and found, an array of
    struct<start, end, kind> that holds base and linked spans by start.

    A null or empty text has no spans and base_sha256 of ''. Equal texts get equal results; repeated rows stay.
    Columns named like an added one are replaced, others may have any name. Offsets are code points, ends exclusive.
    scope is counted from a part's end to the next one's start. keep: the columns of docs to carry (all). Texts are matched once: what the patterns find is written, and each text's spans then meet
    its rows by its digest; texts themselves are only shuffled where they are kept.
    """
    added = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"]
    keep = with_columns_replaced(docs, added) if keep is None else keep
    # Own names from here on, so that no column of docs clashes with one.
    own = [c.alias(f"c{i}") for i, c in enumerate(columns_of(docs, keep))]
    text = F.coalesce(columns_of(docs, [text_col])[0], F.lit(""))
    digest = F.sha2(text.cast("binary"), 256).alias("h")
    parts = [_spans(text, *x).alias(x[0]) for x in (*BASE, *WEAK)]
    if text_col in keep:
        matched = materialize(docs.select(digest, *parts), "parts")
        rows = docs.select(*own, digest)
    else:
        matched = materialize(docs.select(*own, digest, *parts), "parts")
        rows = matched.select(*[f"c{i}" for i in range(len(keep))], "h")
    base = F.array_sort(F.concat(*[F.col(x[0]) for x in BASE]))
    weak = F.concat(*[F.col(x[0]) for x in WEAK])
    sizes = [F.size(x[0]).cast("long").alias(f"n_{x[0]}") for x in BASE]
    some = matched.select("h", base.alias("base"), weak.alias("weak"), *sizes).where((F.size("base") > 0) | (F.size("weak") > 0))
    texts = materialize(some.groupBy("h").agg(*[F.first(c).alias(c) for c in some.columns[1:]]), "texts")
    linked = _linked(texts, scope)
    spans = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN))))
    told = texts.join(linked, "h", "left").select(
        "h", "n_assign", "n_access", "n_hex", _listed(F.col("base")).alias("base_listed"), spans.alias("every"),
    )
    # Texts that over one in a thousand rows hold, a thousand at most: their rows are dealt to SALTS keys.
    total = matched.count()
    hot = matched.groupBy("h").count().where(F.col("count") > max(HOT_ROWS, total // 1_000)).select(F.col("h").alias("hot"))
    hot = materialize(hot, "hot")
    salt = lambda x: F.when(F.col("hot").isNotNull(), x).otherwise(F.lit(0))
    hashed = [f"c{i}" for i, c in enumerate(keep) if "map<" not in docs.select(columns_of(docs, [c])[0]).dtypes[0][1]]
    spread = F.pmod(F.xxhash64(*hashed) if hashed else F.lit(0).cast("long"), F.lit(SALTS)).cast("int")
    rows = rows.join(F.broadcast(hot), rows["h"] == hot["hot"], "left").withColumn("salt", salt(spread)).drop("hot")
    copies = F.sequence(F.lit(0), salt(F.lit(SALTS - 1)))
    told = told.join(F.broadcast(hot), told["h"] == hot["hot"], "left").withColumn("salt", F.explode(copies)).drop("hot")
    joined = rows.join(told, ["h", "salt"], "left")
    every = F.coalesce("every", F.array().cast(_SPAN))
    return joined.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)],
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("n_assign", "n_access", "n_hex")],
        F.sha2(F.coalesce("base_listed", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
        F.transform(every, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))).alias("found"),
    )


def _linked(texts: DataFrame, scope: int) -> DataFrame:
    """(h, linked): the weak parts of each text that a complementary part is within scope of. h is unique in texts."""
    width = scope + 1
    roles = F.array_distinct(F.transform(F.concat("weak", "base"), lambda x: x["role"]))
    some = texts.where((F.size("weak") > 0) & (F.size(roles) > 1))
    both = F.concat(F.transform("base", lambda x: F.struct(F.lit(False).alias("weak"), x.alias("s"))), F.transform("weak", lambda x: F.struct(F.lit(True).alias("weak"), x.alias("s"))))
    flat = materialize(some.select("h", F.explode(both).alias("p")).select("h", "p.weak", "p.s.*"), "flat")
    buckets = lambda a, b: F.explode(F.sequence(F.floor(a / F.lit(width)), F.floor(b / F.lit(width))))
    # Of two others in a bucket, one before and one behind a part's scope, the scope would have to fit between: it is wider than a bucket.
    least = flat.withColumn("bucket", buckets(F.col("start"), F.col("end"))).groupBy("h", "bucket", F.col("role").alias("other")).agg(F.min("start").alias("lo"), F.max("end").alias("hi"))
    asked = flat.where("weak").drop("weak").withColumn("bucket", buckets(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope))
    complement = reduce(lambda a, b: a | b, [(F.col("role") == role) & F.col("other").isin(*others) for role, others in COMPLEMENTS.items()])
    near = (F.col("lo") <= F.col("end") + scope) & (F.col("hi") >= F.col("start") - scope)
    met = asked.join(least, ["h", "bucket"]).where(complement & near)
    return met.groupBy("h").agg(F.collect_set(F.struct("start", "ord", "end", "kind", "role")).alias("linked"))


def redact(docs: DataFrame, text_col: str = "text", *, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """docs, their columns as they were, with every span that scan() finds replaced by mark, and n_chars (if there
    is one) counted anew. Overlapping spans are one. Texts without spans, nulls included, stay untouched."""
    names, types = docs.columns, dict(docs.dtypes)
    found = scan(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]), f"c{names.index(text_col)}", scope=scope)
    text, zero = F.col(f"c{names.index(text_col)}"), F.lit(0).cast("long")
    none = F.array().cast("array<string>")
    cut = lambda of, a, b: F.substring(of, (a + 1).cast("int"), (b - a).cast("int"))

    def ends(at: Column, own: Column) -> Column:
        return F.greatest(at, F.aggregate(own, zero, lambda acc, x: F.greatest(acc, x["end"])))

    def pieces(at: Column, empty: Column, own: Column) -> Column:
        """What is left before each span, and its mark; places count from the end of the spans before."""

        def step(part: Column, acc: Column, x: Column) -> Column:
            start, end = x["start"] - at, x["end"] - at
            first = (at == 0) & (acc["at"] == 0)
            new = F.when(start > acc["at"], F.concat(cut(part, acc["at"], start), F.lit(mark))).when(first | (start == acc["at"]), F.lit(mark)).otherwise(F.lit(""))
            return F.struct(F.greatest(acc["at"], end).alias("at"), F.concat(acc["out"], F.array(new)).alias("out"))

        begun = F.struct(zero.alias("at"), empty.alias("out"))
        return _bound(cut(text, at, ends(at, own)), lambda part: F.aggregate(own, begun, lambda acc, x: step(part, acc, x), lambda acc: acc["out"]))

    last = F.aggregate("found", zero, lambda acc, x: F.greatest(acc, x["end"]))
    clean = F.concat(F.array_join(_walk(F.col("found"), zero, ends, pieces, none), ""), F.substring(text, (last + 1).cast("int"), F.length(text)))
    clean = F.when(F.size("found") > 0, clean).otherwise(text)
    out = found.withColumn(f"c{names.index(text_col)}", clean)
    return out.select(*[
        (F.length(text).cast(types[c]) if c == "n_chars" else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)
    ])


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have no spans; repeated rows stay."""
    return scan(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


#: The kinds for an engine whose patterns cannot look around: pattern, group of the span, group of the value, its least
#: length, a condition on the span. A pattern may take a character before or behind the span, where no other match can begin.
_BEFORE = "[^A-Za-z0-9_-]"
_FLAT = {
    **{kind: (f"({p})", 1, group + 1, least, "true") for kind, p, group, least, _ in (*BASE, *_FIRST)},
    "short": (f"({_assigned(_KEYED, '[A-Za-z0-9+/_.=-]{1,7}')})[^A-Za-z0-9+/_.=-]", 1, 3, 3, "true"),
    "standalone": (
        f"({_TOKEN}+)={{0,2}}", 0, 1, 32, "regexp_matches(span, '^[A-Za-z0-9]') AND regexp_matches(span, '[a-z]') AND regexp_matches(span, '[A-Z]') AND regexp_matches(span, '[0-9]')",
    ),
    "key": (rf"""{_BEFORE}([A-Za-z0-9][A-Za-z0-9_-]*[_-][Kk][Ee][Yy]["']?[ ]*[:=][ ]*["']?({_VALUE}))""", 1, 2, 6, "true"),
    "bearer": ("[^A-Za-z0-9_]([Bb][Ee][Aa][Rr][Ee][Rr][ ]+([A-Za-z0-9+/_.~=-]+))", 1, 2, 6, "true"),
}


def _sql() -> str:
    """Texts are matched between two blanks. For `key`, names that end in api_key or access_key are made others of the same length."""
    q = lambda p: "'" + p.replace("'", "''") + "'"
    roles = {x[0]: x[4] for x in (*BASE, *WEAK)}
    other = "regexp_replace(t, '([Aa][Pp][Ii]|[Aa][Cc][Cc][Ee][Ss][Ss])_[Kk][Ee][Yy]', '\\1_kex', 'g')"
    one = "\n  UNION ALL\n  ".join(
        f"""SELECT d, {KINDS.index(kind)} AS ord, '{kind}' AS kind, '{roles[kind]}' AS role, {kind not in [x[0] for x in BASE]} AS weak, i, s, whole[i] AS whole, spans[i] AS span
    FROM (SELECT *, CAST(list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS BIGINT) - 1 AS s
    FROM (SELECT d, unnest(range(1, len(whole) + 1)) AS i, whole, value, spans, between
    FROM (SELECT d, regexp_extract_all(x, {q(p)}, 0) AS whole, regexp_extract_all(x, {q(p)}, {value}) AS value, regexp_extract_all(x, {q(p)}, {span}) AS spans, regexp_split_to_array(x, {q(p)}) AS between
    FROM (SELECT d, {other if kind == 'key' else 't'} AS x FROM docs)))) WHERE length(value[i]) >= {least} AND {where.replace('span', 'spans[i]')}"""
        for kind, (p, span, value, least, where) in _FLAT.items()
    )
    complement = " OR ".join(f"(a.role = '{r}' AND b.role IN ({', '.join(map(q, others))}))" for r, others in COMPLEMENTS.items())
    return f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, concat(' ', coalesce(text, ''), ' ') AS t FROM documents),
matched AS (
  {one}
), part AS (
  SELECT d, ord, kind, role, weak, s + before AS start, s + before + length(span) AS stop
  FROM (SELECT *, CASE WHEN kind IN ('key', 'bearer') THEN length(whole) - length(span) ELSE 0 END AS before FROM matched)
), kept AS (
  SELECT * FROM part a WHERE NOT weak OR EXISTS (
    SELECT 1 FROM part b WHERE b.d = a.d AND ({complement}) AND b.start <= a.stop + {SCOPE} AND b.stop >= a.start - {SCOPE})
), listed AS (
  SELECT d, CAST(count_if(kind = 'assign') AS BIGINT) AS n_assign, CAST(count_if(kind = 'access') AS BIGINT) AS n_access, CAST(count_if(kind = 'hex') AS BIGINT) AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (WHERE NOT weak) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans
  FROM kept GROUP BY d
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed ON docs.d = listed.d
"""


SQL = _sql()
