"""Glossary mining: id tables, runtime strings, file names and catalog text, merged to one ranked list of terms.

Terms are rows with an order (stage, file, place); merging takes the scalars of the first, adds counts, unites ids
and references, and keeps the first three distinct examples.
"""

from __future__ import annotations

import csv
import json
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.text import PLACEHOLDER, clean_term, nfkc, stable_id
from vellum.operators.scans import held_fields
from vellum.operators.tables import merge_first_seen
from vellum.written import written

# ---- fixed values: patterns, word lists and category ranks

MS_LINE = r"(?U)^\s*MS\s+(\d+)\s*,\s*(.*?):\s*$"
VAR_LINE = r"(?U)^\s*!VAR(154|156|158|160)\s*:\s*(\d+)!\s*$"
KATAKANA = "[ァ-ヺ][ァ-ヺー・]{1,19}"
BRACKET = "［([^］]{1,40})］"
TERM_CHARS = "一-龯々〆ヶァ-ヺー・Ａ-Ｚａ-ｚA-Za-z０-９0-9"
TERM_SUFFIXES = (
    "反乱軍", "共和国", "研究所", "士官学校", "魔法学校", "教団本部", "王国", "帝国", "軍団", "兵団", "部隊", "教団", "同盟", "本部", "司令室", "神殿", "迷宮", "洞窟", "遺跡",
    "アジト", "都市", "基地", "学校", "研究室", "大陸", "軍", "隊", "城", "街", "村", "町", "砦", "塔", "森", "山", "湖", "島", "宮", "館", "ビル", "王", "皇帝", "大統領", "将軍",
    "隊長", "司令", "提督", "大臣", "騎士", "魔人", "魔王", "女神", "族",
)
SUFFIXED = f"(?<![{TERM_CHARS}])([{TERM_CHARS}]{{1,18}}(?:の[{TERM_CHARS}]{{1,12}})?(?:{'|'.join(TERM_SUFFIXES)}))"
KATAKANA_STOP = (
    "アイテム", "ゲーム", "キャラ", "データ", "テスト", "ベッド", "メイド", "パンツ", "ショーツ", "スカート", "ドレス", "プレゼント", "スピード", "キス", "エッチ", "ボール", "バック",
    "カーテン", "バルコニー", "シーツ", "コンバート", "ビジョン", "ルート", "ノック", "ハーレム", "スパイ", "モンスター", "テント", "ピンク", "グッド", "ダーリン", "ユー", "ミー",
    "ボク", "ワシ", "ガキ", "ブス", "マヌケ", "メシ", "パン", "ズボン",
)
MS10_STOP = ("魔物", "ならず者", "落ち武者", "砂漠の兵", "某国の民", "日")
MS8_STOP = ("土地の名前", "年")
BRACKET_STOP = ("装備可能", "装備不可")
NEVER = ("未発見", "終了", "停止")
STEM_STOP = ("", "AL", "DX")
RANKS = {
    "character": 10, "character_role": 20, "unit_or_commander": 30, "unit_class": 40, "location": 50, "item": 60, "organization": 70, "title_or_world_term": 80,
    "character_candidate": 90, "facility_candidate": 100, "item_candidate": 110, "organization_candidate": 120, "location_candidate": 130, "named_phrase_candidate": 140,
    "katakana_candidate": 150,
}
SUFFIX_CLASSES = (
    ("title_or_world_term", "(?:王|皇帝|大統領|将軍|隊長|司令|提督|大臣|騎士|魔人|魔王|女神|族)$"),
    ("organization_candidate", "(?:軍|軍団|兵団|部隊|隊|教団|同盟|本部|王国|帝国|共和国)$"),
    ("facility_candidate", "(?:研究所|学校|研究室|基地|ビル)$"),
    ("location_candidate", "(?:城|街|村|町|砦|塔|神殿|迷宮|洞窟|遺跡|アジト|都市|大陸|森|山|湖|島|宮|館)$"),
)
ORGANIZATION = "(?:軍|部隊|隊|教団|国)$"
FACILITY_MARKS, ITEM_MARKS = ("建設期間", "建設費"), ("価格", "特価", "装備", "万ＧＯＬＤ")
TABLE_FILES = ("SET_CHR.ADV", "SET_MAP.ADV", "SET_ITEM.ADV")

#: Reasons that terms show.
ID_TABLE = "ID-backed {}"
RUNTIME_PLACE = "location slot MS 8 outside SET_MAP"
RUNTIME_FACTION = "battle/faction display slot MS 10"
FROM_FILE_NAME = "G-prefixed scenario filename"
FROM_BRACKETS = "explicit full-width square-bracket term"
FROM_SUFFIX = "short noun phrase with a proper-term suffix"
FROM_KATAKANA = "katakana token occurring at least three times"

#: Which MS fields an id line of SET_CHR closes: line's variable, field that must be there, (field, category, reason).
CHARACTER_FIELDS = {
    "154": (1, ((1, "character", "main character name"), (2, "character_role", "main character role/class"))),
    "156": (4, ((4, "unit_or_commander", "unit/commander display name"), (5, "unit_class", "unit class or affiliation"))),
}

TERM = "stage INT, file STRING, at BIGINT, category STRING, source STRING, confidence STRING, status STRING, origin STRING, reason STRING, entity_ids ARRAY<INT>, occurrences BIGINT, refs ARRAY<STRING>, example STRING"


class GlossaryError(ValueError):
    pass


# ---- classifiers


def classify_suffix(value: Column) -> Column:
    out = F
    for category, pattern in SUFFIX_CLASSES:
        out = out.when(value.rlike(pattern), category)
    return out.otherwise("named_phrase_candidate")


def _has_any(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def classify_bracket(value: Column, text: Column) -> Column:
    by_suffix = classify_suffix(value)
    return (
        F.when(by_suffix != "named_phrase_candidate", by_suffix)
        .when(_has_any(text, FACILITY_MARKS), "facility_candidate")
        .when(_has_any(text, ITEM_MARKS), "item_candidate")
        .otherwise("named_phrase_candidate")
    )


def plausible_bracket(value: Column, category: Column) -> Column:
    """Not dialogue, a counter or layout; a phrase without a class must have no hiragana."""
    bad = (
        (value == "") | value.isin(*BRACKET_STOP) | (F.length(value) > 24) | value.rlike("[。！？!?：:]") | value.rlike(r"(?U)^[\d０-９\s\-－/／。、・]+$")
        | value.contains("－－") | value.rlike("^[/／￥]") | value.rlike(r"(?U)\s")
    )
    return ~bad & ((category != "named_phrase_candidate") | ~value.rlike("[ぁ-ゖ]"))


# ---- terms


def lines_of(files: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """(file, at, line) of (file, content); lines end as they do for str.splitlines()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for file, content in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                lines = content.decode(encoding).splitlines()
                made = [pa.array([file] * len(lines), pa.string()), pa.array(range(1, len(lines) + 1), pa.int64()), pa.array(lines, pa.string())]
                yield pa.RecordBatch.from_arrays(made, names=["file", "at", "line"])

    return files.select("file", "content").mapInArrow(run, "file string, at bigint, line string")


def _term(stage: int, at: Column, category: Column, source: Column, confidence: str | Column, status: str, origin: str, reason: Column | str, ids: Column | None, n: Column, refs: Column, example: Column | None = None) -> list[Column]:
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return [
        F.lit(stage).alias("stage"), F.col("file"), at.cast("bigint").alias("at"), category.alias("category"), clean_term(source).alias("source"), text(confidence).alias("confidence"),
        F.lit(status).alias("status"), F.lit(origin).alias("origin"), text(reason).alias("reason"),
        (F.array(ids.cast("int")) if ids is not None else F.array().cast("array<int>")).alias("entity_ids"), n.cast("bigint").alias("occurrences"), F.array(refs).alias("refs"),
        (example if example is not None else F.lit(None).cast("string")).alias("example"),
    ]


def _parsed(lines: DataFrame) -> DataFrame:
    """Lines that set a string field (ms, value) or carry an id (var, entity)."""
    got = lines.select(
        "file", "at", F.nullif(F.regexp_extract("line", MS_LINE, 1), F.lit("")).cast("int").alias("ms"), F.regexp_extract("line", MS_LINE, 2).alias("value"),
        F.nullif(F.regexp_extract("line", VAR_LINE, 1), F.lit("")).alias("var"), F.nullif(F.regexp_extract("line", VAR_LINE, 2), F.lit("")).cast("bigint").alias("entity"),
    )
    return got.where("ms is not null or var is not null")


def character_terms(parsed: DataFrame) -> DataFrame:
    """SET_CHR: fields are held until an id line that finds its leading field among them takes and clears them."""
    kinds = list(CHARACTER_FIELDS)
    numbers = {1: 0, 2: 1, 4: 2, 5: 3}
    field, closer = F.lit(None).cast("int"), F.lit(None).cast("int")
    for ms, n in numbers.items():
        field = F.when(F.col("ms") == ms, n).otherwise(field)
    for n, var in enumerate(kinds):
        closer = F.when(F.col("ms").isNull() & (F.col("var") == var), n).otherwise(closer)
    lines = parsed.where(F.col("file") == TABLE_FILES[0])
    leads = [numbers[CHARACTER_FIELDS[var][0]] for var in kinds]
    taken = held_fields(lines, ["file"], "at", field=field, value=F.col("value"), closer=closer, leads=leads, fields=len(numbers))
    # The id is the closing line's own.
    ids = lines.where(closer.isNotNull()).select("file", "at", "entity")
    rules = F.array(*[F.struct(F.lit(n).alias("closer"), F.lit(numbers[ms]).alias("field"), F.lit(k).alias("k"), F.lit(category).alias("category"), F.lit(reason).alias("reason"))
                      for n, var in enumerate(kinds) for k, (ms, category, reason) in enumerate(CHARACTER_FIELDS[var][1])])
    found = taken.join(ids, ["file", "at"]).withColumn("rule", F.explode(F.filter(rules, lambda r: r["closer"] == F.col("closer"))))
    found = found.withColumn("held", F.get("taken", F.col("rule.field"))).where(F.col("held").isNotNull())
    found = found.select("file", (F.col("at") * 10 + F.col("rule.k")).alias("at"), "rule.category", F.col("held.value").alias("value"), "rule.reason", "entity", F.concat_ws(":", "file", "held.at").alias("ref"))
    return found.select(*_term(1, F.col("at"), F.col("category"), F.col("value"), "high", "extracted", "id_table", F.col("reason"), F.col("entity"), F.lit(0), F.col("ref")))


def table_terms(parsed: DataFrame, stage: int, file: str, ms: int, var: str, category: str) -> DataFrame:
    """SET_MAP and SET_ITEM: an id line gives its id to the next field line of the kind, once."""
    from vellum.operators.spans import previous

    rows = parsed.where((F.col("file") == file) & ((F.col("var") == var) | (F.col("ms") == ms)))
    found = rows.withColumn("id", previous("entity", ["file"], ["at"])).where(F.col("ms").isNotNull() & F.col("id").isNotNull())
    return found.select(*_term(stage, F.col("at"), F.lit(category), F.col("value"), "high", "extracted", "id_table", ID_TABLE.format(category), F.col("id"), F.lit(0), F.concat_ws(":", "file", "at")))


def runtime_terms(parsed: DataFrame) -> DataFrame:
    """Fields 8 outside SET_MAP and 10 anywhere."""
    value = clean_term(F.col("value"))
    place = (F.col("ms") == 8) & (F.col("file") != TABLE_FILES[1]) & ~value.isin(*MS8_STOP)
    faction = (F.col("ms") == 10) & ~value.isin(*MS10_STOP)
    category = F.when(place, "location").when(value.rlike(ORGANIZATION), "organization").otherwise("title_or_world_term")
    reason = F.when(place, RUNTIME_PLACE).otherwise(RUNTIME_FACTION)
    return parsed.where((place | faction) & (value != "")).select(*_term(4, F.col("at"), category, F.col("value"), "medium", "candidate", "runtime_string", reason, None, F.lit(1), F.concat_ws(":", "file", "at")))


def filename_terms(files: DataFrame) -> DataFrame:
    stem = F.regexp_replace(nfkc(F.regexp_extract("file", r"^G(.*)\.ADV$", 1)), r"(?U)\d+$", "")
    found = files.where(F.col("file").rlike(r"^G.*\.ADV$")).select("file", stem.alias("stem")).where(~F.col("stem").isin(*STEM_STOP) & F.col("stem").rlike(r"[^\x00-\x7F]"))
    return found.select(*_term(5, F.lit(0), F.lit("character_candidate"), F.col("stem"), "medium", "candidate", "character_file", FROM_FILE_NAME, None, F.lit(1), F.col("file")))


def mined_terms(catalog: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bracketed, suffixed and katakana terms of (file, at, source) rows."""
    clean = F.regexp_replace(F.regexp_replace("source", PLACEHOLDER, " "), r"(?U)(?<=[ァ-ヺー])\s+(?=[ァ-ヺー])", "")
    rows = catalog.select("file", F.col("at").alias("row"), clean.alias("text")).withColumn("example", F.substring(clean_term(F.col("text")), 1, 120))

    def each(pattern: str, group: int) -> DataFrame:
        found = rows.select("*", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).alias("k", "value"))
        return found.withColumn("at", F.col("row") * (1 << 31) + F.col("k"))

    bracket = each(BRACKET, 1).withColumn("value", clean_term(F.col("value"))).withColumn("category", classify_bracket(F.col("value"), F.col("text")))
    bracket = bracket.where(~F.col("value").contains("ADV:") & plausible_bracket(F.col("value"), F.col("category")))
    sure = F.when(F.col("category") != "named_phrase_candidate", "medium").otherwise("low")
    suffix = each(SUFFIXED, 1).withColumn("value", clean_term(F.col("value"))).where(F.length("value") >= 2).withColumn("category", classify_suffix(F.col("value")))
    kana = each(KATAKANA, 0).where(~F.col("value").isin(*KATAKANA_STOP))
    one, at, value, file, example = F.lit(1), F.col("at"), F.col("value"), F.col("file"), F.col("example")
    return (
        bracket.select(*_term(6, at, F.col("category"), value, sure, "candidate", "bracketed_text", FROM_BRACKETS, None, one, file, example)),
        suffix.select(*_term(7, at, F.col("category"), value, "low", "candidate", "suffix_mining", FROM_SUFFIX, None, one, file, example)),
        kana.select(*_term(8, at, F.lit("katakana_candidate"), value, "low", "candidate", "frequency_mining", FROM_KATAKANA, None, one, file, example)),
    )


def merge_terms(terms: DataFrame) -> DataFrame:
    """One row for each category and source."""
    kept = terms.where((F.col("source") != "") & ~F.col("source").isin(*NEVER))
    seq = F.struct("stage", F.encode("file", "UTF-8").alias("file"), "at")
    keys = ["category", "source"]
    examples = merge_first_seen(kept.where("example is not null").withColumn("seq", seq), keys, "seq", examples="example", most=3)
    scalars = F.min(F.struct(seq.alias("s"), "confidence", "status", "origin", "reason")).alias("first")
    whole = kept.groupBy(*keys).agg(
        scalars, F.sum("occurrences").alias("occurrences"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("entity_ids")))).alias("entity_ids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("refs")))).alias("source_refs"),
    )
    files = F.size(F.array_distinct(F.transform("source_refs", lambda x: F.substring_index(x, ":", 1)))).cast("bigint")
    return whole.join(examples, keys, "left").select(
        stable_id(F.col("category"), F.col("source")).alias("id"), *keys, "first.confidence", "first.status", "first.origin", "first.reason", "entity_ids", "occurrences",
        files.alias("file_count"), "source_refs", F.coalesce("examples", F.array().cast("array<string>")).alias("examples"),
    )


def build(files: DataFrame, catalog: DataFrame, encoding: str = "utf-8", *, suffix_least: int = 2, katakana_least: int = 3) -> DataFrame:
    """The glossary of (file, content) scripts and (file, at, source) catalog rows, `at` ordering a file's records."""
    parsed = written(_parsed(lines_of(files, encoding)), "lines")
    tables_ = character_terms(parsed).unionByName(table_terms(parsed, 2, TABLE_FILES[1], 8, "158", "location")).unionByName(table_terms(parsed, 3, TABLE_FILES[2], 7, "160", "item"))
    known = tables_.unionByName(runtime_terms(parsed)).where((F.col("source") != "") & ~F.col("source").isin(*NEVER))
    known = written(known.unionByName(filename_terms(files).join(known.select("source").distinct(), "source", "left_anti")), "known")
    sources = known.select("source").distinct()
    bracket, suffix, kana = (t.join(sources, "source", "left_anti") for t in mined_terms(catalog))
    keys = ["category", "source"]
    # A suffixed phrase counts when it repeats, or another way has found it as well.
    repeated = suffix.groupBy(*keys).count().where(F.col("count") >= suffix_least).select(*keys)
    there = known.unionByName(bracket).select(*keys).distinct()
    suffix = suffix.join(repeated.unionByName(there).distinct(), keys, "left_semi")
    kana = kana.join(kana.groupBy(*keys).count().where(F.col("count") >= katakana_least).select(*keys), keys, "left_semi")
    return merge_terms(known.unionByName(bracket).unionByName(suffix).unionByName(kana))


def ranked(glossary: DataFrame) -> DataFrame:
    rank = F
    for category, n in RANKS.items():
        rank = rank.when(F.col("category") == category, n)
    return glossary.orderBy(rank.otherwise(999), nfkc(F.col("source")), "source")


def catalog_rows(catalog: DataFrame) -> DataFrame:
    """(file, at, source) of catalog records, in their places' order."""
    return catalog.select("file", F.col("start.offset").cast("bigint").alias("at"), "source")


def build_project(spark: SparkSession, project: str, catalog: DataFrame) -> DataFrame:
    from vellum.text.catalog import sources

    files = sources(spark, project)
    there = {r["file"] for r in files.where(F.col("file").isin(*TABLE_FILES)).select("file").collect()}
    if missing := set(TABLE_FILES) - there:
        raise GlossaryError(f"missing required files: {sorted(missing)}")
    return build(files, catalog_rows(catalog))


FIELDS = [f.strip().split()[0] for f in "id, category, source, confidence, status, origin, reason, entity_ids, occurrences, file_count, source_refs, examples".split(",")]


def write_outputs(glossary: DataFrame, folder: str) -> dict:
    """The glossary as JSON lines and as CSV with a byte order mark: all, seed, candidates, and one for each category.
    Rows stream to the driver in rank order, as each output is a single ordered file. Returns the report."""
    os.makedirs(os.path.join(folder, "categories"), exist_ok=True)
    counts = {k: Counter() for k in ("category", "confidence", "status")}
    opened: dict[str, tuple] = {}

    def put(name: str, row: dict) -> None:
        if name not in opened:
            stream = open(os.path.join(folder, name), "w", encoding="utf-8-sig", newline="")  # noqa: SIM115
            opened[name] = (stream, csv.DictWriter(stream, fieldnames=FIELDS))
            opened[name][1].writeheader()
        if row:
            opened[name][1].writerow(row | {"entity_ids": ",".join(map(str, row["entity_ids"])), "source_refs": " | ".join(row["source_refs"]), "examples": " | ".join(row["examples"])})

    for name in ("glossary-source.csv", "glossary-seed.csv", "review-candidates.csv"):
        put(name, {})
    try:
        with open(os.path.join(folder, "glossary-source.jsonl"), "w", encoding="utf-8", newline="\n") as lines:
            for r in ranked(glossary).toLocalIterator():
                row = {k: r[k] for k in FIELDS}
                lines.write(json.dumps(row, ensure_ascii=False) + "\n")
                put("glossary-source.csv", row)
                if row["confidence"] in ("high", "medium"):
                    put("glossary-seed.csv", row)
                if row["status"] == "candidate":
                    put("review-candidates.csv", row)
                put(f"categories/{row['category']}.csv", row)
                for k, c in counts.items():
                    c[row[k]] += 1
    finally:
        for stream, _ in opened.values():
            stream.close()
    report = {"total": sum(counts["category"].values())} | {f"by_{k}": dict(sorted(c.items())) for k, c in counts.items()}
    with open(os.path.join(folder, "extraction-report.json"), "w", encoding="utf-8") as f:
        f.write(json.dumps(report, ensure_ascii=False, indent=2) + "\n")
    return report
