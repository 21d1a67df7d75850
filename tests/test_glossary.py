"""Glossary mining on invented tables and text."""

import csv

import pytest
from pyspark.sql import functions as F

from vellum.functions.text import clean_term
from vellum.text import glossary as G


@pytest.fixture
def files(spark):
    rows = {
        "SET_CHR.ADV": "MS 1,カナ:\nMS 2,魔法使い:\n!VAR154:7!\n!VAR154:8!\nMS 4,ミド隊長:\nMS 5,歩兵:\n!VAR156:9!\nMS 1,カナ:\n!VAR154:11!\n",
        "SET_MAP.ADV": "!VAR158:3!\nMS 8,北の丘:\nMS 8,無視:\n",
        "SET_ITEM.ADV": "!VAR160:4!\nMS 7,鉄の剣:\n",
        "OTHER.ADV": "MS 8,南の谷:\nMS 8,年:\nMS 10,緑軍:\nMS 10,日:\n",
        "Gソラ12.ADV": "",
        "GAL.ADV": "",
        "Gカナ.ADV": "",
    }
    return spark.createDataFrame([(k, bytearray(v.encode())) for k, v in rows.items()], "file string, content binary")


def test_build(spark, files, tmp_path):
    catalog = spark.createDataFrame(
        [
            ("A.ADV", 1, "［白銀塔］と［どうする？］ カタ カナ"),
            ("A.ADV", 2, "白銀塔へ、ロボ⟦ADV:1⟧ロボ。ロボ"),
            ("B.ADV", 1, "［薬草］価格、黒猫団。青葉城、青葉城、北の丘"),
        ],
        "file string, at bigint, source string",
    )
    out = {(r["category"], r["source"]): r for r in G.build(files, catalog).collect()}
    assert out["character", "カナ"]["entity_ids"] == [7, 11] and out["character", "カナ"]["source_refs"] == ["SET_CHR.ADV:1", "SET_CHR.ADV:8"]
    assert out["unit_class", "歩兵"]["entity_ids"] == [9]
    assert out["location", "北の丘"]["entity_ids"] == [3] and ("location", "無視") not in out
    assert out["location", "南の谷"]["confidence"] == "medium" and out["organization", "緑軍"]["occurrences"] == 1
    assert ("location", "年") not in out and ("title_or_world_term", "日") not in out
    assert ("character_candidate", "ソラ") in out and ("character_candidate", "カナ") not in out
    tower = out["location_candidate", "白銀塔"]
    assert (tower["origin"], tower["occurrences"], tower["file_count"], len(tower["examples"])) == ("bracketed_text", 3, 1, 2)
    assert out["item_candidate", "薬草"]["confidence"] == "medium"
    assert out["location_candidate", "青葉城"]["occurrences"] == 2
    assert ("katakana_candidate", "ロボ") not in out  # the placeholder's space between two of them is rejoined
    assert not any(s == "どうする？" for _, s in out)
    report = G.write_outputs(G.build(files, catalog), str(tmp_path / "g"))
    assert report["total"] == len(out)
    rows = list(csv.DictReader(open(tmp_path / "g" / "glossary-source.csv", encoding="utf-8-sig")))
    assert [r["category"] for r in rows] == sorted((r["category"] for r in rows), key=G.RANKS.get)


def test_clean_term(spark):
    rows = spark.createDataFrame([(" 　a⟦ADV:12⟧\r\n b：",), ("::",)], "t string")
    assert [r[0] for r in rows.select(clean_term(F.col("t"))).collect()] == ["a b", ""]
