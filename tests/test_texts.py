"""Keys of whole texts: on odd texts, and made in one pass."""

from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidemill.functions import text, transcripts
from tidemill.plans import registry


def test_compact_texts(spark):
    texts = [None, "", " ", "Abc", "  A-b\n\tc 9!", "é中𝔘", "é1中b𝔘C", "ÀKKİi", "x" * 70_000, "a, " * 30_000, "\x00a\x00"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.compact(F.col("t")).alias("k")).collect()
    assert {r.i: r.k for r in rows} == {i: None if t is None else re.sub("[^a-zA-Z0-9]+", "", t).lower() for i, t in enumerate(texts)}


@pytest.mark.parametrize("name", ["J25_text_contamination", "J25_planted_texts"])
def test_keys_of_texts_are_made_once(spark, name):
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan  # eight times slower
    sides = plan.count("Relation [")
    assert plan.count("sha2(") == sides and sides == (2 if name == "J25_text_contamination" else 3), plan


def test_same_texts(spark, tmp_path):
    docs = [(1, "A b, c!"), (2, "abc"), (3, None), (4, ""), (5, "中 ?"), (6, "abd"), (7, "a b c d")]
    items = [(9, "a-B-c"), (8, "ABC"), (7, None), (6, "!"), (5, "x")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = registry.queries()["J25_text_contamination"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 8), (2, 8), (4, 6), (5, 6)]


def test_only_texts_beyond_ascii_are_composed(spark, tmp_path):
    texts = [None, "", "Plain, ASCII!", "Ａｂ①", "é", "ﬁ½", "á̧", "각", "中" * 70_000, "İi"] * 30
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    got = {r.i: r for r in rows.select("i", text.nfkc(F.col("t")).alias("c"), transcripts.scoring_form(F.col("t")).alias("f")).collect()}
    for i, t in enumerate(texts):
        want = None if t is None else unicodedata.normalize("NFKC", t)
        assert got[i].c == want
        assert got[i].f == (None if t is None else "".join(c for c in want.lower() if unicodedata.category(c)[0] in "LN"))
    plan = rows.select(text.nfkc(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "WHEN RLIKE" in plan.replace("CASE WHEN ", "WHEN ").split("run(")[1].split(")#")[0], plan
