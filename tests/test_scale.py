"""Queries on small inputs that the supplied tables don't hold, against their SQL."""

import datetime
import random
import unicodedata

import duckdb
import oracle
import pytest

from gleaner.functions import quality, text
from gleaner.operators import classify
from gleaner.plans import registry
from pyspark.sql import functions as F


@pytest.fixture
def held(spark, tmp_path):
    """Compares a query with its SQL over these texts as documents, with orders to date them."""

    def compare(name, texts):
        days = [datetime.datetime(1998, 6, 1), datetime.datetime(1995, 6, 1)]
        spark.createDataFrame([(k, t, "en", "src1", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame([(k, days[k % 2]) for k in range(len(texts))], "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
        con = duckdb.connect()
        for t in ("documents", "orders"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        return oracle.compare(registry.QUERIES[name](spark, str(tmp_path)), con, registry.ORACLE_SQL[name])

    return compare


def test_classifier_outcomes_of_titles_with_an_error_number(spark, held):
    texts = ["404 page not found\nA story.", "Call 404 325\nA story.", "A title\nA story.", "Another\nA story."]
    equal, what = held("classifier_outcomes", texts)
    assert equal, what
    rows = spark.createDataFrame([(t, t, "1998-06-01") for t in texts], "title string, text string, published_date string")
    found = classify.outcome(rows, F.lit("1998-01-01").cast("timestamp"), F.lit("1998-12-31").cast("timestamp")).collect()
    assert [r.outcome for r in found] == ["error_page", "error_page", "model", "model"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_texts_that_decoding_may_change_go_to_python(spark):
    changed = ["&amp;", "é", "ﬁ", "가", "நொ", "⾀0 \U0002f800", "ẋ̣", "̈́", "①"]
    rng = random.Random(3)
    some = [chr(k) for k in range(1, 0x30000) if not 0xD800 <= k <= 0xDFFF]
    texts = changed + ["".join(rng.choices(some, k=3)) for _ in range(3000)] + some[::7] + ["plain", "Größe 漢字 кот 각 😀 “q” — r"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for form, function in (("NFC", text.decoded), ("NFKC", text.compatible)):
        for r in rows.select("t", function(F.col("t")).alias("new"), text._changeable(F.col("t"), form).alias("sent")).collect():
            want = unicodedata.normalize(form, text.decode_entities(r.t))
            assert r.new == want and (r.sent or r.t == want), r.t
            assert not r.sent or r.t not in texts[-2:]
    assert "CASE WHEN (Contains(" in _plan(rows.select(text.content_hash(F.col("t")))).split("ArrowEvalPython")[1]


def test_gate_lowers_a_text_once_and_counts_in_arrays(spark):
    rows = spark.createDataFrame([("https://e.com/a", "T", "1998-06-01", "A story.")], "url string, title string, published_date string, text string")
    plan = _plan(quality.validated(rows, F.lit("1998-12-31").cast("timestamp")).select("rejection_codes"))
    assert plan.count("lower(_raw") <= 6 and "metrics(cleaned_text" in plan


def test_metrics_of_odd_texts(spark):
    line = "a line of twenty characters"
    texts = ["", None, "One. Two! three?", "x." + "﻿" + "y. ", "ΣΑΣ σας", f"{line}\n A  LINE of twenty characters \n{line}\nend.", "́.”"]
    found = [r.m for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(text.metrics(F.col("t")).alias("m")).collect()]
    assert tuple(found[0]) == (0, 0, 0, 0.0, 0.0, 0.0) and tuple(found[1]) == (None, None, None, 0.0, None, 0.0)
    assert [(m.word_count, m.sentence_count) for m in found[2:]] == [(3, 3), (2, 1), (2, 0), (16, 1), (0, 1)]
    assert found[4].token_diversity == 0.5 and found[5].repeated_line_ratio == 2 / 3 and found[2].letter_ratio == 11 / len(texts[2])
