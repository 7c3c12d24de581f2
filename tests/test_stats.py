"""Per-aspect tables (A1, A2): keys, order, bad labels, min mentions, ties, top-N."""
from pyspark.sql import Row

from aspectra.operators import stats


def _pairs(spark, rows):
    return spark.createDataFrame([Row(aspect=a, sentiment=s) for a, s in rows])


def _triples(spark, rows):
    return spark.createDataFrame([Row(aspect=a, opinion=o, sentiment=s) for a, o, s in rows])


def test_counts_merge_case_and_space(spark):
    df = _pairs(spark, [("Battery", "positive"), (" battery ", "negative"), ("BATTERY", "positive"), ("screen", "neutral")])
    out = {r.aspect: r for r in stats.aspect_sentiment(df).collect()}
    assert set(out) == {"battery", "screen"}
    b = out["battery"]
    assert (b.positive, b.negative, b.neutral, b.total, b.majority_sentiment) == (2, 1, 0, 3, "positive")


def test_unknown_label_and_blank_aspect_skipped(spark):
    df = _pairs(spark, [("keys", "conflict"), ("   ", "positive"), ("keys", "negative")])
    rows = stats.aspect_sentiment(df).collect()
    assert [(r.aspect, r.total) for r in rows] == [("keys", 1)]


def test_majority_tie_order(spark):
    df = _pairs(spark, [("a", "negative"), ("a", "positive"), ("b", "neutral"), ("b", "negative"), ("c", "neutral")])
    out = {r.aspect: r.majority_sentiment for r in stats.aspect_sentiment(df).collect()}
    assert out == {"a": "positive", "b": "negative", "c": "neutral"}


def test_min_mentions_and_display_order(spark):
    df = _pairs(spark, [("z", "positive"), ("z", "positive"), ("a", "positive"), ("a", "negative"), ("m", "neutral")])
    rows = stats.order_by_total(stats.aspect_sentiment(df, min_mentions=2)).collect()
    assert [r.aspect for r in rows] == ["a", "z"]


def test_reasons_rank_ties_and_top_n(spark):
    recs = [("food", f"op{i:02d}", "positive") for i in range(15)]
    recs += [("food", "tasty", "positive")] * 3 + [("food", "Tasty ", "positive")]
    recs += [("food", "bland", "negative"), ("food", "", "negative")]
    out = stats.aspect_reasons(_triples(spark, recs), top_n=10).collect()[0]
    assert out.total == 21 and out.negative == 2  # blank opinion still counts as a mention
    assert out.positive_reasons[0].reason == "tasty" and out.positive_reasons[0].n == 4
    assert len(out.positive_reasons) == 10
    assert [r.reason for r in out.positive_reasons[1:3]] == ["op00", "op01"]  # ties by phrase
    assert [(r.reason, r.n) for r in out.negative_reasons] == [("bland", 1)]
    assert out.neutral_reasons == []
