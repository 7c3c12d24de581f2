import pytest
"""Representative-row selection (both paths) and stats-row validation."""
from pyspark.sql import Row
from pyspark.sql import functions as F

from aspectra.operators.select import select_report_rows
from aspectra.operators.validate import stats_violations

ROWS = [  # aspect, positive, negative, neutral
    ("alpha", 20, 8, 2),
    ("beta", 15, 3, 2),
    ("gamma", 2, 12, 1),
    ("delta", 5, 5, 2),
    ("eps", 3, 1, 1),  # total 5: not a candidate while others reach 10
]


def _table(spark, with_reasons):
    rs = []
    for a, p, n, u in ROWS:
        reasons = [Row(reason=f"{a}-good", n=1)] if with_reasons else []
        rs.append(Row(source="c", aspect=a, positive=p, negative=n, neutral=u, total=p + n + u,
                      positive_reasons=reasons, negative_reasons=[], neutral_reasons=[]))
    return spark.createDataFrame(rs, "source string, aspect string, positive int, negative int, neutral int, total int, "
                                     "positive_reasons array<struct<reason:string,n:int>>, negative_reasons array<struct<reason:string,n:int>>, "
                                     "neutral_reasons array<struct<reason:string,n:int>>")


def test_count_path_duplicate_shifts_roles(spark):
    t = _table(spark, False).drop("positive_reasons", "negative_reasons", "neutral_reasons")
    out = select_report_rows(t, ["source"], 4).orderBy("slot").collect()
    # most mentioned = alpha; most positive is alpha again (skipped), so roles shift by position
    assert [(r.aspect, r.role) for r in out] == [
        ("alpha", "most_discussed"), ("gamma", "strongest_positive"), ("delta", "strongest_negative"), ("beta", "most_divided")
    ]
    assert not out[0].reason_aware


def test_reason_path_excludes_chosen_rows(spark):
    out = select_report_rows(_table(spark, True), ["source"], 4).orderBy("slot").collect()
    assert [r.aspect for r in out] == ["alpha", "beta", "gamma", "delta"]
    assert out[0].reason_aware


def test_fallback_when_no_row_reaches_ten(spark):
    t = spark.createDataFrame([Row(source="s", aspect=a, positive=p, negative=n, neutral=0, total=p + n)
                               for a, p, n in [("x", 3, 1), ("y", 1, 2), ("z", 1, 1)]])
    out = select_report_rows(t, ["source"], 2).orderBy("slot").collect()
    assert [r.aspect for r in out] == ["x", "y"]


def test_stats_violations_first_rule(spark):
    lines = [
        '{"aspect": "Screen ", "positive": 2, "negative": 1, "neutral": 0, "total": 3, "positive_reasons": [["bright", 2]]}',
        '{"aspect": "keys", "positive": 2, "negative": 1, "total": 3}',
        '{"aspect": "  ", "positive": 0, "negative": 0, "neutral": 0, "total": 0}',
        '{"aspect": "fan", "positive": true, "negative": 0, "neutral": 0, "total": 1}',
        '{"aspect": "fan", "positive": 1, "negative": 0, "neutral": 0, "total": 2}',
        '{"aspect": "fan", "positive": 1, "negative": 0, "neutral": 0, "total": 1, "negative_reasons": [["loud", 0]]}',
        '[1, 2]',
        '{oops',
    ]
    df = spark.createDataFrame([Row(i=i, value=v) for i, v in enumerate(lines)])
    got = {r.i: r.violation for r in stats_violations(df).collect()}
    assert got[0] is None
    assert got[1] == "absent:neutral"
    assert got[2] == "blank-aspect"
    assert got[3] == "bad-count:positive"
    assert got[4] == "total-differs"
    assert got[5] == "bad-reason-count:negative_reasons"
    assert got[6] == "no-object"
    assert got[7] == "bad-json"
    ok = stats_violations(df).filter(F.col("i") == 0).select("aspect_key").collect()[0].aspect_key
    assert ok == "screen"


def test_odd_values_are_violations_not_failures(spark):
    long = "9" * 20
    lines = [
        '{"aspect": "fan", "positive": "abc", "negative": 0, "neutral": 0, "total": 1}',
        f'{{"aspect": "fan", "positive": {long}, "negative": 0, "neutral": 0, "total": {long}}}',
        '{"aspect": "fan", "positive": 1, "negative": 0, "neutral": 0, "total": 1, "positive_reasons": [{"a": 1}]}',
    ]
    rows = stats_violations(spark.createDataFrame([Row(i=i, value=v) for i, v in enumerate(lines)])).orderBy("i").collect()
    assert [r.violation for r in rows] == [
        "bad-count:positive", "bad-count:positive",
        "no-pair:positive_reasons[0]",
    ]
    assert rows[0].positive_n is None and rows[1].total_n is None


def test_statistics_documents_of_both_forms(spark):
    from aspectra.operators.validate import stats_documents, validate_strict

    good = '{"aspect": " Hinge", "positive": 4, "negative": 0, "neutral": 1, "total": 5, "majority_sentiment": "Positive", "positive_reasons": [[" Sturdy ", 3], ["LIGHT", 1]]}'
    other = '{"aspect": "cable", "positive": 0, "negative": 2, "neutral": 0, "total": 2, "neutral_reasons": null}'
    docs = {
        "bare": f"[{good}, {other}]", "named": f'{{"gold": [], "predicted": [{other}, 7, {{"aspect": "x"}}, {good}]}}',
        "other": f'{{"gold": [{good}]}}', "empty": '{"predicted": []}', "scalar": "12", "text": '{"predicted": "x"}', "broken": "[1,", "none": None,
    }
    df = spark.createDataFrame([Row(name=k, value=v) for k, v in docs.items()])
    got = {(r.name, r.row_index): r for r in stats_documents(df).collect()}
    assert {k: r.violation for k, r in got.items()} == {
        ("bare", 0): None, ("bare", 1): None, ("named", 0): None, ("named", 1): "no-object", ("named", 2): "absent:positive,negative,neutral,total", ("named", 3): None,
        **{(k, None): "no-rows" for k in ("other", "empty", "scalar", "text")}, ("broken", None): "bad-json", ("none", None): "bad-json",
    }
    first = got["bare", 0]
    assert (first.aspect, first.positive, first.total, first.majority_sentiment) == ("hinge", 4, 5, "positive")
    assert [tuple(x) for x in first.positive_reasons] == [("sturdy", 3), ("light", 1)] and first.negative_reasons == []
    assert got["bare", 1].neutral_reasons == [] and got["bare", 1].majority_sentiment == ""
    assert got["named", 2].aspect is None and got["named", 2].positive_reasons is None
    gold = {(r.name, r.row_index): r.violation for r in stats_documents(df, "gold").collect()}
    assert gold["other", 0] is None and gold["named", None] == "no-rows"
    with pytest.raises(Exception, match="no-object"):
        validate_strict(stats_documents(df.where("name = 'named'"))).collect()
    assert validate_strict(stats_documents(df.where("name = 'bare'"))).count() == 2
