"""Plan checks: native queries have no Cartesian product, no nested-loop join and no Python node."""
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NATIVE = ["aspect_reasons", "aspect_reasons_by_source", "top_reasons", "select_rows_reasons", "check_structured",
          "lexicon_predict", "triplet_prf", "grid_decode", "parse_tagged"]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.mark.parametrize("name", NATIVE)
def test_native_plan(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"


def _plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["aspect_reasons", "top_reasons", "select_rows_reasons"])
def test_ranking_windows_have_a_group_limit(spark, name):
    plan = _plan(spark, name)
    assert "WindowGroupLimit" in plan and "HashAggregate" in plan
    if name == "select_rows_reasons":
        assert plan.count("row_number") and "max(CASE" not in plan


def test_every_document_is_read(spark):
    from aspectra.plans import views
    from aspectra.session import read_table

    n = read_table(spark, SF, "documents").count()
    assert views.labelled(spark, SF).count() == views.documents(spark, SF).count() == n
    assert entry.queries()["hash_split"](spark, SF).count() == n
    tokens = views.token_rows(spark, SF).selectExpr("sum(size(tokens)) AS n", "sum(size(tokens) div 2) AS pairs").first()
    assert views.clause_rows(spark, SF).selectExpr("sum(size(tokens)) AS n").first().n == tokens.n
    assert views.triplet_rows(spark, SF).count() == tokens.pairs


def test_entry_works_without_the_optional_queries(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "aspectra.llm.queries", None)
    names = entry.queries()
    assert "aspect_reasons" in names and not any(n.startswith("op") for n in names) and "pipeline" not in names
    assert "aspect_reasons" in entry.oracle_sql()
