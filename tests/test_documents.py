"""Nested documents, run metrics, totals of checks and the routed attempt loop, against hand-written values."""
import json
from pathlib import Path

from aspectra.operators.checks import check_reasoned, check_structured, report_totals
from aspectra.operators.reports import retry_rejects, routed
from aspectra.sources.documents import log_run, prf, read_report_documents, read_stats_documents, write_measured, write_reports, write_stats_documents
from pyspark.sql import functions as F

REASONS = "array<struct<reason:string,n:bigint>>"
TABLE = (
    "source string, aspect string, positive bigint, negative bigint, neutral bigint, total bigint, majority_sentiment string, "
    f"positive_reasons {REASONS}, negative_reasons {REASONS}, neutral_reasons {REASONS}"
)


def row(source, aspect, p, n, u, reasons=()):
    return (source, aspect, p, n, u, p + n + u, "positive", list(reasons), [], [])


def documents(path):
    return [json.loads(p.read_text()) for p in sorted(Path(path).rglob("part-*")) if p.suffix == ".txt"]


def test_stats_documents_are_valid_json_and_read_back(spark, tmp_path):
    gold = spark.createDataFrame([row("a", f"x{i}", i, 1, 0, [('so "good"\n', 2)]) for i in range(9)] + [row("lost", "y", 1, 0, 0)], TABLE)
    predicted = spark.createDataFrame([row("a", 'qu"ote', 2, 0, 0)], TABLE)
    about = spark.createDataFrame([("a", 9, "m"), ("b", 0, None)], "source string, num_examples long, model string")
    path = str(tmp_path / "docs")
    write_stats_documents({"gold": gold, "predicted": predicted}, about, path, rows=4)
    docs = documents(path)
    assert len(docs) == 4 and all(set(d) == {"metadata", "gold", "predicted"} for d in docs)
    assert [d for d in docs if d["metadata"]["source"] == "b"] == [{"metadata": {"source": "b", "num_examples": 0}, "gold": [], "predicted": []}]
    assert sorted(r["aspect"] for d in docs for r in d["gold"]) == [f"x{i}" for i in range(9)]
    assert all(r["positive_reasons"] == [['so "good"\n', 2]] for d in docs for r in d["gold"])
    back = read_stats_documents(spark, path, ("gold", "predicted"), "source:string,num_examples:bigint,model:string")
    got = {(r.table, r.source, r.num_examples, r.model, r.aspect, r.positive, r.total) for r in back.collect()}
    assert got == {("gold", "a", 9, "m", f"x{i}", i, i + 1) for i in range(9)} | {("predicted", "a", 9, "m", 'qu"ote', 2, 2)}


def test_metrics_come_from_the_pass_that_writes(spark, tmp_path):
    rows = spark.range(10).select("id", (F.col("id") % 2).alias("tp"), F.lit(1).alias("n"))
    seen = write_measured(rows, lambda d: d.write.csv(str(tmp_path / "rows")), {"rows": F.count(F.lit(1)), "tp": F.sum("tp"), "n": F.sum("n")})
    assert seen == {"rows": 10, "tp": 5, "n": 10} and spark.read.csv(str(tmp_path / "rows")).count() == 10
    schema = "run long, f1 double"
    for k in (1, 2):
        log_run(spark, {"run": k, "f1": prf(k, 2, 4)["f1"]}, schema, *(str(tmp_path / x) for x in ("json", "csv", "history")))
    last = spark.read.schema(schema).json(str(tmp_path / "json")).collect()
    assert [tuple(r) for r in last] == [(2, 0.666667)] == [tuple(r) for r in spark.read.schema(schema).option("header", True).csv(str(tmp_path / "csv")).collect()]
    assert sorted(r.run for r in spark.read.schema(schema).json(str(tmp_path / "history")).collect()) == [1, 2]
    assert prf(0, 0, 0) == {"precision": 0.0, "recall": 0.0, "f1": 0.0}


def test_totals_of_every_grouping(spark):
    table = spark.createDataFrame([row("a", "screen", 2, 1, 0), row("a", "fan", 1, 0, 0), row("b", "screen", 1, 0, 0), row("b", "fan", 1, 1, 0)], TABLE)
    selected = table.withColumn("slot", F.when(F.col("aspect") == "screen", 1).otherwise(2)).withColumn("role", F.lit(None).cast("string"))
    line = "{}: {} mentions ({} positive, {} negative, {} neutral)."
    reports = spark.createDataFrame([("a", line.format("screen", 3, 2, 1, 0) + " " + line.format("screen", 3, 2, 1, 0)),
                                     ("b", line.format("screen", 1, 1, 0, 0) + " " + line.format("fan", 2, 1, 1, 0))], "source string, report string")
    per, _ = check_structured(reports, table, selected=selected, totals=True)
    per = per.withColumn("style", F.lit("list")).withColumn("status", F.when(F.col("passed"), "accepted").otherwise("rejected"))
    got = {(r.style, r.status): (r.reports, r.passed, r.claims, r.n_duplicate_aspects, r.n_missing_aspects, r.n_warnings) for r in report_totals(per).collect()}
    one, two = (1, 1, 2, 0, 0, 0), (1, 0, 2, 1, 1, 0)
    both = (2, 1, 4, 1, 1, 0)
    assert got == {("list", "accepted"): one, ("list", "rejected"): two, ("all", "accepted"): one, ("all", "rejected"): two, ("list", "all"): both, ("all", "all"): both}


def test_totals_of_the_reason_checker(spark):
    selected = spark.createDataFrame([(*row("a", "screen", 2, 0, 0, [("bright", 2)]), 1), (*row("a", "fan", 1, 0, 0, [("quiet", 1)]), 2)], TABLE + ", slot int")
    reports = spark.createDataFrame([("a", "The screen had 2 mentions, 2 positive and bright. The screen was bright.")], "source string, report string")
    per, _ = check_reasoned(reports, selected, totals=True)
    assert [(r.n_missing_aspects, r.n_repeated_aspects, r.n_warnings) for r in per.collect()] == [(1, 1, 2)]
    total = report_totals(per.withColumn("status", F.lit("x")), by=("status",))
    assert sorted((r.status, r.n_missing_aspects, r.n_repeated_aspects, r.n_duplicate_aspects) for r in total.collect()) == [("all", 1, 1, 0), ("x", 1, 1, 0)]


def test_each_kind_of_corpus_is_routed_and_its_history_written(spark, tmp_path):
    rows = [("c1", "fan", 1, False), ("c2", "fan", 1, False), ("r1", "fan", 1, True), ("r2", "fan", 1, True), ("r2", "screen", 2, True)]
    selected = spark.createDataFrame(rows, "source string, aspect string, slot int, reason_aware boolean")
    passes = {("c1", 1): True, ("c2", 1): False, ("c2", 2): False, ("c2", 3): False, ("r1", 1): False, ("r1", 2): True, ("r2", 1): True}
    calls = []

    def kind(name, warns):
        def generate(mine, attempt):
            calls.append((name, attempt, sorted(r.source for r in mine.select("source").distinct().collect())))
            return mine.select("source", F.concat(F.lit(f"{name}{attempt} "), "source").alias("report")).distinct()

        def check(reports, mine):
            ok = F.lit(False)
            for (source, attempt), good in passes.items():
                ok = ok | ((F.col("report") == f"{name}{attempt} {source}") & F.lit(good))
            return reports.select("source", ok.alias("passed"), F.array(*[F.lit(w) for w in warns]).cast("array<string>").alias("coverage_warnings"))

        return generate, check

    generate, check = routed(kind("count", ()), kind("reason", ("Missing aspects: x",)))
    final, _ = retry_rejects(selected, generate, check, max_attempts=3)
    write_reports(final, str(tmp_path / "reports"))
    got = {r.source: (r.status, r.checker_mode, r.selected_aspects, r.report, [(h.attempt, h.passed, h.report) for h in r.attempt_history])
           for r in read_report_documents(spark, str(tmp_path / "reports")).collect()}
    assert got == {
        "c1": ("accepted", "strict", ["fan"], "count1 c1", [(1, True, "count1 c1")]),
        "c2": ("rejected", "strict", ["fan"], "count3 c2", [(1, False, "count1 c2"), (2, False, "count2 c2"), (3, False, "count3 c2")]),
        "r1": ("accepted_with_warnings", "factual-only", ["fan"], "reason2 r1", [(1, False, "reason1 r1"), (2, True, "reason2 r1")]),
        "r2": ("accepted_with_warnings", "factual-only", ["fan", "screen"], "reason1 r2", [(1, True, "reason1 r2")]),
    }
    assert calls == [("count", 1, ["c1", "c2"]), ("reason", 1, ["r1", "r2"]), ("count", 2, ["c2"]), ("reason", 2, ["r1"]), ("count", 3, ["c2"]), ("reason", 3, [])]
