"""Representative rows per corpus for a report (T3 count path, T4 reason path, C7 routing).

Per corpus ("group"): candidates are the rows with total >= 10, or all rows when none
has. Input order is the table's display order (-total, aspect); every tie goes to the row
that comes first in it. The count path fills four priority slots (most mentioned, most
positive, most negative, most balanced among the top 10); the reason path chooses each slot
from the top-30 pool excluding rows already chosen. The picks over all rows are partial
aggregates that carry the whole row; the pool is a rank filter, which gets a window group
limit, so a task sends at most 30 rows of a corpus and no corpus is sorted in one place.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aspectra.operators.stats import REASON_FIELDS

# Report roles in slot order.
REPORT_ROLES = ("most_discussed", "strongest_positive", "strongest_negative", "most_divided")
POOL = 30
TOP_DIVIDED = 10


def _has_reasons(df: DataFrame) -> Column:
    present = [f for f in REASON_FIELDS if f in df.columns]
    if not present:
        return F.lit(False)
    return F.greatest(*[F.coalesce(F.size(f) > 0, F.lit(False)) for f in present]) if len(present) > 1 else F.coalesce(
        F.size(present[0]) > 0, F.lit(False)
    )


def _distinct_first(arr: Column) -> Column:
    return F.array_distinct(F.filter(arr, lambda x: x.isNotNull()))


def select_report_rows(table: DataFrame, group_cols: Sequence[str] = ("source",), max_aspects: int = 4) -> DataFrame:
    """(group, slot, role, reason_aware, <table columns>) for the selected rows.

    ``role`` is the slot's role for slots 1-4 (position based, so a skipped duplicate shifts
    later roles, as in the count path) and null after that.
    """
    if max_aspects < 1:
        raise ValueError("max_aspects must be at least 1")
    g = list(group_cols) or ["_all"]
    t = table if group_cols else table.withColumn("_all", F.lit(0))
    k = max(POOL, max_aspects)
    item = F.struct(*[c for c in table.columns if c not in group_cols])
    ten, reasons = F.col("total") >= 10, _has_reasons(t)
    # rows of 10 mentions or more come first in every order; without any, all rows compete
    strongest = lambda c: F.min_by(item, F.struct(~ten, -F.col(c), -F.col("total"), F.col("aspect")))
    per = t.groupBy(*g).agg(
        F.when(F.bool_or(ten), F.bool_or(ten & reasons)).otherwise(F.bool_or(reasons)).alias("reason_aware"),
        strongest("positive").alias("c2"), strongest("negative").alias("c3"),
    )
    rank = F.row_number().over(Window.partitionBy(*g).orderBy(F.col("total").desc(), F.col("aspect")))
    top = t.withColumn("_r", rank).filter(F.col("_r") <= k).groupBy(*g).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_r").alias("r"), item.alias("row")))).alias("_top")
    )
    d = per.join(top, g)
    d = d.withColumn("_top", F.filter("_top", lambda x: (x["row"]["total"] >= 10) | (F.get("_top", 0)["row"]["total"] < 10)))
    name = lambda x: x["row"]["aspect"]
    part = lambda x, c: F.try_divide(c.cast("double"), x["row"]["total"].cast("double"))
    gap = lambda x: F.abs(x["row"]["positive"] - x["row"]["negative"])

    def best(arr, *keys):
        """Aspect of the item with the smallest keys; earlier rank on ties."""
        return F.array_min(F.transform(arr, lambda x: F.struct(*[f(x).alias(f"k{i}") for i, f in enumerate(keys)], x["r"], name(x).alias("aspect"))))["aspect"]

    pool = F.filter("_top", lambda x: x["r"] <= POOL)
    d = d.withColumn("c1", name(F.get("_top", 0))).withColumn("_pool", pool)
    d = d.withColumn("c4", best(F.filter("_top", lambda x: x["r"] <= TOP_DIVIDED), gap, lambda x: -x["row"]["total"]))
    # reason path: each slot excludes the rows already chosen
    rest = lambda *taken: F.filter("_pool", lambda x: ~F.array_contains(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in taken]), name(x)))
    d = d.withColumn("p2", F.when(F.lit(max_aspects) > 1, best(rest("c1"), lambda x: -part(x, x["row"]["positive"]), lambda x: -x["row"]["total"])))
    d = d.withColumn("p3", F.when(F.lit(max_aspects) > 2, best(rest("c1", "p2"), lambda x: -part(x, x["row"]["negative"]), lambda x: -x["row"]["total"])))
    d = d.withColumn("p4", F.when(F.lit(max_aspects) > 3, best(rest("c1", "p2", "p3"), lambda x: part(x, gap(x)), lambda x: -x["row"]["total"])))
    fill = F.transform(F.filter("_top", lambda x: x["r"] <= max_aspects), name)
    chosen = F.when(F.col("reason_aware"), F.array("c1", "p2", "p3", "p4")).otherwise(F.array(F.col("c1"), F.col("c2.aspect"), F.col("c3.aspect"), F.col("c4")))
    rows = F.concat(F.transform("_top", lambda x: x["row"]), F.array("c2", "c3"))
    d = d.select(
        *g, "reason_aware", rows.alias("_rows"), F.posexplode(F.slice(_distinct_first(F.concat(chosen, fill)), 1, max_aspects)).alias("_i", "_aspect"),
    )
    roles = F.array(*[F.lit(r) for r in REPORT_ROLES])
    out = d.select(
        *g, (F.col("_i") + 1).alias("slot"), F.get(roles, F.col("_i")).alias("role"), "reason_aware",
        F.get(F.filter("_rows", lambda x: x["aspect"] == F.col("_aspect")), 0).alias("_row"),
    )
    return out.select(*group_cols, "slot", "role", "reason_aware", "_row.*")
