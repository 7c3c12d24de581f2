"""Per-aspect sentiment tables (A1, A2), top reasons (W1) and display order.

Shape of the plan for A2, chosen for skew: mentions are first pre-aggregated to
(group, aspect, sentiment, reason) with a map-side partial aggregate, so a hot aspect
costs one row per *distinct* opinion, never one per mention. The top-N window over those counts has a
group limit, so each task sends at most N reasons of an aspect and sentiment; one grouping by aspect sums
the counts, partly in each task, and collects only those reasons.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aspectra.functions.text import SENTIMENTS, norm_key

REASON_FIELDS = tuple(f"{s}_reasons" for s in SENTIMENTS)


def majority_expr(pos="positive", neg="negative", neu="neutral") -> Column:
    """Largest count wins; ties go positive, then negative, then neutral."""
    p, n, u = F.col(pos), F.col(neg), F.col(neu)
    return (
        F.when((p >= n) & (p >= u), F.lit("positive"))
        .when(n >= u, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def _valid_records(records: DataFrame, aspect: str, sentiment: str) -> DataFrame:
    return records.withColumn("_key", norm_key(aspect)).filter(
        (F.col("_key") != "") & F.col(sentiment).isin(*SENTIMENTS)
    )


def aspect_sentiment(
    records: DataFrame,
    aspect: str = "aspect",
    sentiment: str = "sentiment",
    group_cols: Sequence[str] = (),
    min_mentions: int = 1,
) -> DataFrame:
    """A1: one row per (group, aspect) with positive/negative/neutral/total/majority."""
    g = list(group_cols)
    counts = (
        _valid_records(records, aspect, sentiment)
        .groupBy(*g, F.col("_key").alias("aspect"))
        .agg(*[F.count_if(F.col(sentiment) == s).alias(s) for s in SENTIMENTS])
        .withColumn("total", F.col("positive") + F.col("negative") + F.col("neutral"))
        .filter(F.col("total") >= min_mentions)
    )
    return counts.select(*g, "aspect", *SENTIMENTS, "total", majority_expr().alias("majority_sentiment"))


def reason_counts(
    records: DataFrame,
    aspect: str = "aspect",
    opinion: str = "opinion",
    sentiment: str = "sentiment",
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Pre-aggregate: (group, aspect, sentiment, reason, n). Blank reasons are kept (reason='')
    because they still count as mentions."""
    g = list(group_cols)
    return (
        _valid_records(records, aspect, sentiment)
        .groupBy(*g, F.col("_key").alias("aspect"), F.col(sentiment).alias("sentiment"),
                 norm_key(opinion).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_reasons(counts: DataFrame, top_n: int = 10, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rank non-blank reasons within (group, aspect, sentiment) by (n desc, reason);
    keeps rank <= top_n. Spark plans the ``row_number() <= N`` filter as a window group
    limit, so each task trims its candidates before the window shuffle."""
    g = list(group_cols)
    # blank reasons are ranked last and dropped above the window: a filter below it would go down into the
    # counts, which then would be computed apart from those that the totals take
    w = Window.partitionBy(*g, "aspect", "sentiment").orderBy(F.col("reason") == "", F.col("n").desc(), F.col("reason"))
    return counts.withColumn("rk", F.row_number().over(w)).filter((F.col("rk") <= top_n) & (F.col("reason") != ""))


def aspect_reasons(
    records: DataFrame,
    aspect: str = "aspect",
    opinion: str = "opinion",
    sentiment: str = "sentiment",
    group_cols: Sequence[str] = (),
    top_n: int = 10,
    min_mentions: int = 1,
) -> DataFrame:
    """A2: A1 plus the top-N reasons per sentiment as array<struct<reason, n>>.

    The counts of a mention's reason and the reasons that ``top_reasons`` keeps, whose window has a
    group limit, meet in one grouping by aspect: its partial aggregation sends a row of totals for each task and
    aspect, and no table is joined."""
    g = list(group_cols)
    keys = [*g, "aspect"]
    counts = reason_counts(records, aspect, opinion, sentiment, g)
    part = lambda s: F.when(F.col("sentiment") == s, F.col("n")).alias(s)
    kept = lambda s: F.when(F.col("sentiment") == s, F.struct("rk", "reason", "n")).alias(f"_{s}")
    rows = counts.select(*keys, *[part(s) for s in SENTIMENTS]).unionByName(
        top_reasons(counts, top_n, g).select(*keys, *[kept(s) for s in SENTIMENTS]), allowMissingColumns=True)
    table = rows.groupBy(*keys).agg(
        *[F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(s) for s in SENTIMENTS],
        *[F.array_sort(F.collect_list(f"_{s}")).alias(f"_{s}") for s in SENTIMENTS],
    ).withColumn("total", F.col("positive") + F.col("negative") + F.col("neutral")).filter(F.col("total") >= min_mentions)
    cols = [F.col(c) for c in keys]
    for s in SENTIMENTS:
        cols += [F.col(s), F.transform(f"_{s}", lambda x: F.struct(x["reason"].alias("reason"), x["n"].alias("n"))).alias(f"{s}_reasons")]
    return table.select(*cols, "total", majority_expr().alias("majority_sentiment"))


def render_reasons(c) -> Column:
    """Array of (reason, n) to one comparable string ``reason:n,reason:n``."""
    return F.array_join(F.transform(c, lambda x: F.concat(x["reason"], F.lit(":"), x["n"].cast("string"))), ",")


def with_rendered_reasons(df: DataFrame) -> DataFrame:
    return df.select(
        *[render_reasons(F.col(c)).alias(c) if c in REASON_FIELDS else F.col(c) for c in df.columns]
    )


def order_by_total(df: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """T1 (sink only): (group, -total, aspect)."""
    return df.orderBy(*group_cols, F.col("total").desc(), F.col("aspect"))


def top_aspects(df: DataFrame, n: int = 10) -> DataFrame:
    """Head of the table in display order (planned as TakeOrderedAndProject)."""
    return df.orderBy(F.col("total").desc(), F.col("aspect")).limit(n)
