"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length in words. A source's target is met by whole passes over
its documents plus a rest: most of the rest is dealt over the lengths in proportion to their
counts, and a bounded-knapsack dynamic programme over the counts that are left closes the
remaining budget. Which documents of a length are taken is decided by a seeded hash.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aspectra.plans.materialize import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Words that the dynamic programme closes at most.
BUDGET = 1 << 16
#: Slices of a group of equal length, so that no task ranks a whole group.
SLICES = 256


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (key, source_size): ``share`` of all words by weight, at most ``most`` times a source.

    Water filling: in order of cap per weight, a source is capped while its cap does not exceed
    its part of what is left; the others share the rest by weight.
    """
    order = W.orderBy("key")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    all_ = W.partitionBy(F.lit(1))
    t = sources.withColumn("w", w).withColumn("cap", most * F.col("source_size").cast("double"))
    t = t.withColumn("total", share * F.sum("source_size").over(all_)).withColumn("all_w", F.sum("w").over(all_))
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), "key").rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("cap0", F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0))).withColumn("w0", F.coalesce(F.sum("w").over(by_ratio), F.lit(0.0)))
    t = t.withColumn("full", F.col("cap") / F.col("w") <= (F.col("total") - F.col("cap0")) / (F.col("all_w") - F.col("w0")))
    t = t.withColumn("rest", F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(all_), F.lit(0.0)))
    t = t.withColumn("open_w", F.sum(F.when(~F.col("full"), F.col("w"))).over(all_))
    return t.select("key", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("rest") * F.col("w") / F.col("open_w")).alias("target"))


def subset_counts(size: np.ndarray, count: np.ndarray, budget: int, draw: np.ndarray, width: int = BUDGET) -> np.ndarray:
    """How many documents of each length to take so that their words come near ``budget``.

    ``size`` > 0, distinct; ``draw``: seeded order of the lengths. Counts never exceed ``count``.
    """
    total = int((size * count).sum())
    if budget >= total:
        return count.copy()
    take = np.floor(count * (max(0, budget - width) / total)).astype(np.int64)
    rest = budget - int((take * size).sum())
    order = np.argsort(draw, kind="stable")
    while rest > width:  # one more of each length in drawn order, as far as it goes
        fit = order[(take[order] < count[order]) & (size[order] <= rest - width // 2)]
        if not len(fit):
            break
        fit = fit[: max(1, int(np.searchsorted(np.cumsum(size[fit]), rest - width // 2, side="right")))]
        take[fit] += 1
        rest -= int(size[fit].sum())
    if rest <= 0:
        return take
    if rest > width:
        # each length left is over half the rest and two exceed it: none, the nearest one or the two smallest
        left = order[take[order] < count[order]]
        low = left[np.argsort(size[left], kind="stable")]
        picks = [[], *([i] for i in low.tolist()), np.repeat(low[:2], np.minimum(2, (count - take)[low[:2]]))[:2].tolist()]
        best = min(picks, key=lambda p: (abs(int(size[p].sum()) - rest), int(size[p].sum())) if p else (rest, 0))
        np.add.at(take, np.array(best, np.int64), 1)
        return take
    # bounded knapsack: first[s] is the item that first reached the sum s
    aim = min(rest, width)
    top = 2 * aim
    first = np.full(top + 1, -1, np.int32)
    first[0] = 0
    items: list[tuple[int, int, int]] = [(0, 0, 0)]
    for i in order.tolist():
        s, left, piece = int(size[i]), min(int(count[i] - take[i]), top // int(size[i])), 1
        while left > 0 and first[aim] < 0:
            n = min(piece, left)
            left, piece = left - n, piece * 2
            step = n * s
            fresh = np.flatnonzero((first[:-step] >= 0) & (first[step:] < 0)) + step
            if len(fresh):
                first[fresh] = len(items)
                items.append((i, n, step))
        if first[aim] >= 0:
            break
    sums = np.flatnonzero(first >= 0)
    s = int(sums[np.lexsort((sums, np.abs(sums - rest)))[0]])
    while s > 0:
        i, n, step = items[first[s]]
        take[i] += n
        s -= step
    return take


def _plan(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", kind="stable").reset_index(drop=True)
        total, aim = int(pdf["source_size"].iloc[0]), int(round(pdf["target"].iloc[0]))
        passes = min(2, aim // total) if total else 0
        some = (pdf["size"] > 0).to_numpy()
        extra = np.zeros(len(pdf), np.int64)
        if some.any():
            extra[some] = subset_counts(pdf["size"].to_numpy()[some], pdf["n"].to_numpy()[some], max(0, aim - passes * total), pdf["draw"].to_numpy()[some], width)
        if passes == 2:
            extra[:] = 0
        return pdf.assign(passes=passes, extra=extra)[["key", "size", "source_size", "target", "passes", "extra"]]

    return run


def mix(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 5, width: int = BUDGET) -> DataFrame:
    """``carry`` columns of ``docs`` (doc_id, text, source), size, source_size, target, copies and taken.

    One row per row of ``docs``; ``copies`` (0 to 2) is how often the mix takes it, ``taken`` the
    words that gives. Null and blank texts have size 0 and are taken as often as their source has
    whole passes. A null source is a source of its own, after all others. Repeated rows are
    documents of their own; which of them is taken is the same in each run. Source totals are
    kept in one row each, lengths in one row per source and length.
    """
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source"))
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    draw = F.xxhash64(F.lit(seed), "doc_id", "source", F.xxhash64("text"))
    sized = docs.select(*[F.col(c) for c in carry], key.alias("__key"), size.alias("__size"), draw.alias("__draw"), F.pmod(draw, F.lit(SLICES)).cast("int").alias("__slice"))
    if set(carry) <= {"doc_id"}:
        sized = materialize(sized, "mix-sizes")  # the texts are read once
        narrow = sized
    else:
        narrow = materialize(sized.select("__key", "__size", "__slice"), "mix-sizes")
    slices = materialize(narrow.groupBy("__key", "__size", "__slice").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    counts = slices.groupBy(F.col("__key").alias("key"), F.col("__size").alias("size")).agg(F.sum("n").alias("n"))
    sources = counts.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    hist = counts.withColumn("draw", F.xxhash64(F.lit(seed), "key", "size")).join(targets(sources, weights, share, most), "key")
    plan = hist.groupBy("key").applyInPandas(_plan(width), "key string, size long, source_size long, target double, passes long, extra long")
    plan = materialize(plan.select(F.col("key").alias("__key"), F.col("size").alias("__size"), "source_size", "target", "passes", "extra"), "mix-plan")
    before = F.sum("n").over(W.partitionBy("__key", "__size").orderBy("__slice")) - F.col("n")
    quota = slices.join(plan, ["__key", "__size"]).withColumn("quota", F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - before))).drop("n", "extra")
    rank = F.row_number().over(W.partitionBy("__key", "__size", "__slice").orderBy("__draw", *[F.col(c) for c in carry if c == "doc_id"]))
    rows = sized.join(quota, ["__key", "__size", "__slice"]).withColumn("__rank", rank)
    copies = F.col("passes") + (F.col("__rank") <= F.col("quota")).cast("long")
    return rows.select(*carry, F.col("__size").alias("size"), "source_size", "target", copies.alias("copies"), (copies * F.col("__size")).alias("taken"))
