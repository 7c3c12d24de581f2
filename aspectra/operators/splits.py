"""Deterministic sampling and splitting (T5, T6) and the leakage audit.

Both use a seeded hash of the row key instead of a random shuffle: the assignment of a row
never depends on partitioning, executor loss/retry or arrival order (streaming-safe).
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aspectra.functions.text import col_
from aspectra.plans.materialize import materialize


def hash_unit(key, seed: int = 42) -> Column:
    """Uniform [0, 1) from the first 8 hex digits of md5('<seed>:<key>')."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), col_(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_split(df: DataFrame, key: str, valid_ratio: float = 0.15, test_ratio: float = 0.15, seed: int = 42,
               out: str = "split") -> DataFrame:
    """train/valid/test by hash bucket; test share = test_ratio, valid share = valid_ratio
    (the reference rescales valid by 1/(1-test) inside train+valid, which gives the same overall share)."""
    if not (0 <= test_ratio < 1 and 0 <= valid_ratio and valid_ratio + test_ratio < 1):
        raise ValueError("ratios must satisfy 0 <= valid, 0 <= test, valid + test < 1")
    u = hash_unit(key, seed)
    return df.withColumn(
        out,
        F.when(u < test_ratio, F.lit("test")).when(u < test_ratio + valid_ratio, F.lit("valid")).otherwise(F.lit("train")),
    )


def exact_split(df: DataFrame, key: str, valid_ratio: float = 0.15, test_ratio: float = 0.15, seed: int = 42, out: str = "split", bits: int = 16) -> DataFrame:
    """T6 with exact sizes: ceil(n * test_ratio) test rows, of the others ceil(rest * valid_ratio /
    (1 - test_ratio)) valid ones, the rest train; rows in order of their seeded hash, then key.

    The two places where the order is cut are found by counting rows per hash prefix (``bits``
    bits, so at most 2**bits counts); only rows whose prefix holds a cut are ranked, all
    others fall to one side by their prefix. No global sort. Rows that repeat a key are ordered by a
    hash of all their columns; equal rows may fall to either side, but as many of them each time.
    An empty table stays empty.
    """
    if not (0 <= test_ratio < 1 and 0 <= valid_ratio and valid_ratio + test_ratio < 1):
        raise ValueError("ratios must satisfy 0 <= valid, 0 <= test, valid + test < 1")
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(col_(key).cast("string"), F.lit(""))))
    prefix = F.shiftright(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), 32 - bits)
    rows = df.withColumns({"_h": h, "_p": prefix, "_x": F.xxhash64(*df.columns)})
    counts = {r["_p"]: r["count"] for r in rows.groupBy("_p").count().collect()}  # at most 2**bits
    n = sum(counts.values())
    n_test = math.ceil(n * test_ratio - 1e-9)
    cuts = [n_test, n_test + math.ceil((n - n_test) * (valid_ratio / (1 - test_ratio)) - 1e-9)]
    before, at, total = {}, [], 0
    for p in sorted(counts):
        if any(total < c < total + counts[p] for c in cuts):
            before[p] = total
        at.append((total, p))
        total += counts[p]
    # the first prefix that lies wholly behind a cut
    limits = [next((p for start, p in at if start >= c), 1 << bits) for c in cuts]
    side = lambda place, first, second: F.when(place < first, "test").when(place < second, "valid").otherwise("train")
    whole = rows.where(~F.col("_p").isin(*before)) if before else rows
    whole = whole.withColumn(out, side(F.col("_p"), *limits))
    for p, start in before.items():  # at most two prefixes
        order = Window.partitionBy("_p").orderBy("_h", key, "_x")
        mine = rows.where(F.col("_p") == p).withColumn(out, side(F.row_number().over(order) - 1 + F.lit(start), *cuts))
        whole = whole.unionByName(mine)
    return whole.drop("_h", "_p", "_x")


def overlap_matrix(items: DataFrame, group: str, value: str) -> DataFrame:
    """(a, b, shared): how many distinct values the groups ``a`` and ``b`` have in common, for every
    pair of groups a <= b, 0 included; on the diagonal the distinct values of a group.

    For corpora by text, and for aspect pools of splits by aspect. Values travel as 128 bits of
    hash. The set of groups of a value is aggregated once, equal sets are counted, and only the
    distinct sets are expanded into pairs. Null groups and values are left out.
    """
    named = items.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    hashed = named.select(F.col(group).alias("g"), F.xxhash64(F.lit(1), value).alias("x"), F.xxhash64(F.lit(2), value).alias("y"))
    sets = hashed.groupBy("x", "y").agg(F.array_sort(F.collect_set("g")).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    pairs = sets.select(F.explode("s").alias("a"), "s", "n").select("a", F.explode("s").alias("b"), "n").where("a <= b")
    names = named.groupBy().agg(F.array_sort(F.collect_set(group)).alias("s"))
    every = names.select(F.explode("s").alias("a"), "s").select("a", F.explode("s").alias("b"), F.lit(0).alias("n")).where("a <= b")
    return pairs.unionByName(every).groupBy("a", "b").agg(F.sum("n").alias("shared"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """T5: the n rows with the smallest seeded hash (planned as a top-k, no full sort)."""
    return df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))).orderBy(
        "_h", key
    ).limit(n).drop("_h")


def leakage_audit(items: DataFrame, text: str = "text", split: str = "split", benchmark: DataFrame | None = None,
                  bench_text: str = "text") -> DataFrame:
    """(check, n) rows — distinct texts per split, texts shared by each split pair, and
    benchmark items whose exact text occurs among the items. Any n > 0 on an overlap row is leakage.

    Texts are compared by 128 bits of hash: one distinct of (split, hash) is shuffled and written, and
    every check reads it. Null texts count as one text of a split; a null benchmark text is no hit.
    Rows with a null split count in a row with a null ``check`` and in the benchmark check."""
    def hashed(df: DataFrame, column: str, *keep: Column) -> DataFrame:
        return df.select(*keep, F.xxhash64(F.lit(1), column).alias("x"), F.xxhash64(F.lit(2), column).alias("y")).distinct()

    d = materialize(hashed(items, text, F.col(split).alias("split")), "leakage-texts")
    per_split = d.groupBy("split").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("distinct_texts:"), "split").alias("check"), "n"
    )
    # Overlap per split pair: the set of splits of each text that occurs in more than one.
    multi = d.groupBy("x", "y").agg(F.array_sort(F.collect_set("split")).alias("splits")).filter(F.size("splits") > 1)
    shared = (
        multi.select(F.explode("splits").alias("a"), "splits")
        .select("a", F.explode("splits").alias("b"))
        .filter(F.col("a") < F.col("b"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # every pair of the few splits has a row, so that 0 says "checked and clean"
    names = d.groupBy().agg(F.array_sort(F.collect_set("split")).alias("names"))
    every = names.select(F.explode("names").alias("a"), "names").select("a", F.explode("names").alias("b")).filter(F.col("a") < F.col("b"))
    pairs = every.join(shared, ["a", "b"], "left").select(
        F.concat(F.lit("overlap:"), "a", F.lit("/"), "b").alias("check"), F.coalesce("n", F.lit(0)).alias("n")
    )
    out = per_split.unionByName(pairs)
    if benchmark is not None:
        b = hashed(benchmark.where(F.col(bench_text).isNotNull()), bench_text)
        hit = b.join(d, ["x", "y"], "left_semi").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(hit.select(F.lit("benchmark_in_items").alias("check"), "n"))
    return out
