"""Split/sample properties: complete, disjoint, deterministic; leakage audit counts overlaps."""
from pyspark.sql import Row
from pyspark.sql import functions as F

import hashlib
import math

import pytest

from aspectra.operators.splits import exact_split, hash_split, leakage_audit, overlap_matrix, seeded_sample


def test_hash_split_complete_disjoint_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = hash_split(df, "k", valid_ratio=0.15, test_ratio=0.15)
    b = hash_split(df.repartition(7), "k", valid_ratio=0.15, test_ratio=0.15)
    ra = {r.k: r.split for r in a.collect()}
    rb = {r.k: r.split for r in b.collect()}
    assert ra == rb and len(ra) == 5000  # same assignment under any partitioning
    share = {s: sum(1 for v in ra.values() if v == s) / 5000 for s in ("train", "valid", "test")}
    assert abs(share["test"] - 0.15) < 0.03 and abs(share["valid"] - 0.15) < 0.03


def test_seeded_sample_is_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s1 = [r.k for r in seeded_sample(df, "k", 25).collect()]
    s2 = [r.k for r in seeded_sample(df.repartition(5), "k", 25).collect()]
    assert sorted(s1) == sorted(s2) and len(set(s1)) == 25


def test_leakage_audit_counts_overlap(spark):
    items = spark.createDataFrame([Row(text=t, split=s) for t, s in
                                   [("a", "train"), ("b", "train"), ("a", "test"), ("c", "test"), ("c", "valid")]])
    bench = spark.createDataFrame([Row(text="c"), Row(text="z")])
    got = {r.check: r.n for r in leakage_audit(items, benchmark=bench).collect()}
    assert got["overlap:test/train"] == 1 and got["overlap:test/valid"] == 1
    assert got["overlap:train/valid"] == 0  # checked and clean
    assert got["distinct_texts:train"] == 2 and got["benchmark_in_items"] == 1


def test_leakage_audit_of_nulls_repeats_and_nothing(spark):
    rows = [("a", "train"), ("a", "train"), (None, "train"), (None, "test"), ("", "test"), ("b", None), ("a", "test")]
    bench = spark.createDataFrame([(t, 1) for t in (None, "", "b", "b", "z")], "text string, split int")
    items = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, split string, x int, y int")
    got = {r.check: r.n for r in leakage_audit(items, benchmark=bench).collect()}
    assert got == {"distinct_texts:train": 2, "distinct_texts:test": 3, None: 1, "overlap:test/train": 2, "benchmark_in_items": 2}
    assert [tuple(r) for r in leakage_audit(items.limit(0), benchmark=bench).collect()] == [("benchmark_in_items", 0)]


@pytest.mark.parametrize(("n", "bits"), [(0, 4), (1, 4), (7, 1), (997, 3), (997, 16), (2000, 0)])
def test_exact_split_sizes_and_order(spark, n, bits):
    df = spark.range(n).selectExpr("id AS k", "id % 3 AS extra")
    got = {r.k: r.split for r in exact_split(df.repartition(5), "k", 0.2, 0.1, bits=bits).collect()}
    test = math.ceil(n * 0.1 - 1e-9)
    valid = math.ceil((n - test) * (0.2 / 0.9) - 1e-9)
    order = sorted(range(n), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    assert got == {k: "test" if i < test else "valid" if i < test + valid else "train" for i, k in enumerate(order)}


def test_exact_split_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(1, "a")] * 500 + [(1, f"b{i}") for i in range(300)] + [(None, "c")] * 200, "k int, v string")
    once = [sorted((str(r.k), r.v, r.split) for r in exact_split(df.repartition(p), "k", 0.15, 0.15).collect()) for p in (1, 6)]
    assert once[0] == once[1]
    sizes = {s: sum(r[2] == s for r in once[0]) for s in ("train", "valid", "test")}
    assert sizes == {"train": 700, "valid": 150, "test": 150}


def test_overlap_matrix_counts_pairs_and_zeros(spark):
    rows = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "y"), ("b", "z"), ("c", "y"), ("c", "x"), ("d", "w"), (None, "x"), ("a", None)]
    got = {(r.a, r.b): r.shared for r in overlap_matrix(spark.createDataFrame(rows, "g string, v string"), "g", "v").collect()}
    values = {g: {v for h, v in rows if h == g and v} for g in "abcd"}
    assert got == {(p, q): len(values[p] & values[q]) for p in "abcd" for q in "abcd" if p <= q}
