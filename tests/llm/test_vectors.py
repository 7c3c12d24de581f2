import numpy as np

from aspectra.llm.ann import balanced_parts, fit, neighbours, search
from aspectra.llm.embedding_dedup import near_duplicates
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, cid long, part int, score double, root long"


def table(spark, seed=11, odd=True):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        base = rng.standard_normal((60, 16))
        dense = rng.standard_normal(16) + 0.05 * rng.standard_normal((50, 16))
        near = base[:20] + 0.02 * rng.standard_normal((20, 16))
        for x in np.concatenate([base, near, dense, base[:5], base[:5]]):
            rows.append((len(rows), x.astype(np.float32).tolist(), label))
    if odd:
        nan, inf = float("nan"), float("inf")
        rows += [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [nan] * 16, 0), (1003, [1.0] * 15 + [inf], 1), (1004, [None] + [1.0] * 15, 1), (1005, [], 0)]
        rows += [(1006, rows[0][1], None), (1007, rows[0][1][:8], 0), (1008, rows[0][1][:8], 0), (None, rows[3][1], 0), (4, rows[4][1], 0), (1009, [1e30] * 16, 0), (1010, [1e-30] * 16, 0)]
    return spark.createDataFrame([(*r, 1, 2, 3.0, 4) for r in rows], SCHEMA), rows


def good(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_links_match_brute_force(spark):
    df, rows = table(spark)
    unit = [np.array(v) / np.linalg.norm(v) if good(v) and label is not None else None for _, v, label in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    comp = [r[0] for r in rows]
    for _ in range(n):
        new = [min([c for c in [comp[i], *[comp[j] for j in links[i]]] if c is not None], default=None) for i in range(n)]
        if new == comp:
            break
        comp = new
    want = sorted(((r[0], len(k), c, r[0] is not None and r[0] == c) for r, k, c in zip(rows, links, comp)), key=str)
    got = sorted(map(tuple, near_duplicates(df, 0.98, passes=12, window=16).collect()), key=str)
    assert got == want
    assert max(len(k) for k in links) > 40


def cone(tmp_path, n, cosine, pairs=300, dim=64, seed=21):
    """One label: vectors about a common direction, and pairs among them planted at a cosine of 0.982."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    away = rng.standard_normal((n, dim - 1)) / np.sqrt(dim - 1)
    x = unit(np.concatenate([np.full((n, 1), np.sqrt(cosine)), np.sqrt(1 - cosine) * away], axis=1))
    side = rng.standard_normal((pairs, dim))
    side = unit(side - (side * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs])
    x = np.concatenate([x, 0.982 * x[:pairs] + np.sqrt(1 - 0.982**2) * side])
    rows = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dim).cast(pa.list_(pa.float64())), "label": np.zeros(len(x), np.int64)})
    pq.write_table(rows, tmp_path / "cone.parquet", row_group_size=10_000)
    return str(tmp_path / "cone.parquet"), n, pairs


def recall(spark, path, n, pairs):
    """Share of the planted pairs whose two vectors are in one component."""
    got = near_duplicates(spark.read.parquet(path)).where(f"vec_id < {pairs} OR vec_id >= {n}")
    return got.groupBy(F.col("vec_id") % n).agg(F.countDistinct("component_id").alias("k"), F.min("n_links").alias("l")).where("k = 1 AND l > 0").count() / pairs


def planned(spark, n, spread, passes=4, window=128):
    from aspectra.llm.embedding_dedup import plan

    bits, need = plan(F.col("n"), F.col("spread"), 0.98, passes, window)
    return tuple(spark.createDataFrame([(n, spread)], "n long, spread double").select(bits, need).first())


def test_pairs_in_a_narrow_cone_meet(spark, tmp_path):
    assert planned(spark, 100_300, 0.05)[0] == 0
    assert recall(spark, *cone(tmp_path, 100_000, 0.95)) == 1


def test_pairs_in_a_wide_cone_meet_in_passes(spark, tmp_path):
    assert planned(spark, 120_300, 0.5)[0] == 11
    assert recall(spark, *cone(tmp_path, 120_000, 0.5)) == 1


def test_windows_alone_join_pairs_of_a_smaller_group(spark, tmp_path):
    from aspectra.llm.embedding_dedup import projection_links

    path, n, pairs = cone(tmp_path, 9_000, 0.3)
    assert planned(spark, n + pairs, 0.7)[0] > 0
    classes = spark.read.parquet(path).selectExpr("label", "vec_id AS cid", "embedding AS vector")
    found = projection_links(classes, 0.98, runs=False)
    met = found.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).where(f"b = a + {n}").distinct().count()
    assert met == pairs


def test_windows_cross_block_borders(spark):
    from aspectra.llm.components import connected_components
    from aspectra.llm.embedding_dedup import in_windows

    rows = [(0, i, [np.cos(0.5 * i), np.sin(0.5 * i), 0.0] if i not in (9, 10, 13, 20) else [0.0, 0.0, 9.0]) for i in range(24)]
    classes = spark.createDataFrame([(label, i, [float(x) for x in v]) for label, i, v in rows], "label long, cid long, vector array<double>")
    keyed = classes.selectExpr("label", "3 AS dim", "0 AS pass", "cid AS key", "cid")
    unit = [np.array(v) / np.linalg.norm(v) for _, _, v in rows]
    want = {(i, j) for i in range(24) for j in range(i) if i - j <= 3 and unit[i] @ unit[j] >= 0.98}
    assert want == {(10, 9), (13, 10)}
    for block in (3, 5, 10, 11, 13):
        links = connected_components(in_windows(keyed, classes, 0.98, 3, block))
        assert {(r.node, r.root) for r in links.collect()} == {(9, 9), (10, 9), (13, 9)}


def test_bits_and_passes_grow_with_the_group(spark):
    got = [planned(spark, n, 0.5) for n in (100, 10**4, 10**6, 10**8)]
    assert got[0] == (0, 1) and 0 < got[1][0] < got[2][0] < got[3][0] and 4 < got[1][1] < got[2][1] < got[3][1]


def test_blocks_of_a_large_group_count_all(spark):
    from aspectra.llm.embedding_dedup import link_counts

    df, _ = table(spark, odd=False)
    members = df.selectExpr("1L AS root", "vec_id AS cid", "1L AS copies", "cast(embedding AS array<double>) AS vector")
    whole = {r.cid: r.links for r in link_counts(members, 0.98).collect()}
    dealt = {r.cid: r.links for r in link_counts(members, 0.98, block=30).collect()}
    assert whole == dealt and max(whole.values()) > 40


def test_nearest_rows_and_recall(spark):
    df, rows = table(spark)
    got = {}
    for r in search(df, F.col("vec_id") % 5 == 0, k=7, parts=8, target_recall=0.95).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    known = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if i is not None and good(v)}
    asked = [i for i in known if i % 5 == 0]
    assert set(got) == {i for i in asked}
    hits = total = 0
    for q in asked:
        mine = sorted(got[q])
        exact = {i: float((known[q] * v).sum()) for i, v in known.items() if i != q and len(v) == len(known[q])}
        best = sorted(exact, key=lambda i: (-exact[i], i))[:7]
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and all(abs(s - exact[v]) <= 1e-9 * abs(s) for _, v, s in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len({m[1] for m in mine} & set(best))
        total += len(best)
    assert hits / total >= 0.9


def test_ties_keep_k_rows_a_block(spark):
    from aspectra.llm.ann import _search_task

    n = 700
    rows = [(1, 0, 0, q, i, [1.0, 2.0 if i % 2 else 1.0]) for q in (False, True) for i in range(n) if not q or i % 10 == 0]
    tasks = spark.createDataFrame(rows, "part long, rb int, qb int, asks boolean, id long, vector array<double>").coalesce(1).sortWithinPartitions("asks", "id")
    found = {}
    for r in tasks.mapInArrow(_search_task(5), "query_id long, vec_id long, score double").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: sorted(v) for q, v in found.items()} == {q: [1, 3, 5, 7, 9] for q in range(0, n, 10)}


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.standard_normal((60, 8)) * 0.1 + 3 * np.eye(8)[k] for k in range(4)])
    near = neighbours(x, x, 5, True)
    part = balanced_parts(x, near, 4, 1.05, 25, rng)
    assert np.bincount(part, minlength=4).max() <= 63 and (part[near] == part[:, None]).mean() > 0.9
    model = fit(x[rng.permutation(len(x))], parts=4, k=5)
    assert model.recall >= 0.95 and model.probes <= 3


def test_empty_and_tiny_tables(spark):
    df, _ = table(spark)
    assert near_duplicates(df.limit(0)).count() == 0 and search(df.limit(0), F.col("vec_id") > 0).count() == 0
    two = spark.createDataFrame([(20, [1.0, 0.0], 1), (1, [0.5, 2.0], 1)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in search(two, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 1, 0.5)]
    one = two.where("vec_id = 20")
    assert search(one, F.col("vec_id") % 20 == 0).count() == 0
    assert [tuple(r) for r in near_duplicates(one).collect()] == [(20, 0, 20, True)]
