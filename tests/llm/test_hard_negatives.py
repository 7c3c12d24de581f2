"""Hard negatives against brute force in whole numbers, with odd rows; the lists against a plain scan."""
import math

import numpy as np
from pyspark.sql import functions as F

from aspectra.llm import hard_negatives as hn
from aspectra.llm.hard_negatives import Best, Lists, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id long, dim int, low long, score double"


def rows_of(odd=True, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, 8))
    rows = [(i, (base[i % 12] + 0.4 * rng.standard_normal(8)).astype(np.float32).tolist(), i % 4) for i in range(260)]
    rows += [(1000 + i, rows[7][1], 3 - i % 2) for i in range(40)]  # ties
    if odd:
        nan, inf = float("nan"), float("inf")
        rows += [(2000, None, 0), (2001, [nan] * 8, 1), (2002, [inf] + [1.0] * 7, 1), (2003, [None] + [1.0] * 7, 1), (2004, rows[1][1], None), (None, rows[2][1], 0)]
        rows += [(2010, [0.0] * 8, 0), (2020, [], 0), (2021, [], 1), (2030, [1.0, 2.0], 0), (2031, [1.0, 1.9], 1), (2032, [1.0, 2.1], 0), (2040, [1e30] * 8, 2), (0, rows[0][1], 0), (3, rows[9][1], 2)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4.0) for r in rows], SCHEMA)


def brute(rows, k=5):
    top = hn.LARGEST
    known = sorted({(i, label, tuple(max(-top, min(top, math.floor(256.0 * x))) for x in v)) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    anchors = {}
    for r in known:
        if r[0] % 10 == 0:
            anchors.setdefault(r[0], r)
    out = []
    for a, label, v in anchors.values():
        scored = [(sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in known if i != a and len(w) == len(v)]
        positives = sorted((-s, i) for s, i, other in scored if other == label)[:k]
        for p, pid in positives:
            fit = sorted((-s, i) for s, i, other in scored if other != label and 80 * -p <= 100 * s <= 100 * -p)[:k]
            out += [(a, pid, r, i, -p, -s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows):
    return sorted(map(tuple, hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0, F.col("label")).collect()))


def test_matches_brute_force(spark):
    rows = rows_of()
    want = brute(rows)
    assert mined(spark, rows) == want and len(want) > 300
    assert any(r[0] == 2030 for r in want)


def test_blocks_and_chains_give_the_same(spark, monkeypatch):
    rows = rows_of(odd=False)
    monkeypatch.setattr(hn, "BLOCK_VALUES", 8)  # blocks of 64 rows
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(hn, "CHAIN", 2)
    assert mined(spark, rows) == brute(rows)


def test_half_the_rows_share_a_vector(spark):
    rows = rows_of(odd=False)
    rows += [(5000 + i, rows[20][1], i % 4) for i in range(len(rows))]
    assert mined(spark, rows) == brute(rows)


def test_lists_stop_early_and_miss_nothing():
    rng = np.random.default_rng(9)
    x = np.floor(256 * rng.standard_normal((5000, 3)))
    lists, seen_all = Lists(x), []
    for anchor in np.floor(256 * rng.standard_normal((20, 3))):
        window, seen = Best(5, -np.inf, np.inf), 0
        for rows, scores, threshold in lists.read(anchor):
            assert np.array_equal(scores, x[rows] @ anchor)
            window.add(scores, rows)
            seen += len(rows)
            if threshold < window.need():
                break
        assert window.scores.tolist() == sorted((x @ anchor).tolist(), reverse=True)[:5]
        seen_all.append(seen)
    assert np.mean(seen_all) < 1500


def test_empty_and_single(spark):
    df = table(spark, rows_of())
    ask = (F.col("vec_id") % 10 == 0, F.col("label"))
    assert hard_negatives(df.limit(0), *ask).count() == 0
    assert hard_negatives(df.where("vec_id = 10"), *ask).count() == 0


def test_registered_query_has_the_contract_columns(spark, sf_dir):
    import __spark_entry__ as entry

    df = entry.queries()["op11_hard_negatives"](spark, sf_dir)
    assert df.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert df.count() > 0
