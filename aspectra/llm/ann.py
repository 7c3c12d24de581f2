"""Approximate nearest neighbours by learned partitions.

Fitting, on a bounded sample: the graph of nearest neighbours is cut into balanced parts
(halves along principal directions, then moves that follow the neighbours' majority while
there is room), and a small neural classifier learns a vector's part and its neighbours' parts.
How many parts a query must visit is measured on sample rows kept aside. Indexing: the
classifier places every row. Search: it routes each query to its most probable parts, whose
rows are compared exactly; crowded parts are dealt into blocks of rows and queries.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aspectra.llm.batches import column, groups
from aspectra.llm.vectors import matrix, usable
from aspectra.plans.materialize import materialize

#: Rows, and queries, of a part that meet in one task.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048
#: Pairs scored again at a time where many rows tie.
RESCORE = 1 << 14


@dataclass(frozen=True)
class Partitions:
    """Classifier weights, the number of parts to visit, and the recall measured at it."""

    weights: tuple[np.ndarray, ...]
    scale: float
    probes: int
    recall: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x * self.scale @ w1 + b1, 0) @ w2 + b2


def neighbours(x: np.ndarray, y: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Places in ``y`` of the ``k`` largest inner products of each row of ``x`` (``own``: x is y, without the row)."""
    out = np.empty((len(x), min(k, len(y) - own)), np.int64)
    for a in range(0, len(x), 512):
        s = x[a : a + 512] @ y.T
        if own:
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 512] = np.argsort(-s, axis=1, kind="stable")[:, : out.shape[1]] if out.shape[1] >= s.shape[1] else np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, room: float, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """A part for each row: few neighbour links cut, no part above ``room`` times the mean."""
    n = len(x)
    sets = [np.arange(n)]
    while len(sets) < parts:
        halves = []
        for s in sets:
            y, v = x[s] - x[s].mean(axis=0), rng.standard_normal(x.shape[1])
            for _ in range(8):
                v = y.T @ (y @ v)
                v /= np.linalg.norm(v) + 1e-30
            order = s[np.argsort(y @ v, kind="stable")]
            halves += [order[: len(s) // 2], order[len(s) // 2 :]]
        sets = halves
    part = np.empty(n, np.int64)
    for i, s in enumerate(sets):
        part[s] = i
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    most = int(np.ceil(room * n / parts))
    for _ in range(rounds):
        votes = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        movers = np.flatnonzero((gain > 0) & (rng.random(n) < 0.5))
        size = np.bincount(part, minlength=parts)
        for i in movers[np.argsort(-gain[movers], kind="stable")].tolist():
            if size[best[i]] < most:
                size[best[i]] += 1
                size[part[i]] -= 1
                part[i] = best[i]
    return part


def _classifier(x: np.ndarray, target: np.ndarray, hidden: int, epochs: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """Weights of one hidden layer, trained by Adam on the cross entropy to soft targets."""
    w = [rng.standard_normal((x.shape[1], hidden)) * 2 / np.sqrt(x.shape[1]), np.zeros(hidden), rng.standard_normal((hidden, target.shape[1])) / np.sqrt(hidden), np.zeros(target.shape[1])]
    mean, square, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for s in range(0, len(x), 256):
            i = order[s : s + 256]
            h = np.maximum(x[i] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (p / p.sum(axis=1, keepdims=True) - target[i]) / len(i)
            dh = (dz @ w[2].T) * (h > 0)
            t += 1
            for q, g, m, v in zip(w, (x[i].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0)), mean, square):
                g = g + 1e-4 * q
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= 2e-3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return tuple(w)


def fit(sample: np.ndarray, parts: int = 64, k: int = 20, links: int = 10, target_recall: float = 0.95, room: float = 1.05, hidden: int = 128, epochs: int = 25, seed: int = 23) -> Partitions:
    """Learn the parts from ``sample`` (rows in any order); ``parts`` is a power of two,
    halved while there are fewer than four rows for each.

    A tenth of the sample asks for its ``k`` nearest among the rest; the fewest parts whose
    visits find ``target_recall`` of them is the number of probes.
    """
    rng = np.random.default_rng(seed)
    scale = 1 / max(float(np.sqrt((sample * sample).mean())), 1e-300)
    aside = len(sample) // 10
    ask, x = sample[:aside], sample[aside:]
    while 4 * parts > len(x) and parts > 1:
        parts //= 2
    near = neighbours(x, x, links, True)
    part = balanced_parts(x, near, parts, room, 25, rng)
    target = 0.7 * np.eye(parts)[part]
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), part[near.ravel()]), 0.3 / max(1, near.shape[1]))
    model = Partitions(_classifier(x * scale, target, hidden, epochs, rng), scale, parts, 1.0)
    if not aside:
        return model
    rank = np.argsort(np.argsort(-model.logits(ask), axis=1, kind="stable"), axis=1)
    placed = model.logits(x).argmax(axis=1)
    found = np.take_along_axis(rank, placed[neighbours(ask, x, k, False)], axis=1)
    recall = np.array([(found < m).mean() for m in range(1, parts + 1)])
    probes = int(np.argmax(recall >= target_recall)) + 1
    return Partitions(model.weights, scale, probes, float(recall[probes - 1]))


def _route_task(model: Partitions | None, dim: int, probes: int):
    """part of each row (probes = 1), or a row for each part that a query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = column(batch, "vector").value_lengths().to_numpy(zero_copy_only=False)
            row, part = np.arange(len(size)), -size.astype(np.int64)  # other lengths: a part of their own
            main = np.flatnonzero(size == dim)
            if model is not None and len(main):
                top = np.argsort(-model.logits(matrix(column(batch.take(pa.array(main)), "vector"))), axis=1, kind="stable")[:, :probes]
                rest = np.flatnonzero(size != dim)
                row = np.concatenate([rest, np.repeat(main, top.shape[1])])
                part = np.concatenate([part[rest], top.ravel()])
            out = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([column(out, "id"), column(out, "vector"), pa.array(part)], ["id", "vector", "part"])

    return run


def _search_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in groups(batches, ("part", "rb", "qb")):
            asks, ids = table.column("asks").to_numpy(), table.column("id").to_numpy()
            vectors = table.column("vector").combine_chunks()
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                q, x, i = asks[a:b], matrix(vectors.slice(a, b - a)), ids[a:b]
                rows, row_ids, qs, q_ids = x[~q], i[~q], x[q], i[q]
                if not len(rows) or not len(qs):
                    continue
                for c in range(0, len(qs), 256):
                    s = qs[c : c + 256] @ rows.T
                    s[q_ids[c : c + 256, None] == row_ids[None, :]] = -np.inf
                    if s.shape[1] > k:  # all within rounding of the k-th are scored again, then the first k kept
                        kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                        keep = s >= (kth - 1e-9 * (1 + np.abs(kth)))[:, None]
                    else:
                        keep = np.ones(s.shape, bool)
                    u, v = np.nonzero(keep & (s > -np.inf))
                    score = np.concatenate([np.zeros(0)] + [(qs[c + u[t : t + RESCORE]] * rows[v[t : t + RESCORE]]).sum(axis=1) for t in range(0, len(u), RESCORE)])
                    order = np.lexsort((row_ids[v], -score, u))
                    order = order[np.arange(len(u)) - np.searchsorted(u, u) < k]
                    u, v, score = u[order], v[order], score[order]
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[c + u]), pa.array(row_ids[v]), pa.array(score)], ["query_id", "vec_id", "score"])

    return run


def _blocks(df: DataFrame, sizes: dict[int, int], block: int) -> Column:
    """How many blocks the rows of a part are dealt into."""
    pairs = [F.lit(x) for p, n in sizes.items() for x in (p, -(-n // block))]
    return F.coalesce(F.create_map(*pairs)[F.col("part")], F.lit(1)) if pairs else F.lit(1)


def search(vectors: DataFrame, queries: Column, k: int = 20, sample_rows: int = 6000, seed: int = 23, **settings) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row where ``queries`` holds.

    ``vectors``: vec_id, embedding. Nearness is the inner product in doubles; a query is no
    candidate for itself (rows with its vec_id); ties go to the smaller vec_id; ranks count from
    1; a query with fewer candidates gets all that its parts hold. Rows with a null id and
    vectors that are null, empty, zero or hold null or non-finite components take no part;
    vectors of another length than most are compared among themselves. Equal rows are one row.
    The index is fitted on at most ``sample_rows`` rows picked by seeded hash.
    """
    usable_rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = usable_rows.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = materialize(rows.distinct(), "ann-rows")
    common = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 0
    drawn = rows.where(F.size("vector") == dim).select("vector").orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(sample_rows)
    sample = matrix(drawn.toArrow().column("vector").combine_chunks()) if dim else np.zeros((0, 0))
    model = fit(sample, k=k, seed=seed, **settings) if len(sample) > 1 else None
    placed = rows.select("id", "vector").mapInArrow(_route_task(model, dim, 1), "id long, vector array<double>, part long")
    routed = rows.where("asks").select("id", "vector").mapInArrow(_route_task(model, dim, model.probes if model else 1), "id long, vector array<double>, part long")
    placed, routed = materialize(placed, "ann-index"), materialize(routed, "ann-queries")
    # a count for each part: a bounded number of parts, and one for each odd vector length
    n_rows = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    n_asks = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}
    rbs, qbs = _blocks(placed, n_rows, BLOCK_ROWS), _blocks(placed, n_asks, BLOCK_QUERIES)
    spread = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    deal = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    targets = placed.select("part", deal(rbs).alias("rb"), spread(qbs).alias("qb"), F.lit(False).alias("asks"), "id", "vector")
    asking = routed.select("part", spread(rbs).alias("rb"), deal(qbs).alias("qb"), F.lit(True).alias("asks"), "id", "vector")
    tasks = targets.unionByName(asking).repartition("part", "rb", "qb").sortWithinPartitions("part", "rb", "qb", "asks", "id")
    found = tasks.mapInArrow(_search_task(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
