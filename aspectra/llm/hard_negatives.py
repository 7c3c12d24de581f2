"""Hard-negative mining by Fagin's threshold algorithm.

Candidates are dealt into blocks by hash, and a block's components are sorted once per dimension.
An anchor reads those lists in parallel, from the top where its own component is positive and
from the bottom where it is negative. Each row met for the first time is looked up and scored
in whole numbers. No row still unseen can score more than the threshold, the anchor's product with
the values last read; a list is left once the threshold lies strictly below the k-th score of
every window, so no tie is lost. A task reads several blocks in a row and carries the k-th scores
on, which lets it leave the later ones sooner.

Two rounds: the nearest rows of an anchor's own label are its positives; each positive opens a
window of scores, from which the best rows of other labels are taken.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aspectra.llm.batches import column, groups
from aspectra.plans.materialize import materialize

#: Components of a candidate block, anchors of an anchor block, and candidate blocks that a task reads in a row.
BLOCK_VALUES = 1 << 20
BLOCK_ANCHORS = 4096
CHAIN = 8
#: Scaled components stop here, so that 100 times a product of 2**14 of them fits a long.
LARGEST = 1 << 20
#: Sums up to here are exact in doubles.
_EXACT = 1 << 53


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as longs within ``LARGEST`` of 0."""
    at_most = lambda x: F.greatest(F.least(x, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    return F.transform(vector, lambda x: F.floor(at_most(F.lit(float(scale)) * x.cast("double"))).cast("int"))


class Lists:
    """The sorted lists of a block's rows, one per dimension, for reading by score."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, self.order, axis=0)

    def read(self, anchor: np.ndarray, first: int = 8) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(rows not seen before, their scores, threshold for the rest) for list depths that double.

        The last threshold is minus infinity: every row is seen then.
        """
        n = len(self.x)
        used = np.flatnonzero(anchor)
        down = anchor[used] > 0
        seen = np.zeros(n, bool)
        done, depth = 0, min(first, n)
        while True:
            top, low = self.order[n - depth : n - done, used[down]], self.order[done:depth, used[~down]]
            met = np.zeros(n, bool)
            met[top.ravel()] = True
            met[low.ravel()] = True
            if not len(used):
                met[done:depth] = True  # all scores are 0
            met &= ~seen
            seen |= met
            rows = np.flatnonzero(met)
            # a look-up for each row met; for many of them it is one product over the block
            score = self.x[rows] @ anchor if 4 * len(rows) < n else (self.x @ anchor)[rows]
            if depth == n:
                yield rows, score, -np.inf
                return
            last = np.where(down, self.sorted[n - depth, used], self.sorted[depth - 1, used])
            yield rows, score, float(last @ anchor[used])
            done, depth = depth, min(2 * depth, n)


class Best:
    """The ``k`` best (score, id) within [low, high] met so far: higher scores first, ties by smaller id."""

    __slots__ = ("high", "ids", "k", "low", "scores")

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def need(self) -> float:
        """A row that scores less than this changes nothing."""
        return max(self.low, self.scores[-1]) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.need()) & (scores <= self.high)
        if not fit.any():
            return
        s, i = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
        if len(s) > self.k:
            near = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
            s, i = s[near], i[near]
        best = np.lexsort((i, -s))[: self.k]
        self.scores, self.ids = s[best], i[best]


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    x = flat.astype(np.float64).reshape(len(col), -1)
    largest = int(np.abs(flat).max(initial=0))
    return x if largest * largest * x.shape[1] < _EXACT else flat.astype(np.int64).reshape(len(col), -1)


def _settle(lists: Lists, ids: np.ndarray, candidate: np.ndarray, anchor: np.ndarray, windows: list[Best]) -> None:
    """Read ``lists`` until no window can gain from a row that is a candidate."""
    for rows, scores, threshold in lists.read(anchor):
        good = candidate[rows]
        for w in windows:
            w.add(scores[good], ids[rows[good]])
        if all(threshold < w.need() for w in windows):
            return


def _mine_task(k: int, same_label: bool):
    """(anchor, window, id, score) of the best rows in each chain of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, asks = None, None
        state: list[list[Best]] = []

        def found() -> Iterator[pa.RecordBatch]:
            size = [len(w.ids) for ws in state for w in ws]
            if not sum(size):
                return
            which = np.repeat([a for a, ws in enumerate(state) for _ in ws], size)
            nth = np.repeat([i for ws in state for i in range(len(ws))], size)
            ids = np.concatenate([w.ids for ws in state for w in ws])
            scores = np.concatenate([w.scores for ws in state for w in ws]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(asks[0][which]), pa.array(nth.astype(np.int32)), pa.array(ids), pa.array(scores)], ["anchor_id", "nth", "id", "score"])

        for table, cuts in groups(batches, ("dim", "qb", "chain", "cb")):
            values = table.column("vector").combine_chunks()
            keys = np.stack([table.column(c).to_numpy() for c in ("dim", "qb", "chain", "cb")], axis=1)
            ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
            lows, highs = table.column("low").combine_chunks(), table.column("high").combine_chunks()
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                key, x = tuple(keys[a, :3].tolist()), _matrix(values.slice(a, b - a))
                if keys[a, 3] < 0:  # a chain's anchors stand before its blocks
                    if chain is not None:
                        yield from found()
                    chain, asks = key, (ids[a:b], labels[a:b], x)
                    bounds = zip(lows.slice(a, b - a).to_pylist(), highs.slice(a, b - a).to_pylist())
                    state = [[Best(k, float(lo), float(hi)) for lo, hi in zip(*both)] for both in bounds]
                    continue
                if key != chain:
                    continue  # no anchor asks this chain
                cand, label = ids[a:b], labels[a:b]
                lists = None if same_label else Lists(x)  # other labels: one set of lists, own rows passed over
                for mine in np.unique(asks[1]).tolist():
                    part = np.flatnonzero(label == mine) if same_label else np.arange(len(x))
                    if not len(part):
                        continue
                    own = Lists(x[part]) if same_label else lists
                    free = np.ones(len(part), bool) if same_label else label != mine
                    for q in np.flatnonzero(asks[1] == mine).tolist():
                        if state[q]:
                            _settle(own, cand[part], free & (cand[part] != asks[0][q]), asks[2][q].astype(x.dtype), state[q])
        if chain is not None:
            yield from found()

    return run


def _best(rows: DataFrame, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(anchor_id, nth, id, score): the best rows of each window of each anchor, found block by block.

    ``rows``: id, label, dim, vector, cb (block), nq (blocks of anchors); ``anchors``: the same
    with qb (their block), nc (blocks of rows) and the windows' bounds low and high.
    """
    bounds = [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")]
    chain = (F.col("cb") / CHAIN).cast("int")
    cands = rows.select("dim", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"), chain.alias("chain"), "cb", "id", "label", "vector", *bounds)
    chains = F.sequence(F.lit(0), ((F.col("nc") - 1) / CHAIN).cast("int"))
    asks = anchors.select("dim", "qb", F.explode(chains).alias("chain"), F.lit(-1).alias("cb"), "id", "label", "vector", "low", "high")
    at = ["dim", "qb", "chain"]
    tasks = asks.unionByName(cands).repartition(*at).sortWithinPartitions(*at, "cb", "label", "id")
    met = tasks.mapInArrow(_mine_task(k, same_label), "anchor_id long, nth int, id long, score long")
    rank = F.row_number().over(W.partitionBy("anchor_id", "nth").orderBy(F.desc("score"), "id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: vec_id, embedding; ``label``: the label of a row; ``anchors``: where it holds a
    row is an anchor. Scores are inner products of floor(``scale`` * x), and higher ones come
    first, ties by smaller vec_id. An anchor's positives are its first ``positives`` other rows of
    its label. For each, the first ``negatives`` rows of other labels count whose score s keeps
    ``low`` * p <= 100 * s <= ``high`` * p for the positive's score p; a positive without any
    gives no row (so does one with a negative score). Fewer rows than asked for are all given.

    Rows with a null id or label, a null vector or a null or non-finite component take no part;
    scaled components stop at 2**20 either side. Vectors meet those of their own length only,
    empty ones score 0. Equal rows are one row; rows that share a vec_id and differ otherwise
    are each a row, but no row is a candidate of an anchor with its own vec_id, and the smallest
    of such rows by label and vector is the anchor. An empty table gives an empty result.
    """
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = vectors.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & whole)
    rows = taken.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), whole_numbers(F.col("embedding"), scale).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows = materialize(rows.distinct().withColumn("dim", F.size("vector")), "negatives-rows")
    one = rows.where("asks").groupBy("id").agg(F.min(F.struct("label", "vector", "dim")).alias("r")).select("id", "r.*")
    block = F.greatest(F.lit(64), (F.lit(BLOCK_VALUES) / F.greatest("dim", F.lit(1))).cast("int"))
    blocks = lambda df, n, name: df.groupBy("dim").count().select("dim", F.ceil(F.col("count") / n).cast("int").alias(name))
    sizes = materialize(blocks(rows, block, "nc").join(blocks(one, F.lit(BLOCK_ANCHORS), "nq"), "dim"), "negatives-blocks")
    deal = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.col(n)).cast("int")
    cands = rows.join(sizes, "dim").withColumn("cb", deal("nc", 5))
    anchors_ = one.join(sizes, "dim").withColumn("qb", deal("nq", 6))
    far = 1 << 62
    everything = anchors_.withColumns({"low": F.array(F.lit(-far)), "high": F.array(F.lit(far))})
    near = materialize(_best(cands, everything, positives, True).select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # scores are whole numbers: the first and the last one that a window admits
    lo = F.expr(f"CASE WHEN positive_score * {low} % 100 > 0 THEN positive_score * {low} div 100 + 1 ELSE positive_score * {low} div 100 END")
    hi = F.expr(f"CASE WHEN positive_score * {high} % 100 < 0 THEN positive_score * {high} div 100 - 1 ELSE positive_score * {high} div 100 END")
    windows = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("positive_id", lo.alias("low"), hi.alias("high"), "positive_score"))).alias("w"))
    windows = windows.withColumn("w", F.filter("w", lambda w: w["low"] <= w["high"]))
    asking = anchors_.join(windows, anchors_["id"] == windows["anchor_id"]).withColumns({"low": F.col("w.low"), "high": F.col("w.high")})
    asking = materialize(asking.where(F.size("w") > 0), "negatives-windows")
    met = _best(cands, asking.drop("w", "anchor_id"), negatives, False)
    named = asking.select("anchor_id", F.posexplode("w").alias("nth", "w"))
    out = met.join(named, ["anchor_id", "nth"])
    return out.select("anchor_id", F.col("w.positive_id").alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("w.positive_score").alias("positive_score"), F.col("score").alias("negative_score"))
