"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Training (bounded sample of labelled rows, both bounds are parameters): the documents' hashed
n-grams are counted by class with one Spark aggregation; each n-gram gets the log ratio of its
smoothed class frequencies; the most telling n-grams, as presence times ratio, feed a logistic
regression. Scoring reads every whole text once, in Arrow batches.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectra.llm.batches import column, forget, release, slices, text_views
from aspectra.plans.materialize import materialize

#: n-gram lengths in code points and size of the hash space.
SIZES = (3, 4, 5, 6)
HASH_BITS = 20
#: Tasks that read the training sample, which is bounded whatever the corpus.
SAMPLE_TASKS = 16
#: Code points hashed at a time, however long a text is.
WINDOW = 1 << 16


@dataclass(frozen=True)
class NgramModel:
    """slot[h]: place of hash h among the kept n-grams or -1; weight: ratio times coefficient."""

    slot: np.ndarray
    weight: np.ndarray
    bias: float


def _code_points(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(folded code points of all rows, offsets): lower case, ASCII signs and white space as one space sign."""
    low = pc.utf8_lower(col.fill_null("") if col.null_count else col)
    raw, offs = text_views(low)
    cps = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    fold = np.arange(128, dtype=np.uint32)
    fold[[c for c in range(128) if not chr(c).isalnum()]] = 32
    cps = np.where(cps < 128, fold[np.minimum(cps, 127)], cps).astype(np.uint32)
    return cps, starts[offs]


def _hits(cps: np.ndarray, offs: np.ndarray, slot: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, sorted; feature: the hash, or its slot where one is given."""
    keys = [np.zeros(0, np.int64)]
    for a in range(0, len(cps), WINDOW):
        piece = cps[a : a + WINDOW + max(SIZES) - 1]
        h = np.zeros(len(piece), np.uint32)
        for n in range(1, min(max(SIZES), len(piece)) + 1):
            h = (h[: len(piece) - n + 1] + piece[n - 1 :]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            if n not in SIZES:
                continue
            f = (h[:WINDOW] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - HASH_BITS)
            at = np.arange(len(f))
            if slot is not None:
                f = slot[f]
                at = np.flatnonzero(f >= 0)
                f = f[at]
            at += a
            row = np.searchsorted(offs, at, side="right") - 1
            whole = at + n <= offs[row + 1]
            keys.append(np.unique(row[whole].astype(np.int64) << HASH_BITS | f[whole].astype(np.int64)))
    key = np.unique(np.concatenate(keys))
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1)


def _features_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        for part in slices(batch, "text", 1 << 18):
            cps, offs = _code_points(column(part, "text"))
            row, f = _hits(cps, offs, None)
            ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            feats = pa.ListArray.from_arrays(pa.array(ends), pa.array(f.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([column(part, "y"), feats], ["y", "f"])


def _logistic(x: list[np.ndarray], y: np.ndarray, w: np.ndarray, scale: np.ndarray, l2: float, steps: int) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on rows of feature places (presence times scale), by accelerated gradient steps."""
    size = np.array([len(r) for r in x])
    row, idx = np.repeat(np.arange(len(x)), size), np.concatenate(x) if len(x) else np.zeros(0, np.int64)
    val = scale[idx]
    w = w / w.sum()
    # the Hessian is at most a quarter of the largest weighted row norm sum
    norm = np.bincount(row, val * val, len(x)) + 1
    step = 1 / (0.25 * float((w * norm).sum()) + l2)
    b, bias = np.zeros(len(scale)), 0.0
    pb, pbias = b.copy(), bias
    for k in range(steps):
        m = k / (k + 3)
        yb, ybias = b + m * (b - pb), bias + m * (bias - pbias)
        z = np.bincount(row, val * yb[idx], len(x)) + ybias
        g = w * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        pb, pbias = b, bias
        b = yb - step * (np.bincount(idx, val * g[row], len(scale)) + l2 * yb)
        bias = ybias - step * float(g.sum())
    return b * scale, bias


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = 3000, ngrams: int = 8192, l2: float = 1e-5, steps: int = 300, seed: int = 7) -> NgramModel:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, y 0/1, one row each).

    At most ``rows_per_class`` labelled rows of a class teach, picked by seeded hash; classes
    are weighted by their shares. Without rows of both classes every score is 0 or 1 alike.
    """
    shares = {int(r["y"]): r["n"] for r in labels.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    slot = np.full(1 << HASH_BITS, -1, np.int16)
    flat = NgramModel(slot, np.zeros(1), 40.0 if 1 in shares and 0 not in shares else -40.0)
    if len(shares) < 2:
        return flat
    draw = F.xxhash64(F.lit(seed), "doc_id")
    picks = [labels.where(F.col("y") == c).select("doc_id", "y").orderBy(draw, "doc_id").limit(rows_per_class) for c in (0, 1)]
    ids = picks[0].unionByName(picks[1])
    # the picks are at most 2 * rows_per_class rows of a long and an int
    rows = docs.join(F.broadcast(ids), "doc_id").select(F.col("y").cast("int").alias("y"), F.coalesce("text", F.lit("")).alias("text"))
    feats = materialize(rows.repartition(SAMPLE_TASKS).mapInArrow(_features_task, "y int, f array<int>"), "toxicity-ngrams")
    n = {int(r["y"]): r["n"] for r in feats.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return flat
    # at most 2^HASH_BITS rows
    counts = (
        feats.select("y", F.explode("f").alias("f")).groupBy("f")
        .agg(F.sum("y").cast("int").alias("p"), F.sum(1 - F.col("y")).cast("int").alias("q")).where("p + q >= 3").toPandas()
    )
    p, q, f = counts["p"].to_numpy(np.float64), counts["q"].to_numpy(np.float64), counts["f"].to_numpy()
    order = np.argsort(f)
    p, q, f = p[order], q[order], f[order]
    ratio = np.log((p + 1) / (n[1] + 2)) - np.log((q + 1) / (n[0] + 2))
    telling = np.abs(ratio) * np.abs(p / n[1] - q / n[0])
    best = np.sort(np.argsort(-telling, kind="stable")[:ngrams])
    slot[f[best]] = np.arange(len(best))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat, offs = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
            s = slot[flat]
            ends = np.concatenate([[0], np.cumsum(s >= 0)])[offs].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(s[s >= 0].astype(np.int32)))], ["y", "f"])

    # at most 2 * rows_per_class rows of at most ``ngrams`` places each
    sample = feats.mapInArrow(keep, "y int, f array<int>").toArrow()
    y = sample.column("y").to_numpy().astype(np.float64)
    x = [np.array(r, dtype=np.int64) for r in sample.column("f").to_pylist()]
    order = sorted(range(len(x)), key=lambda i: (y[i], len(x[i]), x[i].tobytes()))  # reruns add in the same order
    y, x = y[order], [x[i] for i in order]
    w = np.where(y == 1, shares[1] / n[1], shares[0] / n[0])
    weight, bias = _logistic(x, y, w, ratio[best], l2, steps)
    return NgramModel(slot, weight, bias)


def score(docs: DataFrame, model: NgramModel, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and ``score`` (double, 0 to 1, higher: more likely toxic) of every whole text.

    A null or empty text has no n-grams and gets the intercept's score.
    """
    source = docs.select(*carry, F.col(text).alias("__text"))
    schema = source.drop("__text").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                row, f = _hits(*_code_points(column(part, "__text")), model.slot)
                z = np.bincount(row, model.weight[f], part.num_rows) + model.bias
                s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield pa.RecordBatch.from_arrays([column(part, c) for c in carry] + [pa.array(s)], [*carry, "score"])
        release()

    return source.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves 0 modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, y): what may be learned from ``labels`` (doc_id, toxic), one row per document.

    Rows of the held-out fold, null ids and labels other than 0 and 1 teach nothing; of repeated
    rows the largest label counts.
    """
    return labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("y"))


def toxicity(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per row of ``docs``.

    Learns from ``known_labels``; labels of unknown documents teach nothing. Other columns are ignored; lang, source and doc_id never enter a score.
    """
    ids = docs.select("doc_id", "text")
    scored = score(ids, train(ids, known_labels(labels), **settings))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
