"""SimHash near-duplicates by bit-sliced comparison.

1. A task turns each text into a 64-bit fingerprint (word shingles, XXH64, bit majority).
2. Distinct fingerprints are keyed by two of their four 16-bit blocks (six keys each): two
   fingerprints that differ in at most 2 bits agree on two whole blocks, so each linked pair
   meets under a key. A crowded key is keyed again on two of the four bytes it leaves open,
   which is exact for the same reason and bounds a bucket to 65,536 distinct fingerprints.
3. Buckets are compared bit-sliced: 64 fingerprints fill the lanes of one word per bit plane,
   a carry-save pair of counters adds the differing bits of all lanes at once, and a word is
   abandoned as soon as each of its lanes is beyond the radius.
4. The links (a spanning forest per task) go through connected components.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectra.llm.batches import column, forget, release, slices, texts
from aspectra.llm.components import connected_components, local_forest
from aspectra.plans.materialize import materialize

SEED = 42
#: A key with more distinct fingerprints than this is keyed again on further bits.
CROWDED = 2048
#: (query, word) comparisons held at a time.
COMPARISONS = 1 << 19

#: _SPREAD[b]: the eight bits of byte b, highest first, one in each byte of a word.
_SPREAD = np.array([sum(((b >> (7 - j)) & 1) << (8 * j) for j in range(8)) for b in range(256)], np.uint64)


def fingerprints(raw: list[bytes], shingle: int) -> np.ndarray:
    """64-bit fingerprints (as int64) of UTF-8 texts, majority over the XXH64 of word shingles."""
    digest = xxhash.xxh64_digest
    out = np.zeros(len(raw), ">u8")
    parts, counts, rows = [], [], []
    for i, text in enumerate(raw):
        words = text.lower().split()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= shingle:
            parts.append(digest(line, SEED))
            counts.append(1)
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate([[0], ends[:-shingle]]).tolist()
            stops = (ends[shingle - 1 :] - 1).tolist()
            parts.append(b"".join([digest(line[a:b], SEED) for a, b in zip(starts, stops)]))
            counts.append(len(starts))
        rows.append(i)
    if not rows:
        return out.astype(np.int64)
    lanes = _SPREAD[np.frombuffer(b"".join(parts), np.uint8)].reshape(-1, 8)
    n = np.array(counts, np.int64)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    # byte counters hold 255: sum runs of at most 255 shingles, then widen
    runs = (n + 254) // 255
    run_first = np.concatenate([[0], np.cumsum(runs)[:-1]])
    at = np.repeat(first, runs) + 255 * (np.arange(runs.sum()) - np.repeat(run_first, runs))
    sums = np.add.reduceat(lanes, at, axis=0).view(np.uint8).astype(np.int32)
    totals = np.add.reduceat(sums, run_first, axis=0)
    bits = (2 * totals > n[:, None]).astype(np.uint8)
    out[rows] = np.packbits(bits, axis=1).view(">u8")[:, 0]
    return out.astype(np.uint64).view(np.int64)


def simhash(docs: DataFrame, text: str = "text", shingle: int = 3, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and ``fp`` (long): the fingerprint of each row's whole text.

    Null and blank texts have fingerprint 0; a text of fewer words than a shingle is one shingle.
    """
    source = docs.select(*carry, F.col(text).alias("__text"))
    schema = source.drop("__text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch, "__text"):
                fp = fingerprints(list(texts(column(part, "__text"))), shingle)
                yield pa.RecordBatch.from_arrays([column(part, c) for c in carry] + [pa.array(fp)], [*carry, "fp"])
        release()

    return source.mapInArrow(run, schema)


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """planes[i, w]: bit i of the 64 fingerprints w*64 .. w*64+63, one per lane."""
    words = -(-len(fp) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[: len(fp)] = fp.view(np.uint64)
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")  # row: bits 0..63
    by_bit = np.ascontiguousarray(bits.reshape(words, 64, 64).transpose(2, 0, 1))
    return np.packbits(by_bit, axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def within_radius(planes: np.ndarray, fp: np.ndarray, query: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, lanes) of the comparisons that keep a lane: lanes within ``radius`` of the query.

    ``query``/``word`` name a row and a word of planes, ``lanes`` the lanes to compare. Radius
    0 to 2: ones and twos count up to 3 by carry-save addition; a lane beyond it is dropped.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    q = fp.view(np.uint64)[query]
    ones, twos = np.zeros(len(query), np.uint64), np.zeros(len(query), np.uint64)
    alive = lanes.copy()
    for i in range(64):
        diff = planes[i][word] ^ (np.uint64(0) - ((q >> np.uint64(i)) & np.uint64(1)))
        carry = ones & diff
        ones ^= diff
        twos ^= carry  # a lane that has reached 3 is dead by now, so no higher counter is needed
        alive &= ~(ones & twos if radius == 2 else twos if radius == 1 else ones | twos)
        if i % 4 == 3:
            keep = alive != 0
            if not keep.any():
                return query[:0], lanes[:0]
            if keep.mean() < 0.7:
                query, word, q, ones, twos, alive = (x[keep] for x in (query, word, q, ones, twos, alive))
    keep = alive != 0
    return query[keep], alive[keep]


def bucket_links(keys: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside buckets; rows come sorted by bucket key."""
    n = len(fp)
    change = np.flatnonzero(keys[1:] != keys[:-1]) + 1 if n else np.zeros(0, np.int64)
    start = np.concatenate([[0], change])
    end = np.concatenate([change, [n]])
    big = end - start > 1
    start, end = start[big], end[big]
    if not len(start):
        return fp[:0], fp[:0]
    planes = bit_planes(fp)
    row = _ranges(start, end)
    stop = np.repeat(end, end - start)
    row, stop = row[row + 1 < stop], stop[row + 1 < stop]  # the last row of a run has nothing after it
    first, last = (row + 1) >> 6, (stop - 1) >> 6
    todo = np.cumsum(last - first + 1)
    us, vs, at = [], [], 0
    while at < len(row):
        base = todo[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(todo, base + COMPARISONS, side="right")))
        r, f, l, s = row[at:to], first[at:to], last[at:to], stop[at:to]
        reps = l - f + 1
        query = np.repeat(r, reps)
        word = np.repeat(f, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        low = np.clip(query + 1 - (word << 6), 0, 63).astype(np.uint64)
        high = np.clip(np.repeat(s, reps) - (word << 6), 1, 64).astype(np.uint64)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        lanes = (full << low) & (full >> (np.uint64(64) - high))
        # carry the word along with the query through the comparison
        tag = np.arange(len(query))
        kept, hits = within_radius(planes, fp[query], tag, word, lanes, radius)
        bits = np.unpackbits(hits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, lane = np.nonzero(bits)
        us.append(fp[query[kept[k]]])
        vs.append(fp[(word[kept[k]] << 6) + lane])
        if sum(map(len, us)) > 4 * COMPARISONS:
            u, v = local_forest(np.concatenate(us), np.concatenate(vs))
            us, vs = [u], [v]
        at = to
    return local_forest(np.concatenate(us), np.concatenate(vs))


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _link_task(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            key = np.concatenate([held_key, column(batch, "bucket").to_numpy()])
            fp = np.concatenate([held_fp, column(batch, "fp").to_numpy()])
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1], side="left"))  # the last bucket may go on
            held_key, held_fp = key[cut:], fp[cut:]
            u, v = bucket_links(key[:cut], fp[:cut], radius)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
        u, v = bucket_links(held_key, held_fp, radius)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def _masks(parts: list[int]) -> list[int]:
    out = []
    for a, b in combinations(parts, 2):
        m = a | b
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def fingerprint_links(distinct: DataFrame, radius: int = 2, crowded: int = CROWDED) -> DataFrame:
    """(u, v): links that connect every pair of distinct fingerprints at ``radius`` bits or fewer.

    Two bits spoil at most two of four blocks, so a pair agrees on two whole blocks.
    """
    blocks = [0xFFFF << (16 * k) for k in range(4)]
    first = [(c, m) for c, m in enumerate(_masks(blocks))]
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for c, m in first
    ])).alias("k")).select("fp", "k.c", "k.key")
    counts = keyed.groupBy("c", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowded)
    marked = keyed.join(counts, ["c", "key"], "left")
    bits = []
    for (a, b), (c, m) in zip(combinations(range(4), 2), first):
        rest = [k for k in range(4) if k not in (a, b)]
        bytes_ = [0xFF << (16 * k + 8 * h) for k in rest for h in range(2)]
        bits.append(F.array(*[F.struct(F.lit(s + 1).alias("s"), F.col("fp").bitwiseAND(F.lit(m2).cast("long")).alias("more")) for s, m2 in enumerate(_masks(bytes_))]))
    again = F.element_at(F.array(*bits), F.col("c") + 1)
    once = F.array(F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("more")))
    spread = marked.select("fp", "c", "key", F.explode(F.when(F.col("n").isNull(), once).otherwise(again)).alias("x"))
    bucket = F.xxhash64("c", "key", "x.s", "x.more")  # a collision only merges two buckets
    rows = spread.select("fp", bucket.alias("bucket"))
    return rows.repartition("bucket").sortWithinPartitions("bucket", "fp").mapInArrow(_link_task(radius), "u long, v long")


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp long, component_id): one row per row of ``docs``.

    component_id is the smallest doc_id reachable through links of at most ``radius`` differing
    bits (itself included). Null and blank texts share fingerprint 0 and link like any other;
    repeated rows share a component; a null doc_id never becomes a component_id unless the
    component has no other. Other columns are ignored. An empty table gives an empty result.
    """
    prints = materialize(simhash(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle), "simhash-fp")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), radius), "simhash-cc")
    joined = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    joined = materialize(joined, "simhash-roots")
    heads = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined.join(heads, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")
