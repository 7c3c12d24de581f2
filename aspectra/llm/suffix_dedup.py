"""Suffix-array dedup: remove each byte covered by a long string that also starts earlier.

1. Each string of ``length`` bytes belongs to a content-defined anchor (``anchors``), and runs of
   strings with one anchor are segments. A task keeps the first of equal segments among its
   rows, and sends their hashes to a shard named by the anchor; no shard sees a text yet.
2. In a shard every segment but the first of equal ones is a repeat. First segments that share
   an anchor but differ may still share some of their strings: only their bytes are fetched.
   Where an anchor has very many, each is cut into classes of a few strings, which go to shards of
   their own by the bytes that all strings of the class have, so a hot anchor is spread as well.
3. The suffixes of a shard's fetched segments are sorted by external induction (``induced``),
   which gives the strings that occur in more than one of them; the earliest stays.
4. Repeats go back to their documents, and the bytes they cover are cut out.

Shards and documents are dealt by hash, so equal strings always meet. The number of shards follows
the bytes of text. Arrays travel as binary columns: a task gathers what it has for all shards and
sends a row for each of them when a number of bytes is reached.
"""
from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aspectra.llm.anchors import anchor_offsets, mix, range_hashes, segments
from aspectra.llm.batches import column, forget, release, slices, text_views
from aspectra.llm.induced import repeats
from aspectra.plans.materialize import materialize

LENGTH = 100
#: Bytes of text after which a task sends its segments, and of tuples and texts it holds in memory.
SEND_BYTES = 12 << 20
HOLD_BYTES = 48 << 20
#: Bytes of text for each shard.
SHARD_BYTES = 4 << 20
#: Ranges that a task gathers before it sends them.
GATHER = 1 << 18
#: An anchor with more unequal segments than this is spread over shards, in classes of so many neighbouring strings.
HEAVY = 4096
CLASS = 4
_SPREAD = -1
#: A document's place is its version (rows that share a doc_id and differ in text) and byte.
_VERSION = 40
_NO_ID = -(1 << 63)

#: kind 0: segments' hashes for a shard; 1: repeats of documents; 2: requests for segments' bytes; 3: the bytes.
_FIELDS = ["part", "kind", "docs", "places", "sizes", "first", "second"]
_SCHEMA = "part int, kind int, docs binary, places binary, sizes binary, first binary, second binary"


def _packed(x: np.ndarray) -> bytes:
    """An ascending or small array as bytes that compress well: differences, byte plane by byte plane."""
    d = np.diff(x, prepend=x.dtype.type(0)) if len(x) else x
    return np.ascontiguousarray(d.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, np.uint8).reshape(size, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind)[:, 0], dtype=kind)


def _row(part: int, kind: int, docs: np.ndarray, places: np.ndarray, sizes: np.ndarray, first: bytes = b"", second: bytes = b"") -> tuple:
    return part, kind, _packed(docs), _packed(places), sizes.astype(np.int32).tobytes(), first, second


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _FIELDS)


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(order)).tolist()):
        yield int(part[order[a]]), order[a:b]


def _deal(ids: np.ndarray, parts: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(doc ids with a stand-in for null, versions shifted to the upper bits of a place)."""
    ids = column(batch, "__id").fill_null(_NO_ID).to_numpy()
    return ids, column(batch, "__version").to_numpy().astype(np.int64) << _VERSION


class _Outbox:
    """Ranges of bytes on their way to their documents (kind 1: repeats, kind 2: requests of a shard).

    Held for all parts together and sent as a row for each part when ``GATHER`` are held.
    """

    def __init__(self, kind: int, parts: int):
        self.kind, self.parts, self.held, self.size = kind, parts, [], 0

    def add(self, docs: np.ndarray, places: np.ndarray, sizes: np.ndarray, shard: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        if len(docs):
            self.held.append((docs, places, sizes, np.zeros(len(docs), np.int32) if shard is None else shard))
            self.size += len(docs)
        if self.size >= GATHER:
            yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        docs, places, sizes, shard = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        order = np.lexsort((places, docs))
        docs, places, sizes, shard = docs[order], places[order], sizes[order], shard[order]
        rows = [_row(p, self.kind, docs[i], places[i], sizes[i], shard[i].tobytes() if self.kind == 2 else b"") for p, i in _by_part(_deal(docs, self.parts))]
        yield from _batches(rows)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 64):
        yield _batch(rows[a : a + 64])


def _hash_task(length: int, shards: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held: list[tuple[np.ndarray, ...]] = []
        size, marks = 0, _Outbox(1, parts)

        def send() -> Iterator[pa.RecordBatch]:
            doc, place, count, gram, body = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((place, doc, body, gram))
            doc, place, count, gram, body = doc[order], place[order], count[order], gram[order], body[order]
            head = np.ones(len(doc), bool)
            head[1:] = (gram[1:] != gram[:-1]) | (body[1:] != body[:-1])
            # a row that repeats a document is the same occurrence, not a repeat
            origin = np.maximum.accumulate(np.where(head, np.arange(len(doc)), 0))
            again = (doc != doc[origin]) | (place != place[origin])
            yield from marks.add(doc[again], place[again], count[again] + length - 1)
            order = np.flatnonzero(head)
            order = order[np.lexsort((place[order], doc[order]))]
            rows = []
            for shard, i in _by_part((gram[order] % np.uint64(shards)).astype(np.int32)):
                i = order[i]
                rows.append(_row(shard, 0, doc[i], place[i], count[i], gram[i].tobytes(), body[i].tobytes()))
            yield from _batches(rows)

        for batch in batches:
            for part in slices(batch, "__text"):
                data, offs = text_views(column(part, "__text"))
                start, count, gram, body = segments(data, offs, length)
                if not len(start):
                    continue
                ids, version = _ids(part)
                row = np.searchsorted(offs, start, side="right") - 1
                held.append((ids[row], version[row] + start - offs[row], count, gram, body))
                size += len(data)
                if size >= SEND_BYTES:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()
        yield from marks.send()
        release()

    return run


def _shard_task(length: int, parts: int, heavy: int = HEAVY):
    """Segments of a shard: all but the first of equal ones are repeats, unequal ones of one anchor are asked for."""

    def settle(shard: int, held: list[tuple[np.ndarray, ...]], marks: _Outbox, asks: _Outbox) -> Iterator[pa.RecordBatch]:
        doc, place, count, gram, body = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((place, doc, body, gram))
        doc, place, count, gram, body = doc[order], place[order], count[order], gram[order], body[order]
        new_gram = np.ones(len(doc), bool)
        new_gram[1:] = gram[1:] != gram[:-1]
        head = new_gram.copy()
        head[1:] |= body[1:] != body[:-1]
        origin = np.maximum.accumulate(np.where(head, np.arange(len(doc)), 0))
        again = (doc != doc[origin]) | (place != place[origin])
        kinds = np.add.reduceat(head.astype(np.int64), np.flatnonzero(new_gram))
        kinds = kinds[np.cumsum(new_gram) - 1]
        ask = np.flatnonzero(head & (kinds > 1))
        yield from marks.add(doc[again], place[again], count[again] + length - 1)
        yield from asks.add(doc[ask], place[ask], count[ask], np.where(kinds[ask] > heavy, _SPREAD, shard).astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shard, held = None, []
        out = _Outbox(1, parts), _Outbox(2, parts)
        for batch in batches:
            passed = []
            for row in batch.to_pylist():
                if row["kind"] == 1:
                    passed.append(tuple(row[f] for f in _FIELDS))
                    continue
                if row["part"] != shard and held:
                    yield from settle(shard, held, *out)
                    held = []
                shard = row["part"]
                held.append((
                    _unpacked(row["docs"], np.int64), _unpacked(row["places"], np.int64), np.frombuffer(row["sizes"], np.int32).astype(np.int64),
                    np.frombuffer(row["first"], np.uint64), np.frombuffer(row["second"], np.uint64),
                ))
            if passed:
                yield _batch(passed)
        if held:
            yield from settle(shard, held, *out)
        for box in out:
            yield from box.send()
        release()

    return run


class _Ranges:
    """A part's rows of kind 1 or 2, gathered before its documents arrive."""

    def __init__(self):
        self.part: int | None = None
        self.held: list[tuple[np.ndarray, ...]] = []
        self.ready: tuple[np.ndarray, ...] | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        for row in batch.select(_FIELDS).to_pylist():
            if row["part"] != self.part:
                self.part, self.held = row["part"], []
            self.ready = None
            n = len(row["sizes"]) // 4
            self.held.append((_unpacked(row["docs"], np.int64), _unpacked(row["places"], np.int64), np.frombuffer(row["sizes"], np.int32).astype(np.int64), np.frombuffer(row["first"], np.int32) if row["first"] else np.zeros(n, np.int32)))

    def of(self, part: int) -> tuple[np.ndarray, ...]:
        """(doc, place, size, shard) of the part, sorted by doc and place."""
        if part != self.part:
            self.part, self.held, self.ready = part, [], None
        if self.ready is None:
            cols = [np.concatenate(x) for x in zip(*self.held)] if self.held else [np.zeros(0, np.int64)] * 4
            order = np.lexsort((cols[1], cols[0]))
            self.ready = tuple(c[order] for c in cols)
            self.held = [self.ready] if self.held else []
        return self.ready

    def match(self, part: int, ids: np.ndarray, version: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) for each entry of the documents of the rows."""
        doc, place, _, _ = self.of(part)
        lo = _search(doc, place, ids, version)
        hi = _search(doc, place, ids, version + (1 << _VERSION))
        n = hi - lo
        row = np.repeat(np.arange(len(ids)), n)
        return row, np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)


def _search(doc: np.ndarray, place: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where (id, at) would stand among the sorted (doc, place)."""
    out = np.empty(len(ids), np.int64)
    lo, hi = np.searchsorted(doc, ids, "left"), np.searchsorted(doc, ids, "right")
    for i, (a, b, p) in enumerate(zip(lo.tolist(), hi.tolist(), at.tolist())):
        out[i] = a if a == b else a + np.searchsorted(place[a:b], p, "left")
    return out


def _parted(batches: Iterator[pa.RecordBatch], ranges: _Ranges) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(part, rows of documents); a part's ranges come before its documents and are gathered."""
    for batch in batches:
        key = column(batch, "part").to_numpy() * 2 + (column(batch, "kind").to_numpy() == 9)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a == b:
                continue
            piece = batch.slice(a, b - a)
            if key[a] % 2:
                for part in slices(piece, "__text"):
                    yield int(key[a]) // 2, part
            else:
                ranges.add(piece)


def _classes(count: np.ndarray, raw: np.ndarray, start: np.ndarray, length: int, shards: int, width: int = CLASS) -> tuple[np.ndarray, ...]:
    """Segments of heavy anchors cut into classes: (segment, first string in it, strings, shard).

    Strings whose anchor stands at ``width`` neighbouring offsets are a class. The bytes that all of
    them have name the shard; equal strings have equal offsets, so they have one class and shard.
    """
    offset = anchor_offsets(raw, start, length)
    # a segment's strings have offsets offset, offset - 1, ...; classes are runs of offsets with one quotient
    low = offset - count + 1
    n = offset // width - low // width + 1
    seg = np.repeat(np.arange(len(start)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    top = np.minimum(offset[seg], (offset[seg] // width - nth) * width + width - 1)
    bottom = np.maximum(low[seg], (offset[seg] // width - nth) * width)
    first, strings = offset[seg] - top, top - bottom + 1
    # common bytes: from the start of the last possible string of the class to the end of the first
    least = top // width * width
    gram = start[seg] + offset[seg]
    name = range_hashes(raw, gram - least, gram - (least + width - 1) + length)
    return seg, first, strings, (mix(name + top.astype(np.uint64) // np.uint64(width)) % np.uint64(shards)).astype(np.int32)


def _fetch_task(length: int, shards: int):
    """Bytes of the asked segments, sent to their shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        ranges, held, size, marks = _Ranges(), [], 0, _Outbox(1, shards)

        def send() -> Iterator[pa.RecordBatch]:
            shard, doc, place, count = (np.concatenate([h[k] for h in held]) for k in range(4))
            raw = np.concatenate([h[4] for h in held])
            start = np.cumsum(count + length - 1) - (count + length - 1)
            spread = np.flatnonzero(shard == _SPREAD)
            if len(spread):
                seg, first, strings, own = _classes(count[spread], raw, start[spread], length, shards)
                plain, seg = np.flatnonzero(shard != _SPREAD), spread[seg]
                # of equal classes the first is sent, so a hot passage costs a class for each task
                body = _bodies(raw, start[seg] + first, strings + length - 1) ^ own.astype(np.uint64)
                order = np.lexsort((place[seg] + first, doc[seg], strings, body))
                head = np.ones(len(order), bool)
                head[1:] = (body[order][1:] != body[order][:-1]) | (strings[order][1:] != strings[order][:-1])
                later = order[~head]
                yield from marks.add(doc[seg[later]], (place[seg] + first)[later], strings[later] + length - 1)
                order = order[head]
                seg, first, strings, own = seg[order], first[order], strings[order], own[order]
                doc = np.concatenate([doc[plain], doc[seg]])
                start = np.concatenate([start[plain], start[seg] + first])
                place, count = np.concatenate([place[plain], place[seg] + first]), np.concatenate([count[plain], strings])
                shard = np.concatenate([shard[plain], own])
            rows = []
            for s, i in _by_part(shard):
                rows.append(_row(s, 3, doc[i], place[i], count[i], raw[_spans(start[i], count[i] + length - 1)].tobytes()))
            yield from _batches(rows)

        for part, docs in _parted(batches, ranges):
            ids, version = _ids(docs)
            row, entry = ranges.match(part, ids, version)
            if not len(row):
                continue
            doc, place, count, shard = (x[entry] for x in ranges.of(part))
            data, offs = text_views(column(docs, "__text"))
            held.append((shard, doc, place, count, data[_spans(offs[row] + place - version[row], count + length - 1)]))
            size += len(held[-1][4])
            if size >= SEND_BYTES:
                yield from send()
                held, size = [], 0
        if held:
            yield from send()
        yield from marks.send()
        release()

    return run


def _bodies(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of all bytes of each range; the sizes take few values."""
    out = np.zeros(len(start), np.uint64)
    for n in np.unique(size).tolist():
        of = size == n
        out[of] = range_hashes(raw, start[of], start[of] + n)
    return out


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


class _Spool:
    """Bytes in order of arrival, in memory up to a limit and then in an unlinked file."""

    def __init__(self, limit: int):
        self.limit, self.parts, self.size, self.file = limit, [], 0, None

    def add(self, raw: bytes) -> None:
        self.parts.append(raw)
        self.size += len(raw)
        if self.size > self.limit:
            self.file = self.file or tempfile.TemporaryFile(prefix="suffix-text-")
            self.file.writelines(self.parts)
            self.parts = []

    def array(self) -> np.ndarray:
        if self.file is None:
            return np.frombuffer(b"".join(self.parts), np.uint8)
        self.file.writelines(self.parts)
        self.file.flush()
        return np.memmap(self.file, np.uint8, "r")


def _scratch(n: int, kind: type, limit: int) -> np.ndarray:
    """An array of zeros, on disk if it is large."""
    if n * np.dtype(kind).itemsize <= limit:
        return np.zeros(n, kind)
    return np.memmap(tempfile.TemporaryFile(prefix="suffix-array-"), kind, "w+", shape=(n,))


def _induce_task(length: int, parts: int, limit: int = HOLD_BYTES):
    """Strings that more than one of a shard's segments hold, by external induced sorting."""

    def settle(held: list[tuple[np.ndarray, ...]], spool: _Spool, marks: _Outbox) -> Iterator[pa.RecordBatch]:
        doc, place, count = (np.concatenate(x) for x in zip(*held))
        raw, size = spool.array(), count + length - 1
        start = np.cumsum(size) - size
        order = np.lexsort((place, doc))  # earlier in the text is earlier in the corpus
        once = np.ones(len(order), bool)  # a repeated row asks for the same segment again
        once[1:] = (doc[order][1:] != doc[order][:-1]) | (place[order][1:] != place[order][:-1])
        order = order[once]
        doc, place, count, size, start = doc[order], place[order], count[order], size[order], start[order]
        ends = np.cumsum(size)
        text, asked = _scratch(int(ends[-1]), np.uint8, limit), _scratch(int(ends[-1]), bool, limit)
        step = max(1, (8 << 20) // max(1, int(size.max())))
        for a in range(0, len(order), step):
            b = min(len(order), a + step)
            lo = int(ends[a] - size[a])
            text[lo : int(ends[b - 1])] = raw[_spans(start[a:b], size[a:b])]
            asked[_spans((ends - size)[a:b], count[a:b])] = True
        found = np.flatnonzero(repeats(text, asked, length, limit))
        if not len(found):
            return
        seg = np.searchsorted(ends, found, side="right")
        head = np.ones(len(found), bool)
        head[1:] = (found[1:] != found[:-1] + 1) | (seg[1:] != seg[:-1])
        heads = np.flatnonzero(head)
        n = np.diff(np.append(heads, len(found)))
        s = seg[heads]
        yield from marks.add(doc[s], place[s] + found[heads] - (ends - size)[s], n + length - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shard, held, spool, marks = None, [], _Spool(limit), _Outbox(1, parts)
        for batch in batches:
            kinds = column(batch, "kind").to_numpy()
            if (kinds == 1).any():  # repeats that are known already pass through
                yield batch.select(_FIELDS).filter(pa.array(kinds == 1))
            for k in np.flatnonzero(kinds != 1).tolist():
                row = {f: column(batch, f)[k].as_py() for f in _FIELDS}
                if row["part"] != shard and held:
                    yield from settle(held, spool, marks)
                    held, spool = [], _Spool(limit)
                shard = row["part"]
                held.append((_unpacked(row["docs"], np.int64), _unpacked(row["places"], np.int64), np.frombuffer(row["sizes"], np.int32).astype(np.int64)))
                spool.add(row["first"])
        if held:
            yield from settle(held, spool, marks)
        yield from marks.send()
        release()

    return run


def _cut_task(carry: list[str], with_text: bool):
    names = [*carry, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        ranges = _Ranges()
        for part, docs in _parted(batches, ranges):
            ids, version = _ids(docs)
            row, entry = ranges.match(part, ids, version)
            _, place, size, _ = (x[entry] for x in ranges.of(part))
            data, offs = text_views(column(docs, "__text"))
            depth = np.zeros(len(data) + 1, np.int32)
            start = offs[row] + place - version[row]
            np.add.at(depth, start, 1)
            np.add.at(depth, start + size, -1)
            gone = np.cumsum(depth[:-1]) > 0
            rises = gone.copy()
            rises[1:] &= ~gone[:-1]
            first = offs[:-1][np.diff(offs) > 0]
            rises[first] = gone[first]  # a span does not go on into the next document
            total = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(rises)])
            kept, at = data[~gone].tobytes(), offs - total[offs]
            texts = [kept[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            arrays = [column(docs, c) for c in carry] + [
                pa.array(np.diff(offs)), pa.array(np.diff(total[offs])), pa.array(np.diff(spans[offs])), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string())] if with_text else []), names)
        release()

    return run


def _with_versions(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Adds __id, __text and __version: 0, or the rank by hash of a row's text among those of its doc_id."""
    rows = docs.withColumns({"__id": F.col(doc_id).cast("long"), "__text": F.coalesce(F.col(text), F.lit(""))})
    hashes = rows.select("__id", F.xxhash64("__text").alias("__hash")).distinct()
    several = hashes.groupBy("__id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("__id").alias("id"))
    several = materialize(several, "suffix-versions")
    if several.isEmpty():
        return rows.withColumn("__version", F.lit(0))
    rank = F.row_number().over(W.partitionBy("__id").orderBy("__hash")) - 1
    versions = hashes.join(several, F.col("__id").eqNullSafe(F.col("id")), "left_semi").select(F.col("__id").alias("id"), F.col("__hash").alias("hash"), rank.alias("v"))
    rows = rows.join(versions, F.col("__id").eqNullSafe(F.col("id")) & (F.xxhash64("__text") == F.col("hash")), "left")
    return rows.withColumn("__version", F.coalesce("v", F.lit(0))).drop("id", "hash", "v")


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False, shard_bytes: int = SHARD_BYTES, heavy: int = HEAVY) -> DataFrame:
    """``carry`` columns, n_bytes, n_removed, n_spans, kept_sha256 and, on request, kept:
    the remaining text, without the bytes of characters that a cut has halved.

    Texts are UTF-8 bytes (null: empty). A byte goes if a string of ``length`` bytes that covers
    it also starts earlier: at a smaller doc_id, or earlier in the same document; strings do not
    cross documents and are judged on the input. Rows that repeat a doc_id and text are one
    document, and each gets its result; rows that give one doc_id different texts, and rows
    without a doc_id (before all others), are documents in order of their texts' hash. Texts
    shorter than ``length`` are kept. An empty table gives an empty result. There is a shard for each
    ``shard_bytes`` of text; an anchor with more than ``heavy`` unequal segments is spread over them.
    """
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    parts = 1 + size // shard_bytes
    rows = _with_versions(docs, doc_id, text)

    @F.pandas_udf("int")
    def deal(ids: pd.Series) -> pd.Series:
        return pd.Series(_deal(ids.to_numpy(), parts))

    texts = rows.select("__id", "__version", "__text")
    hashed = texts.mapInArrow(_hash_task(length, parts, parts), _SCHEMA)
    settled = hashed.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_shard_task(length, parts, heavy), _SCHEMA)
    settled = materialize(settled, "suffix-settled")

    def meet(ranges: DataFrame, keep: DataFrame) -> DataFrame:
        """Ranges and documents of a part in one task, ranges first."""
        own = keep.withColumns({"part": deal(F.coalesce("__id", F.lit(_NO_ID))), "kind": F.lit(9)})
        return ranges.unionByName(own, allowMissingColumns=True).repartition(parts, "part").sortWithinPartitions("part", "kind")

    fetched = meet(settled.where("kind = 2"), texts).mapInArrow(_fetch_task(length, parts), _SCHEMA)
    shards = fetched.repartition(parts, "part").sortWithinPartitions("part")
    induced = materialize(shards.mapInArrow(_induce_task(length, parts), _SCHEMA), "suffix-induced")
    marks = settled.where("kind = 1").unionByName(induced)
    extra = [F.col(c).alias(f"__{i}") for i, c in enumerate(carry)]
    inner = [f"__{i}" for i in range(len(carry))]
    whole = meet(marks, rows.select("__id", "__version", "__text", *extra))
    fields = ", ".join([f"`{n}` {docs.schema[c].dataType.simpleString()}" for n, c in zip(inner, carry)] + ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"] + ["kept string"] * with_text)
    cut = whole.mapInArrow(_cut_task(inner, with_text), fields)
    return cut.select(*[F.col(n).alias(c) for n, c in zip(inner, carry)], *cut.columns[len(inner) :])
