"""Packing along a space-filling curve.

Each document's token ids are hashed into a vector whose random projection has three
dimensions; the places are scaled by the corpus' own spread and turned into a Hilbert key. The
documents are range-sorted by that key, so a sequence holds neighbours, and each range is cut
into full sequences as one stream of ids. What a range leaves over becomes sequences whose
lengths are powers of two, which take no padding.
"""
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectra.llm import batches
from aspectra.llm.batches import batch_bytes, column, release, slices, texts
from aspectra.plans.materialize import materialize

LENGTH = 4096
END = 2
DIMS = 3
#: Hash space of the document vectors; bytes of words and pieces that a worker remembers, and of a remembered entry beside its two strings.
FEATURES = 1024
REMEMBERED = 32 << 20
ENTRY = 200
#: Bytes of text that are tokenised at a time.
TOKENIZED = 1 << 20
STOPS = b".,;:!?"
#: Letters whose lower case is one letter and which composition leaves alone.
LATIN_WORD = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u0148\u014A-\u017E]+)([.,;:!?]*)")
_TOKENIZERS: dict[tuple[str, int], "WordTokenizer"] = {}
batches.REMEMBERED.append(_TOKENIZERS.clear)


class WordTokenizer:
    """Ids of a tokenizer that drops white space, by ASCII-space separated words remembered in a worker.

    The tokenizer's pieces never span white space, so a text's ids are its words' ids in a row. A
    word of Latin letters, with or without stops after it, is the piece of its letters in lower
    case and the piece of its stops; other words are encoded as they stand. Two generations of
    words are held: words that come again move on to the younger one. Each generation and the pieces
    get a third of ``remembered`` bytes, tested at every word.
    """

    def __init__(self, file: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.limit = remembered // 3
        self.young_bytes = self.piece_bytes = 0
        self.code = "H" if self.kind == np.uint16 else "I"
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}
        self.signs = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x21, 0x180)) if c.isalpha()}

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in a row, number of ids of each row); nulls have none."""
        lists = pc.ascii_split_whitespace(col.fill_null("") if col.null_count else col)
        coded = lists.flatten().dictionary_encode()
        words = list(texts(coded.dictionary))
        blobs = list(map(self.young.get, words))
        missing = [i for i, b in enumerate(blobs) if b is None]
        fresh = []
        for i in missing:
            w = words[i]
            ids = self.old.get(w)
            if ids is None:
                core = w.rstrip(STOPS)
                if core.isalpha():
                    ids = self._piece(core.lower()) if len(core) == len(w) else self._piece(core.lower()) + self._piece(w[len(core) :])
                elif (m := LATIN_WORD.fullmatch(w.decode())) is not None:
                    ids = self._piece(m[1].lower().encode()) + (self._piece(m[2].encode()) if m[2] else b"")
                else:
                    fresh.append(i)
                    continue
            blobs[i] = self._remember(w, ids)
        for a in range(0, len(fresh), 500):  # as one line; a token belongs to the word in which it starts
            line = [words[i].decode() for i in fresh[a : a + 500]]
            whole = self.tokenizer.encode(" ".join(line), add_special_tokens=False)
            ids = np.array(whole.ids, self.kind)
            starts = np.cumsum([0] + [len(w) + 1 for w in line])
            cuts = np.searchsorted(np.fromiter((o[0] for o in whole.offsets), np.int64, len(ids)), starts).tolist()
            for i, x, y in zip(fresh[a : a + 500], cuts, cuts[1:]):
                blobs[i] = self._remember(words[i], ids[x:y].tobytes())
        flat = np.frombuffer(b"".join(blobs), self.kind)
        size = np.fromiter(map(len, blobs), np.int32, len(blobs)) // np.dtype(self.kind).itemsize
        code = coded.indices.to_numpy()
        n = size[code]
        ends = np.cumsum(n, dtype=np.int32)
        at = np.repeat((np.cumsum(size, dtype=np.int32) - size)[code] - (ends - n), n)
        at += np.arange(len(at), dtype=np.int32)
        total = np.concatenate([[0], ends])
        return flat[at], np.diff(total[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])]).astype(np.int64)

    def _remember(self, word: bytes, ids: bytes) -> bytes:
        self.young_bytes += len(word) + len(ids) + ENTRY
        if self.young_bytes > self.limit:
            self.young, self.old, self.young_bytes = {}, self.young, len(word) + len(ids) + ENTRY
        self.young[word] = ids
        return ids

    def _piece(self, piece: bytes) -> bytes:
        """Ids of a run of letters in lower case, or of stops."""
        ids = self.pieces.get(piece)
        if ids is None:
            letters = piece.decode("ascii") if piece.isascii() else piece.decode().translate(self.signs)
            ids = array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()
            self.piece_bytes += len(piece) + len(ids) + ENTRY
            if self.piece_bytes > self.limit:
                self.pieces, self.piece_bytes = {}, len(piece) + len(ids) + ENTRY
            self.pieces[piece] = ids
        return ids


def _tokenizer(file: str, remembered: int = REMEMBERED) -> WordTokenizer:
    if (file, remembered) not in _TOKENIZERS:
        _TOKENIZERS[file, remembered] = WordTokenizer(file, remembered)
    return _TOKENIZERS[file, remembered]


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points [n, dims], each coordinate below 2**bits.

    Skilling's transform of coordinates to the transposed index, then the bits interleaved.
    """
    x = points.astype(np.int64).T.copy()
    dims, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            hi = (x[i] & q) != 0
            swap = np.where(hi, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(hi, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _steps(n: np.ndarray, rows: int) -> Iterator[tuple[int, int, int]]:
    """(first row, first id, end of ids) of every ``rows`` rows."""
    ends = np.concatenate([[0], np.cumsum(n)])
    for i in range(0, len(n), rows):
        yield i, int(ends[i]), int(ends[min(len(n), i + rows)])


def tokenize(docs: DataFrame, file: str, carry: tuple[str, ...] = ("doc_id",), text: str = "text", seed: int = 3, remembered: int = REMEMBERED) -> DataFrame:
    """``carry`` columns, ``ids`` (binary), ``n`` (ids without the closing one), projections p0, p1, p2."""
    source = docs.select(*carry, F.col(text).alias("__text"))
    schema = source.drop("__text").select("*", F.lit(b"").alias("ids"), F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(f"p{k}") for k in range(DIMS)]).schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _tokenizer(file, remembered)
        bucket = np.random.default_rng(seed).integers(0, FEATURES, np.iinfo(coder.kind).max + 1 if coder.kind == np.uint16 else 1 << 22)
        axes = np.random.default_rng([seed, 1]).standard_normal((FEATURES, DIMS))

        def vectors(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
            """Projections of the hashed, dampened and normed count vectors of rows of ``n`` ids."""
            cell = np.repeat(np.arange(len(n)) * FEATURES, n) + bucket[ids]
            counts = np.log1p(np.bincount(cell, minlength=len(n) * FEATURES).reshape(len(n), FEATURES))
            return counts @ axes / np.sqrt(np.maximum((counts * counts).sum(axis=1, keepdims=True), 1e-12))

        for batch in parts:
            for part in slices(batch, "__text", TOKENIZED):
                ids, n = coder.encode(column(part, "__text"))
                ends = np.cumsum(n).tolist()
                blobs = [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]
                places = np.concatenate([vectors(ids[a:b], n[i : i + 256]) for i, a, b in _steps(n, 256)])
                arrays = [column(part, c) for c in carry] + [pa.array(blobs, pa.binary()), pa.array(n)] + [pa.array(places[:, k]) for k in range(DIMS)]
                yield pa.RecordBatch.from_arrays(arrays, [*carry, "ids", "n", *[f"p{k}" for k in range(DIMS)]])
        release()

    return source.mapInArrow(run, schema)


def curve_keys(coded: DataFrame, bits: int = 16) -> DataFrame:
    """Adds ``key``: the Hilbert place of each document, scaled by the mean and spread of all documents."""
    stats = coded.agg(*[f(f"p{k}").alias(f"{name}{k}") for k in range(DIMS) for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stats[f"m{k}"] or 0.0 for k in range(DIMS)])
    spread = np.array([stats[f"s{k}"] or 1.0 for k in range(DIMS)])

    @F.pandas_udf("long")
    def key(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in parts:
            z = (np.stack([c.to_numpy() for c in cols], axis=1) - mean) / spread
            unit = 1 / (1 + np.exp(-1.702 * np.clip(z, -8, 8)))  # near the normal distribution function
            yield pd.Series(hilbert_key(np.minimum((unit * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits))

    return coded.withColumn("key", key(*[f"p{k}" for k in range(DIMS)]))


def _cuts(total: int, length: int) -> np.ndarray:
    """Sequence lengths for ``total`` ids: full ones, then the powers of two of the rest."""
    rest = total % length
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([length] * (total // length) + tail, np.int64)


def pack(docs: DataFrame, file: str, carry: tuple[str, ...] = ("doc_id",), text: str = "text", length: int = LENGTH, end: int = END, seed: int = 3, partitions: int | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """Pieces of all documents: ``carry`` columns, start, length, ids (binary, little-endian
    unsigned 32 bits), ids_crc32, doc_tokens, sequence_id and offset.

    A document is its ids and the closing id; null and empty texts are the closing id alone.
    Each id lies in one piece. Sequences are ``length`` ids, except that each range ends with
    sequences whose lengths are powers of two. Repeated rows are packed each for itself; an
    empty table has no pieces. ``partitions``: ranges of the curve (the session's shuffle
    partitions if not given). ``remembered``: bytes of words that a worker remembers; ids do not depend on it.
    """
    with batch_bytes(docs.sparkSession):
        coded = materialize(tokenize(docs, file, carry, text, seed, remembered), "packing-ids")
    keyed = curve_keys(coded).drop(*[f"p{k}" for k in range(DIMS)])
    tie = F.xxhash64(*carry, "n")
    ranged = keyed.withColumn("tie", tie)
    count = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ranged.repartitionByRange(count, "key", "tie").sortWithinPartitions("key", "tie").withColumn("part", F.spark_partition_id())
    schema = docs.select(*carry, *[F.lit(0).cast("long").alias(c) for c in ("start", "length")], F.lit(b"").alias("ids"), *[F.lit(0).cast("long").alias(c) for c in ("ids_crc32", "doc_tokens", "sequence_id", "offset")]).schema

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _tokenizer(file, remembered).kind
        closing = np.array([end], kind).tobytes()
        names = [f.name for f in schema.fields]
        # held: the open sequence's documents; left: how many ids of each are cut already
        sequence, held, left = None, None, np.zeros(0, np.int64)

        def cut(batch: pa.RecordBatch, starts: np.ndarray, final: bool) -> tuple[pa.RecordBatch, np.ndarray]:
            """Adds the pieces of whole sequences to ``out``; gives back the documents that go on."""
            nonlocal sequence
            n = column(batch, "n").to_numpy() + 1 - starts
            total = int(n.sum())
            size = _cuts(total, length) if final else np.full(total // length, length, np.int64)
            limits = np.cumsum(size)
            done = int(limits[-1]) if len(limits) else 0
            if not done:
                return batch, starts
            ends = np.cumsum(n)
            bounds = np.unique(np.concatenate([ends[ends <= done], limits]))
            begin = np.concatenate([[0], bounds[:-1]])
            doc = np.searchsorted(ends, begin, side="right")
            seq = np.searchsorted(limits, begin, side="right")
            offset = begin - np.concatenate([[0], limits])[seq]
            start = begin - (ends - n)[doc] + starts[doc]
            blobs, item, ids, crc = column(batch, "ids"), np.dtype(kind).itemsize, [], []
            last, raw = -1, b""
            for d, a, m in zip(doc.tolist(), start.tolist(), (bounds - begin).tolist()):
                if d != last:
                    last, raw = d, (blobs[d].as_py() or b"") + closing
                wide = np.frombuffer(raw, kind, m, a * item).astype("<u4").tobytes()
                ids.append(wide)
                crc.append(zlib.crc32(wide))
            take = pa.array(doc)
            arrays = [column(batch, c).take(take) for c in carry] + [
                pa.array(start), pa.array(bounds - begin), pa.array(ids, pa.binary()), pa.array(crc, pa.int64()),
                pa.array(column(batch, "n").to_numpy()[doc] + 1), pa.array(sequence + seq), pa.array(offset),
            ]
            sequence += len(limits)
            out.append(pa.RecordBatch.from_arrays(arrays, names))
            first = int(np.searchsorted(ends, done, side="right"))
            rest = batch.slice(first)
            left = starts[first:].copy()
            if len(left):
                left[0] += done - int(ends[first] - n[first])
            return rest, left

        for batch in parts:
            for part in slices(batch, "ids", 2 << 20):
                if not part.num_rows:
                    continue
                if sequence is None:
                    sequence = int(column(part, "part")[0].as_py()) << 40
                out: list[pa.RecordBatch] = []
                if held is not None and held.num_rows:
                    part, left = pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0], np.concatenate([left, np.zeros(part.num_rows, np.int64)])
                else:
                    left = np.zeros(part.num_rows, np.int64)
                held, left = cut(part, left, False)
                yield from out
        out = []
        if held is not None and held.num_rows:
            cut(held, left, True)
        yield from out

    return ranged.select(*carry, "ids", "n", "part").mapInArrow(run, schema)
