"""Language ID by cross-parsing: the language whose text explains a document in fewest phrases.

For each language a suffix automaton of a bounded training text is built. A document is parsed
greedily into the longest phrases that occur in that text; the count of phrases, times the
logarithm of the text's length, estimates the cross entropy (Ziv and Merhav). The automata
become transition tables, and a task parses thousands of text blocks in step with numpy.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aspectra.llm.batches import column, release, slices, text_views

#: Bytes of a document that are parsed as one block; a longer text is several blocks, all parsed.
BLOCK = 1024
UNKNOWN = "und"
_MODELS: dict[int, "CrossParser"] = {}


class SuffixAutomaton:
    """Suffix automaton of a byte string over small symbol codes."""

    def __init__(self, codes: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in codes:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p != -1:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and self.next[p].get(c) == q:
                        self.next[p][c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur

    def table(self, symbols: int) -> np.ndarray:
        """Flat table: entry [state * symbols + c] is (next state * symbols) * 4 + phrases ended.

        A symbol that does not go on ends the phrase and starts the next one from the root; a
        symbol that occurs nowhere is a phrase of its own.
        """
        root = np.full(symbols, 1, np.int32)
        for c, s in self.next[0].items():
            root[c] = s * symbols * 4
        rows = np.empty((len(self.next), symbols), np.int32)
        rows[:] = root + np.int32(1)
        rows[:, root == 1] = 2
        rows[0] = root
        at = np.repeat(np.arange(len(self.next)), [len(n) for n in self.next])
        cs = np.fromiter((c for n in self.next for c in n), np.int64, len(at))
        to = np.fromiter((s for n in self.next for s in n.values()), np.int64, len(at))
        rows[at, cs] = to * symbols * 4
        return rows.reshape(-1)


class CrossParser:
    """Phrase counts of texts against every language's training text."""

    def __init__(self, training: list[tuple[str, bytes]]):
        self.langs = [lang for lang, _ in training]
        seen = np.bincount(np.frombuffer(b"".join(t for _, t in training), np.uint8), minlength=256)
        letters = [b for b in range(256) if seen[b] and (b >= 0x80 or chr(b).isalpha())]
        self.code = np.zeros(256, np.uint8)  # 0: signs, digits, white space
        self.code[[b for b in range(0x80, 256)]] = 1  # 1: letters' bytes not seen in training
        self.code[[b for b in range(128) if chr(b).isalpha()]] = 1
        for k, b in enumerate(letters):
            self.code[b] = k + 2
        self.symbols = len(letters) + 2
        self.tables = [SuffixAutomaton(self.code[np.frombuffer(t, np.uint8)].tolist()).table(self.symbols) for _, t in training]
        self.bits = np.array([np.log(max(2, len(t))) for _, t in training])

    def phrases(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """counts[row, lang]; blocks of equal place in their texts advance together."""
        n = len(offs) - 1
        size = np.diff(offs)
        blocks = -(-size // BLOCK)
        row = np.repeat(np.arange(n), blocks)
        nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = offs[row] + nth * BLOCK
        length = np.minimum(BLOCK, offs[row + 1] - start)
        order = np.argsort(-length, kind="stable")
        row, start, length = row[order], start[order], length[order]
        active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")
        codes = np.append(self.code[raw], np.zeros(BLOCK, np.uint8))
        grid = np.empty((len(active), len(start)), np.uint8)
        for a in range(0, len(start), 4096):
            part = start[a : a + 4096, None] + np.arange(len(active))
            grid[:, a : a + 4096] = codes[np.minimum(part, len(codes) - 1)].T
        out = np.zeros((n, len(self.tables)), np.int64)
        for k, table in enumerate(self.tables):
            state, count = np.zeros(len(start), np.int32), np.zeros(len(start), np.int32)
            for t, m in enumerate(active):
                v = table[state[:m] + grid[t, :m]]
                count[:m] += v & 3
                np.right_shift(v, 2, out=state[:m])
            out[:, k] = np.bincount(row, count + (state != 0), n)
        return out


def _parser(key: int, training: list[tuple[str, bytes]]) -> CrossParser:
    """The automata are built once in a worker process."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = CrossParser(training)
    return _MODELS[key]


def training_texts(docs: DataFrame, train_bytes: int = 160_000, rows_per_lang: int = 400, excerpt: int = 2048, seed: int = 11) -> list[tuple[str, bytes]]:
    """[(lang, text)]: a bounded sample of ``docs`` (doc_id, text, lang), in order of lang.

    Per language at most ``rows_per_lang`` rows, picked by seeded hash, each giving an excerpt of
    at most ``excerpt`` code points from a hashed place; all languages together give at most
    about ``train_bytes``, in equal parts.
    """
    draw = F.xxhash64(F.lit(seed), "doc_id", "text")
    spoken = docs.where("lang IS NOT NULL AND length(text) > 0")
    # a row per language, of rows with text; of a large one about four times the rows needed come into the draw
    counts = {r["lang"]: r["n"] for r in spoken.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    limits = [F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 4 * rows_per_lang / n))]
    if not limits:
        return []
    spoken = spoken.where(F.pmod(draw, F.lit(1 << 20)) < F.create_map(*limits)[F.col("lang")] * (1 << 20))
    at = F.pmod(draw, F.greatest(F.lit(1), F.length("text") - excerpt)).cast("int") + 1
    first = W.partitionBy("lang").orderBy("h", "doc_id")
    ids = spoken.select("lang", "doc_id", draw.alias("h"), F.lower(F.substring("text", at, F.lit(excerpt))).alias("part"))
    rows = ids.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= rows_per_lang).collect()
    by: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        by.setdefault(r["lang"], []).append((r["rn"], r["part"]))
    share = train_bytes // max(1, len(by))
    out = []
    for lang in sorted(by):
        text = b""
        for _, part in sorted(by[lang]):
            if len(text) >= share:
                break
            text += part.encode()[: share - len(text)] + b"\n"
        out.append((lang, text))
    return out


def identify(docs: DataFrame, training: list[tuple[str, bytes]], text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, ``lang_pred`` and ``score`` of every whole text.

    score: the share of the winner among the languages' likelihoods e^-(phrases * log length)
    per phrase of the document, 0 to 1. Null texts, texts without a letter, and any text when
    nothing was learned are ``und`` with score 0.0. Ties go to the first language in order.
    """
    source = docs.select(*carry, F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("__text"))
    schema = source.drop("__text").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    key = hash(tuple(training))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", 12 << 20):
                col = column(part, "__text")
                known = pc.is_valid(col).to_numpy(zero_copy_only=False)
                if training:
                    parser = _parser(key, training)
                    cost = parser.phrases(*text_views(pc.utf8_lower(col))) * parser.bits
                    best = cost.argmin(axis=1)
                    gap = (cost - cost.min(axis=1, keepdims=True)) / np.maximum(1, cost.min(axis=1, keepdims=True)) * 10
                    score = 1 / np.exp(-gap).sum(axis=1)
                    lang = [parser.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
                else:
                    score, lang = np.zeros(len(known)), [UNKNOWN] * len(known)
                arrays = [pa.array(lang, pa.string()), pa.array(np.where(known, score, 0.0))]
                yield pa.RecordBatch.from_arrays([column(part, c) for c in carry] + arrays, [*carry, "lang_pred", "score"])
        release()

    return source.mapInArrow(run, schema)


def language_id(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): one row per row of ``docs`` (doc_id, text, lang).

    Learns only from text and non-null lang outside the held-out fold (crc32 of the id as text
    leaves 0 modulo 5; a null id counts as the empty text). Other columns are ignored.
    """
    from aspectra.llm.toxicity import held_out

    training = training_texts(docs.select("doc_id", "text", "lang").where(~held_out()), **settings)
    found = identify(docs.select("doc_id", "text"), training)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
