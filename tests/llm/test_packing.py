import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from aspectra.llm.packing import WordTokenizer, _cuts, hilbert_key, pack

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a b c\x1cd İstanbul ΑΣ ΣΑΣ éx <|endoftext|> don't I'LL 12ab ３ x y", "", "  ", "é́ zero​ x", "＜｜ 🤦🏽 it's",
    "Straße ŸŽœ ŉx Ĳ ſ ß, É. A!? ..., a.b a,b ÿ", "\t lead\x0b trail\n", "".join(map(chr, range(0x21, 0x250))), " ".join(map(chr, range(0x21, 0x250))),
]


def test_remembered_words_give_the_tokenizers_ids():
    own, plain = WordTokenizer(FILE, remembered=3000), Tokenizer.from_file(FILE)
    for texts in (ODD, ODD[::-1], ["Word, word. WORD word"] * 3):
        ids, counts = own.encode(pa.array([*texts, None]))
        ends = np.cumsum(counts)
        assert counts[-1] == 0
        for t, a, b in zip(texts, ends - counts, ends):
            assert ids[a:b].tolist() == plain.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_hilbert_neighbours_are_one_step_apart(dims):
    side = np.arange(8)
    points = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    key = hilbert_key(points, 3)
    assert sorted(key.tolist()) == list(range(8**dims))
    assert (np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_cuts_need_no_padding():
    for n in (0, 1, 4095, 4096, 4097, 12000):
        cuts = _cuts(n, 4096)
        assert cuts.sum() == n and all(c == 4096 or c & (c - 1) == 0 for c in cuts.tolist())


@pytest.mark.parametrize("length", [64, 4096])
def test_every_id_lies_in_one_piece(documents, length):
    plain = Tokenizer.from_file(FILE)
    docs = documents.selectExpr("doc_id", "text", "ids", "key", "n").dropDuplicates(["doc_id"])
    got = pack(docs, FILE, length=length, partitions=3).collect()
    want = {r.doc_id: [*plain.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            ids = np.array(want[d][at : at + p.length], "<u4").tobytes()
            assert p.start == at and p.doc_tokens == len(want[d]) and bytes(p.ids) == ids and p.ids_crc32 == zlib.crc32(ids)
            at += p.length
        assert at == len(want[d])
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or at & (at - 1) == 0 and at < length


def test_repeated_rows_and_empty_table(spark, documents):
    docs = spark.createDataFrame([(1, "a b c")] * 3 + [(None, None)] * 2, "doc_id long, text string")
    got = pack(docs, FILE, length=4).collect()
    assert sum(r.length for r in got) == 3 * 4 + 2 and sum(r.length for r in got if r.doc_id is None) == 2
    assert pack(documents.select("doc_id", "text").limit(0), FILE).count() == 0


def test_neighbours_on_the_curve_are_alike(spark):
    rng = np.random.default_rng(9)
    topics = [["river", "stone", "bridge"], ["code", "loop", "array"], ["bread", "salt", "oven"]]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(topics[i % 3], 40))) for i in range(90)], "doc_id long, text string")
    rows = sorted(pack(docs, FILE, partitions=1).collect(), key=lambda r: (r.sequence_id, r.offset))
    order = [r.doc_id % 3 for r in rows if r.start == 0]
    assert sum(a == b for a, b in zip(order, order[1:])) > 70


def test_what_a_worker_remembers_is_bounded_by_bytes():
    import random

    from aspectra.llm.packing import ENTRY

    own, plain, draw = WordTokenizer(FILE, remembered=300_000), Tokenizer.from_file(FILE), random.Random(4)
    for _ in range(20):
        text = " ".join("".join(draw.choices("abcdeé.9", k=draw.randint(1, 30))) for _ in range(2000))
        ids, _ = own.encode(pa.array([text]))
        for memory in (own.young, own.old, own.pieces):
            assert sum(len(k) + len(v) + ENTRY for k, v in memory.items()) <= 100_000 + 400
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_the_query_remembers_a_large_vocabulary():
    from aspectra.llm.packing import _tokenizer
    from aspectra.llm.queries import WORDS

    words = [f"w{i:x}q" for i in range(150_000)]
    coder, small = _tokenizer(FILE, WORDS), _tokenizer(FILE)
    col = pa.array([" ".join(words)])
    ids, n = coder.encode(col)
    assert all(w.encode() in coder.young or w.encode() in coder.old for w in words)  # none is encoded again
    other, m = small.encode(col)
    assert n.tolist() == m.tolist() and (ids == other).all() and small is not coder
