import hashlib
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aspectra.llm import induced
from aspectra.llm.anchors import segments
from aspectra.llm.suffix_dedup import remove_repeats


def brute_repeats(text, asked, length):
    seen, out, raw = set(), np.zeros(len(text), bool), text.tobytes()
    for i in np.flatnonzero(asked):
        out[i] = raw[i : i + length] in seen
        seen.add(raw[i : i + length])
    return out


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=1, max_size=120), st.integers(1, 5), st.integers(1, 24), st.integers(1, 30), st.integers(8, 4000))
def test_induced_order_prefixes_and_repeats(piece, times, length, step, limit):
    text = np.frombuffer((piece * times)[:400].encode(), np.uint8)
    n = len(text)
    asked = np.arange(n) <= n - length
    asked[::5] = False
    induced.STEP, kept = step, induced.STEP
    try:
        assert (induced.repeats(text, asked, length, limit) == brute_repeats(text, asked, length)).all()
        stream = list(induced.suffix_stream(text, length, limit))
    finally:
        induced.STEP = kept
    place, prefix = (np.concatenate(x) for x in zip(*stream))
    heads = [text.tobytes()[p : p + length] for p in place]
    assert sorted(place.tolist()) == list(range(n)) and heads == sorted(heads, reverse=True)
    for a, b, k in zip(heads, heads[1:], prefix[1:].tolist()):
        assert a[:k] == b[:k] and (k == min(len(a), len(b)) or a[k] != b[k])


@settings(max_examples=100, deadline=None)
@given(st.text("ab\x00", max_size=200), st.integers(1, 9))
def test_leftmost_s_by_chunks(piece, look):
    text = np.frombuffer((piece + "b" * 20 + piece).encode(), np.uint8)
    induced.LOOK, kept = look, induced.LOOK
    try:
        got = np.concatenate(list(induced.leftmost_s_chunks(text)))
    finally:
        induced.LOOK = kept
    assert got.tolist() == induced.leftmost_s(text).tolist()


def test_memory_of_the_sort_does_not_grow_with_the_text():
    rng = np.random.default_rng(6)
    peaks = []
    for n in (1 << 20, 1 << 22):
        text = rng.integers(97, 123, n).astype(np.uint8)
        text[n // 2 : n // 2 + 5000] = text[:5000]
        tracemalloc.start()
        next(induced.suffix_stream(text, 100, 1 << 20))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert max(peaks) < 40 << 20 and peaks[1] < 1.5 * peaks[0], peaks


def test_each_string_is_in_one_segment_and_equal_strings_share_an_anchor():
    rng = np.random.default_rng(4)
    part = rng.integers(97, 100, 900).astype(np.uint8)
    data = np.concatenate([part, rng.integers(97, 123, 500).astype(np.uint8), part[200:], np.full(300, 97, np.uint8), part[:99]])
    offs = np.array([0, 700, 700, 1600, len(data) - 99, len(data)])
    start, count, gram, _ = segments(data, offs, 100)
    strings = np.concatenate([np.arange(s, s + c) for s, c in zip(start, count)])
    want = [p for a, b in zip(offs, offs[1:]) for p in range(a, b - 99)]
    assert sorted(strings.tolist()) == want
    anchor = dict(zip(strings.tolist(), np.repeat(gram, count).tolist()))
    by_text = {}
    for p in want:
        assert by_text.setdefault(data[p : p + 100].tobytes(), anchor[p]) == anchor[p]


def brute(rows, length=100):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha256)}, documents in order of id and, for one id, of hash."""
    seen, out = set(), {}
    for key, text in rows:
        raw = (text or "").encode()
        cover = np.zeros(len(raw) + 1, int)
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                cover[p] += 1
                cover[p + length] -= 1
            seen.add(raw[p : p + length])
        gone = np.cumsum(cover)[:-1] > 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[key, text] = (len(raw), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("shard_bytes", "heavy"), [(1 << 24, 4096), (3000, 4096), (3000, 1)])
def test_documents_match_brute_force(documents, shard_bytes, heavy):
    rows = {(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = remove_repeats(documents, carry=("doc_id", "text", "part", "kind"), length=100, shard_bytes=shard_bytes, heavy=heavy).collect()
    want = brute(order)
    assert len(got) == documents.count()
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, r.text], r.doc_id
    assert sum(r.n_removed for r in got) > 1000


def test_two_texts_under_one_id_are_two_documents(spark):
    a, b = "".join(f"alpha {i} " for i in range(40)), "".join(f"beta {i} " for i in range(40))
    docs = spark.createDataFrame([(1, a), (1, b), (2, a + b)], "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes): r for r in remove_repeats(docs, with_text=True).collect()}
    assert [r.n_removed for k, r in sorted(got.items()) if k[0] == 1] == [0, 0]
    assert got[2, len(a + b)].n_removed == len(a + b) and got[2, len(a + b)].kept == ""


def test_halved_characters_go_and_empty_table(spark, documents):
    # the cut starts inside a character: é and è share their first byte
    tail = "x" * 120
    docs = spark.createDataFrame([(1, "é" + tail), (2, "aè" + tail)], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(docs, with_text=True).collect()}
    assert got[2].kept == "aè" and got[2].n_removed == 120
    assert remove_repeats(documents.limit(0)).count() == 0


def hot_rows(n, seed=5):
    """A passage in ``n`` different surroundings, some of which share a few bytes beside it."""
    rng = np.random.default_rng(seed)
    letters = np.frombuffer(b"abcdefghij", np.uint8)
    passage = rng.choice(letters, 170).tobytes().decode()
    side = lambda k: rng.choice(letters, k).tobytes().decode()
    return [(i, side(40) + "xyz"[: i % 4] + passage + "qrs"[: i % 3] + side(40)) for i in range(n)]


def test_a_hot_anchor_is_spread(spark):
    rows = hot_rows(12_000)
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), shard_bytes=1 << 18).collect()
    want = brute(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id, rows[r.doc_id][1]], r.doc_id
    assert len(got) == len(rows) and sum(r.n_removed for r in got) > 170 * 11_990


def test_hot_strings_reach_each_shard_once_a_task():
    from aspectra.llm.suffix_dedup import _bodies, _classes

    raw = np.frombuffer("".join(t for _, t in hot_rows(500)).encode(), np.uint8)
    sizes = [len(t) for _, t in hot_rows(500)]
    start, count, gram, _ = segments(raw, np.concatenate([[0], np.cumsum(sizes)]), 100)
    seg, first, strings, shard = _classes(count, raw, start, 100, 64)
    at = start[seg] + first
    cover = np.sort(np.concatenate([np.arange(a, a + n) for a, n in zip(at, strings)]))
    assert np.array_equal(cover, np.sort(np.concatenate([np.arange(a, a + n) for a, n in zip(start, count)])))
    home = {}
    for a, n, s in zip(at.tolist(), strings.tolist(), shard.tolist()):
        for p in range(a, a + n):
            assert home.setdefault(raw[p : p + 100].tobytes(), s) == s  # equal strings meet
    most = np.bincount(shard, minlength=64).max()
    bodies = {(b, n, s) for b, n, s in zip(_bodies(raw, at, strings + 99).tolist(), strings.tolist(), shard.tolist())}
    assert np.bincount([s for _, _, s in bodies], minlength=64).max() < most


@pytest.mark.parametrize("tasks", [4, 32, 128])
def test_message_rows_follow_tasks_and_shards(spark, documents, tasks):
    from aspectra.llm.suffix_dedup import _SCHEMA, _hash_task, _shard_task

    texts = documents.selectExpr("doc_id AS __id", "0 AS __version", "coalesce(text, '') AS __text").where("__id IS NOT NULL")
    parts = 3
    sent = texts.repartition(tasks).mapInArrow(_hash_task(100, parts, parts), _SCHEMA)
    assert sent.count() <= 2 * tasks * parts
    settled = sent.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_shard_task(100, parts), _SCHEMA)
    assert settled.count() <= 2 * tasks * parts + 2 * parts * parts
