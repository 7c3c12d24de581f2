"""Order MinHash against a plain Python version on the library's hash, with odd rows; its sense of order; the plan."""
import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from aspectra.llm import order_minhash as om
from aspectra.llm.order_minhash import fingerprints


def h(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed)
    return seed


def coordinates(text, k=3, length=2):
    units = re.findall(r"[^\x20\x09-\x0D]{1,12}", text)
    seen, marks = {}, []
    for i in range(len(units)):
        kmer = h(*[u.encode() for u in units[i : i + k]]) % 2**35
        nth = seen[kmer] = seen.get(kmer, -1) + 1
        marks.append((h(struct.pack("<q", kmer), struct.pack("<i", nth)) % 2**35, i))
    out = []
    for b in range(64):
        mine = sorted(m for m in marks if m[0] >> 29 == b)[:length]
        if mine:
            ordered = [struct.pack("<q", m[0]) for m in sorted(mine, key=lambda m: m[1])]
            out.append(f"{b << 16 | h(*ordered) % 65536:06x}")
    return out


def near(a, b):
    buckets = {c[:2] for c in a} | {c[:2] for c in b}
    return len(set(a) & set(b)) / len(buckets) if buckets else 1.0


def brute(rows):
    tie = lambda t: struct.unpack("<q", struct.pack("<Q", h(t.encode())))[0]
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), tie(r[1])))
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, changed = coordinates(t), coordinates(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(changed), near(own, changed), near(own, coordinates(after))))
    return sorted(out, key=str)


def pairs(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


@pytest.mark.parametrize("ranges", [1, 5, 150])
def test_matches_plain_python(documents, ranges):
    got = sorted(map(tuple, fingerprints(documents, ranges=ranges).collect()), key=str)
    assert got == brute(pairs(documents))


def test_equal_ids_and_repeated_rows(spark):
    rows = [(7, f"row {i % 5} of seven") for i in range(30)] + [(8, "eight"), (6, None), (6, ""), (None, "nobody"), (None, None), (-3, "𝒳é" * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, fingerprints(df, ranges=3).collect()), key=str) == brute(rows)


def test_empty_single_and_repeated_words(spark):
    df = spark.createDataFrame([(1, "a " * 30_000 + "b")], "doc_id long, text string")
    assert fingerprints(df.limit(0)).count() == 0
    assert list(map(tuple, fingerprints(df).collect())) == brute([(1, "a " * 30_000 + "b")])


def test_moved_halves_differ_more_than_their_words(spark):
    words = [f"w{i}" for i in range(2000)]
    moved = " ".join(words[1000:] + words[:1000])
    edits = " ".join(w if i % 50 else "new" for i, w in enumerate(words))
    df = spark.createDataFrame([(3, " ".join(words)), (2, moved)], "doc_id long, text string")
    few = spark.createDataFrame([(3, " ".join(words)), (2, edits)], "doc_id long, text string")
    get = lambda d: {r.doc_id: r.near_next for r in fingerprints(d).collect()}[3]
    # nearly all k-mers are the same; about half of the pairs change their order
    assert 0.3 < get(df) < 0.7 < get(few) < 1


def test_registered_query(spark, sf_dir):
    import __spark_entry__ as entry

    df = entry.queries()["op13_order_minhash"](spark, sf_dir)
    assert df.dtypes == [("doc_id", "bigint"), ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan) and plan.count("Exchange hashpartitioning") == 1
    assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert df.agg(F.avg("near_edited") > F.avg("near_next")).first()[0]
