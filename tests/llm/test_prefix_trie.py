"""The prefix trie against a plain dictionary of prefixes, with odd rows, long and repeated conversations."""
import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aspectra.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth long, n1 long, p long, range int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def brute(rows, mixed=True):
    own = defaultdict(list)
    # turns with one number follow by a hash in the library; the rows here repeat equal turns only
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    head = lambda c: zlib.crc32(str(c).encode()) % 9
    base = lambda c: c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
    seqs = {c: own.get(base(c), [])[: head(c)] + t[head(c) :] if mixed else t for c, t in own.items()}
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(list)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    totals = {}
    for n in sorted(members, key=len, reverse=True):
        saved = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        totals[n] = (sum(totals[k][0] for k in children[n]) or 1, saved + sum(totals[k][1] for k in children[n]))
    ends = lambda n: ",".join(str(c) for c in sorted(c for c in members[n] if len(seqs[c]) == len(n)))
    return sorted(
        ((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), *totals[n], hashlib.sha256(ends(n).encode()).hexdigest()) for n, m in members.items()),
        key=str,
    )


def built(spark, rows, mixed=True):
    c = F.col("conv_id")
    how = (c - c % 5, F.crc32(c.cast("string")) % 9) if mixed else ()
    return sorted(map(tuple, pt.prefix_trie(table(spark, rows), *how).collect()), key=str)


def odd_rows():
    turn = lambda c, t: ("user" if t % 2 else "assistant", f"turn {t} of {c % 3}" if t < 4 else f"own {c} {t}")
    rows = [(c, t, *turn(c, t)) for c in range(-6, 40) for t in range(c % 7 + 1)]
    rows += [(50, None, "user", "first"), (50, 3, None, "x"), (50, 5, "user", None), (51, 0, "user", ""), (52, 0, "user", ""), (52, 0, "user", ""), (53, 1, "a", "bc"), (54, 1, "ab", "c")]
    rows += [(None, 0, "user", "nobody"), (60, 1, "user", "é" * 3000), (61, 1, "user", "é" * 3000), (57, 0, "user", "short and its base is absent")]
    return rows


@pytest.mark.parametrize("mixed", [True, False])
def test_matches_a_dictionary_of_prefixes(spark, mixed):
    rows = odd_rows()
    assert built(spark, rows, mixed) == brute(rows, mixed)


def test_deep_shared_conversations(spark):
    long = [("user", f"step {t % 7}") for t in range(300)]
    rows = [(c, t, *x) for c in range(4) for t, x in enumerate(long[: 300 - 37 * c])] + [(9, t, *x) for t, x in enumerate(long)] + [(9, 300, "user", "one more")]
    assert built(spark, rows, False) == brute(rows, False)


def test_ancestors_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 2)
    long = [("user", f"step {t}") for t in range(70)]
    rows = [(c, t, *x) for c in range(3) for t, x in enumerate(long[: 70 - 9 * c])]
    assert built(spark, rows, False) == brute(rows, False)


def test_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(pt, "ENDS_BYTES", 64)  # ids travel in many pieces
    rows = [(c, t, "user", f"same {t}") for c in range(700) for t in range(3)] + [(2000 + c, 0, "user", f"other {c}") for c in range(300)]
    assert built(spark, rows, False) == brute(rows, False)


def test_empty_table(spark):
    assert pt.prefix_trie(table(spark, odd_rows()).limit(0)).count() == 0


def test_registered_query_has_the_contract_columns(spark, sf_dir):
    import __spark_entry__ as entry

    df = entry.queries()["op12_prefix_trie"](spark, sf_dir)
    assert df.dtypes == [(c, "string" if c == "ends_sha256" else "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, df.collect()), key=str) == brute(rows)
