import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aspectra.llm.mixing import mix, subset_counts


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), min_size=1, max_size=8), st.integers(0, 300), st.integers(4, 200))
def test_knapsack_is_as_near_as_any_subset(counts, budget, width):
    size, count = np.array(list(counts)), np.array(list(counts.values()))
    take = subset_counts(size, count, budget, np.arange(len(size)) * 7 % 5, width)
    assert (take >= 0).all() and (take <= count).all()
    if budget <= width:  # the programme alone: the best of all subsets up to twice the budget
        sums = {0}
        for s, c in counts.items():
            sums = {a + k * s for a in sums for k in range(c + 1)}
        best = min(abs(a - budget) for a in sums)
        assert abs(int((take * size).sum()) - budget) == best


def test_very_long_documents_come_near_the_budget():
    assert subset_counts(np.array([200_000]), np.array([3]), 390_000, np.array([0])).tolist() == [2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(50, 400), min_size=1, max_size=5, unique=True), st.integers(1, 3), st.integers(41, 99))
def test_lengths_above_the_programme_are_tried(lengths, copies, budget):
    """Nothing is taken beforehand, as the budget is near the width: the best of all subsets is due."""
    size, count, width = np.array(lengths), np.full(len(lengths), copies), 40
    if budget >= (size * count).sum() or np.floor(count * ((budget - width) / (size * count).sum())).any() or (size <= budget - width // 2).any():
        return
    sums = {0}
    for s in lengths:
        sums = {a + k * s for a in sums for k in range(copies + 1)}
    take = subset_counts(size, count, budget, np.arange(len(size)), width)
    assert (take <= count).all() and abs(int((take * size).sum()) - budget) == min(abs(a - budget) for a in sums)


def water(sizes, weights, share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, rest = {}, set(order), share * sum(sizes.values())
    while left:
        total = sum(w[s] for s in left)
        over = [s for s in left if rest * w[s] / total >= most * sizes[s]]
        if not over:
            return out | {s: rest * w[s] / total for s in left}
        for s in over:
            out[s] = most * sizes[s]
            left.remove(s)
        rest = share * sum(sizes.values()) - sum(out.values())
    return out


def test_targets_and_words_taken(documents):
    rows = mix(documents, carry=("doc_id", "text", "source")).collect()
    assert len(rows) == documents.count()
    sizes = {}
    for r in rows:
        assert r.size == len((r.text or "").encode().split()) and r.taken == r.size * r.copies and r.copies in (0, 1, 2)
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = water(sizes, (5, 2, 1))
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]} and all(r.target == pytest.approx(want[s]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(1, min((r.size for r in mine if r.size), default=0))


def test_reruns_agree_and_partitions_do_not_matter(documents):
    key = lambda rows: sorted(((str(r.doc_id), r.size, r.target, r.taken) for r in rows.collect()))
    assert key(mix(documents)) == key(mix(documents.repartition(7))) == key(mix(documents, carry=("doc_id", "text")))


def test_other_seed_takes_other_documents(spark):
    docs = spark.createDataFrame([(i, "w " * (3 + i % 5), f"s{i % 2}") for i in range(300)], "doc_id long, text string, source string")
    taken = lambda seed: {r.doc_id: r.taken for r in mix(docs, seed=seed, weights=(1.0, 30.0), share=1.25).collect()}
    a, b = taken(1), taken(2)
    assert a != b and sum(a.values()) == sum(b.values())


def test_empty_table_and_no_words(spark, documents):
    assert mix(documents.limit(0)).count() == 0
    got = mix(documents.where("doc_id IN (104, 105)")).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2
