import zlib

import numpy as np

from aspectra.llm.toxicity import HASH_BITS, _code_points, _hits, known_labels, toxicity


def corpus(spark, n=400, null_rows=True):
    nice = "river stone garden window lantern bridge meadow harbour pillow copper".split()
    vile = "blorgh skrunt vexnard".split()
    rng = np.random.default_rng(8)
    docs, labels = [], []
    for i in range(n):
        words = list(rng.choice(nice, 30))
        if i % 4 == 0:
            for _ in range(3):
                words.insert(int(rng.integers(0, 30)), str(rng.choice(vile)) + ",")
        docs.append((i, " ".join(words)))
        labels.append((i, 0, int(i % 4 == 0)))
    if null_rows:
        docs += [(None, "blorgh"), (1000, None), (1001, ""), (1002, "SKRUNT! " * 20000), (1, docs[1][1])]
        labels += [(None, 1, 1), (2, 1, None), (7, 0, 0), (5555, 0, 1), (9, 0, 7)]
    return (
        spark.createDataFrame([(*d, 5.0, 2) for d in docs], "doc_id long, text string, score double, y int"),
        spark.createDataFrame([(*x, "t") for x in labels], "doc_id long, quality int, toxic int, text string"),
    )


def test_held_out_accuracy_and_columns(spark):
    docs, labels = corpus(spark)
    got = toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        held = zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 1000:
            assert r.predicted == (r.doc_id % 4 == 0)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1002].predicted == 1 and by_id[1000].score == by_id[1001].score


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs, labels = corpus(spark, 120, False)
    flipped = labels.selectExpr("doc_id", "quality", "IF(crc32(cast(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    score = lambda rows: sorted((r.doc_id, r.score) for r in rows.collect())
    assert score(toxicity(docs, labels)) == score(toxicity(docs, flipped))


def test_no_labels_or_one_class(spark):
    docs, labels = corpus(spark, 40, False)
    assert {r.score < 0.01 for r in toxicity(docs, labels.limit(0)).collect()} == {True}
    assert {r.predicted for r in toxicity(docs, labels.where("toxic = 1")).collect()} == {1}
    assert toxicity(docs.limit(0), labels).count() == 0


def test_repeated_labels_count_once(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 1), (3, None), (4, 2)], "doc_id long, toxic int")
    assert sorted((r.doc_id, r.y) for r in known_labels(labels).collect()) == [(1, 1), (2, 0)]


def test_ngrams_stay_inside_a_text():
    import pyarrow as pa

    row, feature = _hits(*_code_points(pa.array(["ab", "cd", "abcd", None, "Éab", "éab"])), None)
    of = [set(feature[row == i].tolist()) for i in range(6)]
    assert not of[0] and not of[1] and not of[3] and len(of[2]) == 3 and of[4] == of[5] and len(of[4]) == 1
    assert feature.max() < 1 << HASH_BITS


def test_model_and_scores_match_plain_python(spark):
    """Ratios, features and scores by dictionaries and loops, with the fitted coefficients taken as they are."""
    import math

    from aspectra.llm.toxicity import SIZES, score, train

    docs, labels = corpus(spark, 60, null_rows=False)
    docs = docs.select("doc_id", "text")
    known = known_labels(labels)
    model = train(docs, known, ngrams=400)

    def fold(text):
        return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in text.lower())

    def hashed(gram):
        h = 0
        for c in gram:
            h = (h + ord(c)) * 0x9E3779B1 & 0xFFFFFFFF
            h ^= h >> 15
        return (h * 0x85EBCA6B & 0xFFFFFFFF) >> 32 - HASH_BITS

    def grams(text):
        t = fold(text)
        return {hashed(t[i : i + n]) for n in SIZES for i in range(len(t) - n + 1)}

    texts, y = dict(docs.collect()), dict(known.collect())
    n = [sum(v == c for v in y.values()) for c in (0, 1)]
    seen = {}
    for i, label in y.items():
        for g in grams(texts[i]):
            seen.setdefault(g, [0, 0])[label] += 1
    ratio = {g: math.log((p + 1) / (n[1] + 2)) - math.log((q + 1) / (n[0] + 2)) for g, (q, p) in seen.items() if p + q >= 3}
    telling = {g: abs(r) * abs(seen[g][1] / n[1] - seen[g][0] / n[0]) for g, r in ratio.items()}
    kept = {int(g) for g in np.flatnonzero(model.slot >= 0)}
    least = sorted(telling.values())[-400]
    assert len(kept) == 400 and kept <= set(telling) and all(telling[g] >= least - 1e-12 for g in kept)
    # the scaling: a weight is the ratio times a coefficient, and the penalised loss is at rest there
    coef = {g: model.weight[model.slot[g]] / ratio[g] for g in kept if ratio[g]}
    z = {i: model.bias + sum(model.weight[model.slot[g]] for g in grams(t) & kept) for i, t in texts.items()}
    loss = {i: (1 / (1 + math.exp(-z[i])) - y[i]) / len(y) for i in y}
    slope = [sum(loss[i] * ratio[g] for i in y if g in grams(texts[i])) + 1e-5 * c for g, c in list(coef.items())[:20]]
    assert max(map(abs, slope)) < 0.01
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert all(abs(got[i] - 1 / (1 + math.exp(-v))) < 1e-9 for i, v in z.items())
