import zlib

import numpy as np

from aspectra.llm.langid import BLOCK, CrossParser, identify, language_id


def brute_phrases(text, train):
    """Greedy longest phrases of ``text`` that occur in ``train``; an unseen byte is a phrase of its own."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in train:
            j += 1
        n += 1
        i = max(i + 1, j - 1)
    return n


def test_phrase_counts_match_brute_force():
    rng = np.random.default_rng(5)
    train = [("a", bytes(rng.integers(97, 101, 300).astype(np.uint8))), ("b", bytes(rng.integers(99, 105, 200).astype(np.uint8)))]
    texts = [bytes(rng.integers(97, 105, int(n)).astype(np.uint8)) for n in rng.integers(0, 90, 40)] + [b"", b"zzz"]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    counts = CrossParser(train).phrases(raw, offs)
    seen = set(b"".join(t for _, t in train))
    for i, t in enumerate(texts):
        for k, (_, known) in enumerate(train):
            # bytes that no language knows are alike to the parser: spell them as one unknown byte
            assert counts[i, k] == brute_phrases(bytes(c if c in seen else 0 for c in t), known)


def test_long_texts_are_parsed_whole():
    train = [("a", b"abcabd" * 30), ("b", b"xyzxyw" * 30)]
    text = b"abcabd" * BLOCK + b"xyzxyw" * (3 * BLOCK)
    counts = CrossParser(train).phrases(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert counts[0, 1] < counts[0, 0]


def corpus(spark):
    rng = np.random.default_rng(6)
    syllables = {"en": "the ing er and tion of".split(), "de": "sch ein ung lich keit der".split(), "fr": "eau ou é ment que les".split()}
    rows = []
    for i in range(240):
        lang = list(syllables)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(syllables[lang], 3)) for _ in range(40)), lang if i % 7 else None, "s"))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, "12 .. 34", "en", "s"), (None, "the ingtion ofer", "en", None), (3, rows[3][1], rows[3][2], "s")]
    return spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, lang string, source string, score int, lang_pred string")


def test_held_out_predictions(spark):
    docs = corpus(spark)
    got = language_id(docs).collect()
    assert len(got) == docs.count()
    langs = ["en", "de", "fr"]
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert r.lang_pred == "und" and r.score == 0
        elif r.doc_id is not None:
            assert r.lang_pred == langs[r.doc_id % 3]


def test_nothing_learned_and_empty_table(spark):
    docs = corpus(spark)
    assert {(r.lang_pred, r.score) for r in identify(docs.select("doc_id", "text"), []).collect()} == {("und", 0.0)}
    assert language_id(docs.limit(0)).count() == 0


def test_rows_without_text_do_not_thin_out_the_training(spark):
    from pyspark.sql import functions as F

    from aspectra.llm.langid import training_texts

    blank = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("")).alias("text"), F.lit("xx").alias("lang"))
    spoken = spark.range(20_000, 20_040).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"), F.lit("xx").alias("lang"))
    [(lang, text)] = training_texts(blank.unionByName(spoken))
    assert lang == "xx" and sorted(text.split(b"\n")[:-1]) == [b"word %d" % i for i in range(20_000, 20_040)]
