from pyspark.sql import functions as F

from aspectra.operators import ml
from aspectra.plans.catalog import QUERIES

from test_scale import SF, _plan


def test_term_counts_take_one_shuffle_of_summed_terms(spark):
    d = spark.createDataFrame([("aa bb aa bb",), ("bb cc",), (None,), ("",)], "t string").repartition(2)
    got = {r.term: (r.tf, r.df) for r in ml.term_statistics(d, "t", 10).collect()}
    assert got == {"aa": (2, 1), "bb": (3, 2), "cc": (1, 1), "aa bb": (2, 1), "bb aa": (1, 1), "bb cc": (1, 1)}
    plan = _plan(ml.term_statistics(d, "t", 10).drop("idf"))
    assert plan.count("hashpartitioning") == 1


def test_features_stay_sparse(spark):
    assert "unwrap_udt" in _plan(QUERIES["tfidf_features"](spark, SF))  # no array of 22,000 numbers a row


def test_vocabulary_is_that_of_the_term_statistics(spark):
    words = [f"w{i:03d}" for i in range(200)]
    train = spark.createDataFrame([(" ".join(words[i::20]), "top") for i in range(20)], "context string, aspect string").repartition(3)
    test = spark.createDataFrame([(w, "top") for w in words] + [("W000 w001 (w000)", "other")], "context string, aspect string")
    rows = ml.tfidf_features(train, test, ctx_vocab=50, asp_vocab=5)[1].collect()
    top = [r.term for r in ml.term_statistics(train, "context", 50).collect()]
    known = {r.context for r in rows if r.aspect == "top" and r.features.numNonzeros() == 2}
    assert known == {w for w in top if " " not in w} and words[0] in top and words[-1] not in top  # ties go to the smaller term
    odd = next(r.features for r in rows if r.aspect == "other")
    assert odd.size == 51 and abs(odd.norm(2) - 1) < 1e-9 and odd.numNonzeros() == 1 + (words[1] in top)
    plan = _plan(ml.tfidf_features(train, test, ctx_vocab=50, asp_vocab=5)[1])
    assert plan.count("regexp_extract_all") == 2  # each column is cut into words once


def test_words_are_whole_runs(spark):
    text = "a1 b é̀x _c--dd 'e' ﬀ ü İx ١٢ f_2 a"
    d = spark.createDataFrame([(text,)], "t string")
    both = [d.select(F.regexp_extract_all("t", F.lit(p), 0).alias("w")).first().w for p in (ml.TOKEN_PATTERN, "(?U)\\b\\w\\w+\\b")]
    assert both[0] == both[1] and "a1" in both[0]
