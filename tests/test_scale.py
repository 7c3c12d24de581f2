"""Steps that must not grow faster than their input: what they write, shuffle and evaluate for a row."""
from aspectra.operators import tagged
from aspectra.plans import materialize, views
from aspectra.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tagged_items_are_grouped_once_a_line(spark):
    plan = _plan(tagged.parse_tagged(views.tagged_lines(spark, SF)).select("triplets", "spans"))
    assert plan.count("ArrowEvalPython") == 1  # nor copied into the filter on bad items
    assert "substring_index" not in plan  # no function of an item is interpreted for each group


def test_tagged_odd_lines(spark):
    lines = [
        ("groups", "a b c #### a=TT-NEG b=T-POS c=T-odd #### a=S b=SS c=SS"),
        ("bad", "a b #### a b=T-POS #### a=S b=O"),
        ("two parts", "a #### a=T-POS"), ("null", None),
        ("no group id", "a b #### a=-POS b=O #### a=O b="),
    ]
    got = {r.k: r for r in tagged.parse_tagged_columns(spark.createDataFrame(lines, "k string, line string")).collect()}
    assert set(got) == {"groups", "bad", "no group id"}
    assert [tuple(t) for t in got["groups"].triplets] == [("b c", "a", "positive"), ("a", "b c", "negative")]
    assert [tuple(s) for s in got["groups"].spans] == [(1, 3, 0, 1, "positive"), (0, 1, 1, 3, "negative")]
    assert [got[k].bad_items for k in ("groups", "bad", "no group id")] == [0, 1, 0]
    assert [tuple(s) for s in got["no group id"].spans] == [(0, 1, 1, 2, "positive")]


def test_shared_sentences_are_written_without_their_lines(spark):
    QUERIES["split_pivot"](spark, SF)
    path = next(p for (_, label, sf), p in materialize._SHARED.items() if label == "split-sentences" and sf == SF)
    assert set(spark.read.parquet(path).columns) == {"doc_id", "source", "pos", "tokens", "triplets", "spans", "split", "sid"}


def test_few_row_groups_are_spread_over_the_cores(spark):
    from aspectra.session import spread

    key = "spark.aspectra.spread.partitions"
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), spark.conf.get(key)
    try:
        spark.conf.unset(key)
        dealt = spread(docs)
        assert dealt.rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism and dealt.count() == docs.count()
        spark.conf.set(key, "0")
        assert "RoundRobin" not in _plan(spread(docs))
    finally:
        spark.conf.set(key, before)


def test_totals_and_reasons_take_the_same_counts(spark):
    from aspectra.operators import stats

    rows = [("a", "x", "positive"), ("a", " ", "positive"), ("a", " ", "positive"), ("a", "y", "negative"), ("b", "", "neutral")]
    table = stats.aspect_reasons(spark.createDataFrame(rows, "aspect string, opinion string, sentiment string"), top_n=1)
    got = {r.aspect: r for r in table.collect()}
    assert got["a"].total == 4 and [tuple(x) for x in got["a"].positive_reasons] == [("x", 1)] and [tuple(x) for x in got["a"].negative_reasons] == [("y", 1)]
    assert got["b"].total == 1 and got["b"].neutral_reasons == []
    read = stats.aspect_reasons(views.triplet_rows(spark, SF))
    read.collect()
    final = _plan(read).split("== Initial")[0]
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 2  # documents and labels, once each


def _line_groups_slowly(aspect_items, opinion_items):
    """(aspect, opinion, sentiment, a0, a1, o0, o1) of each aspect group of one line, item by item."""
    bad, sides = 0, ({}, {})
    for side, items in zip(sides, (aspect_items, opinion_items)):
        for i, x in enumerate(items):
            if x.endswith("=O"):
                continue
            tok, eq, tag = x.rpartition("=")
            bad += not eq
            tag, dash, code = tag.partition("-") if side is sides[0] else (tag, "-", "")
            if dash:
                group = side.setdefault(tag, [i, i + 1, code, []])
                group[1] = i + 1
                group[3].append(tok)
    phrase = lambda t: t[0] if len(t) == 1 else " ".join(t).replace(" n't", "n't").replace(" 's", "'s").strip()
    out = []
    for gid in sorted(sides[0], key=lambda g: (len(g), g)):
        a0, a1, code, toks = sides[0][gid]
        o0, o1, _, other = sides[1].get("S" * len(gid)) or (None, None, "", [""])
        out.append((phrase(toks), phrase(other), tagged._sentiment(code), a0, a1, o0, o1))
    return out, bad


def test_tagged_batches_are_grouped_together(monkeypatch):
    import random

    import pyarrow as pa

    r = random.Random(5)
    tags = ["O", "S", "SS", "SSS", "", "T-POS", "TT-NEG", "T-neu", "12-NEU", "TTT-POS", "T-A-B", "-POS", "É-x", "x"]
    item = lambda: r.choice(["a", "n't", "'s", "it's", "b=c", "", "é"]) + r.choice("====,") + r.choice(tags)
    line = lambda: r.choice([" ", "  ", "\t", "　", "\x1c"]).join(item() for _ in range(r.randrange(9))) + r.choice(["", " "])
    lines = [(line(), line()) for _ in range(1500)]
    for size in (0, 1, 7, 1500):
        some = lines[:size]
        got = tagged._line_groups(*(pa.array([x[k] for x in some], pa.string()) for k in (0, 1))).to_pylist()
        for (a, o), g in zip(some, got, strict=True):
            groups, bad = _line_groups_slowly(a.split(), o.split())
            assert [tuple(t.values()) for t in g["triplets"]] == [x[:3] for x in groups if x[0] and x[1]], (a, o)
            assert [tuple(t.values()) for t in g["spans"]] == [(*x[3:], x[2]) for x in groups if x[5] is not None], (a, o)
            assert g["bad_items"] == bad
    seen = []
    monkeypatch.setattr(tagged, "_sentiment", lambda code: seen.append(code) or code)
    tagged._line_groups(pa.array(["a=T-POS b=TT-NEG"] * 1000), pa.array(["a=S b=SS"] * 1000))
    assert sorted(seen) == ["NEG", "POS"]  # not once a group


def test_white_space_of_splits_is_that_of_python(spark):
    from pyspark.sql import functions as F

    from aspectra.functions.text import WS, WS_RUN, tokens

    every = spark.range(1, 0x110000).where("id NOT BETWEEN 55296 AND 57343").select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    text = F.concat(F.lit("a"), F.col("c"), F.col("c"), F.lit("b"))
    odd = every.where((F.split(text, WS_RUN) != F.split(text, WS + "+")) | ((F.size(tokens(text)) == 2) != F.col("c").rlike(WS)))
    assert odd.count() == 0 and every.where(F.size(tokens(text)) == 2).count() == sum(chr(i).isspace() for i in range(0x110000))


def test_kept_tables_are_packed(spark):
    import glob

    QUERIES["split_pivot"](spark, SF)
    path = next(p for (_, label, sf), p in materialize._SHARED.items() if label == "split-sentences" and sf == SF)
    assert glob.glob(f"{path}/*.zstd.parquet") and not glob.glob(f"{path}/*.snappy.parquet")


def _exchanges(df) -> list[str]:
    df.collect()
    return [line for line in _plan(df).split("== Initial")[0].splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]


def test_pairs_of_a_sentence_stay_where_its_matches_are(spark):
    from pyspark.sql import functions as F

    from aspectra.operators.lexicon import lexicon_predict

    rows = [(i, ["good", "soup", "Bad", "tea", "x"][: i % 6]) for i in range(40)] + [(3, ["soup"]), (None, ["soup"])]
    sentences = spark.createDataFrame(rows, "sid int, tokens array<string>")
    vocab, lex = spark.createDataFrame([("soup",), ("tea",)], "phrase string"), spark.createDataFrame([("good", "positive"), ("bad", "negative")], "phrase string, sentiment string")
    pred = lexicon_predict(sentences, vocab, lex)
    got = {r.sid: [tuple(t) for t in r.triplets] for r in pred.collect()}
    assert set(got) == {*range(40), None} and got[None] == got[0] == got[1] == []
    assert got[4] == [("soup", "good", "positive"), ("tea", "bad", "negative")] and got[2] == [("soup", "good", "positive")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        by_sentence = [x for x in _exchanges(lexicon_predict(sentences, vocab, lex).groupBy("sid").agg(F.first("triplets"))) if "hashpartitioning(sid" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(by_sentence) == 2  # the matches and the ids, nothing of what is made of them


def test_selected_rows_take_the_counts_once(spark):
    read = QUERIES["select_rows_reasons"](spark, SF)
    read.collect()
    final = _plan(read).split("== Initial")[0]
    assert final.count("FileScan parquet") == 2 and "ReusedExchange" in final  # documents and labels, once each


def test_reasons_of_null_groups_and_aspects_without_one(spark):
    from aspectra.operators import stats

    rows = [(None, "A", "x", "positive")] * 2 + [(None, "a ", "y", "positive"), (None, "b", " ", "negative"), ("s", "a", "z", "neutral"), ("s", "a", "z", "odd"), ("s", " ", "z", "neutral")]
    d = spark.createDataFrame(rows, "source string, aspect string, opinion string, sentiment string")
    got = {(r.source, r.aspect): r for r in stats.aspect_reasons(d, group_cols=["source"], top_n=1).collect()}
    assert set(got) == {(None, "a"), (None, "b"), ("s", "a")}
    assert [tuple(x) for x in got[None, "a"].positive_reasons] == [("x", 2)] and got[None, "a"].total == 3 and got[None, "a"].negative_reasons == []
    assert got[None, "b"].negative == 1 and got[None, "b"].negative_reasons == [] and got["s", "a"].total == 1
    assert stats.aspect_reasons(d, group_cols=["source"], min_mentions=3).count() == 1
