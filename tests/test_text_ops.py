"""Tagged lines, generated text, lexicon matching, grid round trip and report checks."""
from pyspark.sql import Row
from pyspark.sql import functions as F

from aspectra.functions.triplets import parse_generated, parse_generated_set, render_triplets
from aspectra.operators import checks, grid, lexicon, tagged


def _lines(spark, lines):
    return spark.createDataFrame([Row(sid=i, line=l) for i, l in enumerate(lines)])


def test_tagged_line_groups_pair_by_length(spark):
    tag = lambda words, tags: " ".join(f"{w}={tags.get(w, 'O')}" for w in words.split())
    line = lambda words, aspects, opinions: f"{words} #### {tag(words, aspects)} #### {tag(words, opinions)}"
    lines = [
        "   ",
        # three groups, the longest without an opinion
        line("cable frays early plug sits snug lamp too", {"lamp": "TTT-NEU", "plug": "TT-POS", "cable": "T-NEG"}, {"snug": "SS", "frays": "S", "early": "S"}),
        line("rivet", {}, {}),
        # two groups whose ids have one length share the opinion of that length
        line("lid rim fine", {"lid": "T-POS", "rim": "4-NEG"}, {"fine": "S"}),
        "one #### two=O #### three=O #### four=O",
    ]
    got = {r.sid: [(t.aspect, t.opinion, t.sentiment) for t in r.triplets] for r in tagged.parse_tagged(_lines(spark, lines)).collect()}
    assert got == {
        1: [("cable", "frays early", "negative"), ("plug", "snug", "positive")],
        2: [],
        3: [("rim", "fine", "negative"), ("lid", "fine", "positive")],
    }


def test_tagged_spans_cover_gaps_and_first_code_wins(spark):
    line = "a b c d #### a=T-NEG b=O c=T-POS d=O #### a=O b=S c=O d=O"
    r = tagged.parse_tagged(_lines(spark, [line])).collect()[0]
    assert [(t.aspect, t.sentiment) for t in r.triplets] == [("a c", "negative")]
    assert [(s.a0, s.a1, s.o0, s.o1) for s in r.spans] == [(0, 3, 1, 2)]


def test_render_parse_round_trip_and_sentinel(spark):
    df = spark.createDataFrame([Row(t=[Row(aspect="food", opinion="great", sentiment="positive"),
                                       Row(aspect="staff", opinion="rude", sentiment="negative")]), Row(t=[])],
                               "t array<struct<aspect:string,opinion:string,sentiment:string>>")
    txt = [r.x for r in df.select(render_triplets("t").alias("x")).collect()]
    assert txt[1] == "no triplet"
    back = df.select(render_triplets("t").alias("x")).select(parse_generated("x").alias("p")).collect()
    assert [(t.aspect, t.opinion, t.sentiment) for t in back[0].p] == [("food", "great", "positive"), ("staff", "rude", "negative")]
    assert back[1].p == []
    g = spark.createDataFrame([Row(x="Aspect:  Big  Room | opinion: nice | sentiment: POSITIVE ; aspect: big room | opinion: nice | sentiment: positive xx")])
    s = g.select(parse_generated_set("x").alias("s")).collect()[0].s
    assert [(t.aspect, t.opinion, t.sentiment) for t in s] == [("big room", "nice", "positive")]


def test_lexicon_fit_tie_and_nearest(spark):
    trip = spark.createDataFrame([
        Row(doc_id=1, pos=0, ord=0, aspect="Pizza", opinion="great", sentiment="positive"),
        Row(doc_id=1, pos=1, ord=0, aspect="pizza crust", opinion="bad", sentiment="negative"),
        Row(doc_id=2, pos=0, ord=0, aspect="crust", opinion="bad", sentiment="positive"),
    ])
    vocab, lex = lexicon.fit_lexicon(trip)
    assert {r.phrase: r.sentiment for r in lex.collect()} == {"great": "positive", "bad": "negative"}  # tie -> first seen
    sents = spark.createDataFrame([Row(sid="s1", tokens="The Pizza crust was great but bad".split()), Row(sid="s2", tokens=["nothing"])])
    pred = {r.sid: [(t.aspect, t.opinion, t.sentiment) for t in r.triplets]
            for r in lexicon.lexicon_predict(sents, vocab, lex).collect()}
    assert pred["s1"] == [("pizza crust", "great", "positive")]  # longest match, nearest opinion (tie -> leftmost)
    assert pred["s2"] == []


def test_grid_build_decode_and_subword_round_trip(spark):
    spans = spark.createDataFrame([
        Row(sid="x", ord=0, a0=0, a1=2, o0=3, o1=4, sentiment="positive"),
        Row(sid="x", ord=1, a0=5, a1=6, o0=7, o1=9, sentiment="negative"),
    ])
    cells = grid.build_grid(spans)
    dec = {(r.a0, r.a1, r.o0, r.o1, r.sentiment) for r in grid.decode_grid(cells).collect()}
    assert dec == {(0, 2, 3, 4, "positive"), (5, 6, 7, 9, "negative")}
    toks = spark.createDataFrame([Row(sid="x", tokens=["alpha", "be", "c", "delta", "e", "ff", "g", "hhhhhhhhh", "i"])])
    wm = grid.subword_map(toks)
    back = grid.collapse_grid(grid.expand_grid(cells, wm), wm)
    assert sorted(map(tuple, back.select("i", "j", "tag").collect())) == sorted(map(tuple, cells.select("i", "j", "tag").collect()))


def test_structured_check_verdicts(spark):
    table = spark.createDataFrame([
        Row(source="c", aspect="screen", total=10, positive=6, negative=3, neutral=1),
        Row(source="c", aspect="dock 12", total=4, positive=1, negative=2, neutral=1),
    ])
    reports = spark.createDataFrame([
        Row(source="c", report="Screen attracted the most attention, with 10 mentions: 6 positive, 3 negative, and 1 neutral. "
                               "Dock 12: 4 mentions (1 positive, 2 negative, 1 neutral)."),
    ])
    out = checks.check_structured(reports, table)[0].collect()[0]
    assert out.passed and out.claims_checked == 2 and out.unparsed_numeric_tokens == 0
    bad = spark.createDataFrame([Row(source="c", report="Screen received 11 mentions, including 6 positive, 3 negative, and 1 neutral. Up 20%.")])
    o2 = checks.check_structured(bad, table)[0].collect()[0]
    assert not o2.passed and o2.valid_claims == 0 and o2.unparsed_numeric_tokens == 1 and o2.unexpected_text == "Up 20%"


COUNTED = "source string, slot int, aspect string, total int, positive int, negative int, neutral int, "
REASONED = COUNTED + ("positive_reasons array<struct<reason:string,n:int>>, negative_reasons array<struct<reason:string,n:int>>, "
                      "neutral_reasons array<struct<reason:string,n:int>>")


def test_reasoned_check_longest_aspect_and_foreign_reason(spark):
    R = lambda reason, n: Row(reason=reason, n=n)
    sel = spark.createDataFrame([
        Row(source="c", slot=1, aspect="lens", total=9, positive=6, negative=2, neutral=1,
            positive_reasons=[R("crisp", 4)], negative_reasons=[R("foggy", 2)], neutral_reasons=[]),
        Row(source="c", slot=2, aspect="zoom lens", total=5, positive=4, negative=1, neutral=0,
            positive_reasons=[R("smooth", 3)], negative_reasons=[], neutral_reasons=[]),
    ], REASONED)
    check = lambda text, mode="factual-only": checks.check_reasoned(spark.createDataFrame([Row(source="c", report=text)]), sel, mode=mode)
    r = check("Lens came up 9 times, with 6 positive mentions calling it crisp. Zoom lens had 5 mentions, 4 praising it as smooth.")[0].collect()[0]
    assert r.passed and r.claims_checked == 2
    semi = check("Lens came up 9 times; 6 were positive and crisp. Zoom lens had 5 mentions, 4 smooth.")[0].collect()[0]
    assert semi.unattributed_numbers == "6"  # ';' starts an aspect-free segment
    r2, per = check("Lens came up 9 times, 6 positive and smooth.")
    assert not r2.collect()[0].passed
    errs = {x.aspect: x.errors for x in per.collect()}
    assert "reasons belong to another aspect: [smooth]" in errs["lens"] and errs["zoom lens"] == "aspect not mentioned"
    assert {x.aspect: x.numbers_found for x in per.collect()}["lens"] == "9,6"


def test_strict_mode_needs_every_aspect(spark):
    sel = spark.createDataFrame([
        ("c", 1, "strap", 7, 4, 2, 1, [("soft", 3)], [], []), ("c", 2, "clasp", 3, 1, 2, 0, [], [("loose", 2)], []),
    ], REASONED)
    text = "Strap had 7 mentions, 4 positive and soft."
    loose, strict = (checks.check_reasoned(spark.createDataFrame([Row(source="c", report=text)]), sel, mode=m)[0].collect()[0] for m in ("factual-only", "strict"))
    assert loose.passed and not strict.passed and strict.missing_aspects == "clasp" and strict.factual_passed
    assert loose.coverage_warnings == ["Missing aspects: clasp"]


def _required(spark, text):
    sel = spark.createDataFrame([("c", 1, "strap", 7, 4, 2, 1, "most_discussed"), ("c", 2, "clasp", 3, 3, 0, 0, "strongest_positive")], COUNTED + "role string")
    return checks.check_structured(spark.createDataFrame([Row(source="c", report=text)]), sel.drop("slot", "role"), selected=sel)[0].collect()[0]


def test_generated_reports_need_the_selected_aspects_and_roles(spark):
    first = "Strap attracted the most attention, with 7 mentions: 4 positive, 2 negative, and 1 neutral."
    second = " Clasp emerged as the clearest strength, receiving 3 positive mentions out of 3, alongside 0 negative and 0 neutral."
    assert _required(spark, first + second).passed
    r = _required(spark, first)
    assert not r.passed and r.missing_aspects == "clasp" and r.missing_roles == "strongest_positive"
    listed = _required(spark, "strap: 7 mentions (4 positive, 2 negative, 1 neutral). clasp: 3 mentions (3 positive, 0 negative, 0 neutral).")
    assert not listed.passed and listed.valid_claims == 2 and listed.missing_roles == "most_discussed,strongest_positive"
    swapped = _required(spark, first.replace("Strap", "Clasp").replace("7 mentions: 4 positive, 2 negative, and 1", "3 mentions: 3 positive, 0 negative, and 0"))
    assert swapped.role_errors == "most_discussed: claimed clasp, expected strap" and not swapped.passed


def test_long_digits_are_errors_not_failures(spark):
    long = "9" * 24
    r = _required(spark, f"Strap attracted the most attention, with {long} mentions: 4 positive, 2 negative, and 1 neutral. Call {long}.")
    assert not r.passed and r.claims_checked == 1 and r.valid_claims == 0 and r.unparsed_numeric_tokens == 1
    sel = spark.createDataFrame([("c", 1, "strap", 7, 4, 2, 1, [("soft", 3)], [], [])], REASONED)
    text = spark.createDataFrame([Row(source="c", report=f"Strap had 007 mentions, 4 positive and soft, {long}.")])
    report, per = checks.check_reasoned(text, sel)
    assert not report.collect()[0].passed and per.collect()[0].errors == f"unsupported numbers: [{long}]"
    assert checks.grounded(text, sel).collect()[0].unsupported_numbers == long


def test_retry_runs_only_rejects_and_stops(spark):
    from aspectra.operators.reports import prompt_roles, retry_rejects

    sel = spark.createDataFrame([(s, 1, "strap", 7, 4, 2, 1, "most_discussed", False) for s in ("a", "b")], COUNTED + "role string, reason_aware boolean")
    seen = []

    def generate(rows, attempt):
        seen.append((attempt, sorted(r.source for r in rows.select("source").collect())))
        return prompt_roles(rows, retry_number=attempt - 1).withColumn("report", F.concat("source", F.lit(str(attempt))))

    def check(reports, rows):
        return reports.select("source", F.col("report").isin("a1", "b2").alias("passed"), F.array(F.lit("note")).alias("coverage_warnings"))

    final, history = retry_rejects(sel, generate, check, max_attempts=5)
    assert seen == [(1, ["a", "b"]), (2, ["b"])]
    got = {r.source: r for r in final.collect()}
    assert (got["a"].generation_attempts, got["b"].generation_attempts) == (1, 2) and got["b"].status == "accepted_with_warnings"
    assert got["b"].selected_aspects == ["strap"] and [x.passed for x in got["b"].attempt_history] == [False, True] and got["b"].checker_mode == "strict"
    prompts = {(r.source, r.attempt): r.prompt for r in history.collect()}
    assert prompts["b", 2].startswith("Attempt 2:") and not prompts["b", 1].startswith("Attempt")


def test_lexicon_long_sentence_and_islands(spark):
    vocab = spark.createDataFrame([("a b",), ("b c",), ("c",), ("x y z",)], "phrase string")
    lex = spark.createDataFrame([("x", "positive"), ("y z", "negative")], "phrase string, sentiment string")
    rows = spark.createDataFrame([("s", "a b c x y z c".split()), ("long", ["a", "b", "x"] * 7000), ("none", [])], "sid string, tokens array<string>")
    spans = {(r.kind, r.i, r.n) for r in lexicon.lexicon_spans(rows.filter("sid = 's'"), vocab, lex).collect()}
    assert spans == {("A", 0, 2), ("A", 2, 1), ("A", 3, 3), ("A", 6, 1), ("O", 3, 1), ("O", 4, 2)}
    got = {r.sid: r.triplets for r in lexicon.lexicon_predict(rows, vocab, lex).collect()}
    assert [(t.aspect, t.opinion) for t in got["s"]] == [("a b", "x"), ("c", "x"), ("x y z", "y z"), ("c", "y z")]
    assert len(got["long"]) == 7000 and got["none"] == []


def plain_greedy(matches):
    longest = {}
    for i, n in matches:
        longest[i] = max(n, longest.get(i, 0))
    kept, end = [], 0
    for i in sorted(longest):
        if i >= end:
            kept.append((i, longest[i]))
            end = i + longest[i]
    return kept


def test_greedy_matches_equal_a_plain_scan(spark):
    import random

    draw = random.Random(8)
    rows = [(k, [(i, n) for i in range(draw.randint(1, 60)) for n in range(1, 6) if draw.random() < 0.3]) for k in range(300)]
    rows += [(1000, [(i, 1 + i % 5) for i in range(100_000)]), (1001, [(0, 5)]), (1002, [])]
    df = spark.createDataFrame(rows, "k int, m array<struct<i:int,n:int>>")
    got = {r.k: [tuple(x) for x in r.m] for r in lexicon.greedy_matches(df, ["k"], "m", 5).collect()}
    assert got == {k: plain_greedy(m) for k, m in rows}


def test_greedy_matches_of_many_tokens_finish_in_seconds(spark):
    import time

    times = []
    for n in (100_000, 100_000, 400_000):
        df = spark.range(1).selectExpr("1 AS k", f"transform(sequence(0, {n - 1}), i -> struct(i, 3 AS n)) AS m")
        start = time.time()
        assert lexicon.greedy_matches(df, ["k"], "m", 3).selectExpr("size(m) AS s").first().s == -(-n // 3)
        times.append(time.time() - start)
    assert times[1] < 10 and times[2] < 8 * times[1] + 5
