"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (or tables Spark derives from them) in full. Columns are
aliased to the names used by the matching oracle SQL in ``aspectra.plans.oracle``.
Arrays are rendered to strings where the result is compared by value hash.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectra.functions.text import has_latin_letter, norm_key, tokens
from aspectra.operators import stats
from aspectra.plans import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _widen(df: DataFrame) -> DataFrame:
    """Integers leave as BIGINT and floats as DOUBLE, so result schemas line up with the
    oracle's (DuckDB counts/positions are BIGINT)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("integer", "short", "byte"):
            out.append(F.col(f"`{f.name}`").cast("bigint").alias(f.name))
        elif t == "float":
            out.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def query(name: str):
    def deco(fn):
        def run(spark, sf_dir):
            return _widen(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


# ---------------------------------------------------------------- aggregates


@query("aspect_reasons")
def q_aspect_reasons(spark, sf_dir):
    """Flagship: A2 over V4 (top-10 reasons per sentiment)."""
    table = stats.aspect_reasons(views.triplet_rows(spark, sf_dir), top_n=10)
    return stats.with_rendered_reasons(table)


@query("aspect_reasons_by_source")
def q_aspect_reasons_by_source(spark, sf_dir):
    """V8: A2 per corpus (documents.source), min 2 mentions."""
    table = stats.aspect_reasons(views.triplet_rows(spark, sf_dir), group_cols=["source"], top_n=10, min_mentions=2)
    return stats.with_rendered_reasons(table)


@query("aspect_sentiment")
def q_aspect_sentiment(spark, sf_dir):
    return stats.aspect_sentiment(views.triplet_rows(spark, sf_dir))


@query("top_reasons")
def q_top_reasons(spark, sf_dir):
    counts = stats.reason_counts(views.triplet_rows(spark, sf_dir))
    return stats.top_reasons(counts, top_n=10).select("aspect", "sentiment", "reason", "n", "rk")


@query("top_aspects")
def q_top_aspects(spark, sf_dir):
    return stats.top_aspects(stats.aspect_sentiment(views.triplet_rows(spark, sf_dir)), n=10)


# ---------------------------------------------------------------- text (P10, A10)


@query("split_sentences")
def q_split_sentences(spark, sf_dir):
    s = views.plain_sentences(spark, sf_dir)
    return s.filter((F.size(tokens("sent")) >= 2) & has_latin_letter("sent")).select("doc_id", "pos", "sent")


@query("corpus_counters")
def q_corpus_counters(spark, sf_dir):
    """A10: counts per document are summed, each vocabulary has a distinct of its own; the three
    one-row results are put side by side by a union and a maximum."""
    from aspectra.functions.text import split_sentence_array

    toks = F.transform(split_sentence_array("text"), lambda x: F.size(tokens(x)))
    docs = views.documents(spark, sf_dir).select(toks.alias("sizes")).select(
        F.size("sizes").alias("sentences"), F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, n: a + F.floor(n / 2)).alias("triplets")
    )
    reviews, total = F.count_if(F.col("sentences") > 0), F.sum("sentences")
    counted = docs.agg(
        reviews.alias("reviews_with_sentences"), total.alias("sentences"), F.round(total / reviews, 6).alias("sentences_per_review"), F.sum("triplets").alias("triplets"),
    )
    v4 = views.triplet_rows(spark, sf_dir)
    vocab = [v4.select(norm_key(c).alias("k")).distinct().agg(F.count("k").alias(f"{c}_vocab")) for c in ("aspect", "opinion")]
    rows = counted.unionByName(vocab[0], allowMissingColumns=True).unionByName(vocab[1], allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


# ---------------------------------------------------------------- tagged lines and generated text


@query("parse_tagged")
def q_parse_tagged(spark, sf_dir):
    p = views.parsed_tagged(spark, sf_dir)
    return p.select("doc_id", "pos", F.posexplode("triplets").alias("ord", "t")).select(
        "doc_id", "pos", "ord", "t.aspect", "t.opinion", "t.sentiment"
    )


@query("parse_spans")
def q_parse_spans(spark, sf_dir):
    p = views.parsed_tagged(spark, sf_dir)
    return p.select("doc_id", "pos", F.posexplode("spans").alias("ord", "t")).select(
        "doc_id", "pos", "ord", "t.a0", "t.a1", "t.o0", "t.o1", "t.sentiment"
    )


@query("span_phrases")
def q_span_phrases(spark, sf_dir):
    """Span -> phrase with a plain space join."""
    p = views.parsed_tagged(spark, sf_dir)
    e = p.select("doc_id", "pos", "tokens", F.posexplode("spans").alias("ord", "t"))
    phrase = lambda a, b: F.array_join(F.slice("tokens", F.col(a) + 1, F.col(b) - F.col(a)), " ")
    return e.select("doc_id", "pos", "ord", "tokens", "t.*").select(
        "doc_id", "pos", "ord", phrase("a0", "a1").alias("aspect"), phrase("o0", "o1").alias("opinion"), "sentiment"
    )


@query("detokenize")
def q_detokenize(spark, sf_dir):
    from aspectra.functions.text import detokenize

    return views.token_rows(spark, sf_dir).select("doc_id", "pos", detokenize("tokens").alias("phrase"))


@query("render_triplets")
def q_render_triplets(spark, sf_dir):
    return views.generated_texts(spark, sf_dir).select("doc_id", "pos", "generated")


@query("parse_generated")
def q_parse_generated(spark, sf_dir):
    from aspectra.functions.triplets import parse_generated

    g = views.generated_texts(spark, sf_dir)
    return g.select("doc_id", "pos", F.posexplode(parse_generated("generated")).alias("ord", "t")).select(
        "doc_id", "pos", "ord", "t.aspect", "t.opinion", "t.sentiment"
    )


@query("parse_generated_set")
def q_parse_generated_set(spark, sf_dir):
    from aspectra.functions.triplets import parse_generated_set

    g = views.generated_texts(spark, sf_dir)
    return g.select("doc_id", "pos", F.explode(parse_generated_set("generated")).alias("t")).select(
        "doc_id", "pos", "t.aspect", "t.opinion", "t.sentiment"
    )


# ---------------------------------------------------------------- splits, lexicon baseline, metrics


def _split_sentences(spark, sf_dir):
    """Parsed V5 sentences with a doc-level hash split and a sentence id."""
    from aspectra.operators.splits import hash_split

    from aspectra.plans.materialize import shared

    def build():
        # what the queries read; the lines and sentences that the rows came from are not written again
        parsed = views.parsed_tagged(spark, sf_dir).select("doc_id", "source", "pos", "tokens", "triplets", "spans")
        return hash_split(parsed, "doc_id").withColumn("sid", F.concat_ws(":", "doc_id", "pos"))

    return shared(spark, "split-sentences", sf_dir, build)


def _gold_triplets(split_df, split):
    return split_df.filter(F.col("split") == split).select(
        "doc_id", "pos", "sid", "source", F.posexplode("triplets").alias("ord", "t")
    ).select("doc_id", "pos", "sid", "source", "ord", "t.aspect", "t.opinion", "t.sentiment")


def _lexicon_run(spark, sf_dir):
    from aspectra.operators.lexicon import fit_lexicon, lexicon_predict

    sp = _split_sentences(spark, sf_dir)
    vocab, lex = fit_lexicon(_gold_triplets(sp, "train"))
    test = sp.filter(F.col("split") == "test")
    pred = lexicon_predict(test, vocab, lex)
    gold = test.select("sid", "triplets")
    return sp, vocab, lex, pred, gold


@query("hash_split")
def q_hash_split(spark, sf_dir):
    from aspectra.operators.splits import hash_split

    return hash_split(views.documents(spark, sf_dir).select("doc_id"), "doc_id")


@query("exact_split")
def q_exact_split(spark, sf_dir):
    from aspectra.operators.splits import exact_split

    return exact_split(views.documents(spark, sf_dir).select("doc_id"), "doc_id")


@query("seeded_sample")
def q_seeded_sample(spark, sf_dir):
    from aspectra.operators.splits import seeded_sample

    return seeded_sample(views.documents(spark, sf_dir).select("doc_id", "source"), "doc_id", 100)


@query("fit_lexicon")
def q_fit_lexicon(spark, sf_dir):
    from aspectra.operators.lexicon import fit_lexicon

    vocab, lex = fit_lexicon(_gold_triplets(_split_sentences(spark, sf_dir), "train"))
    return vocab.select(F.lit("aspect").alias("kind"), "phrase", F.lit(None).cast("string").alias("sentiment")).unionByName(
        lex.select(F.lit("opinion").alias("kind"), "phrase", "sentiment")
    )


@query("lexicon_match")
def q_lexicon_match(spark, sf_dir):
    spans = _test_spans(spark, sf_dir)
    return spans.select("sid", F.when(F.col("kind") == "A", "aspect").otherwise("opinion").alias("kind"), "i", "n", "phrase")


def _test_spans(spark, sf_dir):
    from aspectra.operators.lexicon import fit_lexicon, lexicon_spans

    sp = _split_sentences(spark, sf_dir)
    vocab, lex = fit_lexicon(_gold_triplets(sp, "train"))
    return lexicon_spans(sp.filter(F.col("split") == "test").select("sid", "tokens"), vocab, lex)


@query("lexicon_predict")
def q_lexicon_predict(spark, sf_dir):
    _, _, _, pred, _ = _lexicon_run(spark, sf_dir)
    return pred.select("sid", F.posexplode("triplets").alias("ord", "t")).select(
        "sid", "ord", "t.aspect", "t.opinion", "t.sentiment"
    )


@query("nearest_opinion")
def q_nearest_opinion(spark, sf_dir):
    """J2 alone: every aspect span paired with its nearest opinion span (centre distance x2)."""
    from aspectra.operators.lexicon import nearest_opinions

    return nearest_opinions(_test_spans(spark, sf_dir)).drop("sentiment")


@query("triplet_prf")
def q_triplet_prf(spark, sf_dir):
    from aspectra.operators.metrics import triplet_prf

    _, _, _, pred, gold = _lexicon_run(spark, sf_dir)
    return triplet_prf(pred, gold)


def _gold_pred_tables(spark, sf_dir, min_mentions=2):
    _, _, _, pred, gold = _lexicon_run(spark, sf_dir)
    ex = lambda d: d.select(F.explode("triplets").alias("t")).select("t.*")
    return (
        stats.aspect_sentiment(ex(gold), min_mentions=min_mentions),
        stats.aspect_sentiment(ex(pred), min_mentions=min_mentions),
    )


@query("majority_agreement")
def q_majority_agreement(spark, sf_dir):
    from aspectra.operators.metrics import majority_agreement

    g, p = _gold_pred_tables(spark, sf_dir)
    return majority_agreement(g, p)


@query("agreement_errors")
def q_agreement_errors(spark, sf_dir):
    from aspectra.operators.metrics import agreement_errors

    g, p = _gold_pred_tables(spark, sf_dir)
    return agreement_errors(g, p)


@query("exact_match")
def q_exact_match(spark, sf_dir):
    from aspectra.functions.triplets import render_triplets
    from aspectra.operators.metrics import exact_match

    _, _, _, pred, gold = _lexicon_run(spark, sf_dir)
    j = pred.select("sid", render_triplets("triplets").alias("p")).join(
        gold.select("sid", render_triplets("triplets").alias("g")), "sid"
    )
    return exact_match(j, "p", "g")


def _per_example_labels(spark, sf_dir):
    """Gold test triplets labelled by the fitted opinion lexicon (unseen opinion -> neutral)."""
    from aspectra.operators.lexicon import fit_lexicon

    sp = _split_sentences(spark, sf_dir)
    _, lex = fit_lexicon(_gold_triplets(sp, "train"))
    test = _gold_triplets(sp, "test")
    j = test.join(lex.withColumnRenamed("sentiment", "lex_sentiment"), norm_key(test["opinion"]) == lex["phrase"], "left")
    return j.select(
        "sid", "source", "ord", F.col("sentiment").alias("label"),
        F.coalesce("lex_sentiment", F.lit("neutral")).alias("prediction"),
    )


@query("example_agreement")
def q_example_agreement(spark, sf_dir):
    from aspectra.operators.metrics import example_agreement

    return example_agreement(_per_example_labels(spark, sf_dir), "prediction", "label")


@query("classification_report")
def q_classification_report(spark, sf_dir):
    from aspectra.operators.metrics import classification_report

    return classification_report(_per_example_labels(spark, sf_dir))


@query("run_summary")
def q_run_summary(spark, sf_dir):
    """A8 with each corpus (source) as one run of the per-example classifier."""
    from aspectra.operators.metrics import classification_report, run_summary

    ex = _per_example_labels(spark, sf_dir).withColumn("run", F.regexp_extract("source", "([0-9]+)$", 1).cast("int"))
    return run_summary(classification_report(ex, group_cols=["run"], digits=None), run="run")


@query("class_weights")
def q_class_weights(spark, sf_dir):
    from aspectra.operators.metrics import class_weights

    return class_weights(_gold_triplets(_split_sentences(spark, sf_dir), "train"), label="sentiment")


@query("split_pivot")
def q_split_pivot(spark, sf_dir):
    """Sentences by domain (source) x split."""
    sp = _split_sentences(spark, sf_dir)
    return (
        sp.groupBy(F.col("source").alias("domain"))
        .pivot("split", ["train", "valid", "test"])
        .agg(F.count(F.lit(1)))
        .na.fill(0, ["train", "valid", "test"])
    )


@query("triplet_histogram")
def q_triplet_histogram(spark, sf_dir):
    sp = _split_sentences(spark, sf_dir)
    return sp.groupBy("split", F.size("triplets").alias("triplet_count")).agg(F.count(F.lit(1)).alias("sentences"))


@query("leakage_audit")
def q_leakage_audit(spark, sf_dir):
    from aspectra.operators.splits import hash_split, leakage_audit
    from aspectra.session import read_table

    s = hash_split(views.plain_sentences(spark, sf_dir), "doc_id")
    bench = read_table(spark, sf_dir, "benchmark")
    # benchmark passages are split into sentences the same way before the exact-text check
    from aspectra.functions.text import split_sentence_array

    bench_s = bench.select(F.explode(split_sentence_array("text")).alias("text"))
    return leakage_audit(s, text="sent", split="split", benchmark=bench_s)


@query("corpus_overlap")
def q_corpus_overlap(spark, sf_dir):
    """J12 between corpora: distinct sentences that each pair of sources shares, zeros included."""
    from aspectra.operators.splits import overlap_matrix

    return overlap_matrix(views.plain_sentences(spark, sf_dir), "source", "sent")


@query("aspect_pool_overlap")
def q_aspect_pool_overlap(spark, sf_dir):
    """J12 of aspect pools: distinct aspects that each pair of splits shares, zeros included."""
    from aspectra.functions.text import norm_key
    from aspectra.operators.splits import hash_split, overlap_matrix

    pools = hash_split(views.triplet_rows(spark, sf_dir), "doc_id").select("split", norm_key("aspect").alias("aspect"))
    return overlap_matrix(pools.where("aspect <> ''"), "split", "aspect")


# ---------------------------------------------------------------- stats tables per corpus, row selection


def _stats_by_source(spark, sf_dir, reasons: bool = True):
    """V8: per-corpus table (min 2 mentions), with or without reason lists."""
    trip = views.triplet_rows(spark, sf_dir)
    if reasons:
        return stats.aspect_reasons(trip, group_cols=["source"], top_n=10, min_mentions=2)
    return stats.aspect_sentiment(trip, group_cols=["source"], min_mentions=2)


@query("select_rows_counts")
def q_select_rows_counts(spark, sf_dir):
    from aspectra.operators.select import select_report_rows

    return select_report_rows(_stats_by_source(spark, sf_dir, reasons=False), ["source"], max_aspects=4)


@query("select_rows_reasons")
def q_select_rows_reasons(spark, sf_dir):
    from aspectra.operators.select import select_report_rows

    sel = select_report_rows(_stats_by_source(spark, sf_dir), ["source"], max_aspects=4)
    return stats.with_rendered_reasons(sel)


# ---------------------------------------------------------------- prompts, reports, checks


def _selected(spark, sf_dir, reasons: bool):
    from aspectra.operators.select import select_report_rows

    return select_report_rows(_stats_by_source(spark, sf_dir, reasons=reasons), ["source"], max_aspects=4)


@query("reason_text")
def q_reason_text(spark, sf_dir):
    from aspectra.operators.reports import reason_text

    return _selected(spark, sf_dir, True).select("source", "slot", "aspect", reason_text().alias("reason_text"))


@query("prompt_reasoned")
def q_prompt_reasoned(spark, sf_dir):
    from aspectra.operators.reports import prompt_reasoned

    return prompt_reasoned(_selected(spark, sf_dir, True))


@query("prompt_roles")
def q_prompt_roles(spark, sf_dir):
    from aspectra.operators.reports import prompt_roles

    return prompt_roles(_selected(spark, sf_dir, False))


def _structured(spark, sf_dir, required: bool = False):
    from aspectra.operators.checks import check_structured
    from aspectra.plans.fixtures import count_reports

    sel = _selected(spark, sf_dir, False)
    reports = count_reports(sel)
    return reports, check_structured(reports, _stats_by_source(spark, sf_dir, reasons=False), selected=sel if required else None)


@query("check_structured")
def q_check_structured(spark, sf_dir):
    """C1 for report files as they are."""
    _, (per_report, _) = _structured(spark, sf_dir)
    return per_report


@query("check_structured_required")
def q_check_structured_required(spark, sf_dir):
    """C1 for generated reports: the selected aspects and roles are required."""
    _, (per_report, _) = _structured(spark, sf_dir, required=True)
    return per_report


@query("claim_check")
def q_claim_check(spark, sf_dir):
    _, (_, per_claim) = _structured(spark, sf_dir)
    return per_claim.select(
        "source", "kind", "k", "role", "aspect", "total", "positive", "negative", "neutral", "valid",
        F.array_join("errors", "; ").alias("errors"),
    )


@query("report_rollup")
def q_report_rollup(spark, sf_dir):
    from aspectra.operators.checks import report_rollup

    _, (per_report, _) = _structured(spark, sf_dir)
    return report_rollup(per_report.withColumn("style", F.when(F.col("claims_checked") > 0, "claims").otherwise("none")), ["style"])


@query("report_totals")
def q_report_totals(spark, sf_dir):
    """A13 over (style, status): reports of which some lack a selected aspect and some repeat one."""
    from aspectra.operators.checks import check_structured, report_totals
    from aspectra.operators.reports import report_status
    from aspectra.plans.fixtures import count_reports, flawed_rows, style_of

    sel = _selected(spark, sf_dir, False)
    reports = count_reports(flawed_rows(sel))
    per_report, _ = check_structured(reports, _stats_by_source(spark, sf_dir, reasons=False), selected=sel, totals=True)
    named = F.element_at(F.array(F.lit("roles"), F.lit("list"), F.lit("natural")), (style_of(F.col("source"), 3) + 1).cast("int"))
    status = report_status(F.col("passed"), F.array().cast("array<string>"))
    return report_totals(per_report.withColumn("style", named).withColumn("status", status))


@query("report_pass_rate")
def q_report_pass_rate(spark, sf_dir):
    from aspectra.operators.checks import report_rollup

    _, (per_report, _) = _structured(spark, sf_dir)
    return report_rollup(per_report)


@query("report_status")
def q_report_status(spark, sf_dir):
    """P17 + C7 for the count-path reports: the structured checker requires the selected aspects
    and roles and gives no coverage warnings; the effective mode is strict."""
    from aspectra.operators.reports import report_status

    _, (per_report, _) = _structured(spark, sf_dir, required=True)
    sel = _selected(spark, sf_dir, False).groupBy("source").agg(F.bool_or("reason_aware").alias("reason_aware"))
    j = per_report.join(sel, "source")
    return j.select(
        "source", "reason_aware", F.col("passed").alias("accepted"),
        report_status(F.col("passed"), F.array().cast("array<string>")).alias("status"),
        F.when(F.col("reason_aware"), F.lit("factual-only")).otherwise(F.lit("strict")).alias("checker_mode"),
    )


@query("report_status_reasoned")
def q_report_status_reasoned(spark, sf_dir):
    """P17 for the reason path, whose checker warns of missing and repeated aspects."""
    from aspectra.operators.reports import report_status

    _, _, (per_report, _) = _reasoned(spark, sf_dir)
    return per_report.select("source", F.col("passed").alias("accepted"), report_status(F.col("passed"), F.col("coverage_warnings")).alias("status"), "checker_mode")


@query("coverage_gaps")
def q_coverage_gaps(spark, sf_dir):
    """O3: required aspects/roles (the selection) minus what each report claims."""
    _, (_, per_claim) = _structured(spark, sf_dir)
    sel = _selected(spark, sf_dir, False)
    req = sel.select("source", "aspect", "role")
    claimed = per_claim.select("source", "aspect").distinct()
    missing_aspects = req.join(claimed, ["source", "aspect"], "left_anti").select("source", F.lit("aspect").alias("gap"), F.col("aspect").alias("value"))
    roles = per_claim.filter(F.col("role").isNotNull()).select("source", "role").distinct()
    missing_roles = req.filter(F.col("role").isNotNull()).join(roles, ["source", "role"], "left_anti").select(
        "source", F.lit("role").alias("gap"), F.col("role").alias("value")
    )
    return missing_aspects.unionByName(missing_roles)


@query("claims_equal")
def q_claims_equal(spark, sf_dir):
    """Role-claim tuples of each (possibly perturbed) report equal those of a clean rendering."""
    from aspectra.operators.checks import extract_claims
    from aspectra.operators.reports import role_sentence
    from aspectra.plans.fixtures import count_reports

    sel = _selected(spark, sf_dir, False)
    sentence = F.struct("slot", role_sentence(F.col("role"), F.col("aspect")).alias("x"))
    clean = sel.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(sentence)), lambda x: x["x"]), " ").alias("target"))
    roles_only = lambda c: F.array_sort(F.filter(extract_claims(c), lambda x: x["role"].isNotNull()))
    j = count_reports(sel).join(clean, "source")
    a, b = roles_only(F.col("report")), roles_only(F.col("target"))
    return j.select("source", ((a == b) & (F.size(b) > 0)).alias("claims_equal"), F.size(a).cast("bigint").alias("report_claims"),
                    F.size(b).cast("bigint").alias("target_claims"))


def _reasoned(spark, sf_dir, mode="factual-only"):
    from aspectra.operators.checks import check_reasoned
    from aspectra.plans.fixtures import reasoned_reports

    sel = _selected(spark, sf_dir, True)
    reports = reasoned_reports(sel)
    return reports, sel, check_reasoned(reports, sel, mode=mode)


@query("check_reasoned")
def q_check_reasoned(spark, sf_dir):
    _, _, (per_report, _) = _reasoned(spark, sf_dir)
    return per_report.drop("coverage_warnings")


@query("reason_grounding")
def q_reason_grounding(spark, sf_dir):
    _, _, (_, per_aspect) = _reasoned(spark, sf_dir)
    return per_aspect


@query("segment_aspects")
def q_segment_aspects(spark, sf_dir):
    from aspectra.operators.checks import segment_aspect_set, segments

    reports, sel, _ = _reasoned(spark, sf_dir)
    asp = sel.groupBy("source").agg(F.collect_list(F.lower("aspect")).alias("aspects"))
    d = reports.join(asp, "source").select("source", "aspects", F.posexplode(segments("report")).alias("seg_idx", "segment"))
    return d.select("source", "seg_idx", "segment", F.array_join(F.array_sort(segment_aspect_set(F.col("segment"), F.col("aspects"))), ",").alias("aspects"))


@query("check_grounded")
def q_check_grounded(spark, sf_dir):
    from aspectra.operators.checks import grounded

    reports, sel, _ = _reasoned(spark, sf_dir)
    return grounded(reports, sel)


# ---------------------------------------------------------------- grid tagging


def _grid_inputs(spark, sf_dir):
    sp = _split_sentences(spark, sf_dir)
    spans = sp.select("sid", F.posexplode("spans").alias("ord", "t")).select("sid", "ord", "t.*")
    return sp, spans


@query("grid_build")
def q_grid_build(spark, sf_dir):
    from aspectra.operators.grid import build_grid

    _, spans = _grid_inputs(spark, sf_dir)
    return build_grid(spans)


@query("diagonal_spans")
def q_diagonal_spans(spark, sf_dir):
    from aspectra.operators.grid import build_grid, diagonal_spans

    _, spans = _grid_inputs(spark, sf_dir)
    return diagonal_spans(build_grid(spans))


@query("grid_decode")
def q_grid_decode(spark, sf_dir):
    from aspectra.operators.grid import build_grid, decode_grid

    _, spans = _grid_inputs(spark, sf_dir)
    return decode_grid(build_grid(spans))


@query("grid_expand")
def q_grid_expand(spark, sf_dir):
    from aspectra.operators.grid import build_grid, expand_grid, subword_map

    sp, spans = _grid_inputs(spark, sf_dir)
    return expand_grid(build_grid(spans), subword_map(sp))


@query("grid_collapse")
def q_grid_collapse(spark, sf_dir):
    """Round trip: collapse(expand(grid)) must give the word grid back."""
    from aspectra.operators.grid import build_grid, collapse_grid, expand_grid, subword_map

    sp, spans = _grid_inputs(spark, sf_dir)
    wmap = subword_map(sp)
    return collapse_grid(expand_grid(build_grid(spans), wmap), wmap)


# ---------------------------------------------------------------- ABSA XML


def _xml_sentences(spark, sf_dir):
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.xml import read_absa_xml, write_absa_xml

    path = new_scratch_path(spark, "absa-xml")
    write_absa_xml(views.xml_sentence_rows(spark, sf_dir), path)
    return read_absa_xml(spark, path)


@query("scan_xml")
def q_scan_xml(spark, sf_dir):
    s = _xml_sentences(spark, sf_dir)
    return s.select("sentence_id", "text", F.posexplode_outer("terms").alias("term_idx", "t")).select(
        "sentence_id", "text", "term_idx", F.col("t.term").alias("term"), F.col("t.polarity").alias("polarity"),
        F.col("t.start").alias("start"), F.col("t.end").alias("end"),
    )


@query("flatten_examples")
def q_flatten_examples(spark, sf_dir):
    from aspectra.sources.xml import flatten_examples

    return flatten_examples(_xml_sentences(spark, sf_dir))


@query("mark_aspect")
def q_mark_aspect(spark, sf_dir):
    """P2 over every term, including the invalid-offset (untouched) cases."""
    from aspectra.functions.text import mark_aspect

    s = _xml_sentences(spark, sf_dir)
    e = s.select("sentence_id", "text", F.posexplode("terms").alias("term_idx", "t"))
    return e.select("sentence_id", "term_idx", mark_aspect(F.col("text"), F.col("t.start"), F.col("t.end")).alias("marked"))


@query("drop_labels")
def q_drop_labels(spark, sf_dir):
    from aspectra.sources.xml import drop_labels

    d = drop_labels(_xml_sentences(spark, sf_dir))
    return d.select("sentence_id", F.col("terms").isNotNull().alias("has_terms"), F.coalesce(F.size("terms"), F.lit(0)).alias("n_terms"))


@query("sink_xml_roundtrip")
def q_sink_xml_roundtrip(spark, sf_dir):
    """K1: write the conflict-free sentences as XML and read them back."""
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.xml import drop_labels, read_absa_xml, write_absa_xml

    path = new_scratch_path(spark, "absa-xml-out")
    write_absa_xml(drop_labels(_xml_sentences(spark, sf_dir)), path)
    back = read_absa_xml(spark, path)
    return back.select("sentence_id", "text", F.size("terms").alias("n_terms"))


# ---------------------------------------------------------------- ML baseline and model hooks


def _examples_split(spark, sf_dir):
    from aspectra.operators.splits import hash_split
    from aspectra.sources.xml import flatten_examples

    from aspectra.plans.materialize import shared

    # the vocabulary, idf, weights and every optimiser pass read this table
    return shared(spark, "examples", sf_dir, lambda: hash_split(flatten_examples(_xml_sentences(spark, sf_dir)), "sentence_id", valid_ratio=0.0, test_ratio=0.15))


@query("tfidf_features")
def q_tfidf_features(spark, sf_dir):
    from aspectra.operators.ml import tfidf_features

    ex = _examples_split(spark, sf_dir)
    tr, te = tfidf_features(ex.filter(F.col("split") == "train"), ex.filter(F.col("split") == "test"))
    # a sparse vector's own values: no row becomes an array of 22,000 numbers
    arr = F.unwrap_udt("features")["values"]
    return te.select("sentence_id", "term_idx", F.size(F.filter(arr, lambda x: x != 0)).alias("nnz"),
                     F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x), 6).alias("sq_norm"))


@query("tfidf_terms")
def q_tfidf_terms(spark, sf_dir):
    """The vocabularies and weights behind M1, fitted on the train split."""
    from aspectra.operators.ml import term_statistics

    train = _examples_split(spark, sf_dir).filter(F.col("split") == "train")
    blocks = [term_statistics(train, c, n).select(F.lit(c).alias("block"), "*") for c, n in (("context", 20000), ("aspect", 2000))]
    return blocks[0].unionByName(blocks[1]).withColumn("idf", F.round("idf", 6))


@query("polarity_classifier")
def q_polarity_classifier(spark, sf_dir):
    from aspectra.operators.metrics import classification_report
    from aspectra.operators.ml import polarity_classifier

    ex = _examples_split(spark, sf_dir)
    pred = polarity_classifier(ex.filter(F.col("split") == "train"), ex.filter(F.col("split") == "test"), max_iter=1000)
    return classification_report(pred.select("label", F.col("prediction_label").alias("prediction")))


@query("batch_generate")
def q_batch_generate(spark, sf_dir):
    """Entry 1 end to end: sentences -> generator hook (U1) -> parse (P8) -> aspect table (A2)."""
    from aspectra.functions.triplets import parse_generated
    from aspectra.operators.infer import batch_generate

    s = q_split_sentences(spark, sf_dir).withColumn("generated", batch_generate(F.col("sent")))
    trip = s.select(F.explode(parse_generated("generated", sentinel_empty=True)).alias("t")).select("t.*")
    return stats.with_rendered_reasons(stats.aspect_reasons(trip, min_mentions=2))


@query("batch_classify")
def q_batch_classify(spark, sf_dir):
    """U2 over every labelled term, scored like A7."""
    from aspectra.operators.infer import batch_classify
    from aspectra.operators.metrics import example_agreement
    from aspectra.sources.xml import flatten_examples

    ex = flatten_examples(_xml_sentences(spark, sf_dir)).withColumn("prediction", batch_classify(F.col("context"), F.col("aspect")))
    return example_agreement(ex, "prediction", "label")


# ---------------------------------------------------------------- text/JSON/CSV sources and sinks


def _write_tagged_corpus(spark, sf_dir):
    """V5 lines laid out as domain=<source>/split=<train|dev|test>/part-*.txt."""
    from aspectra.operators.splits import hash_split
    from aspectra.plans.materialize import new_scratch_path

    path = new_scratch_path(spark, "tagged-corpus")
    v5 = hash_split(views.tagged_lines(spark, sf_dir), "doc_id", valid_ratio=0.15, test_ratio=0.15)
    v5 = v5.withColumn("split", F.when(F.col("split") == "valid", "dev").otherwise(F.col("split")))
    v5.select(F.col("source").alias("domain"), "split", "line").write.partitionBy("domain", "split").text(path)
    return path


@query("scan_tagged")
def q_scan_tagged(spark, sf_dir):
    """Tagged text files read line by line and parsed (blank/malformed lines skipped)."""
    from aspectra.operators.tagged import parse_tagged

    lines = spark.read.text(_write_tagged_corpus(spark, sf_dir)).withColumnRenamed("value", "line")
    p = parse_tagged(lines)
    return p.select("domain", "split", "sentence", F.posexplode("triplets").alias("ord", "t")).select(
        "domain", "split", "sentence", "ord", "t.aspect", "t.opinion", "t.sentiment"
    )


@query("corpus_catalog")
def q_corpus_catalog(spark, sf_dir):
    from aspectra.sources.files import corpus_catalog, list_files

    return corpus_catalog(list_files(spark, _write_tagged_corpus(spark, sf_dir)), strict=False).select("domain", "split", F.col("unit").isNotNull().alias("found"))


@query("load_splits")
def q_load_splits(spark, sf_dir):
    """S4 + O1: every split of every domain with lineage (domain, split, row_id from the line
    number), target text and triplet count, as one union."""
    from aspectra.functions.triplets import render_triplets
    from aspectra.operators.tagged import parse_tagged
    from aspectra.sources.files import read_lines_with_index

    path = _write_tagged_corpus(spark, sf_dir)
    lines = read_lines_with_index(spark, path)
    lines = lines.withColumn("domain", F.regexp_extract("file_path", "/domain=([^/]+)/", 1)).withColumn(
        "split", F.regexp_extract("file_path", "/split=([^/]+)/", 1)
    )
    p = parse_tagged(lines)
    return p.select(
        "domain", "split",
        F.concat_ws("-", "domain", "split", F.regexp_extract("file_path", "part-([0-9]+)", 1), "line_idx").alias("row_id"),
        F.col("sentence").alias("text"), render_triplets("triplets").alias("target_text"),
        F.size("triplets").alias("triplet_count"),
    )


@query("sink_stats_roundtrip")
def q_sink_stats_roundtrip(spark, sf_dir):
    """K2 + S6: per-corpus tables written as JSON lines in the reference's row shape (named
    table, [[reason, count]] pairs) and read back; must equal V8."""
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.files import read_stats_json, stats_json_lines

    path = new_scratch_path(spark, "stats-json")
    stats_json_lines(_stats_by_source(spark, sf_dir), "predicted").write.text(path)
    return stats.with_rendered_reasons(read_stats_json(spark, path, "predicted"))


def _chunked(df, key, rows=1000):
    """``chunk``: deals the rows of a source by a hash of ``key`` into documents of about ``rows`` rows;
    the counts are aggregated before the join, so no task sees a whole source."""
    sizes = df.groupBy(F.col("source").alias("_source")).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).alias("_n"))
    same = df["source"].eqNullSafe(sizes["_source"])
    return df.join(sizes, same).drop("_source").withColumn("chunk", F.pmod(F.xxhash64(key), F.col("_n"))).drop("_n")


@query("scan_stats_json")
def q_scan_stats_json(spark, sf_dir):
    """S6 for a reference-style document: {"gold": [...], "predicted": [...]} per corpus file,
    read whole and unpacked with inline(table)."""
    from aspectra.plans.materialize import materialize, new_scratch_path
    from aspectra.sources.files import read_json_documents, stats_json_lines

    path = new_scratch_path(spark, "stats-doc")
    rows = stats_json_lines(_stats_by_source(spark, sf_dir), "predicted").select(
        F.get_json_object("value", "$.source").alias("source"), "value"
    )
    rows = _chunked(materialize(rows, "stats-rows"), "value")  # the sizes of the sources are counted over the written rows
    docs = rows.groupBy("source", "chunk").agg(
        F.concat(F.lit('{"predicted": ['), F.array_join(F.collect_list("value"), ","), F.lit("]}")).alias("doc")
    )
    docs.select("source", "chunk", "doc").write.partitionBy("source", "chunk").text(path)
    elem = (
        "aspect:string,positive:bigint,negative:bigint,neutral:bigint,total:bigint,majority_sentiment:string,"
        "positive_reasons:array<array<string>>,negative_reasons:array<array<string>>,neutral_reasons:array<array<string>>"
    )
    d = read_json_documents(spark, path, f"predicted array<struct<{elem}>>")
    out = d.select("source", F.inline("predicted"))
    conv = lambda c: F.array_join(F.transform(F.col(c), lambda p: F.concat(F.get(p, 0), F.lit(":"), F.get(p, 1))), ",")
    return out.select("source", "aspect", "positive", "negative", "neutral", "total", "majority_sentiment",
                      conv("positive_reasons").alias("positive_reasons"), conv("negative_reasons").alias("negative_reasons"),
                      conv("neutral_reasons").alias("neutral_reasons"))


@query("scan_csv_reviews")
def q_scan_csv_reviews(spark, sf_dir):
    """Reviews written as CSV (header, quoted multi-line text) and read back through the
    review-text column rule."""
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.files import read_review_csv

    path = new_scratch_path(spark, "reviews-csv")
    docs = views.labelled(spark, sf_dir).select("doc_id", F.col("text").alias("Review Text"), "sentiment")
    (docs.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_review_csv(spark, path)


@query("scan_csv_split")
def q_scan_csv_split(spark, sf_dir):
    """S7 in split form: the same files read in blocks of lines, whose records are found by quote counts."""
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.csv_split import read_review_csv_split

    path = new_scratch_path(spark, "reviews-csv-split")
    docs = views.labelled(spark, sf_dir).select("doc_id", F.col("text").alias("Review Text"), "sentiment")
    (docs.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_review_csv_split(spark, path)


@query("scan_json_reviews")
def q_scan_json_reviews(spark, sf_dir):
    """{case, text} arrays, one JSON document per corpus chunk of about 1,000 reviews."""
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.files import read_json_reviews

    path = new_scratch_path(spark, "reviews-json")
    d = views.documents(spark, sf_dir).select("source", F.col("doc_id").cast("string").alias("case"), "text")
    d = _chunked(d, "case")
    docs = d.groupBy("source", "chunk").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct("case", "text"))), ","), F.lit("]")).alias("doc")
    )
    docs.write.partitionBy("source", "chunk").text(path)
    return read_json_reviews(spark, path).select("case", "text")


@query("scan_reports")
def q_scan_reports(spark, sf_dir):
    """Each count-path report written to its own text file and read back whole."""
    from aspectra.plans.fixtures import count_reports
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.files import read_reports

    path = new_scratch_path(spark, "reports")
    count_reports(_selected(spark, sf_dir, False)).write.partitionBy("source").text(path)
    r = read_reports(spark, path)
    return r.select(F.regexp_extract("report_id", "/source=([^/]+)/", 1).alias("source"), "report")


#: Predictions repeat the words of their form: packed, a file is a small part of its text.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


@query("sink_predictions")
def q_sink_predictions(spark, sf_dir):
    """K4: lexicon predictions written as CSV (one row per sentence, target-style text) and read back."""
    from aspectra.functions.triplets import render_triplets
    from aspectra.plans.materialize import new_scratch_path

    _, _, _, pred, gold = _lexicon_run(spark, sf_dir)
    out = pred.join(gold.withColumnRenamed("triplets", "gold"), "sid").select(
        "sid", render_triplets("triplets").alias("predicted_text"), render_triplets("gold").alias("target_text")
    )
    path = new_scratch_path(spark, "predictions-csv")
    out.write.option("header", True).option("escape", '"').options(**PACKED).csv(path)
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)


@query("sink_reports")
def q_sink_reports(spark, sf_dir):
    """K5: report + check result as nested JSON, read back."""
    from aspectra.plans.materialize import new_scratch_path

    reports, _, (per_report, per_aspect) = _reasoned(spark, sf_dir)
    checks_nested = per_aspect.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("slot", "aspect", "valid", "errors"))).alias("checks"))
    doc = reports.join(per_report, "source").join(checks_nested, "source").select(
        "source", "report", F.struct("passed", "factual_passed", "coverage_passed", "claims_checked", "valid_claims",
                                     "coverage_warnings", "checks").alias("factual_check"),
    )
    path = new_scratch_path(spark, "reports-json")
    doc.write.json(path)
    back = spark.read.schema(doc.schema).json(path)
    return back.select("source", F.col("factual_check.passed").alias("passed"), F.size("factual_check.checks").alias("checks"))


@query("sink_stats_documents")
def q_sink_stats_documents(spark, sf_dir):
    """K2: gold and predicted tables of each corpus with its metadata as one nested document, read back."""
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.documents import read_stats_documents, write_stats_documents

    sp, _, _, pred, gold = _lexicon_run(spark, sf_dir)
    test = sp.where("split = 'test'").select("sid", "source")
    table = lambda d: stats.aspect_reasons(d.join(test, "sid").select("source", F.inline("triplets")), group_cols=["source"], top_n=10, min_mentions=2)
    about = test.groupBy("source").agg(F.lit(2).alias("min_mentions"), F.lit(10).alias("top_n_reasons"), F.count(F.lit(1)).alias("num_examples"))
    path = new_scratch_path(spark, "stats-documents")
    write_stats_documents({"gold": table(gold), "predicted": table(pred)}, about, path)
    back = read_stats_documents(spark, path, ("gold", "predicted"), "source:string,min_mentions:bigint,top_n_reasons:bigint,num_examples:bigint")
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x[0], F.lit(":"), x[1])), ",").alias(c)
    return back.select(
        "table", "source", "min_mentions", "num_examples", "aspect", "positive", "negative", "neutral", "total",
        "majority_sentiment", shown("positive_reasons"), shown("negative_reasons"), shown("neutral_reasons"),
    )


@query("sink_report_documents")
def q_sink_report_documents(spark, sf_dir):
    """K5: a document per corpus with report, status, selected aspects and attempt history, read back."""
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.documents import read_report_documents, write_reports

    path = new_scratch_path(spark, "report-documents")
    write_reports(_retried(spark, sf_dir)[0], path)
    attempts = F.transform("attempt_history", lambda h: F.concat(h["attempt"].cast("string"), F.lit(":"), h["passed"].cast("string")))
    return read_report_documents(spark, path).select(
        "source", "accepted", "status", "checker_mode", "generation_attempts", F.array_join("selected_aspects", "|").alias("selected_aspects"),
        F.array_join(attempts, ",").alias("attempts"), (F.get("attempt_history", F.size("attempt_history") - 1)["report"] == F.col("report")).alias("last_is_report"),
    )


RUN_SCHEMA = "model string, sentences bigint, tp bigint, pred_total bigint, gold_total bigint, precision double, recall double, f1 double"


@query("sink_run_metrics")
def q_sink_run_metrics(spark, sf_dir):
    """K3/K4: predictions written as CSV, the run's metrics observed in that pass and written as JSON,
    as CSV and as a line of the history; all three read back."""
    from aspectra.functions.triplets import render_triplets
    from aspectra.operators.metrics import triplet_key_set
    from aspectra.plans.materialize import new_scratch_path
    from aspectra.sources.documents import log_run, prf, write_measured

    _, _, _, pred, gold = _lexicon_run(spark, sf_dir)
    rows = gold.withColumnRenamed("triplets", "gold").join(pred.select("sid", "triplets"), "sid", "left")
    mine, want = triplet_key_set("triplets"), triplet_key_set("gold")
    rows = rows.select("sid", render_triplets("triplets").alias("predicted_text"), render_triplets("gold").alias("target_text"),
                       F.coalesce(F.size(F.array_intersect(mine, want)), F.lit(0)).alias("tp"), F.coalesce(F.size(mine), F.lit(0)).alias("pred_total"),
                       F.coalesce(F.size(want), F.lit(0)).alias("gold_total"))
    path = new_scratch_path(spark, "run")
    total = lambda c: F.coalesce(F.sum(F.greatest(F.col(c), F.lit(0))), F.lit(0))
    seen = write_measured(rows, lambda d: d.write.option("header", True).option("escape", '"').options(**PACKED).csv(f"{path}/predictions"),
                          {"sentences": F.count(F.lit(1)), **{c: total(c) for c in ("tp", "pred_total", "gold_total")}})
    run = {"model": "lexicon", **seen, **prf(seen["tp"], seen["pred_total"], seen["gold_total"])}
    log_run(spark, run, RUN_SCHEMA, f"{path}/json", f"{path}/csv", f"{path}/history")
    read = spark.read.schema(RUN_SCHEMA)
    back = {"json": read.json(f"{path}/json"), "csv": spark.read.schema(RUN_SCHEMA).option("header", True).csv(f"{path}/csv"), "history": read.json(f"{path}/history")}
    parts = [d.withColumn("sink", F.lit(n)) for n, d in back.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- stats validation

# Fixed rule for the derived "dirty" copy: rows whose seeded hash bucket (0-99) is below 10
# get one corruption each, kind = bucket.
CORRUPTIONS = 10


def _jstr(c):
    j = F.to_json(F.struct(c.alias("r")))
    return F.substring(j, 6, F.length(j) - 6)


def _pairs_json(c):
    return F.concat(F.lit("["), F.array_join(F.transform(F.col(c), lambda x: F.concat(F.lit("["), _jstr(x["reason"]), F.lit(","), x["n"].cast("string"), F.lit("]"))), ","), F.lit("]"))


def _dirty_stats_lines(spark, sf_dir):
    from aspectra.operators.splits import hash_unit

    t = _stats_by_source(spark, sf_dir)
    key = F.concat("source", F.lit("|"), "aspect")
    t = t.withColumn("_id", key).withColumn("_b", F.floor(hash_unit(key, seed=7) * 100)).withColumn(
        "_k", F.when(F.col("_b") < CORRUPTIONS, F.col("_b"))
    )
    k = F.col("_k")
    s = lambda c: F.col(c).cast("string")
    parts = [
        F.concat(F.lit('{"id":'), _jstr(F.col("_id"))),
        F.concat(F.lit(',"aspect":'), F.when(k == 1, F.lit('"  "')).otherwise(_jstr(F.col("aspect")))),
        F.concat(F.lit(',"positive":'), F.when(k == 2, F.lit("-1")).otherwise(s("positive"))),
        F.concat(F.lit(',"negative":'), F.when(k == 3, F.lit("true")).otherwise(s("negative"))),
        F.when(k == 0, F.lit("")).otherwise(F.concat(F.lit(',"neutral":'), s("neutral"))),
        F.concat(F.lit(',"total":'), F.when(k == 4, F.concat(s("total"), F.lit(".5"))).when(k == 5, (F.col("total") + 1).cast("string")).otherwise(s("total"))),
        F.concat(F.lit(',"majority_sentiment":'), _jstr(F.col("majority_sentiment"))),
        F.concat(F.lit(',"positive_reasons":'), F.when(k == 6, F.lit('"x"')).when(k == 9, F.lit('[["ok",0]]')).otherwise(_pairs_json("positive_reasons"))),
        F.concat(F.lit(',"negative_reasons":'), F.when(k == 7, F.lit('[["a",1,2]]')).otherwise(_pairs_json("negative_reasons"))),
        F.concat(F.lit(',"neutral_reasons":'), F.when(k == 8, F.lit('[[" ",1]]')).otherwise(_pairs_json("neutral_reasons")), F.lit("}")),
    ]
    return t.select(F.concat(*parts).alias("value"))


@query("validate_stats")
def q_validate_stats(spark, sf_dir):
    """P19 over a JSON-lines copy of V8 in which a hash-chosen tenth of the rows carries one
    corruption each; returns (id, first violation) for every invalid row."""
    from aspectra.operators.validate import stats_violations
    from aspectra.plans.materialize import new_scratch_path

    path = new_scratch_path(spark, "stats-dirty")
    _dirty_stats_lines(spark, sf_dir).write.text(path)
    checked = stats_violations(spark.read.text(path))
    return checked.filter(F.col("violation").isNotNull()).select(
        F.variant_get(F.try_parse_json("value"), "$.id", "string").alias("id"), "violation"
    )


#: Rows of a statistics document.
DOCUMENT_ROWS = 1000


@query("stats_documents")
def q_stats_documents(spark, sf_dir):
    """S6 + P19 over whole documents: the rows of ``validate_stats`` in documents of about
    ``DOCUMENT_ROWS`` rows, dealt by hash, with even ones a named table and odd ones a bare array; each
    source has one more document without the table. Every row comes back with its index, its
    violation or its normalised fields."""
    from aspectra.operators.splits import hash_unit
    from aspectra.operators.validate import stats_documents
    from aspectra.plans.materialize import materialize

    lines = materialize(_dirty_stats_lines(spark, sf_dir), "stats-dirty")
    lines = lines.select(F.get_json_object("value", "$.id").alias("id"), "value").withColumn("source", F.split_part("id", F.lit("|"), F.lit(1)))
    sizes = lines.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(DOCUMENT_ROWS)).alias("n"))
    dealt = lines.join(sizes, "source").withColumn("chunk", F.floor(hash_unit("id", seed=11) * F.col("n")))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "value"))), lambda x: x["value"]), ",")
    docs = dealt.groupBy("source", "chunk").agg(F.concat(F.lit("["), rows, F.lit("]")).alias("value"))
    docs = docs.withColumn("value", F.when(F.col("chunk") % 2 == 0, F.concat(F.lit('{"gold": [], "predicted": '), "value", F.lit("}"))).otherwise(F.col("value")))
    without = sizes.select("source", F.lit(-1).cast("long").alias("chunk"), F.lit('{"gold": []}').alias("value"))
    out = stats_documents(docs.unionByName(without))
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["reason"], F.lit(":"), x["n"].cast("string"))), ",").alias(c)
    return out.select(
        "source", "chunk", F.col("row_index").cast("long").alias("row_index"), "violation", "aspect", "positive", "negative", "neutral", "total",
        "majority_sentiment", shown("positive_reasons"), shown("negative_reasons"), shown("neutral_reasons"),
    )


# ---------------------------------------------------------------- retry loop and synthetic tables


@query("retry_rejects")
def q_retry_rejects(spark, sf_dir):
    """Attempt 1 is the perturbed rendering, attempt 2 a clean one in the same style, attempt 3
    the role form; only corpora rejected at attempt k-1 are generated again, each attempt from its
    own prompt, and the loop ends when none is left."""
    final, _ = _retried(spark, sf_dir)
    return final.select("source", "generation_attempts", "accepted", "status", "checker_mode", F.array_join("selected_aspects", "|").alias("selected_aspects"))


def _retried(spark, sf_dir):
    from aspectra.operators.checks import check_structured
    from aspectra.operators.reports import prompt_roles, retry_rejects
    from aspectra.plans.fixtures import count_reports

    table = _stats_by_source(spark, sf_dir, reasons=False)

    def generate(rows, attempt):
        reports = count_reports(rows, perturb=attempt == 1, style=0 if attempt == 3 else None)
        return reports.join(prompt_roles(rows, retry_number=attempt - 1), "source")

    def check(reports, rows):
        per_report, _ = check_structured(reports, table, selected=rows)
        return per_report.withColumn("coverage_warnings", F.array().cast("array<string>"))

    return retry_rejects(_selected(spark, sf_dir, False), generate, check, max_attempts=3)


@query("retry_routed")
def q_retry_routed(spark, sf_dir):
    """C6 + C7: corpora with and without reasons (half of the sources by hash have theirs taken away) go
    through one attempt loop, each with the prompt, the retry prompt and the checker of its kind."""
    from aspectra.operators.checks import check_reasoned, check_structured
    from aspectra.operators.reports import prompt_reasoned, prompt_roles, retry_rejects, routed
    from aspectra.operators.select import select_report_rows
    from aspectra.plans.fixtures import count_reports, reasoned_reports, style_of
    from aspectra.plans.materialize import materialize

    plain = style_of(F.concat(F.lit("kind:"), F.col("source")), 2) == 0
    table = _stats_by_source(spark, sf_dir)
    for c in ("positive_reasons", "negative_reasons", "neutral_reasons"):
        table = table.withColumn(c, F.when(plain, F.slice(c, 1, 0)).otherwise(F.col(c)))
    table = materialize(table, "routed-stats")

    def by_counts(rows, attempt):
        return count_reports(rows, perturb=attempt == 1, style=0 if attempt == 3 else None).join(prompt_roles(rows, retry_number=attempt - 1), "source")

    def by_reasons(rows, attempt):
        return reasoned_reports(rows, perturb=attempt == 1).join(prompt_reasoned(rows, retry_number=attempt - 1), "source")

    def check_counts(reports, rows):
        return check_structured(reports, table, selected=rows)[0].withColumn("coverage_warnings", F.array().cast("array<string>"))

    def check_reasons(reports, rows):
        return check_reasoned(reports, rows, mode="factual-only")[0]

    generate, check = routed((by_counts, check_counts), (by_reasons, check_reasons))
    final, _ = retry_rejects(materialize(select_report_rows(table, ["source"], max_aspects=4), "routed-rows"), generate, check, max_attempts=3)
    return final.select("source", "generation_attempts", "accepted", "status", "checker_mode", F.array_join("selected_aspects", "|").alias("selected_aspects"))


#: Names per pool and (role, leading sentiment, share in percent) of the synthetic tables.
SYNTH_POOLS = (("train", 240), ("valid", 60), ("test", 60))
SYNTH_LEADING = (("most_discussed", "positive", 50), ("strongest_positive", "positive", 80), ("strongest_negative", "negative", 75), ("most_divided", "negative", 45))


def _synthetic_names(spark, sf_dir):
    from aspectra.operators.synth import synthetic_names

    return synthetic_names(spark, _stats_by_source(spark, sf_dir, reasons=False).select("aspect"), SYNTH_POOLS)


@query("synth_names")
def q_synth_names(spark, sf_dir):
    return _synthetic_names(spark, sf_dir)


@query("synth_rows")
def q_synth_rows(spark, sf_dir):
    from aspectra.operators.synth import synthetic_rows

    return stats.with_rendered_reasons(synthetic_rows(_synthetic_names(spark, sf_dir), SYNTH_LEADING))


@query("synth_reports")
def q_synth_reports(spark, sf_dir):
    """Every group of four synthetic rows (one per role) rendered as a reason-aware
    paragraph (four rotating styles) and audited by the reason-aware checker."""
    from aspectra.operators.checks import check_reasoned
    from aspectra.operators.synth import synthetic_rows
    from aspectra.plans.fixtures import reasoned_reports

    rows = synthetic_rows(_synthetic_names(spark, sf_dir), SYNTH_LEADING)
    sel = rows.select(
        F.concat("pool", F.lit("-"), F.floor(F.col("slot") / 4).cast("string")).alias("example"),
        (F.pmod(F.col("slot"), F.lit(4)) + 1).alias("slot"), F.col("name").alias("aspect"),
        "positive", "negative", "neutral", "total", "positive_reasons", "negative_reasons", "neutral_reasons",
    )
    reports = reasoned_reports(sel, key="example")
    per_report, _ = check_reasoned(reports, sel, key=["example"])
    return reports.join(per_report.select("example", "passed", "claims_checked", "valid_claims"), "example")


# ---------------------------------------------------------------- second corpus: conversations grouped by role


@query("conversation_aspects")
def q_conversation_aspects(spark, sf_dir):
    """Entry 1 on the second corpus: conversation turns -> sentences -> lexicon triplets
    (lexicon fitted on the documents' train split) -> A2 per speaker role."""
    from aspectra.functions.text import split_sentence_array
    from aspectra.operators.lexicon import fit_lexicon, lexicon_predict
    from aspectra.session import read_table, spread

    vocab, lex = fit_lexicon(_gold_triplets(_split_sentences(spark, sf_dir), "train"))
    conv = spread(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    sents = conv.select("conv_id", "turn", "role", F.posexplode(split_sentence_array("text")).alias("pos", "sent")).withColumn(
        "sid", F.struct("conv_id", "turn", "pos", "role")
    ).withColumn("tokens", tokens("sent"))
    pred = lexicon_predict(sents, vocab, lex)
    trip = pred.select(F.col("sid.role").alias("role"), F.inline("triplets"))
    return stats.with_rendered_reasons(stats.aspect_reasons(trip, group_cols=["role"], min_mentions=2))
