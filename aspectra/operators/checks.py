"""Report audits.

C1 (structured): claims are pulled out of each report with the six claim grammars
(``regexp_extract_all`` per group, zipped), exploded, and checked against the corpus' full
statistics table with a left join on (corpus, aspect) — the table can be large, so it is
joined, never collected. Report-level facts (unparsed numbers, leftover text, duplicate
claims) are row-local string work.

C2 (reason-aware): a report is checked against its corpus' *selected* rows only (at most
max_aspects), so those rows travel with the report as one small array and sentence /
segment splitting, aspect spotting (longest first, overlaps suppressed) and reason
grounding are array functions on that row: no per-segment shuffle.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aspectra.functions.text import WS, col_, norm_key, strip_ws

_S = WS + "*"
_S1 = WS + "+"
_ASPECT = "([A-Za-z][A-Za-z0-9 /_-]*?)"
_D = "([0-9]+)"

# The claim grammars (same patterns for Java regex and RE2). Each entry:
# (role or None, pattern, group numbers of aspect, total, positive, negative, neutral).
CLAIM_GRAMMARS = [
    ("structured", None,
     f"(?i){_ASPECT}:{_S}{_D}{_S1}mentions?{_S}\\({_S}{_D}{_S1}positive{_S},{_S}{_D}{_S1}negative{_S},{_S}{_D}{_S1}neutral{_S}\\)",
     (1, 2, 3, 4, 5)),
    ("natural", None,
     f"(?i)(?:Finally,{_S})?{_ASPECT}{_S1}received{_S1}{_D}{_S1}mentions?{_S},{_S}(?:including|with){_S1}{_D}{_S1}positive{_S},{_S}"
     f"{_D}{_S1}negative{_S},{_S}and{_S}{_D}{_S1}neutral",
     (1, 2, 3, 4, 5)),
    ("most_discussed", "most_discussed",
     f"(?i){_ASPECT}{_S1}attracted{_S1}the{_S1}most{_S1}attention{_S},{_S}with{_S1}{_D}{_S1}mentions?{_S}:{_S}{_D}{_S1}positive{_S},{_S}"
     f"{_D}{_S1}negative{_S},{_S}and{_S}{_D}{_S1}neutral",
     (1, 2, 3, 4, 5)),
    ("strongest_positive", "strongest_positive",
     f"(?i){_ASPECT}{_S1}emerged{_S1}as{_S1}the{_S1}clearest{_S1}strength{_S},{_S}receiving{_S1}{_D}{_S1}positive{_S1}mentions?{_S1}"
     f"out{_S1}of{_S1}{_D}{_S},{_S}alongside{_S1}{_D}{_S1}negative{_S1}and{_S1}{_D}{_S1}neutral",
     (1, 3, 2, 4, 5)),
    ("strongest_negative", "strongest_negative",
     f"(?i)(?:In{_S1}contrast{_S},{_S})?{_ASPECT}{_S1}was{_S1}the{_S1}main{_S1}concern{_S},{_S}with{_S1}{_D}{_S1}negative{_S1}mentions?{_S1}"
     f"out{_S1}of{_S1}{_D}{_S},{_S}compared{_S1}with{_S1}{_D}{_S1}positive{_S1}and{_S1}{_D}{_S1}neutral",
     (1, 3, 4, 2, 5)),
    ("most_divided", "most_divided",
     f"(?i){_ASPECT}{_S1}feedback{_S1}was{_S1}the{_S1}most{_S1}divided{_S},{_S}with{_S1}{_D}{_S1}positive{_S},{_S}{_D}{_S1}negative{_S},{_S}"
     f"and{_S}{_D}{_S1}neutral{_S1}mentions?{_S1}among{_S1}{_D}{_S1}total",
     (1, 5, 2, 3, 4)),
]
NUMBER_RE = "[0-9]+(?:\\.[0-9]+)?%?"
LEFTOVER_STRIP = " \t\r\n.;"
TOO_LARGE = "a number too large"
COUNT_FIELDS = ("total", "positive", "negative", "neutral")


def extract_claims(report) -> Column:
    """array<struct<kind, role, k, aspect, total, positive, negative, neutral>> over all grammars.

    A number beyond a BIGINT is null, which matches no source row's count."""
    r = col_(report)
    def to_claim(kind, role):
        def f(z, i):
            return F.struct(
                F.lit(kind).alias("kind"),
                F.lit(role).cast("string").alias("role"),
                i.alias("k"),
                norm_key(z["g0"]).alias("aspect"),
                z["g1"].try_cast("bigint").alias("total"),
                z["g2"].try_cast("bigint").alias("positive"),
                z["g3"].try_cast("bigint").alias("negative"),
                z["g4"].try_cast("bigint").alias("neutral"),
            )

        return f

    parts = []
    for kind, role, pat, groups in CLAIM_GRAMMARS:
        cols = [F.regexp_extract_all(r, F.lit(pat), g) for g in groups]
        zipped = F.arrays_zip(*[c.alias(f"g{i}") for i, c in enumerate(cols)])
        parts.append(F.transform(zipped, to_claim(kind, role)))
    return F.concat(*parts)


def _places(text: Column, pattern: str) -> Column:
    """(s, e) of each match: starts follow from the lengths of the pieces and matches before."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), F.length)
    between = F.transform(F.split(text, pattern, -1), F.length)
    total = lambda arr: F.aggregate(arr, F.lit(0), lambda a, x: a + x)
    return F.transform(found, lambda n, i: F.struct(
        (total(F.slice(between, F.lit(1), i + 1)) + total(F.slice(found, F.lit(1), i))).alias("s"),
        (total(F.slice(between, F.lit(1), i + 1)) + total(F.slice(found, F.lit(1), i + 1))).alias("e"),
    ))


def claim_spans(report: Column) -> Column:
    """Places of all claims in the report as it stands, sorted by start."""
    return F.array_sort(F.concat(*[_places(report, pat) for _, _, pat, _ in CLAIM_GRAMMARS]))


def numbers_outside(report: Column, spans: Column) -> Column:
    """How many number tokens lie in no claim."""
    return F.size(F.filter(_places(report, NUMBER_RE), lambda n: ~F.exists(spans, lambda c: (c["s"] <= n["s"]) & (n["e"] <= c["e"])))).cast("bigint")


def text_outside(report: Column, spans: Column) -> Column:
    """What remains of the report without its claims."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    walked = F.aggregate(spans, start, lambda acc, c: F.struct(
        F.greatest(acc["at"], c["e"]).alias("at"),
        F.concat(acc["text"], F.substring(report, acc["at"] + 1, F.greatest(F.lit(0), c["s"] - acc["at"]))).alias("text"),
    ))
    rest = F.concat(walked["text"], F.substring(report, walked["at"] + 1, F.length(report)))
    return F.btrim(rest, F.lit(LEFTOVER_STRIP))


def claim_check(claims: DataFrame, table: DataFrame, key: Sequence[str] = ("source",)) -> DataFrame:
    """One row per claim with its source row (left join) and mismatch messages."""
    k = list(key)
    src = table.select(*k, "aspect", *[F.col(c).alias(f"exp_{c}") for c in COUNT_FIELDS])
    j = claims.join(src, [*k, "aspect"], "left")
    found = F.col("exp_total").isNotNull()
    errs = F.when(~found, F.array(F.lit("aspect not found in source statistics"))).otherwise(
        F.filter(
            F.array(*[
                F.when(~F.col(c).eqNullSafe(F.col(f"exp_{c}")),
                       F.concat(F.lit(f"{c}: claimed "), F.coalesce(F.col(c).cast("string"), F.lit(TOO_LARGE)), F.lit(", expected "), F.col(f"exp_{c}").cast("string")))
                for c in COUNT_FIELDS
            ]),
            lambda x: x.isNotNull(),
        )
    )
    return j.withColumn("errors", errs).withColumn("valid", F.size("errors") == 0)


def check_structured(reports: DataFrame, table: DataFrame, key: Sequence[str] = ("source",), report: str = "report",
                     selected: DataFrame | None = None, totals: bool = False) -> tuple[DataFrame, DataFrame]:
    """C1. Returns (per_report, per_claim).

    With ``selected`` (key, slot, aspect, role) each of its aspects and roles must be claimed,
    and a role by the aspect selected for it: missing_aspects, missing_roles and role_errors are
    added and count for ``passed``. Without it an existing report is checked as it is. ``totals``
    adds how many of each there are (n_...), for ``report_totals``."""
    k = list(key)
    base = reports.select(*k, F.col(report).alias("report"), extract_claims(report).alias("claims"), claim_spans(F.col(report)).alias("_spans"))
    per_claim = claim_check(
        base.select(*k, F.explode("claims").alias("c")).select(*k, "c.*"), table, k
    )
    rolled = per_claim.groupBy(*k).agg(
        F.count_if("valid").alias("valid_claims"), F.bool_and("valid").alias("_all_valid")
    )
    if selected is not None:
        want = selected.groupBy(*k).agg(F.array_sort(F.collect_list(F.struct("slot", norm_key("aspect").alias("aspect"), "role"))).alias("_want"))
        base = base.join(want, k, "left").withColumn("_want", F.coalesce("_want", F.array().cast("array<struct<slot:int,aspect:string,role:string>>")))
    aspects = F.transform("claims", lambda c: c["aspect"])
    dups = F.array_sort(F.array_distinct(F.filter(aspects, lambda a: F.size(F.filter(aspects, lambda b: b == a)) > 1)))
    extra: list[Column] = []
    if selected is not None:
        by_role = lambda role: F.element_at(F.filter("claims", lambda c: c["role"] == role), -1)["aspect"]  # noqa: E731  the last claim counts
        with_role = F.filter("_want", lambda x: x["role"].isNotNull())
        claimed_roles = F.transform("claims", lambda c: c["role"])
        wrong = F.filter(
            F.transform(F.filter(with_role, lambda x: F.array_contains(claimed_roles, x["role"])), lambda x: F.struct(x["role"].alias("role"), x["aspect"].alias("want"), by_role(x["role"]).alias("got"))),
            lambda x: x["got"] != x["want"],
        )
        extra = [
            F.array_sort(F.array_except(F.transform("_want", lambda x: x["aspect"]), aspects)).alias("_missing_aspects"),
            F.array_sort(F.array_except(F.transform(with_role, lambda x: x["role"]), claimed_roles)).alias("_missing_roles"),
            F.transform(wrong, lambda x: F.concat(x["role"], F.lit(": claimed "), x["got"], F.lit(", expected "), x["want"])).alias("_role_errors"),
        ]
    rep = base.select(
        *k,
        F.size("claims").cast("bigint").alias("claims_checked"),
        numbers_outside(F.col("report"), F.col("_spans")).alias("unparsed_numeric_tokens"),
        dups.alias("_dups"),
        text_outside(F.col("report"), F.col("_spans")).alias("unexpected_text"),
        *extra,
    ).join(rolled, k, "left")
    passed = (
        (F.col("claims_checked") > 0)
        & F.coalesce(F.col("_all_valid"), F.lit(True))
        & (F.col("unparsed_numeric_tokens") == 0)
        & (F.size("_dups") == 0)
        & (F.col("unexpected_text") == "")
    )
    named = ("missing_aspects", "missing_roles", "role_errors") if selected is not None else ()
    for c in named:
        passed = passed & (F.size(f"_{c}") == 0)
    out = rep.select(
        *k, passed.alias("passed"), "claims_checked",
        F.coalesce("valid_claims", F.lit(0)).cast("bigint").alias("valid_claims"),
        "unparsed_numeric_tokens", F.array_join("_dups", ",").alias("duplicate_aspects"), "unexpected_text",
        *[F.array_join(f"_{c}", ",").alias(c) for c in named],
        *([F.size("_dups").alias("n_duplicate_aspects"), *[F.size(f"_{c}").alias(f"n_{c}") for c in named]] if totals else []),
    )
    return out, per_claim


# ---------------------------------------------------------------- reason-aware check

SEGMENT_RE = f"(?i);{_S}|,{_S}(?:whereas|while|but){_S1}|\\b(?:whereas|while)\\b"
SENTENCE_RE = f"(?<=[.!?]){_S1}"
WORD = "[\\p{L}\\p{N}_]"


def phrase_regex(phrase: Column) -> Column:
    """Whole-phrase, case-insensitive pattern (word characters = letters, digits, underscore)."""
    q = F.concat(F.lit("\\Q"), F.replace(phrase, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    return F.concat(F.lit(f"(?iu)(?<!{WORD})"), q, F.lit(f"(?!{WORD})"))


def has_phrase(text: Column, phrase: Column) -> Column:
    return F.regexp_like(text, phrase_regex(phrase))


def segments(report) -> Column:
    sents = F.filter(F.transform(F.split(strip_ws(col_(report)), SENTENCE_RE), strip_ws), lambda s: s != "")
    return F.flatten(
        F.transform(sents, lambda s: F.filter(F.transform(F.split(s, SEGMENT_RE), strip_ws), lambda x: x != ""))
    )


def _occurrences(seg: Column, aspect: Column) -> Column:
    """(start, end, aspect) of every whole-word occurrence of ``aspect`` in ``seg``; starts come
    from the lengths of the pieces between matches (match length = aspect length)."""
    pieces = F.split(seg, phrase_regex(aspect), -1)
    lens = F.transform(pieces, lambda p: F.length(p))
    L = F.length(aspect)
    occ = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))),
        lambda j: F.struct(
            (F.aggregate(F.slice(lens, 1, j), F.lit(0), lambda a, b: a + b) + (j - 1) * L).alias("start"),
            aspect.alias("aspect"),
            L.alias("len"),
        ),
    )
    return F.when(F.size(pieces) > 1, occ).otherwise(F.filter(occ, lambda x: F.lit(False)))


def segment_aspect_set(seg: Column, aspects: Column) -> Column:
    """Aspects mentioned in a segment, longest first, overlapping shorter ones dropped."""
    cands = F.flatten(F.transform(aspects, lambda a: _occurrences(seg, a)))
    ordered = F.array_sort(
        cands,
        lambda l, r: F.when(l["len"] > r["len"], -1).when(l["len"] < r["len"], 1)
        .when(l["start"] < r["start"], -1).when(l["start"] > r["start"], 1).otherwise(0),
    )
    kept = F.aggregate(
        ordered,
        F.filter(ordered, lambda x: F.lit(False)),
        lambda acc, c: F.when(
            F.exists(acc, lambda o: (c["start"] < o["start"] + o["len"]) & (o["start"] < c["start"] + c["len"])), acc
        ).otherwise(F.concat(acc, F.array(c))),
    )
    return F.array_distinct(F.transform(kept, lambda x: x["aspect"]))


def _reason_list(row: Column) -> Column:
    return F.array_distinct(F.transform(
        F.concat(F.coalesce(row["positive_reasons"], F.array()), F.coalesce(row["negative_reasons"], F.array()),
                 F.coalesce(row["neutral_reasons"], F.array())),
        lambda x: F.lower(x["reason"]),
    ))


def _reason_counts(row: Column) -> Column:
    return F.transform(
        F.concat(F.coalesce(row["positive_reasons"], F.array()), F.coalesce(row["negative_reasons"], F.array()),
                 F.coalesce(row["neutral_reasons"], F.array())),
        lambda x: x["n"].cast("string"),
    )


def _digits(text: Column) -> Column:
    """The digit runs of a text without leading zeros, as text, so that any length compares."""
    return F.transform(F.regexp_extract_all(text, F.lit("[0-9]+"), 0), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", ""))


def check_reasoned(reports: DataFrame, selected: DataFrame, key: Sequence[str] = ("source",), report: str = "report",
                   mode: str = "factual-only", totals: bool = False) -> tuple[DataFrame, DataFrame]:
    """C2. ``selected``: (key, slot, aspect, counts, reason arrays). Returns
    (per_report, per_aspect)."""
    if mode not in ("factual-only", "strict"):
        raise ValueError("mode must be 'factual-only' or 'strict'")
    k = list(key)
    row = F.struct(
        F.lower(F.col("aspect")).alias("aspect"), "slot", *[F.col(c).cast("bigint").alias(c) for c in COUNT_FIELDS],
        "positive_reasons", "negative_reasons", "neutral_reasons",
    )
    rows = selected.groupBy(*k).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    d = reports.select(*k, F.col(report).alias("report")).join(rows, k)
    d = d.withColumn("segs", segments("report"))
    d = d.withColumn("_aspects", F.transform("rows", lambda r: r["aspect"]))
    d = d.withColumn("seg_aspects", F.transform("segs", lambda s: F.struct(s.alias("seg"), segment_aspect_set(s, F.col("_aspects")).alias("found"))))
    d = d.withColumn("all_reasons", F.array_distinct(F.flatten(F.transform("rows", _reason_list))))

    def per_aspect(r):
        segs = F.filter("seg_aspects", lambda x: F.array_contains(x["found"], r["aspect"]))
        text = F.lower(F.array_join(F.transform(segs, lambda x: x["seg"]), " "))
        nums = _digits(text)
        total, *parts = (r[c].cast("string") for c in COUNT_FIELDS)
        allowed = F.concat(F.array(total, *parts), _reason_counts(r))
        invalid = F.filter(nums, lambda x: ~F.array_contains(allowed, x))
        own = _reason_list(r)
        found = F.array_sort(F.filter(own, lambda x: has_phrase(text, x)))
        foreign = F.array_sort(F.filter(F.array_except(F.col("all_reasons"), own), lambda x: (F.length(x) >= 3) & has_phrase(text, x)))
        checked = F.size(segs) > 0
        errors = F.filter(F.array(
            F.when(F.size(invalid) > 0, F.concat(F.lit("unsupported numbers: ["), F.array_join(invalid, ", "), F.lit("]"))),
            F.when(~F.array_contains(nums, total), F.concat(F.lit("missing total count "), total)),
            F.when(F.size(F.array_intersect(F.array(*parts), nums)) == 0, F.lit("missing sentiment count evidence")),
            F.when((F.size(own) > 0) & (F.size(found) == 0), F.lit("no grounded reason mentioned")),
            F.when(F.size(foreign) > 0, F.concat(F.lit("reasons belong to another aspect: ["), F.array_join(foreign, ", "), F.lit("]"))),
        ), lambda x: x.isNotNull())
        return F.struct(
            r["aspect"].alias("aspect"), r["slot"].alias("slot"), checked.alias("checked"),
            F.when(checked, F.size(errors) == 0).alias("valid"),
            F.array_join(nums, ",").alias("numbers_found"), F.array_join(found, ",").alias("reasons_found"), F.array_join(foreign, ",").alias("foreign_reasons"),
            F.when(checked, F.array_join(errors, "; ")).otherwise(F.lit("aspect not mentioned")).alias("errors"),
        )

    d = d.withColumn("checks", F.transform("rows", per_aspect))
    unknown = F.flatten(F.transform(
        F.filter("seg_aspects", lambda x: F.size(x["found"]) == 0),
        lambda x: _digits(x["seg"]),
    ))
    distinct_segs = F.array_distinct(F.col("seg_aspects"))
    checked = F.filter("checks", lambda c: c["checked"])
    missing = F.array_sort(F.transform(F.filter("checks", lambda c: ~c["checked"]), lambda c: c["aspect"]))
    repeated = F.array_sort(F.filter("_aspects", lambda a: F.size(F.filter(distinct_segs, lambda x: F.array_contains(x["found"], a))) > 1))
    d = d.select(
        *k, "checks", unknown.alias("unknown"), checked.alias("_checked"), missing.alias("_missing"), repeated.alias("_repeated"),
    )
    factual = (F.size("_checked") > 0) & F.forall("_checked", lambda c: c["valid"]) & (F.size("unknown") == 0)
    coverage = F.size("_missing") == 0
    warnings = F.filter(F.array(
        F.when(F.size("_missing") > 0, F.concat(F.lit("Missing aspects: "), F.array_join("_missing", ", "))),
        F.when(F.size("_repeated") > 0, F.concat(F.lit("Repeated aspects: "), F.array_join("_repeated", ", "))),
    ), lambda x: x.isNotNull())
    passed = factual if mode == "factual-only" else (factual & coverage)
    per_report = d.select(
        *k, passed.alias("passed"), factual.alias("factual_passed"), coverage.alias("coverage_passed"),
        F.lit(mode).alias("checker_mode"),
        F.size("_checked").cast("bigint").alias("claims_checked"),
        F.size(F.filter("_checked", lambda c: c["valid"])).cast("bigint").alias("valid_claims"),
        F.array_join("_missing", ",").alias("missing_aspects"), F.array_join("_repeated", ",").alias("repeated_aspects"),
        warnings.alias("coverage_warnings"),
        F.array_join("unknown", ",").alias("unattributed_numbers"),
        *([F.size(f"_{c}").alias(f"n_{c}_aspects") for c in ("missing", "repeated")] + [F.size(warnings).alias("n_warnings")] if totals else []),
    )
    per_aspect_rows = d.select(*k, F.explode("checks").alias("c")).select(*k, "c.*")
    return per_report, per_aspect_rows


def grounded(reports: DataFrame, selected: DataFrame, key: Sequence[str] = ("source",), report: str = "report") -> DataFrame:
    """C4: aspect present (whole word: a plain substring would count "bar" in "barely"), total
    present as a substring, some reason present as a substring, and no number outside all rows'
    allowed counts."""
    k = list(key)
    row = F.struct(F.lower(F.col("aspect")).alias("aspect"), *[F.col(c).cast("bigint").alias(c) for c in COUNT_FIELDS],
                   "positive_reasons", "negative_reasons", "neutral_reasons")
    rows = selected.groupBy(*k).agg(F.collect_list(row).alias("rows"))
    d = reports.select(*k, F.col(report).alias("report")).join(rows, k).withColumn("text", F.lower("report"))
    allowed = F.flatten(F.transform("rows", lambda r: F.concat(F.array(*[r[c].cast("string") for c in COUNT_FIELDS]), _reason_counts(r))))
    nums = _digits(F.col("report"))
    unsupported = F.filter(nums, lambda x: ~F.array_contains(allowed, x))
    valid_row = lambda r: (
        has_phrase(F.col("text"), r["aspect"]) & F.col("text").contains(r["total"].cast("string"))
        & F.exists(F.transform(F.concat(F.coalesce(r["positive_reasons"], F.array()), F.coalesce(r["negative_reasons"], F.array()),
                                        F.coalesce(r["neutral_reasons"], F.array())), lambda x: x["reason"]),
                   lambda x: F.col("text").contains(x))
    )
    return d.select(
        *k, (F.forall("rows", valid_row) & (F.size(unsupported) == 0)).alias("passed"),
        F.size(F.filter("rows", valid_row)).cast("bigint").alias("valid_rows"),
        F.array_join(unsupported, ",").alias("unsupported_numbers"),
    )


def report_rollup(per_report: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Reports checked, passed, pass rate."""
    g = list(group_cols)
    return per_report.groupBy(*g).agg(
        F.count(F.lit(1)).alias("reports"), F.count_if("passed").alias("passed"),
        F.round(F.avg(F.col("passed").cast("double")), 6).alias("pass_rate"),
    )


#: What ``report_totals`` adds up; a checker that has no such column counts none.
TOTALS = ("n_duplicate_aspects", "n_missing_aspects", "n_missing_roles", "n_role_errors", "n_repeated_aspects", "n_warnings")


def report_totals(per_report: DataFrame, by: Sequence[str] = ("style", "status")) -> DataFrame:
    """Reports, passed, pass rate, claims and totals of each kind of finding, for every
    combination of ``by``, each column alone and all reports together ("all" in the columns left
    out), from one aggregation. ``per_report``: rows of a checker with ``totals``."""
    sets = [[c for i, c in enumerate(by) if n >> i & 1] for n in range(1 << len(by))]
    found = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint") if c in per_report.columns else F.lit(0).cast("bigint") for c in TOTALS]
    got = per_report.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by]).agg(
        F.count(F.lit(1)).alias("reports"), F.count_if("passed").alias("passed"), F.round(F.avg(F.col("passed").cast("double")), 6).alias("pass_rate"),
        F.sum("claims_checked").alias("claims"), F.sum("valid_claims").alias("valid_claims"),
        *[f.alias(c) for f, c in zip(found, TOTALS)], *[F.grouping(c).alias(f"_{c}") for c in by],
    )
    return got.select(*[F.when(F.col(f"_{c}") == 1, F.lit("all")).otherwise(F.col(c)).alias(c) for c in by], *[c for c in got.columns if c not in by and c[0] != "_"])
