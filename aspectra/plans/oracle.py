"""DuckDB oracle SQL, one string per registered query that SQL can express.

Views over the driver tables are pre-registered by the driver; the derived views
(v1..v4) are rebuilt here as CTEs from ``aspectra.plans.sqlviews``.
"""
from __future__ import annotations

import re

from aspectra.plans.sqlviews import a1_sql, a2_sql, lower_strip, tokens, with_views

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


sql("aspect_reasons", with_views("v4", a2_sql("v4", 10)) + "SELECT * FROM a2")

sql(
    "aspect_reasons_by_source",
    with_views("v4", a2_sql("v4", 10, group="source")) + "SELECT * FROM a2 WHERE total >= 2",
)

sql("aspect_sentiment", with_views("v4", a1_sql("v4")) + "SELECT * FROM a1")

sql(
    "top_reasons",
    with_views("v4")
    + f""", rc AS (
  SELECT {lower_strip('aspect')} AS aspect, sentiment, {lower_strip('opinion')} AS reason, count(*) AS n
  FROM v4 WHERE {lower_strip('aspect')} <> '' AND sentiment IN ('positive','negative','neutral') GROUP BY ALL)
SELECT aspect, sentiment, reason, n, rk FROM (
  SELECT *, row_number() OVER (PARTITION BY aspect, sentiment ORDER BY n DESC, reason) AS rk
  FROM rc WHERE reason <> '') WHERE rk <= 10""",
)

sql("top_aspects", with_views("v4", a1_sql("v4")) + "SELECT * FROM a1 ORDER BY total DESC, aspect LIMIT 10")

sql(
    "split_sentences",
    with_views("v2")
    + f"SELECT doc_id, pos, sent FROM v2 WHERE len({tokens('sent')}) >= 2 AND regexp_matches(sent, '[a-zA-Z]')",
)

sql(
    "corpus_counters",
    with_views("v4")
    + f"""SELECT (SELECT count(DISTINCT doc_id) FROM v3) AS reviews_with_sentences, (SELECT count(*) FROM v3) AS sentences,
       round((SELECT count(*) FROM v3) / (SELECT count(DISTINCT doc_id) FROM v3), 6) AS sentences_per_review,
       count(*) AS triplets, count(DISTINCT {lower_strip('aspect')}) AS aspect_vocab, count(DISTINCT {lower_strip('opinion')}) AS opinion_vocab
FROM v4""",
)


# ---------------------------------------------------------------- tagged lines and generated text
from aspectra.plans.sqlviews import V6, detok, strip, tagged_parse_ctes  # noqa: E402
from aspectra.functions.triplets import TRIPLET_PATTERN_RE2  # noqa: E402

_T = with_views("v5", tagged_parse_ctes())

sql("parse_tagged", _T + "SELECT doc_id, pos, ord, aspect, opinion, sentiment FROM tt")
sql("parse_spans", _T + "SELECT doc_id, pos, ord, a0, a1, o0, o1, sentiment FROM ts")
sql(
    "span_phrases",
    _T
    + f""", tk AS (SELECT doc_id, pos, {tokens('sentence')} AS toks FROM ok5)
SELECT ts.doc_id, ts.pos, ts.ord, array_to_string(toks[a0 + 1:a1], ' ') AS aspect,
       array_to_string(toks[o0 + 1:o1], ' ') AS opinion, sentiment
FROM ts JOIN tk ON ts.doc_id = tk.doc_id AND ts.pos = tk.pos""",
)
sql("detokenize", with_views("v3") + f"SELECT doc_id, pos, {detok(chr(97) + 'rray_to_string(tokens, ' + chr(39) + ' ' + chr(39) + ')')} AS phrase FROM v3")
sql("render_triplets", with_views("v5", tagged_parse_ctes(), V6) + "SELECT doc_id, pos, generated FROM v6")

_G = with_views(
    "v5",
    tagged_parse_ctes(),
    V6,
    f"""gm AS (SELECT doc_id, pos, generated,
  regexp_extract_all(generated, '{TRIPLET_PATTERN_RE2}', 1) AS xa,
  regexp_extract_all(generated, '{TRIPLET_PATTERN_RE2}', 2) AS xo,
  regexp_extract_all(generated, '{TRIPLET_PATTERN_RE2}', 3) AS xs FROM v6),
gx AS (SELECT doc_id, pos, generated, unnest(range(0, len(xa))) AS ord, unnest(xa) AS a, unnest(xo) AS o, unnest(xs) AS s FROM gm)""",
)
sql("parse_generated", _G + f"SELECT doc_id, pos, ord, {strip('a')} AS aspect, {strip('o')} AS opinion, lower({strip('s')}) AS sentiment FROM gx")


def _normtext(x: str) -> str:
    from aspectra.functions.text import WS

    return f"regexp_replace(lower({strip(x)}), '{WS}+', ' ', 'g')"


sql(
    "parse_generated_set",
    _G
    + f"""SELECT DISTINCT doc_id, pos, {_normtext('a')} AS aspect, {_normtext('o')} AS opinion, {_normtext('s')} AS sentiment
FROM gx WHERE {_normtext('generated')} <> 'no triplet'""",
)


# ---------------------------------------------------------------- splits, lexicon baseline, metrics
from aspectra.plans.sqlviews import a1_sql as _a1  # noqa: E402


def _norm(x: str) -> str:
    return lower_strip(x)


def _hash_u(key: str) -> str:
    return f"((('0x' || substr(md5('42:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT)::DOUBLE / 4294967296.0)"


def _split_case(u: str) -> str:
    return f"CASE WHEN {u} < 0.15::DOUBLE THEN 'test' WHEN {u} < (0.15::DOUBLE + 0.15::DOUBLE) THEN 'valid' ELSE 'train' END"


_EMPTY_M = "[]::STRUCT(i BIGINT, n BIGINT, phrase VARCHAR, sentiment VARCHAR)[]"


def _fold(x: str) -> str:
    return (
        f"list_reduce(coalesce({x}, {_EMPTY_M}), lambda acc, m: CASE WHEN m.i >= acc.e THEN "
        f"{{'e': m.i + m.n, 'kept': list_append(acc.kept, m)}} ELSE acc END, {{'e': 0::BIGINT, 'kept': {_EMPTY_M}}}).kept"
    )


_LEX = with_views(
    "v5",
    tagged_parse_ctes(),
    f"""sp AS (SELECT o.doc_id, o.pos, o.sentence, v.source, o.doc_id || ':' || o.pos AS sid, {tokens('o.sentence')} AS toks,
              {_split_case(_hash_u('o.doc_id'))} AS split
       FROM ok5 o JOIN v5 v ON o.doc_id = v.doc_id AND o.pos = v.pos),
trn AS (SELECT t.* FROM tt t JOIN sp ON t.doc_id = sp.doc_id AND t.pos = sp.pos WHERE sp.split = 'train'),
voc AS (SELECT DISTINCT {_norm('aspect')} AS phrase FROM trn),
lc AS (SELECT {_norm('opinion')} AS phrase, sentiment, count(*) AS n, min({{'d': doc_id, 'p': pos, 'o': ord}}) AS f
       FROM trn GROUP BY ALL),
lex AS (SELECT phrase, sentiment FROM (
          SELECT *, row_number() OVER (PARTITION BY phrase ORDER BY n DESC, f) AS r FROM lc) WHERE r = 1),
tst AS (SELECT * FROM sp WHERE split = 'test'),
ng AS (SELECT t.sid, r.i, q.n::BIGINT AS n, lower(array_to_string(t.toks[r.i + 1 : r.i + q.n], ' ')) AS phrase
       FROM tst t, unnest(range(0, len(t.toks))) r(i), unnest([1, 2, 3]) q(n) WHERE r.i + q.n <= len(t.toks)),
dic AS (SELECT phrase, 'A' AS kind, NULL::VARCHAR AS sentiment FROM voc UNION ALL SELECT phrase, 'O', sentiment FROM lex),
hit AS (SELECT ng.*, dic.kind, dic.sentiment FROM ng JOIN dic ON ng.phrase = dic.phrase),
grp AS (SELECT sid,
          list({{'i': i, 'n': n, 'phrase': phrase, 'sentiment': sentiment}} ORDER BY i, n DESC) FILTER (WHERE kind = 'A') AS a_all,
          list({{'i': i, 'n': n, 'phrase': phrase, 'sentiment': sentiment}} ORDER BY i, n DESC) FILTER (WHERE kind = 'O') AS o_all
        FROM hit GROUP BY sid),
fld AS (SELECT sid, {_fold('a_all')} AS a_sp, {_fold('o_all')} AS o_sp FROM grp),
prd AS (SELECT sid, list_transform(a_sp, lambda a: list_min(list_transform(o_sp, lambda o:
          {{'d': abs((2 * o.i + o.n) - (2 * a.i + a.n)), 'i': o.i, 'n': o.n, 'phrase': o.phrase, 'sentiment': o.sentiment,
            'a': a}}))) AS best
        FROM fld WHERE len(o_sp) > 0),
pr AS (SELECT sid, unnest(range(0, len(best))) AS ord, unnest(best) AS b FROM prd),
prow AS (SELECT sid, ord, b.a.phrase AS aspect, b.phrase AS opinion, b.sentiment AS sentiment FROM pr),
grow AS (SELECT tst.sid, tt.ord, tt.aspect, tt.opinion, tt.sentiment FROM tt JOIN tst ON tt.doc_id = tst.doc_id AND tt.pos = tst.pos)""",
)

sql("hash_split", with_views("v1") + f"SELECT doc_id, {_split_case(_hash_u('doc_id'))} AS split FROM v1")
sql("seeded_sample", with_views("v1") + "SELECT doc_id, source FROM v1 ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100")
sql(
    "fit_lexicon",
    _LEX + "SELECT 'aspect' AS kind, phrase, NULL::VARCHAR AS sentiment FROM voc UNION ALL SELECT 'opinion', phrase, sentiment FROM lex",
)
sql(
    "lexicon_match",
    _LEX
    + """, ex AS (SELECT sid, 'aspect' AS kind, unnest(a_sp) AS s FROM fld UNION ALL SELECT sid, 'opinion', unnest(o_sp) FROM fld)
SELECT sid, kind, s.i AS i, s.n AS n, s.phrase AS phrase FROM ex""",
)
sql("lexicon_predict", _LEX + "SELECT sid, ord, aspect, opinion, sentiment FROM prow")
sql(
    "nearest_opinion",
    _LEX
    + """SELECT sid, b.a.i AS a_i, b.a.n AS a_n, b.a.phrase AS aspect, b.i AS o_i, b.n AS o_n, b.phrase AS opinion, b.d AS dist2
FROM pr""",
)
sql(
    "triplet_prf",
    _LEX
    + f""", ps AS (SELECT DISTINCT sid, {_norm('aspect')} AS a, {_norm('opinion')} AS o, sentiment AS s FROM prow),
gs AS (SELECT DISTINCT sid, {_norm('aspect')} AS a, {_norm('opinion')} AS o, sentiment AS s FROM grow),
c AS (SELECT (SELECT count(*) FROM ps JOIN gs USING (sid, a, o, s)) AS tp, (SELECT count(*) FROM ps) AS pred_total,
             (SELECT count(*) FROM gs) AS gold_total),
r AS (SELECT *, CASE WHEN pred_total > 0 THEN tp::DOUBLE / pred_total ELSE 0.0 END AS p,
                CASE WHEN gold_total > 0 THEN tp::DOUBLE / gold_total ELSE 0.0 END AS rc FROM c)
SELECT tp, pred_total, gold_total, round(p, 6) AS precision, round(rc, 6) AS recall,
       round(CASE WHEN p + rc > 0 THEN 2 * p * rc / (p + rc) ELSE 0.0 END, 6) AS f1 FROM r""",
)
_TABLES = f""", {_a1('grow', name='ga', min_mentions=2)}, {_a1('prow', name='pa', min_mentions=2)}"""
sql(
    "majority_agreement",
    _LEX
    + _TABLES
    + """ SELECT count(*) AS shared, count(*) FILTER (WHERE ga.majority_sentiment = pa.majority_sentiment) AS agree,
       round(CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE ga.majority_sentiment = pa.majority_sentiment))::DOUBLE / count(*) ELSE 0.0 END, 6) AS ratio
FROM ga JOIN pa ON ga.aspect = pa.aspect""",
)
sql(
    "agreement_errors",
    _LEX
    + _TABLES
    + """ SELECT coalesce(ga.aspect, pa.aspect) AS aspect,
       CASE WHEN pa.total IS NULL THEN 'gold_only' WHEN ga.total IS NULL THEN 'predicted_only'
            WHEN ga.majority_sentiment <> pa.majority_sentiment THEN 'flipped' ELSE 'agree' END AS status,
       ga.majority_sentiment AS gold_majority, pa.majority_sentiment AS predicted_majority,
       (coalesce(pa.positive, 0) - coalesce(ga.positive, 0))::BIGINT AS delta_positive,
       (coalesce(pa.negative, 0) - coalesce(ga.negative, 0))::BIGINT AS delta_negative,
       (coalesce(pa.neutral, 0) - coalesce(ga.neutral, 0))::BIGINT AS delta_neutral,
       (coalesce(pa.total, 0) - coalesce(ga.total, 0))::BIGINT AS delta_total
FROM ga FULL JOIN pa ON ga.aspect = pa.aspect""",
)


def _render(src: str) -> str:
    return (
        f"coalesce(string_agg('aspect: ' || x.aspect || ' | opinion: ' || x.opinion || ' | sentiment: ' || x.sentiment, "
        f"' ; ' ORDER BY x.ord), 'no triplet')"
    )


def _normtext2(x: str) -> str:
    from aspectra.functions.text import WS

    return f"lower({strip(f'regexp_replace({x}, {chr(39)}{WS}+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')})"


sql(
    "exact_match",
    _LEX
    + f""", pt AS (SELECT t.sid, {_render('x')} AS p FROM tst t LEFT JOIN prow x ON x.sid = t.sid GROUP BY t.sid),
gt AS (SELECT t.sid, {_render('x')} AS g FROM tst t LEFT JOIN grow x ON x.sid = t.sid GROUP BY t.sid)
SELECT count(*) AS n, round(avg(CASE WHEN {_normtext2('p')} = {_normtext2('g')} THEN 1.0 ELSE 0.0 END), 6) AS exact_match
FROM pt JOIN gt ON pt.sid = gt.sid""",
)

_EX = _LEX + f""", ex AS (SELECT g.sid, t.source, g.ord, g.sentiment AS label, coalesce(l.sentiment, 'neutral') AS prediction
  FROM grow g JOIN tst t ON g.sid = t.sid LEFT JOIN lex l ON {_norm('g.opinion')} = l.phrase)"""

sql(
    "example_agreement",
    _EX
    + """ SELECT count(*) AS n, count(*) FILTER (WHERE prediction = label) AS agree,
       round(CASE WHEN count(*) > 0 THEN (count(*) FILTER (WHERE prediction = label))::DOUBLE / count(*) ELSE 0.0 END, 6) AS agreement
FROM ex""",
)


def _class_report(src: str, g: str = "") -> str:
    gk = f"{g}, " if g else ""
    on = f"a.{g} = b.{g} AND " if g else ""
    part = f"PARTITION BY {g}" if g else ""
    return f""", cf AS (SELECT {gk}label, prediction, count(*) AS n FROM {src} GROUP BY ALL),
al AS (SELECT {gk}label AS cls, sum(n) AS support, sum(CASE WHEN label = prediction THEN n END) AS tp FROM cf GROUP BY ALL),
ap AS (SELECT {gk}prediction AS cls, sum(n) AS predicted FROM cf GROUP BY ALL),
per AS (SELECT {('coalesce(a.' + g + ', b.' + g + ') AS ' + g + ', ') if g else ''}coalesce(a.cls, b.cls) AS cls,
               coalesce(a.support, 0)::BIGINT AS support, coalesce(b.predicted, 0)::BIGINT AS predicted, coalesce(a.tp, 0)::BIGINT AS tp
        FROM al a FULL JOIN ap b ON {on}a.cls = b.cls),
pr2 AS (SELECT *, CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0.0 END AS precision,
               CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0.0 END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr2),
rep AS (SELECT {gk}cls AS label, precision, recall, f1, support,
        CASE WHEN sum(support) OVER ({part}) > 0 THEN sum(tp) OVER ({part})::DOUBLE / sum(support) OVER ({part}) ELSE 0.0 END AS accuracy,
        avg(f1) OVER ({part}) AS macro_f1 FROM f)"""


sql(
    "classification_report",
    _EX
    + _class_report("ex")
    + """ SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support,
       round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1 FROM rep""",
)
sql(
    "run_summary",
    _EX
    + ", exr AS (SELECT *, CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) AS run FROM ex)"
    + _class_report("exr", "run")
    + """, rr AS (SELECT run, precision, recall, f1, accuracy, macro_f1, label FROM rep),
pr3 AS (SELECT run, any_value(accuracy) AS accuracy, any_value(macro_f1) AS macro_f1 FROM rr GROUP BY run)
SELECT 'overall' AS label, round(avg(accuracy), 6) AS accuracy_mean, round(stddev_samp(accuracy), 6) AS accuracy_std,
       round(avg(macro_f1), 6) AS f1_mean, round(stddev_samp(macro_f1), 6) AS f1_std,
       CAST(arg_max(run, (macro_f1, -run)) AS VARCHAR) AS best_run, count(*) AS runs FROM pr3
UNION ALL
SELECT label, NULL::DOUBLE, NULL::DOUBLE, round(avg(f1), 6), round(stddev_samp(f1), 6),
       CAST(arg_max(run, (f1, -run)) AS VARCHAR), count(*) FROM rr GROUP BY label""",
)
sql(
    "class_weights",
    _LEX
    + """, cw AS (SELECT sentiment AS label, count(*) AS n_c FROM trn GROUP BY ALL)
SELECT label, n_c, round(sum(n_c) OVER () / (count(*) OVER () * n_c), 6) AS weight FROM cw""",
)
sql(
    "split_pivot",
    _LEX
    + """ SELECT source AS domain, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'valid') AS valid,
       count(*) FILTER (WHERE split = 'test') AS test FROM sp GROUP BY source""",
)
sql(
    "triplet_histogram",
    _LEX
    + """, cnt AS (SELECT sp.sid, sp.split, (SELECT count(*) FROM tt WHERE tt.doc_id = sp.doc_id AND tt.pos = sp.pos) AS triplet_count FROM sp)
SELECT split, triplet_count, count(*) AS sentences FROM cnt GROUP BY ALL""",
)
from aspectra.plans.sqlviews import lower_strip as _lower_strip  # noqa: E402
from aspectra.plans.sqlviews import sentence_array as _sa  # noqa: E402

sql(
    "leakage_audit",
    with_views("v2")
    + f""", s AS (SELECT DISTINCT {_split_case(_hash_u('doc_id'))} AS split, sent AS text FROM v2),
m AS (SELECT text, list_sort(list(split)) AS splits FROM s GROUP BY text HAVING count(*) > 1),
pairs AS (SELECT a.x AS a, b.y AS b FROM m, unnest(m.splits) a(x), unnest(m.splits) b(y) WHERE a.x < b.y),
every AS (SELECT DISTINCT x.split AS a, y.split AS b FROM (SELECT DISTINCT split FROM s) x, (SELECT DISTINCT split FROM s) y WHERE x.split < y.split),
bt AS (SELECT DISTINCT unnest({_sa('text')}) AS text FROM benchmark)
SELECT 'distinct_texts:' || split AS "check", count(*) AS n FROM s GROUP BY split
UNION ALL SELECT 'overlap:' || e.a || '/' || e.b, count(p.a) FROM every e LEFT JOIN pairs p ON p.a = e.a AND p.b = e.b GROUP BY e.a, e.b
UNION ALL SELECT 'benchmark_in_items', count(*) FROM bt WHERE text IN (SELECT text FROM s)""",
)




def _overlap_sql(ctes: str) -> str:
    """Matrix over a CTE ``d`` of distinct (g, x)."""
    return ctes + """, names AS (SELECT DISTINCT g FROM d),
c AS (SELECT p.g AS a, q.g AS b, count(*) AS n FROM d p JOIN d q ON p.x = q.x AND p.g <= q.g GROUP BY 1, 2)
SELECT p.g AS a, q.g AS b, coalesce(c.n, 0) AS shared FROM names p JOIN names q ON p.g <= q.g LEFT JOIN c ON c.a = p.g AND c.b = q.g"""


sql("corpus_overlap", _overlap_sql(with_views("v2") + ", d AS (SELECT DISTINCT source AS g, sent AS x FROM v2 WHERE source IS NOT NULL)"))
sql(
    "aspect_pool_overlap",
    _overlap_sql(with_views("v4") + f", d AS (SELECT DISTINCT {_split_case(_hash_u('doc_id'))} AS g, {_lower_strip('aspect')} AS x FROM v4 WHERE {_lower_strip('aspect')} <> '')"),
)
sql(
    "exact_split",
    with_views("v1")
    + """, r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM v1),
c AS (SELECT *, ceil(n * 0.15 - 1e-9) AS t FROM r)
SELECT doc_id, CASE WHEN k <= t THEN 'test' WHEN k <= t + ceil((n - t) * (0.15 / 0.85) - 1e-9) THEN 'valid' ELSE 'train' END AS split FROM c""",
)


# ---------------------------------------------------------------- per-corpus tables and row selection
from aspectra.plans.sqlviews import a2_sql as _a2  # noqa: E402

_V8R = with_views("v4", _a2("v4", 10, group="source")) + ", t AS (SELECT * FROM a2 WHERE total >= 2)"
_V8C = with_views("v4", _a1("v4", group="source", min_mentions=2)) + ", t AS (SELECT * FROM a1)"


def _select_sql(base: str, reasons: bool, max_aspects: int = 4) -> str:
    rcols = ", t.positive_reasons, t.negative_reasons, t.neutral_reasons" if reasons else ""
    aware = ("bool_or(positive_reasons <> '' OR negative_reasons <> '' OR neutral_reasons <> '')" if reasons else "false")
    return base + f""",
c AS (SELECT *, max(CASE WHEN total >= 10 THEN 1 ELSE 0 END) OVER (PARTITION BY source) AS has10 FROM t),
cand AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY total DESC, aspect) AS r FROM c WHERE total >= 10 OR has10 = 0),
per AS (SELECT source, {aware} AS reason_aware,
          arg_min(aspect, r) AS c1,
          arg_max(aspect, (positive, total, -r)) AS c2,
          arg_max(aspect, (negative, total, -r)) AS c3,
          arg_min(aspect, (abs(positive - negative), -total, r)) FILTER (WHERE r <= 10) AS c4,
          list({{'r': r, 'aspect': aspect, 'total': total, 'pr': positive / total, 'nr': negative / total,
                 'dr': abs(positive - negative) / total}} ORDER BY r) FILTER (WHERE r <= 30) AS pool,
          list(aspect ORDER BY r) FILTER (WHERE r <= {max_aspects}) AS fill
        FROM cand GROUP BY source),
s1 AS (SELECT *, pool[1].aspect AS p1 FROM per),
s2 AS (SELECT *, list_filter(pool, lambda x: x.aspect <> p1) AS rem1 FROM s1),
s3 AS (SELECT *, list_max(list_transform(rem1, lambda x: {{'k': x.pr, 't': x.total, 'r': -x.r, 'aspect': x.aspect}})).aspect AS p2 FROM s2),
s4 AS (SELECT *, list_filter(rem1, lambda x: x.aspect <> coalesce(p2, '')) AS rem2 FROM s3),
s5 AS (SELECT *, list_max(list_transform(rem2, lambda x: {{'k': x.nr, 't': x.total, 'r': -x.r, 'aspect': x.aspect}})).aspect AS p3 FROM s4),
s6 AS (SELECT *, list_filter(rem2, lambda x: x.aspect <> coalesce(p3, '')) AS rem3 FROM s5),
s7 AS (SELECT *, list_min(list_transform(rem3, lambda x: {{'k': x.dr, 't': -x.total, 'r': x.r, 'aspect': x.aspect}})).aspect AS p4 FROM s6),
ords AS (SELECT source, reason_aware,
           CASE WHEN reason_aware THEN list_filter([p1, p2, p3, p4], lambda x: x IS NOT NULL) || fill
                ELSE list_filter([c1, c2, c3, c4], lambda x: x IS NOT NULL) || fill END AS l FROM s7),
dd AS (SELECT source, reason_aware, list_filter(l, lambda x, i: list_position(l, x) = i)[1:{max_aspects}] AS sel FROM ords),
ch AS (SELECT source, reason_aware, unnest(sel) AS aspect, unnest(range(1, len(sel) + 1)) AS slot FROM dd)
SELECT ch.source, ch.slot, CASE ch.slot WHEN 1 THEN 'most_discussed' WHEN 2 THEN 'strongest_positive'
       WHEN 3 THEN 'strongest_negative' WHEN 4 THEN 'most_divided' END AS role, ch.reason_aware,
       t.aspect, t.positive, t.negative, t.neutral, t.total, t.majority_sentiment{rcols}
FROM ch JOIN t ON ch.source = t.source AND ch.aspect = t.aspect"""


sql("select_rows_counts", _select_sql(_V8C, reasons=False))
sql("select_rows_reasons", _select_sql(_V8R, reasons=True))


# ---------------------------------------------------------------- prompts, reports and checks
from aspectra.operators import checks as _ck  # noqa: E402
from aspectra.operators import reports as _rp  # noqa: E402


def _sel_cte(base: str, reasons: bool) -> str:
    body = _select_sql(base, reasons)
    head, final = body.rsplit("SELECT ch.source", 1)
    return head + ",\nsel AS (SELECT ch.source" + final + ")"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_SELC = _sel_cte(_V8C, False)
_SELR = _sel_cte(_V8R, True)

_COUNT_REPORTS = """,
st AS (SELECT *, ('0x' || substr(md5(source), 1, 6))::BIGINT % 3 AS style,
              (('0x' || substr(md5('perturb:' || source), 1, 8))::BIGINT)::DOUBLE < 4294967296.0 / 3 AS pert FROM sel),
st2 AS (SELECT *, CASE WHEN pert AND slot = 1 THEN total + 1 ELSE total END AS t2, upper(substr(aspect, 1, 1)) || substr(aspect, 2) AS cap FROM st),
sent AS (SELECT source, slot, CASE
   WHEN style = 0 THEN (CASE role
     WHEN 'most_discussed' THEN cap || ' attracted the most attention, with ' || t2 || ' mentions: ' || positive || ' positive, ' || negative || ' negative, and ' || neutral || ' neutral.'
     WHEN 'strongest_positive' THEN cap || ' emerged as the clearest strength, receiving ' || positive || ' positive mentions out of ' || t2 || ', alongside ' || negative || ' negative and ' || neutral || ' neutral.'
     WHEN 'strongest_negative' THEN 'In contrast, ' || cap || ' was the main concern, with ' || negative || ' negative mentions out of ' || t2 || ', compared with ' || positive || ' positive and ' || neutral || ' neutral.'
     WHEN 'most_divided' THEN cap || ' feedback was the most divided, with ' || positive || ' positive, ' || negative || ' negative, and ' || neutral || ' neutral mentions among ' || t2 || ' total.'
     END)
   WHEN style = 1 THEN aspect || ': ' || t2 || ' mentions (' || positive || ' positive, ' || negative || ' negative, ' || neutral || ' neutral).'
   ELSE cap || ' received ' || t2 || ' mentions, including ' || positive || ' positive, ' || negative || ' negative, and ' || neutral || ' neutral.'
   END AS x FROM st2),
rep AS (SELECT source, string_agg(x, ' ' ORDER BY slot) AS report FROM sent GROUP BY source)"""


def _claims_cte(src: str = "rep") -> str:
    parts = []
    for kind, role, pat, groups in _ck.CLAIM_GRAMMARS:
        ex = ", ".join(f"regexp_extract_all(report, {_q(pat)}, {g}) AS x{i}" for i, g in enumerate(groups))
        r = _q(role) if role else "NULL::VARCHAR"
        parts.append(
            f"SELECT source, {_q(kind)} AS kind, {r} AS role, unnest(range(0, len(x0))) AS k, unnest(x0) AS a, "
            f"unnest(x1) AS t, unnest(x2) AS p, unnest(x3) AS n, unnest(x4) AS u FROM (SELECT source, {ex} FROM {src})"
        )
    masked = "report"
    for _, _, pat, _ in _ck.CLAIM_GRAMMARS:
        masked = f"regexp_replace({masked}, {_q(pat)}, chr(1), 'g')"
    return f""",
craw AS ({' UNION ALL '.join(parts)}),
cl AS (SELECT source, kind, role, k, {lower_strip('a')} AS aspect, t::BIGINT AS total, p::BIGINT AS positive,
              n::BIGINT AS negative, u::BIGINT AS neutral FROM craw),
cc AS (SELECT cl.*, tt2.total AS et, tt2.positive AS ep, tt2.negative AS en, tt2.neutral AS eu FROM cl
       LEFT JOIN t tt2 ON cl.source = tt2.source AND cl.aspect = tt2.aspect),
cc2 AS (SELECT *, CASE WHEN et IS NULL THEN 'aspect not found in source statistics' ELSE concat_ws('; ',
          CASE WHEN total <> et THEN 'total: claimed ' || total || ', expected ' || et END,
          CASE WHEN positive <> ep THEN 'positive: claimed ' || positive || ', expected ' || ep END,
          CASE WHEN negative <> en THEN 'negative: claimed ' || negative || ', expected ' || en END,
          CASE WHEN neutral <> eu THEN 'neutral: claimed ' || neutral || ', expected ' || eu END) END AS errors FROM cc),
cc3 AS (SELECT *, errors = '' AS valid FROM cc2),
mk AS (SELECT source, {masked} AS m FROM {src}),
dup AS (SELECT source, string_agg(aspect, ',' ORDER BY aspect) AS d FROM (SELECT source, aspect FROM cl GROUP BY ALL HAVING count(*) > 1) GROUP BY source),
agg AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE valid) AS v, bool_and(valid) AS allv FROM cc3 GROUP BY source),
chk AS (SELECT mk.source, coalesce(agg.n, 0) AS claims_checked, coalesce(agg.v, 0) AS valid_claims,
               len(regexp_extract_all(m, {_q(_ck.NUMBER_RE)}, 0))::BIGINT AS unparsed_numeric_tokens,
               coalesce(dup.d, '') AS duplicate_aspects,
               trim(replace(m, chr(1), ''), ' ' || chr(9) || chr(13) || chr(10) || '.;') AS unexpected_text,
               coalesce(agg.allv, true) AS allv
        FROM mk LEFT JOIN agg ON mk.source = agg.source LEFT JOIN dup ON mk.source = dup.source),
chk2 AS (SELECT source, (claims_checked > 0 AND allv AND unparsed_numeric_tokens = 0 AND duplicate_aspects = ''
                AND unexpected_text = '') AS passed, claims_checked, valid_claims, unparsed_numeric_tokens, duplicate_aspects,
                unexpected_text FROM chk)"""


def _required_cte(chk: str = "chk2", claims: str = "cl", name: str = "req") -> str:
    """The check with the selection required: missing aspects and roles, and roles claimed for another aspect."""
    return f""",
{name}a AS (SELECT s.source, string_agg(DISTINCT {lower_strip('s.aspect')}, ',' ORDER BY {lower_strip('s.aspect')}) AS x FROM sel s
  WHERE NOT EXISTS (SELECT 1 FROM {claims} c WHERE c.source = s.source AND c.aspect = {lower_strip('s.aspect')}) GROUP BY s.source),
{name}r AS (SELECT s.source, string_agg(s.role, ',' ORDER BY s.role) AS x FROM sel s WHERE s.role IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {claims} c WHERE c.source = s.source AND c.role = s.role) GROUP BY s.source),
{name}l AS (SELECT source, role, arg_max(aspect, k) AS aspect FROM {claims} WHERE role IS NOT NULL GROUP BY source, role),
{name}e AS (SELECT s.source, string_agg(s.role || ': claimed ' || c.aspect || ', expected ' || {lower_strip('s.aspect')}, ',' ORDER BY s.slot) AS x
  FROM sel s JOIN {name}l c ON c.source = s.source AND c.role = s.role WHERE c.aspect <> {lower_strip('s.aspect')} GROUP BY s.source),
{name} AS (SELECT c.source, (c.passed AND a.x IS NULL AND r.x IS NULL AND e.x IS NULL) AS passed, c.claims_checked, c.valid_claims,
    c.unparsed_numeric_tokens, c.duplicate_aspects, c.unexpected_text, coalesce(a.x, '') AS missing_aspects, coalesce(r.x, '') AS missing_roles,
    coalesce(e.x, '') AS role_errors
  FROM {chk} c LEFT JOIN {name}a a ON a.source = c.source LEFT JOIN {name}r r ON r.source = c.source LEFT JOIN {name}e e ON e.source = c.source)"""


_STRUCT = _SELC + _COUNT_REPORTS + _claims_cte()
sql("check_structured_required", _STRUCT + _required_cte() + " SELECT * FROM req")
sql("check_structured", _STRUCT + " SELECT * FROM chk2")
sql("claim_check", _STRUCT + " SELECT source, kind, k, role, aspect, total, positive, negative, neutral, valid, errors FROM cc3")
sql("report_pass_rate", _STRUCT + " SELECT count(*) AS reports, count(*) FILTER (WHERE passed) AS passed, round(avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM chk2")
sql(
    "report_rollup",
    _STRUCT
    + """ SELECT CASE WHEN claims_checked > 0 THEN 'claims' ELSE 'none' END AS style, count(*) AS reports,
       count(*) FILTER (WHERE passed) AS passed, round(avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM chk2 GROUP BY 1""",
)
sql(
    "report_status",
    _STRUCT
    + _required_cte()
    + """, ra AS (SELECT source, bool_or(reason_aware) AS reason_aware FROM sel GROUP BY source)
SELECT req.source, ra.reason_aware, req.passed AS accepted, CASE WHEN passed THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN ra.reason_aware THEN 'factual-only' ELSE 'strict' END AS checker_mode
FROM req JOIN ra ON req.source = ra.source""",
)


def _attempt(n: int, perturb: bool, style: str | None) -> str:
    """The reports and required check of attempt ``n`` for all corpora, in CTEs of their own."""
    reports = _COUNT_REPORTS
    if not perturb:
        reports = reports.replace("< 4294967296.0 / 3 AS pert", "< 0 AS pert")
    if style is not None:
        reports = reports.replace("('0x' || substr(md5(source), 1, 6))::BIGINT % 3 AS style", f"{style} AS style")
    text = reports + _claims_cte() + _required_cte()
    return re.sub(r"\b(st|st2|sent|rep|craw|cl|cc|cc2|cc3|mk|dup|agg|chk|chk2|req|reqa|reqr|reql|reqe)\b(?!')", rf"\1_{n}", text)


sql(
    "retry_rejects",
    _SELC
    + "".join(_attempt(n, n == 1, "0" if n == 3 else None) for n in (1, 2, 3))
    + """,
att AS (SELECT a.source, CASE WHEN a.passed THEN 1 WHEN b.passed THEN 2 ELSE 3 END AS n, a.passed OR b.passed OR c.passed AS ok
        FROM req_1 a JOIN req_2 b ON a.source = b.source JOIN req_3 c ON a.source = c.source),
about AS (SELECT source, bool_or(reason_aware) AS reason_aware, string_agg(aspect, '|' ORDER BY slot) AS selected_aspects FROM sel GROUP BY source)
SELECT att.source, n::BIGINT AS generation_attempts, ok AS accepted, CASE WHEN ok THEN 'accepted' ELSE 'rejected' END AS status,
       CASE WHEN reason_aware THEN 'factual-only' ELSE 'strict' END AS checker_mode, selected_aspects
FROM att JOIN about ON att.source = about.source""",
)
sql(
    "sink_report_documents",
    ORACLE["retry_rejects"].replace(
        "ELSE 3 END AS n, a.passed", "ELSE 3 END AS n, concat_ws(',', '1:' || a.passed, CASE WHEN NOT a.passed THEN '2:' || b.passed END, "
        "CASE WHEN NOT a.passed AND NOT b.passed THEN '3:' || c.passed END) AS attempts, a.passed"
    ).replace("checker_mode, selected_aspects\nFROM att", "checker_mode, selected_aspects, attempts, true AS last_is_report\nFROM att"),
)
_FLAWED = """,
flw AS (SELECT *, ('0x' || substr(md5('flaw:' || source), 1, 6))::BIGINT % 3 AS flaw FROM sel),
selx AS (SELECT * EXCLUDE (flaw) FROM flw WHERE NOT (flaw = 1 AND slot = 2)
         UNION ALL SELECT * EXCLUDE (flaw) REPLACE (9 AS slot) FROM flw WHERE flaw = 2 AND slot = 1)"""
sql(
    "report_totals",
    _SELC + _FLAWED + _COUNT_REPORTS.replace("AS pert FROM sel)", "AS pert FROM selx)") + _claims_cte() + _required_cte()
    + f""",
nd AS (SELECT source, count(*) AS n FROM (SELECT source, aspect FROM cl GROUP BY ALL HAVING count(*) > 1) GROUP BY source),
nm AS (SELECT source, count(DISTINCT {lower_strip('s.aspect')}) AS n FROM sel s
       WHERE NOT EXISTS (SELECT 1 FROM cl c WHERE c.source = s.source AND c.aspect = {lower_strip('s.aspect')}) GROUP BY source),
nr AS (SELECT source, count(*) AS n FROM sel s WHERE s.role IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM cl c WHERE c.source = s.source AND c.role = s.role) GROUP BY source),
ne AS (SELECT s.source, count(*) AS n FROM sel s JOIN reql c ON c.source = s.source AND c.role = s.role WHERE c.aspect <> {lower_strip('s.aspect')} GROUP BY s.source),
graded AS (SELECT ['roles', 'list', 'natural'][('0x' || substr(md5(req.source), 1, 6))::BIGINT % 3 + 1] AS style,
               CASE WHEN passed THEN 'accepted' ELSE 'rejected' END AS status, passed, claims_checked, valid_claims,
               coalesce(nd.n, 0) AS d, coalesce(nm.n, 0) AS m, coalesce(nr.n, 0) AS r, coalesce(ne.n, 0) AS e
        FROM req LEFT JOIN nd ON nd.source = req.source LEFT JOIN nm ON nm.source = req.source
        LEFT JOIN nr ON nr.source = req.source LEFT JOIN ne ON ne.source = req.source)
SELECT CASE WHEN grouping(style) = 1 THEN 'all' ELSE style END AS style, CASE WHEN grouping(status) = 1 THEN 'all' ELSE status END AS status,
       count(*) AS reports, count(*) FILTER (WHERE passed) AS passed, round(avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END), 6) AS pass_rate,
       sum(claims_checked)::BIGINT AS claims, sum(valid_claims)::BIGINT AS valid_claims, sum(d)::BIGINT AS n_duplicate_aspects,
       sum(m)::BIGINT AS n_missing_aspects, sum(r)::BIGINT AS n_missing_roles, sum(e)::BIGINT AS n_role_errors,
       0::BIGINT AS n_repeated_aspects, 0::BIGINT AS n_warnings
FROM graded GROUP BY GROUPING SETS ((style, status), (style), (status), ())""",
)
sql(
    "coverage_gaps",
    _STRUCT
    + """ SELECT s.source, 'aspect' AS gap, s.aspect AS value FROM sel s
  WHERE NOT EXISTS (SELECT 1 FROM cl WHERE cl.source = s.source AND cl.aspect = s.aspect)
UNION ALL
SELECT s.source, 'role', s.role FROM sel s WHERE s.role IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM cl WHERE cl.source = s.source AND cl.role = s.role)""",
)


def _reason_text_sql() -> str:
    parts = []
    for s in ("positive", "negative", "neutral"):
        parts.append(
            f"CASE WHEN {s}_top <> '' THEN '{s}_reasons=' || {s}_top END"
        )
    return f"coalesce(nullif(concat_ws(' | ', {', '.join(parts)}), ''), {_q(_rp.NO_REASONS)})"


# selected rows (reason path) with their top-2 reasons rendered as "r (n), r (n)"
_RT = _SELR + """,
top2 AS (SELECT source, aspect, sentiment, string_agg(reason || ' (' || n || ')', ', ' ORDER BY rk) AS r2
         FROM rk WHERE rk <= 2 GROUP BY ALL),
selr AS (SELECT s.*, coalesce(p.r2, '') AS positive_top, coalesce(ng.r2, '') AS negative_top, coalesce(nu.r2, '') AS neutral_top
         FROM sel s
         LEFT JOIN top2 p ON p.source = s.source AND p.aspect = s.aspect AND p.sentiment = 'positive'
         LEFT JOIN top2 ng ON ng.source = s.source AND ng.aspect = s.aspect AND ng.sentiment = 'negative'
         LEFT JOIN top2 nu ON nu.source = s.source AND nu.aspect = s.aspect AND nu.sentiment = 'neutral')"""

sql("reason_text", _RT + f" SELECT source, slot, aspect, {_reason_text_sql()} AS reason_text FROM selr")
def _template_sql(template: str, **parts: str) -> str:
    cut = re.split(r"\{(\w+)\}", template)
    return " || ".join(parts[x] if i % 2 else _q(x) for i, x in enumerate(cut))


_COUNTS = "'total=' || total || ' | positive=' || positive || ' | negative=' || negative || ' | neutral=' || neutral"
sql(
    "prompt_reasoned",
    _RT
    + f""", lines AS (SELECT source, string_agg('aspect=' || aspect || ' | ' || {_COUNTS} || ' | ' || {_reason_text_sql()}, chr(10) ORDER BY slot) AS x FROM selr GROUP BY source)
SELECT source, {_template_sql(_rp.REASONED_PROMPT, rows='x')} AS prompt FROM lines""",
)
sql(
    "prompt_roles",
    _SELC
    + f""", lines AS (SELECT source, string_agg(aspect, ' | ' ORDER BY slot) AS o,
       string_agg('role=' || role || ' | aspect=' || aspect || ' | ' || {_COUNTS}, chr(10) ORDER BY slot) AS x FROM sel WHERE role IS NOT NULL GROUP BY source)
SELECT source, {_template_sql(_rp.ROLE_PROMPT, rows='x', order='o')} AS prompt FROM lines""",
)


# ---------------------------------------------------------------- grid tagging
_GRID = _LEX + """,
sps AS (SELECT ts.doc_id || ':' || ts.pos AS sid, ts.* FROM ts),
gcell AS (
  SELECT sid, i, j, 1 AS tag, {'ph': 0, 'o': ord, 'st': 0} AS prio FROM sps, unnest(range(sps.a0, sps.a1)) r(i), unnest(range(sps.a0, sps.a1)) q(j) WHERE i <= j
  UNION ALL
  SELECT sid, i, j, 2, {'ph': 0, 'o': ord, 'st': 1} FROM sps, unnest(range(sps.o0, sps.o1)) r(i), unnest(range(sps.o0, sps.o1)) q(j) WHERE i <= j
  UNION ALL
  SELECT sid, least(ai, oi), greatest(ai, oi), CASE sentiment WHEN 'positive' THEN 3 WHEN 'neutral' THEN 4 WHEN 'negative' THEN 5 END,
         {'ph': 1, 'o': ord, 'st': 0} FROM sps, unnest(range(sps.a0, sps.a1)) r(ai), unnest(range(sps.o0, sps.o1)) q(oi)),
grid AS (SELECT sid, i, j, arg_max(tag, prio) AS tag FROM gcell GROUP BY sid, i, j),
dg AS (SELECT sid, tag, min(i) AS start, max(i) + 1 AS "end" FROM (
         SELECT *, i - row_number() OVER (PARTITION BY sid, tag ORDER BY i) AS g FROM grid WHERE i = j AND tag IN (1, 2))
       GROUP BY sid, tag, g),
ix AS (SELECT sid, tag, start, "end", t FROM dg, unnest(range(dg.start, dg."end")) r(t)),
sc AS (SELECT * FROM grid WHERE tag IN (3, 4, 5)),
vt AS (SELECT sc.sid, a.start AS a0, a."end" AS a1, o.start AS o0, o."end" AS o1, sc.tag
       FROM sc JOIN ix a ON a.sid = sc.sid AND a.tag = 1 AND a.t = sc.i JOIN ix o ON o.sid = sc.sid AND o.tag = 2 AND o.t = sc.j
       UNION ALL
       SELECT sc.sid, a.start, a."end", o.start, o."end", sc.tag
       FROM sc JOIN ix a ON a.sid = sc.sid AND a.tag = 1 AND a.t = sc.j JOIN ix o ON o.sid = sc.sid AND o.tag = 2 AND o.t = sc.i),
dec AS (SELECT sid, a0, a1, o0, o1, arg_max(tag, (n, -tag)) AS tag FROM (
          SELECT sid, a0, a1, o0, o1, tag, count(*) AS n FROM vt GROUP BY ALL) GROUP BY sid, a0, a1, o0, o1),
wm0 AS (SELECT sid, [NULL::BIGINT] || flatten(list_transform(toks, lambda t, w: list_transform(range(greatest(ceil(length(t) / 4), 1)::BIGINT), lambda z: (w - 1)::BIGINT)))
               || [NULL::BIGINT] AS ids FROM sp),
wm AS (SELECT sid, unnest(range(0, len(ids))) AS p, unnest(ids) AS word_id FROM wm0),
ex AS (SELECT DISTINCT g.sid, least(m1.p, m2.p) AS p, greatest(m1.p, m2.p) AS q, g.tag FROM grid g
       JOIN wm m1 ON m1.sid = g.sid AND m1.word_id = g.i JOIN wm m2 ON m2.sid = g.sid AND m2.word_id = g.j)"""

sql("grid_build", _GRID + " SELECT sid, i, j, tag FROM grid")
sql("diagonal_spans", _GRID + ' SELECT sid, tag, start, "end" FROM dg')
sql("grid_decode", _GRID + """ SELECT sid, a0, a1, o0, o1, CASE tag WHEN 3 THEN 'positive' WHEN 4 THEN 'neutral' WHEN 5 THEN 'negative' END AS sentiment FROM dec""")
sql("grid_expand", _GRID + " SELECT sid, p, q, tag FROM ex")
sql("grid_collapse", _GRID + " SELECT sid, i, j, tag FROM grid")


# ---------------------------------------------------------------- ABSA XML: expected values from the views
_XML = with_views("v3c") + """, xs AS (SELECT doc_id || ':' || pos AS sentence_id, array_to_string(tokens, ' ') AS text, tokens, sentiment FROM v3c),
xt AS (SELECT sentence_id, text, tokens[i + 1] AS term, i, CASE i % 3 WHEN 0 THEN sentiment WHEN 2 THEN 'conflict' END AS polarity,
              CASE WHEN i = 0 THEN 0 ELSE -1 END::BIGINT AS start, CASE WHEN i = 0 THEN length(tokens[1]) ELSE -1 END::BIGINT AS "end"
       FROM xs, unnest(range(0, len(tokens))) u(i) WHERE len(tokens) >= 2),
xr AS (SELECT *, row_number() OVER (PARTITION BY sentence_id ORDER BY i) - 1 AS term_idx FROM xt WHERE polarity IS NOT NULL)"""
_MARKED = """CASE WHEN start >= 0 AND "end" > 0 THEN '$T$ ' || substr(text, 1, "end") || ' $T$' || substr(text, "end" + 1) ELSE text END"""
sql(
    "scan_xml",
    _XML
    + """ SELECT xs.sentence_id, xs.text, term_idx, term, polarity, start, "end" FROM xs LEFT JOIN xr ON xs.sentence_id = xr.sentence_id""",
)
sql(
    "flatten_examples",
    _XML + f""" SELECT sentence_id, term_idx, {_MARKED} AS context, term AS aspect, polarity AS label FROM xr WHERE polarity <> 'conflict'""",
)
sql("mark_aspect", _XML + f""" SELECT sentence_id, term_idx, {_MARKED} AS marked FROM xr""")
sql(
    "drop_labels",
    _XML + """ SELECT xs.sentence_id, count(xr.term) > 0 AS has_terms, count(xr.term) AS n_terms
FROM xs LEFT JOIN xr ON xs.sentence_id = xr.sentence_id AND xr.polarity <> 'conflict' GROUP BY xs.sentence_id""",
)
sql(
    "sink_xml_roundtrip",
    _XML + """ SELECT xs.sentence_id, xs.text, count(xr.term) AS n_terms
FROM xs LEFT JOIN xr ON xs.sentence_id = xr.sentence_id AND xr.polarity <> 'conflict' GROUP BY xs.sentence_id, xs.text""",
)


# ---------------------------------------------------------------- file sources: round trips must give the view back
_V8SQL = ORACLE["aspect_reasons_by_source"]
sql("sink_stats_roundtrip", _V8SQL)
sql("scan_stats_json", _V8SQL)
sql("scan_csv_reviews", with_views("v1") + " SELECT text FROM v1 WHERE text IS NOT NULL")
sql("scan_csv_split", ORACLE["scan_csv_reviews"])
sql("scan_json_reviews", with_views("v1") + ' SELECT CAST(doc_id AS VARCHAR) AS "case", text FROM v1')
sql("scan_reports", _STRUCT + " SELECT source, report FROM rep")
sql(
    "scan_tagged",
    _T
    + f""" SELECT v5.source AS domain,
       CASE WHEN {_hash_u('v5.doc_id')} < 0.15::DOUBLE THEN 'test' WHEN {_hash_u('v5.doc_id')} < (0.15::DOUBLE + 0.15::DOUBLE) THEN 'dev' ELSE 'train' END AS split,
       ok5.sentence, tt.ord, tt.aspect, tt.opinion, tt.sentiment
FROM tt JOIN ok5 ON tt.doc_id = ok5.doc_id AND tt.pos = ok5.pos JOIN v5 ON v5.doc_id = tt.doc_id AND v5.pos = tt.pos""",
)


# ---------------------------------------------------------------- stats validation: expected first violation per corruption kind
_VIOL = {
    0: "absent:neutral",
    1: "blank-aspect",
    2: "bad-count:positive",
    3: "bad-count:negative",
    4: "bad-count:total",
    5: "total-differs",
    6: "no-list:positive_reasons",
    7: "no-pair:negative_reasons[0]",
    8: "blank-reason:neutral_reasons",
    9: "bad-reason-count:positive_reasons",
}
_case = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in _VIOL.items())
sql(
    "validate_stats",
    with_views("v4", _a2("v4", 10, group="source"))
    + f""", t AS (SELECT source || '|' || aspect AS id,
                floor(((('0x' || substr(md5('7:' || source || '|' || aspect), 1, 8))::BIGINT)::DOUBLE / 4294967296.0) * 100) AS b
         FROM a2 WHERE total >= 2)
SELECT id, CASE b::BIGINT {_case} END AS violation FROM t WHERE b < 10""",
)


_shown = ", ".join(f"CASE WHEN b >= 10 THEN {c} END AS {c}" for c in ("aspect", "positive", "negative", "neutral", "total", "majority_sentiment", "positive_reasons", "negative_reasons", "neutral_reasons"))
sql(
    "stats_documents",
    with_views("v4", _a2("v4", 10, group="source"))
    + f""", t AS (SELECT *, source || '|' || aspect AS id, ceil(count(*) OVER (PARTITION BY source) / 1000.0) AS n FROM a2 WHERE total >= 2),
d AS (SELECT *, floor(((('0x' || substr(md5('7:' || id), 1, 8))::BIGINT)::DOUBLE / 4294967296.0) * 100) AS b,
             CAST(floor(((('0x' || substr(md5('11:' || id), 1, 8))::BIGINT)::DOUBLE / 4294967296.0) * n) AS BIGINT) AS chunk FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY source, chunk ORDER BY id) - 1 AS row_index FROM d)
SELECT source, chunk, row_index, CASE b::BIGINT {_case} END AS violation, {_shown} FROM r
UNION ALL SELECT DISTINCT source, -1, NULL::BIGINT, 'no-rows', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM t""",
)


# ---------------------------------------------------------------- synthetic tables
def _byte(key: str, k: int) -> str:
    return f"('0x' || substr(md5({key}), {2 * k + 1}, 2))::BIGINT"


def _spelled(key: str, pairs: int) -> str:
    pick = lambda letters, b: f"substr('{letters}', {b} % {len(letters)} + 1, 1)"
    return " || ".join(pick(x, _byte(key, 2 * k + j)) for k in range(pairs) for j, x in enumerate(("bcdfglmnprstvz", "aeiou")))


_SYN = _V8C + f""",
cand AS (SELECT {_spelled("('names:' || i)", 4)} AS name, min(i) AS idx FROM range(1440) r(i) GROUP BY 1),
kept AS (SELECT * FROM cand WHERE name NOT IN (SELECT lower(aspect) FROM t) ORDER BY idx LIMIT 360),
names AS (SELECT name, idx, CASE WHEN rn <= 240 THEN 'train' WHEN rn <= 300 THEN 'valid' ELSE 'test' END AS pool
          FROM (SELECT *, row_number() OVER (ORDER BY idx) AS rn FROM kept)),
sr0 AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY idx) - 1 AS slot, 24 + {_byte("('rows:total:' || name)", 0)} % 72 AS total FROM names),
sr1 AS (SELECT *, ['most_discussed', 'strongest_positive', 'strongest_negative', 'most_divided'][slot % 4 + 1] AS role,
        ['positive', 'positive', 'negative', 'negative'][slot % 4 + 1] AS lead, total * [50, 80, 75, 45][slot % 4 + 1] // 100 AS first FROM sr0),
sr2 AS (SELECT *, (total - first) // 2 AS neutral, (total - first) - (total - first) // 2 AS other FROM sr1),
sr4 AS (SELECT *, CASE WHEN lead = 'positive' THEN first ELSE other END AS positive, CASE WHEN lead = 'negative' THEN first ELSE other END AS negative FROM sr2)"""


def _reasons_sql(sent: str) -> str:
    n = f"greatest(1, least({sent}, {_byte(f'({_q(f'rows:{sent}:')} || name)', 0)} % 6 + 2))"
    word = lambda k: "(" + _spelled(f"({_q(f'rows:{sent}{k}:')} || name)", 3) + ")"
    return f"{word(0)} || ':' || {n} || ',' || {word(1)} || ':' || greatest(1, {n} - 1)"


sql("synth_names", _SYN + " SELECT name, idx, pool FROM names")
sql(
    "synth_rows",
    _SYN
    + f""" SELECT pool, slot, name, role, positive, {_reasons_sql('positive')} AS positive_reasons, negative,
       {_reasons_sql('negative')} AS negative_reasons, neutral, {_reasons_sql('neutral')} AS neutral_reasons, total FROM sr4""",
)


# ---------------------------------------------------------------- grounding check (C4) on the reason-path reports
_WB = "[^\\p{L}\\p{N}_]"


def _phrase_sql(p: str) -> str:
    q = f"'\\Q' || replace({p}, '\\E', '\\E\\\\E\\Q') || '\\E'"
    return f"'(?i)(^|{_WB})' || {q} || '({_WB}|$)'"


_GROUNDED = _SELR + f""",
why AS (SELECT s.source, s.aspect, coalesce(
          max(CASE WHEN r.sentiment = 'positive' AND r.rk = 1 THEN r.reason END),
          max(CASE WHEN r.sentiment = 'negative' AND r.rk = 1 THEN r.reason END),
          max(CASE WHEN r.sentiment = 'neutral' AND r.rk = 1 THEN r.reason END), '') AS w
        FROM sel s LEFT JOIN rk r ON r.source = s.source AND r.aspect = s.aspect AND r.rk <= 10 GROUP BY s.source, s.aspect),
rs AS (SELECT s.*, why.w, ('0x' || substr(md5(s.source), 1, 6))::BIGINT % 4 AS st0,
              (('0x' || substr(md5('perturb:' || s.source), 1, 8))::BIGINT)::DOUBLE < 4294967296.0 / 3 AS pert
       FROM sel s JOIN why ON why.source = s.source AND why.aspect = s.aspect),
rs2 AS (SELECT *, (st0 + slot) % 4 AS st, CASE WHEN pert AND slot = 1 THEN total + 1 ELSE total END AS t2 FROM rs),
rsent AS (SELECT source, slot, CASE st
    WHEN 0 THEN 'Reviewers brought up ' || aspect || ' ' || t2 || ' times, and ' || positive || ' of those were positive, often about ' || w || '.'
    WHEN 1 THEN 'For ' || aspect || ' there were ' || t2 || ' mentions, and ' || negative || ' were negative, pointing to ' || w || '.'
    WHEN 2 THEN 'Opinions on ' || aspect || ' were split across ' || t2 || ' mentions, with ' || neutral || ' neutral notes such as ' || w || '.'
    ELSE 'Finally, ' || aspect || ' collected ' || t2 || ' mentions, ' || positive || ' of them positive and citing ' || w || '.' END AS x FROM rs2),
rrep AS (SELECT source, string_agg(x, ' ' ORDER BY slot) AS report FROM rsent GROUP BY source),
rv AS (SELECT s.source, s.aspect,
              regexp_matches(lower(p.report), {_phrase_sql('lower(s.aspect)')})
              AND contains(lower(p.report), CAST(s.total AS VARCHAR))
              AND EXISTS (SELECT 1 FROM rk r WHERE r.source = s.source AND r.aspect = s.aspect AND r.rk <= 10
                          AND contains(lower(p.report), r.reason)) AS ok
       FROM sel s JOIN rrep p ON p.source = s.source),
allowed AS (SELECT source, total AS v FROM sel UNION ALL SELECT source, positive FROM sel UNION ALL SELECT source, negative FROM sel
            UNION ALL SELECT source, neutral FROM sel
            UNION ALL SELECT r.source, r.n FROM rk r JOIN sel s ON r.source = s.source AND r.aspect = s.aspect WHERE r.rk <= 10),
nums AS (SELECT source, unnest(xs)::BIGINT AS v, unnest(range(0, len(xs))) AS k FROM (SELECT source, regexp_extract_all(report, '[0-9]+') AS xs FROM rrep)),
uns AS (SELECT source, string_agg(CAST(v AS VARCHAR), ',' ORDER BY k) AS u FROM nums n
        WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE a.source = n.source AND a.v = n.v) GROUP BY source)"""

sql(
    "check_grounded",
    _GROUNDED
    + """ SELECT p.source, (bool_and(rv.ok) AND coalesce(any_value(uns.u), '') = '') AS passed,
       count(*) FILTER (WHERE rv.ok) AS valid_rows, coalesce(any_value(uns.u), '') AS unsupported_numbers
FROM rrep p JOIN rv ON rv.source = p.source LEFT JOIN uns ON uns.source = p.source GROUP BY p.source""",
)


# ---------------------------------------------------------------- claim-tuple equality
def _role_claims(src: str, name: str) -> str:
    parts = []
    for kind, role, pat, groups in _ck.CLAIM_GRAMMARS:
        if role is None:
            continue
        ex = ", ".join(f"regexp_extract_all(report, {_q(pat)}, {g}) AS x{i}" for i, g in enumerate(groups))
        parts.append(
            f"SELECT source, {_q(kind)} AS kind, {_q(role)} AS role, unnest(range(0, len(x0))) AS k, unnest(x0) AS a, "
            f"unnest(x1) AS t, unnest(x2) AS p, unnest(x3) AS n, unnest(x4) AS u FROM (SELECT source, {ex} FROM {src})"
        )
    return f"""{name} AS (SELECT source, kind || chr(31) || role || chr(31) || lpad(CAST(k AS VARCHAR), 9, '0') || chr(31) || {lower_strip('a')}
        || chr(31) || t::BIGINT || chr(31) || p::BIGINT || chr(31) || n::BIGINT || chr(31) || u::BIGINT AS c
      FROM ({' UNION ALL '.join(parts)}))"""


sql(
    "claims_equal",
    _STRUCT
    + f""",
tgt AS (SELECT source, string_agg(CASE role
     WHEN 'most_discussed' THEN aspect || ' attracted the most attention, with ' || total || ' mentions: ' || positive || ' positive, ' || negative || ' negative, and ' || neutral || ' neutral.'
     WHEN 'strongest_positive' THEN aspect || ' emerged as the clearest strength, receiving ' || positive || ' positive mentions out of ' || total || ', alongside ' || negative || ' negative and ' || neutral || ' neutral.'
     WHEN 'strongest_negative' THEN 'In contrast, ' || aspect || ' was the main concern, with ' || negative || ' negative mentions out of ' || total || ', compared with ' || positive || ' positive and ' || neutral || ' neutral.'
     WHEN 'most_divided' THEN aspect || ' feedback was the most divided, with ' || positive || ' positive, ' || negative || ' negative, and ' || neutral || ' neutral mentions among ' || total || ' total.'
     END, ' ' ORDER BY slot) AS report FROM sel GROUP BY source),
{_role_claims('rep', 'ca')},
{_role_claims('tgt', 'cb')},
sa AS (SELECT source, string_agg(c, chr(30) ORDER BY c) AS s, count(*) AS n FROM ca GROUP BY source),
sb AS (SELECT source, string_agg(c, chr(30) ORDER BY c) AS s, count(*) AS n FROM cb GROUP BY source)
SELECT r.source, (coalesce(sa.s, '') = coalesce(sb.s, '') AND coalesce(sb.n, 0) > 0) AS claims_equal,
       coalesce(sa.n, 0) AS report_claims, coalesce(sb.n, 0) AS target_claims
FROM rep r JOIN tgt ON tgt.source = r.source LEFT JOIN sa ON sa.source = r.source LEFT JOIN sb ON sb.source = r.source""",
)


# ---------------------------------------------------------------- catalog, prediction sink, second corpus
sql(
    "corpus_catalog",
    with_views("v5")
    + f""", f AS (SELECT DISTINCT source AS domain, CASE WHEN {_hash_u('doc_id')} < 0.15::DOUBLE THEN 'test'
          WHEN {_hash_u('doc_id')} < (0.15::DOUBLE + 0.15::DOUBLE) THEN 'dev' ELSE 'train' END AS split FROM v5)
SELECT d.domain, s.split, f.domain IS NOT NULL AS found
FROM (SELECT DISTINCT domain FROM f) d, unnest(['train', 'dev', 'test']) s(split) LEFT JOIN f ON f.domain = d.domain AND f.split = s.split""",
)
sql(
    "sink_predictions",
    _LEX
    + f""", pt AS (SELECT t.sid, {_render('x')} AS p FROM tst t LEFT JOIN prow x ON x.sid = t.sid GROUP BY t.sid),
gt AS (SELECT t.sid, {_render('x')} AS g FROM tst t LEFT JOIN grow x ON x.sid = t.sid GROUP BY t.sid)
SELECT pt.sid, p AS predicted_text, g AS target_text FROM pt JOIN gt ON pt.sid = gt.sid""",
)
sql(
    "sink_run_metrics",
    "SELECT k.sink, 'lexicon' AS model, q.* FROM (" + ORACLE["triplet_prf"].replace("AS f1 FROM r", "AS f1, (SELECT count(*) FROM tst) AS sentences FROM r")
    + ") q, (VALUES ('json'), ('csv'), ('history')) k(sink)",
)
sql(
    "sink_stats_documents",
    _LEX
    + """, tab AS (SELECT 'gold:' || tst.source AS grp, grow.* FROM grow JOIN tst ON grow.sid = tst.sid
         UNION ALL SELECT 'predicted:' || tst.source, prow.* FROM prow JOIN tst ON prow.sid = tst.sid),
ex AS (SELECT source, 2::BIGINT AS min_mentions, count(*) AS num_examples FROM tst GROUP BY source), """
    + _a2("tab", 10, group="grp")
    + """ SELECT split_part(grp, ':', 1) AS "table", ex.*, a2.* EXCLUDE (grp)
FROM a2 JOIN ex ON ex.source = substr(grp, strpos(grp, ':') + 1) WHERE total >= 2""",
)
_CONV = f"""cs AS (SELECT conv_id, turn, role, unnest(arr) AS sent, unnest(range(0, len(arr))) AS pos
       FROM (SELECT conv_id, turn, role, {_sa('text')} AS arr FROM conversations)),
tst AS (SELECT conv_id || ':' || turn || ':' || pos AS sid, role, {tokens('sent')} AS toks, NULL::BIGINT AS doc_id, NULL::BIGINT AS pos FROM cs)"""
sql(
    "conversation_aspects",
    _LEX.replace("tst AS (SELECT * FROM sp WHERE split = 'test')", _CONV)
    + ", ct AS (SELECT tst.role, prow.aspect, prow.opinion, prow.sentiment FROM prow JOIN tst ON prow.sid = tst.sid), "
    + _a2("ct", 10, group="role")
    + " SELECT * FROM a2 WHERE total >= 2",
)


# ---------------------------------------------------------------- TF-IDF vocabularies of the train split
def _terms(block: str, vocab: int) -> str:
    return f"""w_{block} AS (SELECT id, regexp_extract_all(lower({block}), '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}]{{{{2,}}}}') AS w FROM trx),
t_{block} AS (SELECT id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM w_{block}),
c_{block} AS (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM (SELECT id, term, count(*) AS n FROM t_{block} GROUP BY ALL) GROUP BY term
              ORDER BY tf DESC, term LIMIT {vocab})""".replace("{{2,}}", "{2,}")


sql(
    "tfidf_terms",
    _XML
    + f""", ex AS (SELECT sentence_id, {_MARKED} AS context, term AS aspect FROM xr WHERE polarity <> 'conflict'),
trx AS (SELECT *, row_number() OVER () AS id FROM ex WHERE NOT ({_hash_u('sentence_id')} < 0.15::DOUBLE)),
{_terms('context', 20000)},
{_terms('aspect', 2000)},
n AS (SELECT count(*) AS n FROM trx)
SELECT 'context' AS block, term, tf, df, round(ln((n.n + 1) / (df + 1)) + 1, 6) AS idf FROM c_context, n
UNION ALL SELECT 'aspect', term, tf, df, round(ln((n.n + 1) / (df + 1)) + 1, 6) FROM c_aspect, n""",
)
