"""DuckDB SQL twins of the derived views (used only by the oracle SQL strings).

DuckDB's RE2 has no look-around, so sentence boundaries are first marked with chr(1)
and then split (equivalent to the look-behind split used on the Spark side).
"""
from __future__ import annotations

from aspectra.functions.text import WS, WS_CHARS

_WS_SQL = " || ".join(f"chr({ord(c)})" for c in WS_CHARS)

WSR = WS + "+"


def strip(x: str) -> str:
    return f"trim({x}, {_WS_SQL})"


def lower_strip(x: str) -> str:
    return f"lower({strip(x)})"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WSR}'), lambda t: t <> '')"


def sentence_array(x: str) -> str:
    marked = f"regexp_replace({strip(f'coalesce({x}, {chr(39)}{chr(39)})')}, '([.!?]){WSR}', '\\1' || chr(1), 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')}), lambda s: s <> '')"


V1 = """v1 AS (
  SELECT d.doc_id, d.source, d.text,
         CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

V2 = f"""v2a AS (SELECT doc_id, source, sentiment, {sentence_array('text')} AS arr FROM v1),
v2 AS (SELECT doc_id, source, sentiment, unnest(arr) AS sent, unnest(range(0, len(arr))) AS pos FROM v2a)"""

V3 = f"""v3 AS (SELECT *, {tokens('sent')} AS tokens FROM v2)"""

V4 = """v4 AS (SELECT doc_id, source, pos, tokens[2 * k + 1] AS aspect, tokens[2 * k + 2] AS opinion, sentiment
        FROM v3, unnest(range(0, len(tokens) // 2)) u(k))"""

V3C = """v3c AS (SELECT doc_id, source, sentiment, CAST(pos AS BIGINT) * 1000000 + k AS pos, tokens[12 * k + 1 : 12 * k + 12] AS tokens
        FROM v3, unnest(range(0, (len(tokens) + 11) // 12)) u(k))"""

VIEWS = {"v1": V1, "v2": V2, "v3": V3, "v4": V4, "v3c": V3C}
ORDER = ["v1", "v2", "v3", "v4"]
#: Views that a view needs beside those before it in ORDER.
CHAINS = {"v4": ["v1", "v2", "v3", "v4"], "v3c": ["v1", "v2", "v3", "v3c"], "v5": ["v1", "v2", "v3", "v3c", "v5"]}


def with_views(upto: str, *extra: str) -> str:
    """``WITH v1 AS (..), ..., <upto>, <extra CTEs>``."""
    names = CHAINS.get(upto) or ORDER[: ORDER.index(upto) + 1]
    return "WITH " + ",\n".join([VIEWS[n] for n in names] + list(extra)) + "\n"


MAJORITY = (
    "CASE WHEN positive >= negative AND positive >= neutral THEN 'positive' "
    "WHEN negative >= neutral THEN 'negative' ELSE 'neutral' END"
)


def a1_sql(src: str, group: str = "", name: str = "a1", min_mentions: int = 1) -> str:
    """A1 over a CTE with (aspect, sentiment)."""
    g = f"{group}, " if group else ""
    return f"""{name} AS (
  SELECT {g}aspect, positive, negative, neutral, positive + negative + neutral AS total, {MAJORITY} AS majority_sentiment
  FROM (SELECT {g}{lower_strip('aspect')} AS aspect,
               CAST(count(*) FILTER (WHERE sentiment = 'positive') AS BIGINT) AS positive,
               CAST(count(*) FILTER (WHERE sentiment = 'negative') AS BIGINT) AS negative,
               CAST(count(*) FILTER (WHERE sentiment = 'neutral') AS BIGINT) AS neutral
        FROM {src}
        WHERE {lower_strip('aspect')} <> '' AND sentiment IN ('positive', 'negative', 'neutral')
        GROUP BY ALL) WHERE positive + negative + neutral >= {min_mentions})"""


def a2_sql(src: str, top_n: int = 10, group: str = "") -> str:
    """A2 over a CTE with (aspect, opinion, sentiment); reasons rendered ``reason:n,...``."""
    g = f"{group}, " if group else ""
    gj = f"a.{group} = r.{group} AND " if group else ""
    parts = []
    for s in ("positive", "negative", "neutral"):
        parts.append(
            f"coalesce(string_agg(CASE WHEN r.sentiment = '{s}' AND r.rk <= {top_n} THEN r.reason || ':' || r.n END, ',' "
            f"ORDER BY r.rk), '') AS {s}_reasons"
        )
    return f"""rc AS (
  SELECT {g}{lower_strip('aspect')} AS aspect, sentiment, {lower_strip('opinion')} AS reason, count(*) AS n
  FROM {src}
  WHERE {lower_strip('aspect')} <> '' AND sentiment IN ('positive', 'negative', 'neutral')
  GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY {g}aspect, sentiment ORDER BY n DESC, reason) AS rk
       FROM rc WHERE reason <> ''),
{a1_sql(src, group)},
a2 AS (
  SELECT a.{g.replace(', ', ', a.') if g else ''}aspect, a.positive, a.negative, a.neutral, a.total, a.majority_sentiment,
         {', '.join(parts)}
  FROM a1 a LEFT JOIN rk r ON {gj}a.aspect = r.aspect
  GROUP BY ALL)"""


def detok(x: str) -> str:
    return strip(f"replace(replace({x}, ' n''t', 'n''t'), ' ''s', '''s')")


CODE = "CASE sentiment WHEN 'positive' THEN 'POS' WHEN 'negative' THEN 'NEG' ELSE 'NEU' END"
ITEM_RE = "^(.*)=([^=]*)$"

V5 = f"""v5 AS (
  SELECT doc_id, source, pos, sentiment,
    array_to_string(tokens, ' ') || ' #### ' || array_to_string(list_transform(tokens, lambda x, i: x || '=' ||
        CASE WHEN i % 2 = 1 AND i < len(tokens)
             THEN CASE WHEN i = 3 THEN '12' ELSE repeat('T', least((i + 1) // 2, 5)) END || '-' || CASE WHEN i = 11 THEN 'POS' ELSE code END
             ELSE 'O' END), ' ')
    || ' #### ' || array_to_string(list_transform(tokens, lambda x, i: x || '=' ||
        CASE WHEN i % 2 = 0 THEN repeat('S', least(i // 2, 5)) ELSE 'O' END), ' ') AS line
  FROM (SELECT *, {CODE} AS code FROM v3c))"""


def tagged_parse_ctes(src: str = "v5") -> str:
    """CTE chain parsing tagged lines of ``src`` into ``tj`` (one row per aspect group)."""
    return f"""p5 AS (SELECT doc_id, pos, string_split({strip('line')}, '####') AS parts FROM {src}),
ok5 AS (SELECT doc_id, pos, {strip('parts[1]')} AS sentence, {tokens('parts[2]')} AS a_items, {tokens('parts[3]')} AS o_items
        FROM p5 WHERE len(parts) = 3),
ai AS (SELECT doc_id, pos, unnest(a_items) AS item, unnest(range(0, len(a_items))) AS i FROM ok5),
oi AS (SELECT doc_id, pos, unnest(o_items) AS item, unnest(range(0, len(o_items))) AS i FROM ok5),
ae AS (SELECT doc_id, pos, i, regexp_extract(item, '{ITEM_RE}', 1) AS tok, regexp_extract(item, '{ITEM_RE}', 2) AS tag FROM ai),
oe AS (SELECT doc_id, pos, i, regexp_extract(item, '{ITEM_RE}', 1) AS tok, regexp_extract(item, '{ITEM_RE}', 2) AS tag FROM oi),
ag AS (SELECT doc_id, pos, split_part(tag, '-', 1) AS gid, arg_min(substr(tag, strpos(tag, '-') + 1), i) AS code,
              string_agg(tok, ' ' ORDER BY i) AS raw, min(i) AS a0, max(i) + 1 AS a1
       FROM ae WHERE tag <> 'O' AND strpos(tag, '-') > 0 GROUP BY ALL),
og AS (SELECT doc_id, pos, tag AS gid, string_agg(tok, ' ' ORDER BY i) AS raw, min(i) AS o0, max(i) + 1 AS o1
       FROM oe WHERE tag <> 'O' GROUP BY ALL),
tj AS (SELECT ag.doc_id, ag.pos, ag.gid, {detok('ag.raw')} AS aspect, coalesce({detok('og.raw')}, '') AS opinion,
              CASE code WHEN 'POS' THEN 'positive' WHEN 'NEG' THEN 'negative' WHEN 'NEU' THEN 'neutral' ELSE lower(code) END AS sentiment,
              a0, a1, o0, o1
       FROM ag LEFT JOIN og ON ag.doc_id = og.doc_id AND ag.pos = og.pos AND og.gid = repeat('S', length(ag.gid))),
tt AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, pos ORDER BY length(gid), gid) - 1 AS ord,
              aspect, opinion, sentiment FROM tj WHERE aspect <> '' AND opinion <> ''),
ts AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, pos ORDER BY length(gid), gid) - 1 AS ord,
              a0, a1, o0, o1, sentiment FROM tj WHERE o0 IS NOT NULL)"""


V6 = """v6 AS (
  SELECT s.doc_id, s.source, s.pos, coalesce(string_agg('aspect: ' || t.aspect || ' | opinion: ' || t.opinion || ' | sentiment: ' || t.sentiment,
         ' ; ' ORDER BY t.ord), 'no triplet') AS generated
  FROM ok5 o JOIN v5 s ON s.doc_id = o.doc_id AND s.pos = o.pos
  LEFT JOIN tt t ON t.doc_id = o.doc_id AND t.pos = o.pos
  GROUP BY ALL)"""
VIEWS["v5"] = V5
