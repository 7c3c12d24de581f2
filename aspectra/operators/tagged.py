"""Tagged triplet lines (P4, P5, P13, J1, S2 parsing).

Line format: ``sentence #### token=tag ... #### token=tag ...``. Aspect tags are
``<group>-<code>``; opinion tags are ``S`` repeated as often as the aspect group id is
long, so the aspect group ``1`` (and ``T``, ``7``, ...) pairs with opinion group ``S``.

A sentence is one row and all its groups live inside it: no shuffle, and the cost per row is
in proportion to the sentence's own tags. The items of all lines of an Arrow batch are cut, grouped and
paired together, by Arrow's string functions and sorted keys, not by a loop over lines or items.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aspectra.functions.text import WS, WS_CHARS, once, strip_ws, tokens

# Sentiment codes of the tag format.
CODE_TO_SENTIMENT = {"POS": "positive", "NEG": "negative", "NEU": "neutral"}
SENTIMENT_TO_CODE = {v: k for k, v in CODE_TO_SENTIMENT.items()}

#: White space other than the space.
_OTHER_SPACE = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in WS_CHARS if c != " ") + "]"

TRIPLET_TYPE = "array<struct<aspect:string,opinion:string,sentiment:string>>"


def sentiment_to_code(s: Column) -> Column:
    return F.when(s == "positive", "POS").when(s == "negative", "NEG").otherwise("NEU")


def _sentiment(code: str) -> str:
    return CODE_TO_SENTIMENT.get(code, code.lower())


def _items(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Line, place in its line and text of each item that is not tagged O."""
    if pc.any(pc.match_substring_regex(lines, _OTHER_SPACE)).as_py():
        lines = pc.replace_substring_regex(lines, WS, " ")
    cut = pc.split_pattern(lines, " ")
    line, items = pc.list_parent_indices(cut).to_numpy(), cut.flatten()
    there = pc.not_equal(items, "")
    line, items = line[there.to_numpy(zero_copy_only=False)], items.filter(there)
    place = np.arange(len(line)) - np.searchsorted(line, line)
    tagged = pc.invert(pc.ends_with(items, "=O"))
    kept = tagged.to_numpy(zero_copy_only=False)
    return line[kept], place[kept], items.filter(tagged)


def _cut_once(values: pa.Array, at: str, last: bool) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The texts before and behind the first (or last) ``at``, and whether there is one; else all is on the side that ``rpartition`` or ``partition`` leaves it."""
    cut = pc.split_pattern(values, at, max_splits=1, reverse=last)
    ends, parts = np.cumsum(pc.list_value_length(cut).to_numpy()), cut.flatten()
    sizes = np.diff(ends, prepend=0)
    pick = lambda where, there: pc.if_else(pa.array(there), parts.take(pa.array(where)), "")
    two, every = sizes == 2, np.ones(len(sizes), bool)
    return pick(ends - sizes, two if last else every), pick(ends - 1, every if last else two), two


def _coded(values: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _grouped(key: np.ndarray, place: np.ndarray, token: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Key, first item, first place, end and phrase of the items of each key, by rising key."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    ends = np.append(first[1:], len(key))[:len(first)]
    phrase = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(first, len(key)), pa.int32()), token.take(pa.array(order))), " ")
    several = pa.array(ends - first > 1)
    joined = phrase.filter(several)
    for glued in (" n't", " 's"):
        joined = pc.replace_substring(joined, glued, glued[1:])
    phrase = pc.replace_with_mask(phrase, several, pc.utf8_trim(joined, WS_CHARS))
    return key[first], order[first], place[order[first]], place[order[ends - 1]] + 1, phrase


_GROUPS = f"struct<triplets:{TRIPLET_TYPE},spans:array<struct<a0:int,a1:int,o0:int,o1:int,sentiment:string>>,bad_items:int>"


def _lists(groups: pa.StructArray, kept: np.ndarray, line: np.ndarray, lines: int) -> pa.Array:
    """The kept groups of each line as a list."""
    ends = np.append(0, np.cumsum(np.bincount(line[kept], minlength=lines)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), groups.filter(pa.array(kept)))


def _line_groups(aspects: pa.Array, opinions: pa.Array) -> pa.Array:
    """Triplets (P4), spans (P5) and the number of items without ``=`` of tagged lines.

    The groups of a line come by length and name of their id. A group is the items that share its id: its
    span ends behind the last one, its code is the first one's; one without an opinion has no span and no triplet."""
    n = len(aspects)
    line, place, items = _items(aspects)
    token, tag, eq = _cut_once(items, "=", last=True)
    bad = np.bincount(line[~eq], minlength=n)
    gid, code, dash = _cut_once(tag, "-", last=False)
    line, place, token, gid, code = line[dash], place[dash], *(x.filter(pa.array(dash)) for x in (token, gid, code))
    at, names = _coded(gid)
    ranked = sorted(range(len(names)), key=lambda i: (len(names[i]), names[i]))
    rank = np.argsort(np.array(ranked, np.int64))
    size = np.array([len(names[i]) for i in ranked], np.int64)
    many = max(len(names), 1)
    key, item, a0, a1, aspect = _grouped(line.astype(np.int64) * many + rank[at], place, token)
    line, size = key // many, size[key % many]
    at, codes = _coded(code.take(pa.array(item)))
    sentiment = pa.array([_sentiment(c) for c in codes], pa.string()).take(pa.array(at))

    o_line, place, items = _items(opinions)
    token, tag, eq = _cut_once(items, "=", last=True)
    bad = bad + np.bincount(o_line[~eq], minlength=n)
    at, names = _coded(tag)
    length = np.array([len(x) if x == "S" * len(x) else -1 for x in names], np.int64)[at]
    some = length >= 0
    longest = 1 + max(length.max(initial=0), size.max(initial=0))
    key, _, o0, o1, opinion = _grouped(o_line[some].astype(np.int64) * longest + length[some], place[some], token.filter(pa.array(some)))
    wanted = line * longest + size
    where = np.searchsorted(key, wanted)
    found = np.append(key, -1)[where] == wanted
    where = pa.array(where, mask=~found)
    opinion, o0, o1 = opinion.take(where), pa.array(o0, pa.int32()).take(where), pa.array(o1, pa.int32()).take(where)
    triplets = pa.StructArray.from_arrays([aspect, opinion, sentiment], ["aspect", "opinion", "sentiment"])
    spans = pa.StructArray.from_arrays([pa.array(a0, pa.int32()), pa.array(a1, pa.int32()), o0, o1, sentiment], ["a0", "a1", "o0", "o1", "sentiment"])
    full = pc.and_(pc.not_equal(aspect, ""), pc.not_equal(opinion, "").fill_null(False)).to_numpy(zero_copy_only=False)
    return pa.StructArray.from_arrays([_lists(triplets, full, line, n), _lists(spans, found, line, n), pa.array(bad, pa.int32())], ["triplets", "spans", "bad_items"])


def parse_tagged_columns(df: DataFrame, line: str = "line") -> DataFrame:
    """Adds sentence, tokens, triplets (P4), spans (P5) and bad_items to well-formed lines
    (exactly three ``####`` parts; others are dropped like the file loader drops them).

    ``bad_items`` counts items without ``=``. Splitting lines and the filter are column expressions;
    the items of a line are grouped by one small function over Arrow batches."""
    cols = df.columns
    # not deterministic to Spark, so that it is not copied into the filters above it
    groups = F.arrow_udf(_line_groups, _GROUPS).asNondeterministic()
    d = once(df, cols, _parts=F.split(strip_ws(F.col(line)), "####")).filter(F.size("_parts") == 3)
    d = d.select(*cols, strip_ws(F.get("_parts", 0)).alias("sentence"), groups(F.get("_parts", 1), F.get("_parts", 2)).alias("_g"))
    return d.select(*cols, "sentence", tokens("sentence").alias("tokens"), "_g.triplets", "_g.spans", "_g.bad_items")


def parse_tagged(df: DataFrame, line: str = "line", strict: bool = False) -> DataFrame:
    """Keep well-formed lines (blank/malformed skipped, like the file loader); lines with an
    item lacking ``=`` go to :func:`tagged_rejects` (or raise when ``strict``)."""
    parsed = parse_tagged_columns(df, line)
    if strict:
        parsed = parsed.withColumn(
            "bad_items",
            F.when(F.col("bad_items") > 0, F.raise_error(F.lit("tag item without '='"))).otherwise(F.col("bad_items")),
        )
    return parsed.filter(F.col("bad_items") == 0).drop("bad_items")


def tagged_rejects(df: DataFrame, line: str = "line") -> DataFrame:
    return parse_tagged_columns(df, line).filter(F.col("bad_items") > 0).drop("bad_items")
