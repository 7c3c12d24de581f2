"""Order MinHash fingerprints of documents, which follow the edit distance, in SQL functions alone.

1. A text is a run of units: its words, longer ones cut every ``UNIT`` code points. Every unit starts a
   k-mer of ``k`` units (the last ones are cut short by the end of the text).
2. k-mers are numbered by occurrence: their hashes are sorted with their places, so equal ones
   stand together, and each run of equal ones is counted from 0.
3. The hash of k-mer and number puts it into one of ``BUCKETS`` buckets and orders it there. The
   ``TUPLE`` smallest of a bucket are put back into text order, and the hash of that tuple is the
   bucket's coordinate of the fingerprint.

Equal coordinates of two texts mean equal k-mers in the same order, so moved passages count as
edits, as they do not in plain MinHash. All of it is array functions on one row: no token
leaves its row, no text is sent for its fingerprint.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aspectra.functions.text import once

UNIT = 12
K = 3
TUPLE = 2
BUCKETS = 64
#: A place in a text takes the lower bits of a sort key, a hash the upper ones of 63.
_PLACE = 28
_HASH = 35
#: Ranges of doc_id are told apart in two steps of so many bounds.
_STEP = 64


def _hashed(*parts: Column) -> Column:
    return F.shiftleft(F.xxhash64(*parts).bitwiseAND(F.lit((1 << _HASH) - 1)), _PLACE)


def _differs(keys: Column, bits: int, behind: int = 1):
    """Lambda (value, index) of a sorted array: true where the upper bits differ from those ``behind`` places before."""
    return lambda v, i: (i < behind) | (F.shiftright(v, bits) != F.shiftright(F.get(keys, i - behind), bits))


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K, length: int = TUPLE) -> DataFrame:
    """``df`` with ``name``: the coordinates of ``text`` as an array of longs, bucket << 16 | value, ascending.

    A null text counts as empty; a text without units has no coordinates.
    """
    keep = df.columns
    kept = [F.col(f"`{c}`") for c in keep]
    units = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"[^\\x20\\x09-\\x0D]{{1,{UNIT}}}"), F.lit(0))
    df = once(df, kept, __units=units)
    kmer = lambda x, i: _hashed(x, *[F.get("__units", i + n) for n in range(1, k)]).bitwiseOR(i.cast("long"))
    df = once(df, kept, __keys=F.sort_array(F.transform("__units", kmer)))
    # places are told apart from hashes, so the first of equal k-mers and the later ones keep their order
    first = _differs(F.col("__keys"), _PLACE)
    df = once(df, kept, __first=F.filter("__keys", first), __later=F.filter("__keys", lambda v, i: ~first(v, i)))
    runs = F.filter(F.transform("__later", lambda v, i: F.when(_differs(F.col("__later"), _PLACE)(v, i), i)), lambda i: i.isNotNull())
    df = once(df, [*kept, "__first", "__later"], __runs=runs)
    ends = lambda i: F.coalesce(F.get("__runs", i + 1), F.size("__later"))
    df = once(df, [*kept, "__first", "__later"], __nth=F.flatten(F.transform("__runs", lambda start, i: F.sequence(F.lit(1), ends(i) - start))))
    place = (1 << _PLACE) - 1
    mark = lambda v, nth: _hashed(F.shiftright(v, _PLACE), nth).bitwiseOR(v.bitwiseAND(F.lit(place)))
    marks = F.concat(F.transform("__first", lambda v: mark(v, F.lit(0))), F.transform("__later", lambda v, i: mark(v, F.get("__nth", i))))
    df = once(df, kept, __marks=F.sort_array(marks))
    bucket = _PLACE + _HASH - (BUCKETS.bit_length() - 1)
    df = once(df, kept, __least=F.filter("__marks", _differs(F.col("__marks"), bucket, length)))
    starts = F.transform("__least", lambda v, i: F.when(_differs(F.col("__least"), bucket)(v, i), i))

    def coordinate(i: Column) -> Column:
        own = F.shiftright(F.get("__least", i), bucket)
        mine = F.filter(F.slice("__least", i + 1, F.lit(length)), lambda v: F.shiftright(v, bucket) == own)
        in_text = F.sort_array(F.transform(mine, lambda v: F.shiftleft(v.bitwiseAND(F.lit(place)), _HASH).bitwiseOR(F.shiftright(v, _PLACE))))
        value = F.xxhash64(F.transform(in_text, lambda v: v.bitwiseAND(F.lit((1 << _HASH) - 1))))
        return F.shiftleft(own, 16).bitwiseOR(value.bitwiseAND(F.lit(0xFFFF)))

    return once(df, kept, **{name: F.transform(F.filter(starts, lambda i: i.isNotNull()), coordinate)})


def fingerprint_text(coordinates: Column) -> Column:
    """The fingerprint as a string: six hexadecimal digits a coordinate, empty for none."""
    return F.array_join(F.transform(coordinates, lambda c: F.lpad(F.lower(F.hex(c)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of buckets filled in either fingerprint whose coordinates are equal (1 if none is filled)."""
    buckets = lambda x: F.transform(x, lambda c: F.shiftright(c, 16))
    filled = F.size(F.array_union(buckets(a), buckets(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / filled)


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the descending ``bounds`` are greater than or equal to ``value``; null: all of them."""
    if not bounds:
        return F.lit(0)
    coarse, every = F.array(*[F.lit(b) for b in bounds[_STEP - 1 :: _STEP]]).cast("array<bigint>"), F.array(*[F.lit(b) for b in bounds])
    step = F.size(F.filter(coarse, lambda b: b >= value)) * _STEP
    return F.when(value.isNull(), F.lit(len(bounds))).otherwise(step + F.size(F.filter(F.slice(every, step + 1, F.lit(_STEP)), lambda b: b >= value)))


def with_next(docs: DataFrame, derive: Callable[[DataFrame], DataFrame], fields: list[str], ranges: int | None = None) -> DataFrame:
    """``derive(docs)`` with ``next_<field>`` of the next row by descending doc_id (after the last: the first).

    Nulls come last, rows of one doc_id in order of a hash of their text. Rows are dealt to ranges of
    doc_id; the first row of each range is sent to the range before it as well, so a text moves
    once. ``derive`` may add columns, which move with their row. ``ranges``: the session's shuffle
    partitions if not given.
    """
    n = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [1 - k / n for k in range(1, n)]
    # one row of at most ``ranges`` bounds
    found = docs.agg(F.percentile_approx("doc_id", shares, 100 * n).alias("b")).first()["b"] if shares else None
    bounds = sorted({int(b) for b in found or []}, reverse=True)
    rows = once(docs.withColumn("__tie", F.xxhash64("text")), [*docs.columns, "__tie"], __range=_range_of(F.col("doc_id"), bounds))
    # the first row of each range: the greatest doc_id (null: none), then the smallest hash
    first = F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", F.bitwise_not("__tie").alias("not_tie")))
    heads = rows.groupBy("__range").agg(first.alias("h")).orderBy("__range").collect()
    # a row per range: a bounded table of constants
    long = lambda x: F.lit(x).cast("long")
    places = [F.struct(F.lit(r["__range"]).alias("__range"), F.lit(heads[i - 1]["__range"]).alias("__before"), long(r["h"]["doc_id"]).alias("__head"), long(~r["h"]["not_tie"]).alias("__head_tie")) for i, r in enumerate(heads)]
    if not places:
        return derive(docs).withColumns({f"next_{f}": F.col(f) for f in fields})
    before = docs.sparkSession.range(1).select(F.inline(F.array(*places)))
    rows = rows.join(F.broadcast(before), "__range")
    is_head = F.col("doc_id").eqNullSafe(F.col("__head")) & (F.col("__tie") == F.col("__head_tie"))
    at = lambda c, copy: F.struct(F.col(c).alias("at"), F.lit(copy).alias("copy"))
    rows = derive(rows.select(*docs.columns, "__tie", "__range", "__before", is_head.alias("__is_head")))
    is_head = F.col("__is_head")
    places = F.explode(F.when(is_head, F.array(at("__range", False), at("__before", True))).otherwise(F.array(at("__range", False))))
    rows = rows.withColumn("__place", places).withColumns({"__at": F.col("__place.at"), "__copy": F.col("__place.copy")}).drop("__place", "__range", "__before", "__is_head")
    follows = W.partitionBy("__at").orderBy("__copy", F.col("doc_id").desc_nulls_last(), "__tie")
    rows = rows.repartition(n, "__at").withColumns({f"next_{f}": F.lead(f).over(follows) for f in fields})
    return rows.where("NOT __copy").drop("__at", "__copy", "__tie")


def fingerprints(docs: DataFrame, k: int = K, length: int = TUPLE, ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): one
    row per row of ``docs`` (doc_id, text).

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document's, by descending doc_id (after the last: the first; nulls last, rows of
    one doc_id in order of a hash of their text, repeated rows one after the other). A null text is
    empty. near_edited and near_next are the likeness, from 0 to 1, of the fingerprint to the edited
    text's and to the next document's; texts without words have an empty fingerprint, like each
    other by 1 and all others by 0. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, lambda df: with_fingerprint(df, "text", "own", k, length), ["text", "own"], ranges)
    n = F.length("text")
    half = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = once(rows.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited")), ["doc_id", "n_chars", "own", "next_own"], edited=F.col("edited"))
    rows = once(rows, ["doc_id", "n_chars", "own", "next_own", "edited"], edited_sha256=F.sha2(F.col("edited").cast("binary"), 256))
    rows = with_fingerprint(rows, "edited", "changed", k, length)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_text(F.col("own")).alias("fingerprint"), fingerprint_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
