"""Column-level text helpers (all JVM-side built-ins, no Python UDFs).

Whitespace follows Python's ``str.isspace`` (what ``str.split()``/``str.strip()`` and the
``\\s`` of Unicode regexes use). The character class is derived from that rule at import
time and written with ``\\x{..}`` escapes, which both Java regex (Spark) and RE2 (the
DuckDB oracle) accept, so the two engines split on exactly the same characters.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ws_class() -> str:
    ranges: list[tuple[int, int]] = []
    for cp in range(0x110000):
        if chr(cp).isspace():
            if ranges and ranges[-1][1] == cp - 1:
                ranges[-1] = (ranges[-1][0], cp)
            else:
                ranges.append((cp, cp))
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:X}}}" if lo == hi else f"\\x{{{lo:X}}}-\\x{{{hi:X}}}")
    return "[" + "".join(parts) + "]"


WS = _ws_class()  # one whitespace character
WS_CHARS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
#: A run of them in Java's notation: single ones below 256 are a bit set, the others are tried on characters above it only.
WS_RUN = ("[" + "".join(f"\\x{{{ord(c):X}}}" for c in WS_CHARS if ord(c) < 256)
          + "[\\x{100}-\\x{10FFFF}&&[" + "".join(f"\\x{{{ord(c):X}}}" for c in WS_CHARS if ord(c) > 255) + "]]]+")
STRIP_RE = f"^{WS}+|{WS}+$"

SENTIMENTS = ("positive", "negative", "neutral")  # fixed order: majority ties go left


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends (character-set trim, no regex)."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def norm_key(c) -> Column:
    """Aspect/opinion key: ``strip().lower()``."""
    return F.lower(strip_ws(c))


def collapse_ws(c) -> Column:
    """Whitespace runs to one space, then strip (the second normalisation)."""
    return strip_ws(F.regexp_replace(col_(c), WS_RUN, " "))


def tokens(c) -> Column:
    """Python ``str.split()``: non-empty whitespace-separated tokens."""
    return F.array_remove(F.split(col_(c), WS_RUN), "")


def split_sentence_array(c) -> Column:
    """Split after ``.``/``!``/``?`` followed by whitespace; pieces stripped, empties dropped."""
    pieces = F.split(strip_ws(F.coalesce(col_(c), F.lit(""))), f"(?<=[.!?]){WS_RUN}")
    return F.array_remove(F.transform(pieces, strip_ws), "")


def has_latin_letter(c) -> Column:
    return col_(c).rlike("[a-zA-Z]")


def detokenize(arr) -> Column:
    """Join tokens by spaces, glue `` n't`` and `` 's``, strip."""
    joined = F.array_join(col_(arr), " ")
    return strip_ws(F.replace(F.replace(joined, F.lit(" n't"), F.lit("n't")), F.lit(" 's"), F.lit("'s")))


def mark_aspect(text, start, end) -> Column:
    """Wrap [start, end) in ``$T$`` markers; untouched when offsets are invalid.

    Offsets count code points, like Python string indexing and Spark ``substring``.
    """
    t, s, e = col_(text), col_(start), col_(end)
    valid = (s >= 0) & (e >= 0) & (e <= F.length(t)) & (s < e)
    marked = F.concat(
        F.substring(t, F.lit(1), s),
        F.lit("$T$ "),
        F.substring(t, s + 1, e - s),
        F.lit(" $T$"),
        F.substring(t, e + 1, F.length(t)),
    )
    return F.when(valid, marked).otherwise(t)


def once(df: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """``df`` with ``keep`` and the given columns, each computed once per row.

    The optimiser copies an expression into every filter and projection that uses it; columns that
    come out of a generator are not copied, so costly ones go through a one-row ``inline``."""
    return df.select(*keep, F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
