"""Derived test inputs: tagged lines and reports written from the driver tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aspectra.functions.text import col_
from aspectra.operators.reports import list_sentence, natural_sentence, role_sentence
from aspectra.operators.tagged import sentiment_to_code


def render_tagged_line(toks, sentiment) -> Column:
    """A clause of at most 12 tokens as a tagged line in which every pair of tokens is tagged.

    Token 2k is an aspect and token 2k + 1 its opinion. Pairs 0 to 3 are groups of id length 1
    to 4; pairs 4 and 5 share the group of length 5, whose spans have gaps and whose second
    token carries code POS, so that the first token's code must win.
    """
    t = col_(toks)
    n, code = F.size(t), sentiment_to_code(col_(sentiment))

    # the places are written out: a clause has few, and plain expressions are compiled where a function over an array is interpreted
    def items(tag):
        return F.concat_ws(" ", *[F.concat(F.get(t, i), F.lit("="), tag(i)) for i in range(12)])

    def a_tag(i):
        if i % 2:
            return F.lit("O")
        group = "12" if i == 2 else "T" * min(i // 2 + 1, 5)
        return F.when(n > i + 1, F.concat(F.lit(group + "-"), F.lit("POS") if i == 10 else code)).otherwise(F.lit("O"))

    def o_tag(i):
        return F.lit("S" * min(i // 2 + 1, 5) if i % 2 else "O")

    return F.concat(F.array_join(t, " "), F.lit(" #### "), items(a_tag), F.lit(" #### "), items(o_tag))


def style_of(key: Column, n: int) -> Column:
    """Deterministic style number in [0, n) from a hash of the corpus key."""
    return F.pmod(F.conv(F.substring(F.md5(col_(key).cast("string")), 1, 6), 16, 10).cast("bigint"), F.lit(n))


def perturbed(key: Column) -> Column:
    """Corpora whose report gets one wrong count (about one in three, by hash)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("perturb:"), col_(key).cast("string"))), 1, 8), 16, 10).cast("double") < F.lit(
        4294967296.0 / 3
    )


def count_reports(selected: DataFrame, key: str = "source", perturb: bool = True, style: int | None = None) -> DataFrame:
    """V9 (count path): one report per corpus in one of three styles (role sentences, list
    form, natural form), or in ``style``; perturbed corpora state slot 1's total plus one."""
    wrong = perturbed(F.col(key)) & (F.col("slot") == 1) if perturb else F.lit(False)
    s = selected.withColumn("_style", style_of(F.col(key), 3) if style is None else F.lit(style)).withColumn(
        "total", F.when(wrong, F.col("total") + 1).otherwise(F.col("total"))
    )
    asp = F.concat(F.upper(F.substring("aspect", 1, 1)), F.substring("aspect", 2, 1 << 30))
    sent = (
        F.when(F.col("_style") == 0, role_sentence(F.col("role"), asp))
        .when(F.col("_style") == 1, list_sentence(F.col("aspect")))
        .otherwise(natural_sentence(asp))
    )
    out = s.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", sent.alias("x")))), lambda x: x["x"]), " ").alias("report")
    )
    return out


def flawed_rows(selected: DataFrame, key: str = "source") -> DataFrame:
    """The rows that a report tells of: by a hash of the corpus key a third lack slot 2, a third tell slot 1 twice."""
    s = selected.withColumn("_flaw", style_of(F.concat(F.lit("flaw:"), F.col(key)), 3))
    again = s.where("_flaw = 2 AND slot = 1").withColumn("slot", F.lit(9))
    return s.where("NOT (_flaw = 1 AND slot = 2)").unionByName(again).drop("_flaw")


def _reason(col: str) -> Column:
    return F.coalesce(F.get(F.col(col), 0)["reason"], F.lit(""))


def reasoned_reports(selected: DataFrame, key: str = "source", perturb: bool = True) -> DataFrame:
    """V9 (reason path): one paragraph per corpus, each selected aspect in its own sentence
    with its total, one sentiment count and its top reason, in four rotating styles."""
    s = selected.withColumn("_style", F.pmod(style_of(F.col(key), 4) + F.col("slot"), F.lit(4))).withColumn(
        "total", F.when(perturbed(F.col(key)) & (F.col("slot") == 1) & F.lit(perturb), F.col("total") + 1).otherwise(F.col("total"))
    )
    why = F.coalesce(
        F.when(F.size("positive_reasons") > 0, _reason("positive_reasons")),
        F.when(F.size("negative_reasons") > 0, _reason("negative_reasons")),
        _reason("neutral_reasons"),
    )
    a = F.col("aspect")
    sent = (
        F.when(F.col("_style") == 0, F.concat(F.lit("Reviewers brought up "), a, F.lit(" "), F.col("total").cast("string"),
               F.lit(" times, and "), F.col("positive").cast("string"), F.lit(" of those were positive, often about "), why, F.lit(".")))
        .when(F.col("_style") == 1, F.concat(F.lit("For "), a, F.lit(" there were "), F.col("total").cast("string"), F.lit(" mentions, and "),
              F.col("negative").cast("string"), F.lit(" were negative, pointing to "), why, F.lit(".")))
        .when(F.col("_style") == 2, F.concat(F.lit("Opinions on "), a, F.lit(" were split across "), F.col("total").cast("string"),
              F.lit(" mentions, with "), F.col("neutral").cast("string"), F.lit(" neutral notes such as "), why, F.lit(".")))
        .otherwise(F.concat(F.lit("Finally, "), a, F.lit(" collected "), F.col("total").cast("string"), F.lit(" mentions, "),
                   F.col("positive").cast("string"), F.lit(" of them positive and citing "), why, F.lit(".")))
    )
    return s.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slot", sent.alias("x")))), lambda x: x["x"]), " ").alias("report")
    )
