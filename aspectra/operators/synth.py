"""Synthetic aspect tables for report evaluation.

A name is spelled from the caller's letters by the bytes of a hash of its index; names of real
aspects are left out by an anti join. Counts follow a caller-given leading share per role and
always add up to the total. Everything is a function of the index and the seed.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ONSETS, VOWELS = "bcdfglmnprstvz", "aeiou"


def hash_byte(key: Column, k: int) -> Column:
    """Byte ``k`` (0-15) of md5(key)."""
    return F.conv(F.substring(F.md5(key), 2 * k + 1, 2), 16, 10).cast("int")


def spelled(key: Column, pairs: int, onsets: str = ONSETS, vowels: str = VOWELS) -> Column:
    """A pronounceable word of ``pairs`` onset-vowel pairs, picked by the bytes of md5(key)."""
    pick = lambda letters, b: F.substring(F.lit(letters), F.pmod(b, F.lit(len(letters))) + 1, F.lit(1))
    return F.concat(*[pick(letters, hash_byte(key, 2 * k + j)) for k in range(pairs) for j, letters in enumerate((onsets, vowels))])


def synthetic_names(spark: SparkSession, real_aspects: DataFrame, pools: Sequence[tuple[str, int]], seed: str = "names",
                    pairs: int = 4, tries: int = 4) -> DataFrame:
    """(name, idx, pool), as many distinct unused names as the pools ask for, in order of index.

    ``tries`` times the names wanted are spelled; the job fails if too few of them are left."""
    wanted = sum(n for _, n in pools)
    names = spark.range(tries * wanted).select(spelled(F.concat(F.lit(seed + ":"), F.col("id").cast("string")), pairs).alias("name"), F.col("id").alias("idx"))
    names = names.groupBy("name").agg(F.min("idx").alias("idx"))
    free = names.join(real_aspects.select(F.lower("aspect").alias("name")).distinct(), "name", "left_anti")
    kept = free.orderBy("idx").limit(wanted)  # at most the names asked for, ranked in one task
    ranked = kept.withColumn("rank", F.row_number().over(Window.orderBy("idx"))).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))
    pool, upto = None, 0
    for label, n in pools:
        upto += n
        pool = F.when(F.col("rank") <= upto, label) if pool is None else pool.when(F.col("rank") <= upto, label)
    short = F.raise_error(F.concat(F.lit(f"{wanted} names wanted, found "), F.col("_n").cast("string")))
    return ranked.select(F.when(F.col("_n") < wanted, short).otherwise(F.col("name")).alias("name"), "idx", pool.alias("pool"))


def synthetic_rows(names: DataFrame, leading: Sequence[tuple[str, str, int]], seed: str = "rows") -> DataFrame:
    """Y2: counts and two reasons per sentiment for each name; roles take turns within a pool.

    ``leading``: (role, sentiment that leads, its share of the total in percent). The other two
    sentiments halve the rest, the negative or positive one getting the odd mention."""
    d = names.withColumn("slot", F.row_number().over(Window.partitionBy("pool").orderBy("idx")) - 1)
    turn = lambda k: F.get(F.array(*[F.lit(x[k]) for x in leading]), F.pmod(F.col("slot"), F.lit(len(leading))).cast("int"))
    key = lambda salt: F.concat(F.lit(f"{seed}:{salt}:"), F.col("name"))
    d = d.withColumn("role", turn(0)).withColumn("_lead", turn(1)).withColumn("total", F.lit(24) + F.pmod(hash_byte(key("total"), 0), F.lit(72)))
    d = d.withColumn("_first", F.floor(F.col("total") * turn(2) / 100).cast("int"))
    rest = F.col("total") - F.col("_first")
    d = d.withColumn("neutral", F.floor(rest / 2).cast("int")).withColumn("_other", rest - F.col("neutral"))
    for s in ("positive", "negative"):
        d = d.withColumn(s, F.when(F.col("_lead") == s, F.col("_first")).otherwise(F.col("_other")))

    def reasons(sent: str) -> Column:
        n = F.greatest(F.lit(1), F.least(F.col(sent), F.pmod(hash_byte(key(sent), 0), F.lit(6)) + 2))
        word = lambda k: spelled(key(f"{sent}{k}"), 3)
        return F.array(F.struct(word(0).alias("reason"), n.alias("n")), F.struct(word(1).alias("reason"), F.greatest(F.lit(1), n - 1).alias("n")))

    cols = [c for s in ("positive", "negative", "neutral") for c in (F.col(s), reasons(s).alias(f"{s}_reasons"))]
    return d.select("pool", "slot", "name", "role", *cols, "total")
