"""Corpus pipeline: five stages over the documents table, each written and reread as Parquet.

Every stage works on all rows that its predecessor kept. All but the last return the columns of
documents; ``n_chars`` follows the text where a stage changes it. Texts are long, so a stage bounds
the bytes that go to a Python worker at once where the session has not set that limit itself; its
result is computed after it returns, so only ``run`` puts the setting back.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectra.plans.materialize import materialize
from aspectra.session import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bounded(spark: SparkSession) -> None:
    from aspectra.llm.batches import BATCH_BYTES

    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go; it learns from the labels table."""
    from aspectra.llm.toxicity import known_labels, score, train

    _bounded(spark)
    rows = docs.select(*COLUMNS)
    model = train(rows.select("doc_id", "text"), known_labels(read_table(spark, sf_dir, "labels")))
    return score(rows, model, carry=tuple(COLUMNS)).where("score < 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one with the smallest doc_id (null last).

    Rows are told apart by doc_id and by a hash of all their columns, so texts that share a doc_id
    are judged each by itself; among rows of one group and doc_id the smallest hash stays, and of
    rows that are equal in all columns one.
    """
    from aspectra.llm.simhash import simhash_groups

    _bounded(spark)
    row_hash = F.xxhash64(*COLUMNS, *[F.col(c).isNull() for c in COLUMNS])
    rows = docs.select(*COLUMNS, row_hash.alias("hash"), F.coalesce("doc_id", F.lit(0)).alias("known"))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "known", "hash")
    groups = simhash_groups(rows.withColumn("row", row), doc_id="row", shingle=3, radius=2)
    keep = groups.where("doc_id = component_id").select("doc_id.known", "doc_id.hash").distinct()
    return rows.join(keep, ["known", "hash"], "left_semi").dropDuplicates(["known", "hash"]).select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by an earlier string of 100 bytes are cut; a character that a cut halves goes whole.

    Null texts stay null; a document that is cut empty stays with an empty text.
    """
    from aspectra.llm.suffix_dedup import remove_repeats

    _bounded(spark)
    rows = docs.select(*COLUMNS).withColumn("n_chars", F.when(F.col("text").isNotNull(), 1).cast("long"))
    cut = remove_repeats(rows, carry=("doc_id", "lang", "source", "n_chars"), length=100, with_text=True)
    text = F.when(F.col("n_chars").isNotNull(), F.col("kept"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stands as often as the mix takes it: never, once or twice."""
    from aspectra.llm.mixing import mix

    _bounded(spark)
    mixed = mix(docs, carry=tuple(COLUMNS)).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids."""
    import public_tokenizers

    from aspectra.llm.packing import pack

    _bounded(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The stages train, hash and sort in ways SQL cannot state; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.conf.get(BATCH_SETTING, None)
    docs = read_table(spark, sf_dir, "documents")
    try:
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        if own is None:
            spark.conf.unset(BATCH_SETTING)
    return docs
