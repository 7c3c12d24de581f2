"""Derived views V1-V7 over the driver tables, built with Spark only.

V1 documents with a sentiment from the label flags; a document without a label is neutral
V2 sentences one row per sentence (doc_id, source, pos, sent, sentiment)
V3 tokens    V2 with its whitespace token array
V3c clauses  V3 cut into runs of at most CLAUSE tokens, all kept
V4 triplets  every pair of tokens of a sentence: aspect = token 2k, opinion = token 2k + 1
V5 tagged lines of all clauses; V6 generated text; V7 XML sentences

Every document and every token is read. Everything after the join is narrow (per-row
explode/filter), so the scan-heavy part parallelises over the document files with no shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectra.functions.text import once, split_sentence_array, tokens
from aspectra.session import read_table, spread


#: Tokens of a clause; tag groups and grids are written per clause, so their size is bounded.
CLAUSE = 12


def sentiment_from_labels(toxic="toxic", quality="quality"):
    return (
        F.when(F.col(toxic) == 1, F.lit("negative"))
        .when(F.col(quality) == 1, F.lit("positive"))
        .otherwise(F.lit("neutral"))
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, all documents. labels is much smaller than documents; AQE turns this into a
    broadcast join at run time only when the measured labels side is under the broadcast
    threshold, else it stays a sort-merge join on doc_id."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return documents(spark, sf_dir).join(labels, "doc_id", "left").select(
        "doc_id", "source", "text", sentiment_from_labels().alias("sentiment")
    )


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2."""
    return spread(labelled(spark, sf_dir)).select(
        "doc_id", "source", "sentiment", F.posexplode(split_sentence_array("text")).alias("pos", "sent")
    )


def plain_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2 without the sentiment, for queries that need no label."""
    return spread(documents(spark, sf_dir)).select(
        "doc_id", "source", F.posexplode(split_sentence_array("text")).alias("pos", "sent")
    )


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3."""
    d = sentences(spark, sf_dir)
    return once(d, d.columns, tokens=tokens("sent"))


def clause_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pos`` is the sentence's place times 10^6 plus the clause's place in it."""
    at = F.sequence(F.lit(0), F.floor((F.size("tokens") - 1) / CLAUSE))
    cut = F.transform(at, lambda k: F.slice("tokens", (k * CLAUSE + 1).cast("int"), CLAUSE))
    c = token_rows(spark, sf_dir).filter(F.size("tokens") > 0).select(
        "doc_id", "source", "sentiment", "pos", F.posexplode_outer(cut).alias("k", "tokens")
    )
    return c.select("doc_id", "source", "sentiment", (F.col("pos").cast("bigint") * 1000000 + F.col("k")).alias("pos"), "tokens")


def triplet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: (doc_id, source, pos, aspect, opinion, sentiment), one row per pair of tokens."""
    pairs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("tokens") / 2).cast("int") - 1),
        lambda k: F.struct(F.get("tokens", k * 2).alias("aspect"), F.get("tokens", k * 2 + 1).alias("opinion")),
    )
    return (
        token_rows(spark, sf_dir)
        .filter(F.size("tokens") >= 2)
        .select("doc_id", "source", "pos", F.inline_outer(pairs), "sentiment")
    )


def tagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: every clause rendered as a tagged triplet line."""
    from aspectra.plans.fixtures import render_tagged_line

    return once(clause_rows(spark, sf_dir), ["doc_id", "source", "pos", "sentiment"], line=render_tagged_line("tokens", "sentiment"))


def parsed_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.operators.tagged import parse_tagged

    return parse_tagged(tagged_lines(spark, sf_dir))


def generated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: the parsed V5 triplets rendered as model-style text (sentinel when none)."""
    from aspectra.functions.triplets import render_triplets

    return parsed_tagged(spark, sf_dir).select(
        "doc_id", "source", "pos", "sentence", render_triplets("triplets").alias("generated")
    )


def xml_sentence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 as structured rows: (sentence_id, text, terms). A clause of two or more tokens has a
    term for each token: every third one labelled (the first with its offsets), the next
    without polarity, the next ``conflict``."""
    t = clause_rows(spark, sf_dir)
    polarity = lambda i: F.when(i % 3 == 0, F.col("sentiment")).when(i % 3 == 2, F.lit("conflict"))
    term = F.transform("tokens", lambda x, i: F.struct(
        x.alias("term"), polarity(i).alias("polarity"),
        F.when(i == 0, 0).otherwise(-1).alias("start"), F.when(i == 0, F.length(x)).otherwise(-1).alias("end"),
    ))
    terms = F.when(F.size("tokens") >= 2, term)
    return t.select(F.concat_ws(":", "doc_id", "pos").alias("sentence_id"), F.array_join("tokens", " ").alias("text"), terms.alias("terms"))
