"""Registered queries of the training-data operators: whole tables, production parameters."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectra.session import new_scratch_path, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.simhash import simhash_groups

    groups = simhash_groups(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op3_toxicity_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.toxicity import toxicity

    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op10_language_crossparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.langid import language_id

    return language_id(read_table(spark, sf_dir, "documents"))


@query
def op5_mixing_subset_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.mixing import mix

    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: Bytes of words that a worker of op4 remembers; the packer is alone in its workers there, unlike in the pipeline.
WORDS = 192 << 20


@query
def op4_packing_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from aspectra.llm.packing import pack

    pieces = pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), remembered=WORDS)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.warc import captures_of

    captures = captures_of(spark, read_table(spark, sf_dir, "pages"), new_scratch_path(spark, "warc"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op6_warc_transactions"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(encode(html)) AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS leader,
         row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST) AS r FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND r > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND r > 1 THEN leader END AS refers_to
FROM g
"""


@query
def op9_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.html import main_text

    texts = main_text(read_table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.embedding_dedup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.98)


@query
def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.ann import search

    return search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.suffix_dedup import remove_repeats

    return remove_repeats(read_table(spark, sf_dir, "documents"), length=100)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.hard_negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE["op11_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS r
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 5
"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.prefix_trie import prefix_trie

    c = F.col("conv_id")
    return prefix_trie(read_table(spark, sf_dir, "conversations"), c - c % 5, F.crc32(c.cast("string")) % 9)


# DuckDB has no crc32: the fold takes a byte of the number's decimals (0 to 255) and then its eight bits (-1)
ORACLE["op12_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS bytes, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS tok,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT conv_id, list(tok ORDER BY p) AS toks, list(bytes ORDER BY p) AS sizes FROM t GROUP BY conv_id
), c AS (
  SELECT conv_id, toks, sizes, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: [CAST(ascii(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END)) % 9 AS h
  FROM l
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.toks[1:c.h], []), c.toks[c.h + 1:]) AS toks, list_concat(coalesce(b.sizes[1:c.h], []), c.sizes[c.h + 1:]) AS sizes
  FROM c LEFT JOIN l b ON b.conv_id = c.base
), w AS (
  SELECT conv_id, d AS depth, d = len(toks) AS ends, md5(array_to_string(toks[1:d], ',')) AS name,
         CASE WHEN d > 0 THEN md5(array_to_string(toks[1:d - 1], ',')) END AS up, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(len(toks) + 1)) AS d FROM r)
), n AS (
  SELECT depth, name, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM w GROUP BY depth, name
), k AS (
  SELECT depth - 1 AS depth, up AS name, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2
), m AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, name)
), s AS (
  SELECT w.depth, w.name, CAST(count(*) FILTER (m.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum((m.n_convs - 1) * m.bytes) AS BIGINT) AS saved_tokens
  FROM m JOIN w ON w.conv_id = m.conv_id AND w.depth <= m.depth GROUP BY w.depth, w.name
)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, m.ends_sha256
FROM m JOIN s USING (depth, name) LEFT JOIN m q ON q.depth = m.depth - 1 AND q.name = m.up
"""


@query
def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aspectra.llm.order_minhash import fingerprints

    return fingerprints(read_table(spark, sf_dir, "documents"))
