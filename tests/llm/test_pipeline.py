"""The stages of the pipeline, each against a brute-force version on its own input, and the registered queries."""
import numpy as np
import public_tokenizers
import pytest
from test_mixing import water
from test_simhash import brute_fingerprint, components
from test_suffix_dedup import brute
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline

COLUMNS = {
    "op1_learned_partitions": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op2_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op3_toxicity_nbsvm": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_packing_hilbert": {"doc_id": "bigint", **{c: "bigint" for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}},
    "op5_mixing_subset_sum": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6_warc_transactions": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op7_simhash_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op8_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op9_html_consensus": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op10_language_crossparse": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
}
TABLE = {"op1": "embeddings", "op8": "embeddings", "op6": "pages", "op9": "pages"}


@pytest.mark.parametrize("name", COLUMNS)
def test_registered_query(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    assert dict(df.dtypes) == COLUMNS[name]
    rows, table = df.count(), spark.read.parquet(f"{sf_dir}/{TABLE.get(name.split('_')[0], 'documents')}.parquet")
    if name.startswith("op1_"):
        assert rows == 20 * table.where("vec_id % 20 = 0").count()
    else:
        assert rows >= table.count() if name.startswith("op4") else rows == table.count()


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows before the first and after each stage."""
    from aspectra.plans.materialize import materialize

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        out.append(docs.collect())
    return out


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "mixing", "packing"]
    for rows in stages[:-1]:
        assert set(rows[0].asDict()) == set(corpus_pipeline.COLUMNS)


def test_toxic_documents_go(spark, sf_dir, stages):
    predicted = {r.doc_id: r.predicted for r in entry.queries()["op3_toxicity_nbsvm"](spark, sf_dir).collect()}
    assert {r.doc_id for r in stages[1]} == {d for d, p in predicted.items() if p == 0}
    before = {r.doc_id: r for r in stages[0]}
    assert all(before[r.doc_id].text == r.text for r in stages[1])


def test_one_of_each_group_stays(stages):
    ids = [r.doc_id for r in stages[1]]
    comp = components(ids, [brute_fingerprint(r.text) for r in stages[1]])
    assert sorted(r.doc_id for r in stages[2]) == sorted(set(comp))


def test_repeated_passages_are_cut(stages):
    import hashlib

    order = sorted((r.doc_id, r.text) for r in stages[2])
    want = brute(order)
    after = {r.doc_id: r for r in stages[3]}
    assert set(after) == {d for d, _ in order}
    cut = 0
    for d, text in order:
        n_bytes, n_removed, _, sha = want[d, text]
        got = after[d]
        assert got.n_chars == len(got.text)
        if n_removed == 0:
            assert got.text == text
        elif hashlib.sha256(got.text.encode()).hexdigest() != sha:  # a cut halved a character
            assert 0 < n_bytes - n_removed - len(got.text.encode()) <= 6 * want[d, text][2]
        cut += n_removed
    assert cut > 0


def test_mix_meets_its_targets(stages):
    size = lambda r: len((r.text or "").encode().split())
    sizes, taken, copies = {}, {}, {}
    for r in stages[3]:
        sizes[r.source] = sizes.get(r.source, 0) + size(r)
    for r in stages[4]:
        taken[r.source] = taken.get(r.source, 0) + size(r)
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2
    want = water(sizes, (5, 2, 1))
    for s in sizes:  # as near as any choice of its documents comes
        aim = round(want[s])
        whole = min(2, aim // sizes[s]) * sizes[s]
        sums = {whole}
        for r in stages[3]:
            if r.source == s and whole < 2 * sizes[s]:
                sums |= {x + size(r) for x in sums}
        assert abs(taken.get(s, 0) - aim) == min(abs(x - aim) for x in sums)


def test_packed_ids_are_the_documents(stages):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sum(len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in stages[4])
    assert sum(r.length for r in stages[5]) == want
    by_seq = {}
    for r in stages[5]:
        assert np.frombuffer(bytes(r.ids), "<u4").size == r.length
        by_seq[r.sequence_id] = by_seq.get(r.sequence_id, 0) + r.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in by_seq.values())


def test_odd_documents_pass_all_stages(spark, sf_dir, documents):
    docs = documents.selectExpr("doc_id", "text", "lang", "source", "n AS n_chars", "score", "ids", "part")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, sf_dir)
            assert (out.columns == corpus_pipeline.COLUMNS) == (k < 4)
            assert (out.count() > 0) == (rows is docs)


def test_texts_that_share_an_id_are_judged_apart(spark, sf_dir):
    one, two, three = (" ".join(f"{w}{i * i % 97}" for i in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(1, one, "en", "a"), (2, one, "en", "a"), (2, two, "en", "a"), (2, two, "en", "a"), (3, three, None, None), (None, three, "en", "b"), (None, two + " x y", "en", "b"), (9, None, "fr", "a")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    pairs = sorted([(r.doc_id, r.text) for r in got], key=str)
    near = sorted([(1, one), (2, two), (3, three), (9, None)], key=str)
    assert [p for p in pairs if p[0] is not None] == near and len(pairs) <= 5


def test_run_is_the_chain_of_stages(spark, sf_dir, stages):
    key = corpus_pipeline.BATCH_SETTING
    spark.conf.unset(key)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(stages[-1])
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "3m")  # a limit of the caller's own is left alone
    try:
        corpus_pipeline.toxicity(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
        assert spark.conf.get(key) == "3m"
    finally:
        spark.conf.unset(key)
    assert entry.queries()["pipeline"] is corpus_pipeline.run
