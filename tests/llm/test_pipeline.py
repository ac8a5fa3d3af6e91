"""The pipeline's stages against plain versions, each on what the one before it kept."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from kinfold.llm import bpe_tree, disclosure, fertility, tokens
from kinfold.llm.tokens import Cache, vocabulary_path
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, odd_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*COLUMNS).unionByName(
        odd_docs.select(F.col("doc_id") + 100_000, "text", "lang", "source", "n_chars").toDF(*COLUMNS)).unionByName(
        spark.createDataFrame([(None, "no id " * 4 + "but words enough to be kept by the rules of quality, one hopes, at the end of it",
                                "en", "s", 1)] * 2 + [(100_500, None, None, None, None)],
                              "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    items = list(map(tuple, spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()))
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.cut_lineage(stage(spark, steps[-1], SMALL)))
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert steps[-1].columns == COLUMNS
    rows = [sorted(map(tuple, s.select("doc_id", "text").collect()), key=str) for s in steps]

    kept = {r.doc_id for r in fertility.measure(docs).filter("kept").select("doc_id").collect()}
    assert rows[1] == [r for r in rows[0] if r[0] in kept] and len(rows[1]) < len(rows[0])
    firsts = {top for _, _, top in brute.similar([r for r in rows[1] if r[0] is not None])}
    assert rows[2] == [r for r in rows[1] if r[0] is None or r[0] in firsts] and len(rows[2]) < len(rows[1])
    assert rows[3] == [r for r, found in zip(rows[2], brute.contamination(rows[2], items)) if not found[5]]
    assert len(rows[3]) < len(rows[2])
    assert [r[0] for r in rows[4]] == [r[0] for r in rows[3]]
    for (_, before), (_, after) in zip(rows[3], rows[4]):
        spans = brute.personal_data(before)
        assert not any(before[a:b] in after for k in disclosure.KINDS for a, b in spans[k])
        if not any(spans.values()):
            assert after == before
    library = tokens.rank_encoding(tokens.vocabulary_path(bpe_tree.VOCABULARY))
    texts = dict(rows[4])
    for r in steps[5].collect():
        if r.doc_id is not None:
            assert r.text == texts[r.doc_id]
            assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text) and r.n_tokens == len(r.ids) // 4


def test_run_and_empty_documents(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, SMALL).count() > 100


def test_encoding_keeps_one_worker_per_task_and_no_answers_of_others(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id bigint, text string")
    out = corpus_pipeline.encoding(spark, docs, "")
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [(r.doc_id, r.text) for r in out.sort("doc_id").collect()] == [(1, "one two"), (2, "")]
    cache = Cache()
    cache.lookup(["a"], lambda new: [b"1"])
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["one two"]})
    encoded = list(bpe_tree._encode([batch], vocabulary_path(bpe_tree.VOCABULARY)))
    assert not cache and encoded[0].column("n_tokens").to_pylist() == [out.filter("doc_id = 1").first().n_tokens]
