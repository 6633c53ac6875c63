"""The registered queries and the pipeline on the smallest folder."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
import compare  # noqa: E402

import corpus_pipeline  # noqa: E402
from tallyward.llm import bpe, queries  # noqa: E402
from tallyward.llm.common import stage  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    assert compare.compare(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), queries.ORACLES[name]) == ""


@pytest.mark.parametrize("name, table, key", [
    ("op1_bpe_round_trip", "documents", "doc_id"), ("op3_embedding_dedup", "embeddings", "vec_id"),
    ("op4_secret_scan", "documents", "doc_id"), ("op5_token_shards", "documents", "doc_id"),
    ("op6_quality_rules", "documents", "doc_id"), ("op8_jaccard_join", "documents", "doc_id"),
    ("op9_suffix_tree", "documents", "doc_id"), ("op10_mix_sources", "documents", "doc_id")])
def test_every_row_is_answered(spark, name, table, key):
    got = Counter(r[key] for r in queries.QUERIES[name](spark, FOLDER).select(key).collect())
    assert got == Counter(r[key] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect())


def test_pipeline(spark):
    docs = queries.table(spark, FOLDER, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    for name, work in corpus_pipeline.STAGES[:-1]:
        docs = stage(work(spark, docs, FOLDER), "test-pipeline")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        after = docs.collect()
        ids = {r.doc_id for r in after}
        assert ids <= set(before) and ids
        if name != "mixing sources":
            assert len(after) == len(ids)
        before = {r.doc_id: r for r in after}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(before) and len(got) == len(after)
    some = next(r for r in got if r.n_tokens)
    assert bpe.decode_ids(bpe.np.array(some.ids), queries.vocabulary()) and len(some.ids) == some.n_tokens
    empty = corpus_pipeline.STAGES[0][1](spark, queries.table(spark, FOLDER, "documents").limit(0), FOLDER)
    for _, work in corpus_pipeline.STAGES[1:]:
        empty = work(spark, stage(empty, "test-empty"), FOLDER)
    assert empty.count() == 0


def test_batches_are_bounded_in_bytes(spark):
    """Documents reach the pipeline's Python tasks in batches of a few MB, however long they are."""
    def sizes(batches):
        for batch in batches:
            yield bpe.pa.RecordBatch.from_arrays([bpe.pa.array([batch.num_rows]), bpe.pa.array([batch.nbytes])],
                                                 names=["n", "size"])

    corpus_pipeline.prepare(spark)
    rows = spark.range(3000, numPartitions=1).selectExpr("id", "repeat('some text ', 2000) AS text")
    got = rows.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < 2 * queries.BATCH
