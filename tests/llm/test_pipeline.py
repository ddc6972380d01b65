"""The pipeline's stages on documents, and on odd ones."""

import brute
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from shelfwise.llm.staging import forget

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, small)
        assert docs.columns == COLUMNS
        after = {r.doc_id: r for r in docs.collect()}
        assert after.keys() <= before.keys()
        assert all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id].text)
        rows = [(i, r.text) for i, r in before.items()]
        if name == "near_duplicates":
            assert after.keys() == {i for i, (_, first) in brute.jaccard_components(rows).items() if i == first}
        if name == "substring_dedup":
            want = {i: n - gone for i, n, gone, _ in brute.repeated_windows(rows)}
            assert {i: len(brute.words(r.text)) for i, r in after.items()} == want
        docs = spark.createDataFrame(list(after.values()), docs.schema)
        texts = {i: r.text for i, r in after.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small).toPandas()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = packed.groupby("doc_id").length.sum().to_dict()
    assert lengths == {i: len(brute.token_ids(whole, t, 1)) for i, t in texts.items()}
    forget(spark)


def test_run_and_odd_rows(spark, small, docs, odd_rows):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "decontamination", "packing"]
    assert corpus_pipeline.run(spark, small).count() > 0
    for rows in (odd_rows, []):
        table = docs(rows)
        for _, stage in corpus_pipeline.STAGES:
            table = stage(spark, table, small)
        assert (table.count() > 0) == bool(rows)
    forget(spark)


@pytest.mark.parametrize("stage", ["near_duplicates", "substring_dedup", "packing"])
def test_workers_get_small_batches(spark, small, docs, odd_rows, stage):
    name, stages = "spark.sql.execution.arrow.maxRecordsPerBatch", dict(corpus_pipeline.STAGES)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    def largest():
        stages[stage](spark, docs(odd_rows), small)
        return max(r.n for r in spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long").collect())

    spark.conf.unset(name)
    try:
        assert largest() <= corpus_pipeline.ARROW_ROWS
        spark.conf.set(name, "100")
        assert largest() == 100
    finally:
        spark.conf.unset(name)
        forget(spark)
