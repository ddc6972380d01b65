"""From raw documents to training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one
before it kept. All but the last return the columns of documents.

1. ``toxicity``: documents that the kernel machine rejects go.
2. ``near_duplicates``: of documents linked by shingle similarity the first stays.
3. ``substring_dedup``: windows of words that occur earlier are cut out.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``packing``: what is left becomes sequences of token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import packing as bins
from shelfwise.llm.decontamination import without_contaminated
from shelfwise.llm.jaccard_join import without_similar
from shelfwise.llm.shipping import ship
from shelfwise.llm.staging import discard, staged
from shelfwise.llm.substring_dedup import remove_repeated_windows
from shelfwise.llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Training sequences are not expressible in SQL: a fitted model, tokenizers and bin packing.
ORACLE_SQL = None


#: Rows that a Python worker gets at once, at most: a stage's texts lie in the executor's direct memory and in the worker.
ARROW_ROWS = 1024


def _ready(spark: SparkSession) -> None:
    """Send the package to the executors, and rows to their workers in small batches; a smaller setting stays."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return without_similar(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    cut = remove_repeated_windows(docs)
    changed = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return changed.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return bins.pack_documents(docs, public_tokenizers.path(bins.TOKENIZER), added_tokens=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written before the next reads it."""
    docs = _table(spark, sf_dir, "documents")
    kept = None
    for name, stage in STAGES[:-1]:
        after = staged(stage(spark, docs, sf_dir), name)
        if kept is not None:
            discard(kept)
        docs = kept = after
    return STAGES[-1][1](spark, docs, sf_dir)
