"""Bounded samples of labelled documents, and texts that belong to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo a number: the fold of a row."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: int, folds: int, per_class: int) -> DataFrame:
    """(doc_id, label, text) of at most ``per_class`` documents of each class outside the held-out fold.

    The documents with the smallest hashes of their ids are taken. An id that is
    labelled twice counts once, with its larger label; rows without an id or a label
    of 0 or 1 are no part of it. The sample's ids are broadcast: ``per_class`` bounds them.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").where(remainder("doc_id", folds) != fold)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("label = 0").orderBy(*order).limit(per_class).unionAll(known.where("label = 1").orderBy(*order).limit(per_class))
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text"))


def held_out(fold: int, folds: int):
    """Whether a row is in the held-out fold; a row without an id is not."""
    return F.coalesce(remainder("doc_id", folds) == fold, F.lit(False))
