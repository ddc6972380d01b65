"""Small helpers on the columns of caller's tables."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns of these names, whatever their case; results replace them."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def ids_and_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns that operators on documents read, under fixed names."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def batch_of(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def character_total(docs: DataFrame) -> int:
    """Bytes of text in all rows, to size sketches by."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
