"""Tables written once to the folder that all executors share.

A staged table cuts lineage: a lost executor costs the tasks it was running and
nothing that is already written.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, list[str]] = {}
_ENTRIES: dict[str, str] = {}  # the catalog entries of bucketed tables, by path


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may make its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _OWN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    result = df.sparkSession.read.schema(df.schema).parquet(path)
    result.staged_at = path
    return result


def bucketed(df: DataFrame, name: str, by: str) -> DataFrame:
    """Stage ``df`` in buckets by a column, as a shuffle on it would place rows: joins on it move the other side only."""
    spark = df.sparkSession
    path, entry = new_path(spark, name), f"llm_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(buckets, by).write.format("parquet").option("path", path)
    placed.bucketBy(buckets, by).sortBy(by).saveAsTable(entry)
    _ENTRIES[path] = entry
    result = spark.table(entry)
    result.staged_at = path
    return result


def _delete(spark: SparkSession, path: str) -> None:
    if path in _ENTRIES:
        spark.sql(f"drop table if exists {_ENTRIES.pop(path)}")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df.staged_at)
        _OWN[df.sparkSession.sparkContext.applicationId].remove(df.staged_at)


def staged_alone(make: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """Stage what ``make`` returns and delete the tables that it staged on its way."""
    own = _OWN.setdefault(spark.sparkContext.applicationId, [])
    before = set(own)
    result = staged(make(), name)
    for path in [p for p in own if p not in before and p != result.staged_at]:
        _delete(spark, path)
        own.remove(path)
    return result


def forget(spark: SparkSession) -> None:
    """Delete every staged table of this application; results that read them must be written first."""
    for path in _OWN.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)
