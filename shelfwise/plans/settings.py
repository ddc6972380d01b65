"""Session settings for a job, from the bytes its widest shuffle moves."""

from __future__ import annotations

import math

MIB = 1024 * 1024


def session_settings(
    shuffle_bytes: int, cores: int, partition_bytes: int = 128 * MIB, max_partitions: int = 40_000
) -> dict[str, str]:
    """Settings that keep a task's share of the shuffle near ``partition_bytes``.

    Past ``max_partitions`` the shares grow instead, and scans take larger splits
    with them: a shuffle has map tasks times reduce tasks blocks, and that product,
    not the size of a share that can spill, is what very large inputs run into.
    Adaptive execution merges what turns out smaller and splits skewed joins. The
    record limit bounds an Arrow batch of whole series in the parameter search.
    """
    partitions = max(cores, min(math.ceil(shuffle_bytes / partition_bytes), max_partitions))
    share = max(partition_bytes, math.ceil(shuffle_bytes / partitions))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(share),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(min(share, 1024 * MIB)),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    }
