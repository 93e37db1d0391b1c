"""Session settings for large runs.

The package itself sets nothing on a session it is given; these are the values it
is written for. ``builder.config(map=cluster_settings(...))`` applies them.
"""

from __future__ import annotations

MB = 1 << 20
PARTITION_BYTES = 200 * MB  # fits several times into the memory of one executor core
MAX_SHUFFLE_PARTITIONS = 50_000  # beyond this the map-output bookkeeping outweighs smaller partitions


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions of the largest shuffle: about 200 MB each, never fewer than the cores."""
    wanted = -(-shuffled_bytes // PARTITION_BYTES)
    return max(cores, min(wanted, MAX_SHUFFLE_PARTITIONS))


def cluster_settings(shared_folder: str, shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves about ``shuffled_bytes``.

    Shuffles start with that many partitions; the adaptive planner joins small
    ones and splits hot ones, in joins as well as in rebalanced writes.
    """
    partitions = str(shuffle_partitions(shuffled_bytes, cores))
    return {
        "spark.checkpoint.dir": shared_folder,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * PARTITION_BYTES),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }
