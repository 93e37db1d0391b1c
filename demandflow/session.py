"""Session helpers: shared scratch folder, materialised tables, size-checked joins."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A dimension with more rows than this is never broadcast.
BROADCAST_ROWS = 500_000

# Rows of one task where rows are spread by their number.
TASK_ROWS = 250_000

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()  # applications whose executors have the package


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own; on a
    cluster an unset folder is an error, because a machine-local path would not
    be visible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="demandflow-")
    return _local_scratch[app]


def new_dir(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that was never used before."""
    return f"{scratch_root(spark)}/demandflow/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``, once per application.

    Python functions are pickled by module reference; without this a job fails on
    every executor that does not happen to have the source folder on its path.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="demandflow-package-")
    archive = shutil.make_archive(
        os.path.join(folder, "demandflow-src"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table and continue from the written table.

    Cuts lineage in a way that survives lost executors, computes the frame once
    however often it is read, and gives the optimizer its true size. Hashes do not
    compress; ``uncompressed`` saves their readers the buffers outside the heap.
    """
    spark = df.sparkSession
    path = new_dir(spark, name)
    (df.write if compression is None else df.write.option("compression", compression)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side[T, R](fn: Callable[[T], R], items: Iterable[T], threads: int = 4) -> list[R]:
    """``fn`` of each item, in order; the Spark jobs of a few items run at the same time."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(fn, items))


def materialize_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``materialize`` several independent frames, their jobs running side by side."""
    return dict(side_by_side(lambda name: (name, materialize(frames[name], name)), frames))


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (footer-only on a Parquet scan)."""
    return df.count() <= max_rows


def sized(df: DataFrame, max_rows: int = BROADCAST_ROWS, bound: DataFrame | None = None) -> DataFrame:
    """``df`` marked for broadcast when its counted size allows, unmarked otherwise.

    ``bound`` is a frame with at least as many rows that is cheaper to count, such
    as the table a derived dimension has one row each of. An unmarked side leaves a
    shuffle join whose hot keys the adaptive planner splits
    (``spark.sql.adaptive.skewJoin``).
    """
    return F.broadcast(df) if is_small(df if bound is None else bound, max_rows) else df


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of at most ``rows`` rows, shuffled by ``keys`` into tasks of about ``TASK_ROWS`` rows each.

    What a task holds then does not grow with the table, whatever the session's number of partitions and however well
    the rows compress. For keys that are nearly unique or of bounded groups; rows of few hot keys are better summed up first.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = max(-(-rows // TASK_ROWS), min(cores, -(-rows // (TASK_ROWS // 25))), 1)
    return df.repartition(wanted, *keys)


def dimension_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of a fact with a dimension, broadcasting only a dimension of checked size."""
    keys = [on] if isinstance(on, str) else list(on)
    return fact.join(sized(dim, max_rows, bound), keys, how)
