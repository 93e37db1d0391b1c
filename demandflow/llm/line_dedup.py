"""Operator 11: lines that many documents share, by levelled sorted runs of line hashes.

A batch of documents becomes one run: its distinct line hashes with the number of
documents and the largest doc_id, sorted and bucketed by the hash. The runs of a level lie in one table, a file per run
and bucket; when a level has ``FAN`` runs they are merged, bucket by bucket, into one run of the next level. A
new batch is first merge-anti-joined with the runs: a hash that they already
settle, found often enough and in a larger doc_id, is not added again. Runs and batches share their buckets, so the
runs are never shuffled; a hot line is one row a run.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.llm.common import text_of
from demandflow.session import materialize, new_dir, ship_package, sized

SHORTEST = 40  # code points of a line that may be dropped
DOCUMENTS = 5  # that hold a dropped line, at least
FAN = 3  # runs of a level that are merged into one of the next
BATCHES = 6  # ranges of doc_id that a whole table is taken in
SPACE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes that begin no code point
KEY = ["h", "g"]  # the two halves of a line's 128-bit hash
RUN = "h bigint, g bigint, n bigint, top bigint"


def digests(text: bytes, shortest: int) -> Iterator[bytes | None]:
    """The hash of the key of every line, None for keys under ``shortest`` code points."""
    for line in text.split(b"\n"):
        key = line.strip(SPACE)
        long = len(key) >= shortest and (key.isascii() or len(key.translate(None, CONTINUATION)) >= shortest)
        yield xxhash.xxh3_128_digest(key.lower()) if long else None


def line_hashes(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, h and g of the distinct long lines of every row of ``docs``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = [], []
            for i, text in enumerate(batch.column(1)):
                of_row = {d for d in digests(text.as_buffer().to_pybytes(), shortest) if d is not None}
                places.extend([i] * len(of_row))
                found.extend(of_row)
            halves = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            rows = batch.column(0).take(pa.array(places, pa.int32()))
            yield pa.RecordBatch.from_arrays([rows, pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["doc_id", *KEY])

    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    return texts.mapInArrow(hashed, "doc_id bigint, h bigint, g bigint")


class LineRuns:
    """An index of line hashes that grows batch by batch, as tables of sorted runs below the scratch folder.

    ``add`` may be given batches in any order; batches of falling doc_id add the least. ``totals`` has the number of rows
    and the largest doc_id of every hash found in ``documents`` rows or more: exact for those, since only
    hashes that are settled already are left out of a run.
    """

    def __init__(self, spark: SparkSession, documents: int = DOCUMENTS, fan: int = FAN) -> None:
        self.spark, self.documents, self.fan = spark, documents, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.database = f"line_runs_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{new_dir(spark, 'line_runs')}'")
        self.runs: list[int] = []  # runs of every level

    def table(self, level: int) -> str:
        return f"{self.database}.level_{level}"

    def write(self, run: DataFrame, level: int) -> None:
        """``run`` as one more run of ``level``; a full level is merged upwards."""
        if level == len(self.runs):
            self.runs.append(0)
        bucketed = run.select(*KEY, "n", "top").write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        bucketed.mode("append").saveAsTable(self.table(level))
        self.runs[level] += 1
        if self.runs[level] == self.fan:
            self.write(merged(self.spark.table(self.table(level))), level + 1)
            self.spark.sql(f"DROP TABLE {self.table(level)}")
            self.runs[level] = 0

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``line_hashes``."""
        run = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top"))
        for level, number in enumerate(self.runs):
            if number:
                settled = self.spark.table(self.table(level)).where(F.col("n") >= self.documents)
                settled = settled.select(*[F.col(k).alias(f"run_{k}") for k in KEY], F.col("top").alias("run_top"))
                known = (F.col("h") == F.col("run_h")) & (F.col("g") == F.col("run_g"))
                # Without a doc_id in the batch, or in both, nothing changes either.
                no_larger = F.col("top").isNull() | (F.col("top") <= F.col("run_top"))
                run = run.join(settled.hint("merge"), known & no_larger, "left_anti")
        self.write(run, 0)

    def totals(self) -> DataFrame:
        """h, g, n and top of the hashes of ``documents`` rows or more; the runs are given up."""
        levels = [self.spark.table(self.table(k)) for k, number in enumerate(self.runs) if number]
        every = self.spark.createDataFrame([], RUN)
        for level in levels:
            every = every.unionByName(level)
        found = materialize(merged(every).where(F.col("n") >= self.documents), "shared_lines")
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")
        return found


def merged(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("top").alias("top"))


def batch_number(lines: DataFrame, batches: int) -> DataFrame:
    """``lines`` with ``batch``: ranges of about equal size of doc_id, the largest first; a missing doc_id is in the last."""
    shares = [1 - k / batches for k in range(1, batches)]
    bounds = lines.approxQuantile("doc_id", shares, 0.01) if shares else []
    number = F.lit(0)
    for bound in bounds:
        number = number + (F.col("doc_id").isNull() | (F.col("doc_id") < bound)).cast("int")
    return lines.withColumn("batch", number)


def shared_lines(docs: DataFrame, shortest: int, documents: int, batches: int) -> tuple[DataFrame, DataFrame]:
    """The written ``line_hashes`` of ``docs``, and h, g, n and top of those in ``documents`` rows or more."""
    spark = docs.sparkSession
    path = new_dir(spark, "line_hashes")
    lines = materialize(line_hashes(docs, shortest), "line_hashes", "uncompressed")
    batch_number(lines, batches).write.partitionBy("batch").option("compression", "uncompressed").parquet(path)
    stored = spark.read.schema("doc_id bigint, h bigint, g bigint, batch int").parquet(path)
    index = LineRuns(spark, documents)
    for k in range(batches):
        index.add(stored.where(F.col("batch") == k))
    return lines, index.totals()


def without_shared_lines(
    docs: DataFrame, shortest: int = SHORTEST, documents: int = DOCUMENTS, batches: int = BATCHES
) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped and text (the lines that stay) of every row of ``docs``.

    A line's key is the line without white space at its ends, A-Z in small letters. Lines with a
    key of ``shortest`` code points or more that ``documents`` rows or more hold are dropped
    everywhere but in the largest doc_id that holds it; repeated lines of one row count once.
    Every row is a document: rows with the same doc_id count one by one, and each
    of them that has the largest doc_id keeps its lines. A missing doc_id is smaller than all others. Null and empty texts
    are one empty line. An empty table gives no rows; columns other than doc_id and text are not looked at.
    """
    ship_package(docs.sparkSession)
    lines, shared = shared_lines(docs, shortest, documents, batches)
    found = lines.join(sized(shared.select(*KEY, "top")), KEY)
    smaller = F.col("doc_id").isNull() & F.col("top").isNotNull() | (F.col("doc_id") < F.col("top"))
    hits = materialize(found.where(smaller).select("doc_id", *KEY), "dropped_lines", "uncompressed")
    dropped = hits.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("gone"))
    dropped = sized(dropped.withColumnRenamed("doc_id", "dropped_id"), bound=hits)
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    met = texts.join(dropped, F.col("doc_id").eqNullSafe(F.col("dropped_id")), "left").select("doc_id", "text", "gone")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, less, kept = [], [], []
            for text, gone in zip(batch.column(1), batch.column(2), strict=True):
                data = text.as_buffer().to_pybytes()
                total.append(data.count(b"\n") + 1)
                if gone.is_valid:
                    h, g = gone.values.flatten()
                    halves = np.stack([h.to_numpy(), g.to_numpy()], axis=1).astype("<i8").tobytes()
                    out = {halves[i : i + 16] for i in range(0, len(halves), 16)}
                    rest = [line for line, d in zip(data.split(b"\n"), digests(data, shortest), strict=True) if d not in out]
                    less.append(total[-1] - len(rest))
                    data = b"\n".join(rest)
                else:
                    less.append(0)
                kept.append(data)
            counts = [pa.array(total, pa.int64()), pa.array(less, pa.int64())]
            texts = pa.array(kept, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, texts], ["doc_id", "n_lines", "n_dropped", "text"])

    return met.mapInArrow(keep, "doc_id bigint, n_lines bigint, n_dropped bigint, text string")
