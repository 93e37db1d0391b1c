"""Operator 4: exact duplicates by a streaming aggregation with disk-backed state.

The documents are written once as a content store. A stream over its digests
keeps, per digest and without expiry, the smallest identifier, the locator of that
row in the store and the number of rows; the state lies in RocksDB, its log and
progress below the checkpoint folder, so a lost executor or a restart continues from the last
committed batch. Rows whose digest was met more than once are then compared by
their full text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.llm.common import SPACE, file_place, text_of, whole_row
from demandflow.session import materialize, new_dir

BATCH_BYTES = 1 << 38  # of the content store in one micro-batch
BROADCAST_DIGESTS = 200_000  # 64 characters each; more are joined by a shuffle

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Every partition's store would otherwise reserve some MB for its log files.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normal(text: Column) -> Column:
    """The text with each run of white space as one space; equal texts are equal in this form."""
    return F.regexp_replace(text, SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@dataclass(frozen=True)
class Store:
    """``rows``: ``row`` (all columns), ``doc_id``, ``locator`` and ``digest``; the table at ``path`` has its keys at least."""

    path: str
    rows: DataFrame
    keys: DataFrame


def store(docs: DataFrame, digest: Callable[[Column], Column], written: bool = False) -> Store:
    """Write ``docs`` with the digest of each normal text; if it is ``written`` already, only identifiers and digests.

    The locator is the number of the written part and the position in it, of a written table the file and
    row number, so it is unique, also between equal rows, and the same in every later read.
    """
    spark = docs.sparkSession
    place = file_place(docs) if written else None
    rows = docs.select(
        whole_row(docs).alias("row"),
        docs["doc_id"].cast("bigint").alias("doc_id"),
        (F.monotonically_increasing_id() if place is None else place).alias("locator"),
        digest(normal(text_of(docs))).alias("digest"),
    )
    path = new_dir(spark, "content_store")
    stored = rows if place is None else rows.drop("row")
    stored.write.parquet(path)
    again = spark.read.schema(stored.schema).parquet(path)
    return Store(path, again if place is None else rows, again.select("doc_id", "locator", "digest"))


def first_of(prefix: str = "") -> Column:
    """Ordering key of a row among equal texts: the smallest doc_id, a missing one last, then the place."""
    doc_id, locator = F.col(f"{prefix}doc_id"), F.col(f"{prefix}locator")
    return F.struct(doc_id.isNull().alias("unknown"), doc_id.alias("doc_id"), locator.alias("locator"))


def digest_state(content: Store, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """digest, first (identifier and locator) and n of every digest, from the stream's state.

    Each micro-batch writes the entries that it changed into a folder of its own number, so a repeated batch
    replaces itself; the entry with the largest count is the current one.
    """
    spark = content.rows.sparkSession
    keys = content.keys.schema
    root = new_dir(spark, "digest_state")
    stream = (
        spark.readStream.schema(keys)
        .option("maxBytesPerTrigger", batch_bytes)
        .parquet(content.path)
        .groupBy("digest")
        .agg(F.min(first_of()).alias("first"), F.count(F.lit(1)).alias("n"))
    )

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/changes/batch={batch}")

    kept = {k: spark.conf.get(k, None) for k in ROCKSDB}
    try:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
        (
            stream.writeStream.outputMode("update")
            .option("checkpointLocation", f"{root}/progress")
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
            .awaitTermination()
        )
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # An empty table gives no batch and so no folder: the placeholder batch keeps it readable.
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{root}/changes/batch=-1")
    changes = spark.read.schema(stream.schema).parquet(f"{root}/changes/batch=*")
    newest = F.max(F.struct("n", "first")).alias("s")
    return materialize(changes.groupBy("digest").agg(newest).select("digest", "s.first", "s.n"), "digest_classes")


def collisions(content: Store, state: DataFrame, broadcast_digests: int) -> DataFrame:
    """Digests that stand for more than one text, from the full texts of all rows with a repeated digest.

    Equal texts meet before the shuffle, so a text that most rows share is compared once per task.
    """
    repeated = state.where("n > 1").select("digest")
    small = repeated.count() <= broadcast_digests
    texts = content.rows.select("digest", normal(text_of(content.rows, "row.text")).alias("text"))
    if small:
        texts = texts.join(F.broadcast(repeated), "digest", "left_semi")
    texts = texts.distinct()
    if not small:
        texts = texts.join(repeated, "digest", "left_semi")
    several = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    return materialize(several.select("digest"), "digest_collisions")


def classified(content: Store, batch_bytes: int = BATCH_BYTES, broadcast_digests: int = BROADCAST_DIGESTS) -> DataFrame:
    """locator, doc_id, digest, keep_id, group_size and kept of every stored row."""
    state = digest_state(content, batch_bytes)
    mixed = collisions(content, state, broadcast_digests)
    classes = state.select("digest", "first", F.col("n").alias("group_size"))
    if mixed.isEmpty():
        rows = content.keys.join(classes, "digest")
    else:
        texts = content.rows.join(mixed, "digest").select(
            "doc_id", "locator", "digest", normal(text_of(content.rows, "row.text")).alias("text")
        )
        by_text = texts.groupBy("digest", "text").agg(
            F.min(first_of()).alias("first"), F.count(F.lit(1)).alias("group_size")
        )
        apart = texts.join(by_text, ["digest", "text"]).drop("text")
        rows = content.keys.join(classes.join(mixed, "digest", "left_anti"), "digest").unionByName(apart)
    return rows.select(
        *["locator", "doc_id", "digest", "group_size"],
        F.col("first.doc_id").alias("keep_id"),
        (F.col("locator") == F.col("first.locator")).alias("kept"),
    )


def duplicates(
    docs: DataFrame,
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = BATCH_BYTES,
    broadcast_digests: int = BROADCAST_DIGESTS,
) -> DataFrame:
    """Every row of ``docs`` with its class of equal texts.

    Returns locator, doc_id, digest, keep_id (doc_id of the row that stays),
    group_size and kept. Null and empty texts are equal. Of rows with equal text and
    doc_id the first in the store stays; a row without doc_id stays only if all of its
    class are without. An empty table gives no rows; other columns are not looked
    at. ``digest`` may be any function of the normal text: texts that share a digest
    but differ are told apart by the full comparison.
    """
    return classified(store(docs.select("doc_id", "text"), digest), batch_bytes, broadcast_digests)


def without_duplicates(docs: DataFrame, written: bool = False) -> DataFrame:
    """``docs`` with one row of each class of equal texts, in its own columns.

    Rows are looked up by locator, which is unique, so a text with many copies loads no single task. With
    ``written``, ``docs`` is one Parquet table as read, and its rows are not copied.
    """
    content = store(docs, sha256, written)
    kept = classified(content).where("kept").select("locator")
    return content.rows.join(kept, "locator", "left_semi").select("row.*")
