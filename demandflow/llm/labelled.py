"""Bounded samples of labelled documents, shared by the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import text_of
from demandflow.session import materialize


def fold(doc_id: Column, folds: int) -> Column:
    """Number of the fold of a document, from the checksum of its id as text; a missing id is in fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(-1))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int
) -> DataFrame:
    """doc_id, text and label of up to ``per_class`` documents of each label outside the fold ``held_out``.

    They are those with the smallest hash of their id. Missing labels are left out;
    a document that is labelled several times has its largest label; of several texts
    with one doc_id the first in order is taken.
    """
    known = (
        labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("int").alias("label"))
        .dropna()
        .where(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    order = F.xxhash64("doc_id", F.lit(per_class)), "doc_id"
    parts = [known.where(F.col("label") == value).orderBy(*order).limit(per_class) for value in (0, 1)]
    chosen = materialize(parts[0].unionByName(parts[1]), "label_sample")  # at most 2 * per_class rows
    texts = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return materialize(found, "labelled_texts")
