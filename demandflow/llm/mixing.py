"""Operator 1: a mix of sources with target weights, drawn by weighted sampling without replacement.

Each document gets an exponential key, its uniform hash number scaled by its
quality weight, so that taking the smallest keys of a source is a sample with those weights. Whole epochs of a source come
first; what is left of its target is filled by the smallest keys, up to the prefix of their
running size that comes nearest. The end of the prefix is found in a histogram
of the keys, a part of it in a finer one, and so on, and only then among rows, so no
task ever sorts a source. What comes out is one cut per source, and documents
are compared with it where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.llm.common import WORD, join_null_safe, text_of, whole_row
from demandflow.session import materialize, sized

SEED = 20_240_601
WEIGHTS = (3.0, 1.0, 2.0)  # of the sources in order, repeating
SHARE = 1.5  # of all sizes
REPEATS = 2  # times that a source can be taken at most
FAN_BITS, LEVELS = 8, 4  # of a histogram's parts, and histograms: 2 ** 32 parts per source


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """Between 0.1 and 1: less for texts with many symbols."""
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.1), 1 - 8 * symbols)


def position(weight: Column, *identity: Column) -> Column:
    """The exponential key of a row, k = -ln(u) / weight, brought into [0, 1) in its own order as k / (1 + k).

    At weights from 0.1 to 1 no place of [0, 1) has more than six times its share of the rows.
    """
    u = (F.pmod(F.xxhash64(F.lit(SEED), *identity), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    key = -F.log(u) / weight
    return key / (1 + key)


def measured(docs: DataFrame, *keep: Column, weight: Column | None = None) -> DataFrame:
    """``keep``, source, size, key position and histogram part of each row."""
    text = text_of(docs)
    p = position(quality_weight(text) if weight is None else weight, docs["doc_id"], text)
    sized_rows = docs.select(*keep, docs["source"].alias("source"), size_of(text).alias("size"), p.alias("p"))
    return sized_rows.withColumn("part", F.floor(F.col("p") * (1 << FAN_BITS * LEVELS)))


def targets(rows: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """source, source_size and target.

    The sources, in order of code points and null last, take ``weights`` in turn. What a source is due beyond
    ``repeats`` times its size goes to the others by weight; a round ends that when it caps no further source. A round
    reads back two sums.
    """
    ordered = (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .orderBy(F.col("source").asc_nulls_last())
        .withColumn("_id", F.monotonically_increasing_id())
    )
    # The upper bits of the id are the sorted part, the lower 33 bits the place in it.
    sources = materialize(
        ordered.select(
            "source",
            "source_size",
            F.shiftright("_id", 33).alias("chunk"),
            F.col("_id").bitwiseAND((1 << 33) - 1).alias("place"),
        ),
        "mix_sources",
    )
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per sorted part
    offsets = (
        sources.groupBy("chunk")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    rank = F.col("place") + F.col("offset")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighted = materialize(
        sources.join(F.broadcast(offsets), "chunk").select(
            "source",
            "source_size",
            F.get(cycle, (rank % len(weights)).cast("int")).alias("weight"),
            (F.col("source_size") * repeats).cast("double").alias("most"),
        ),
        "mix_weights",
    )
    total, open_weight = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    due, capped, rate = share * (total or 0), 0.0, 0.0
    while open_weight:
        rate = max(0.0, (due - capped) / open_weight)
        full = F.col("most") <= F.lit(rate) * F.col("weight")
        left = weighted.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, F.col("most")))).first()
        if (left[0] or 0.0) == open_weight:
            break
        open_weight, capped = left[0] or 0.0, left[1] or 0.0
    return weighted.select(
        "source", "source_size", F.least("most", F.lit(rate) * F.col("weight")).alias("target")
    )


def first_part(rows: DataFrame, begun: DataFrame, part: Column, group: list[str]) -> DataFrame:
    """Of each source the first part whose running size reaches ``rest``, with the size ``before`` it.

    A source has at most 2 ** ``FAN_BITS`` parts here, summed up before the shuffle.
    """
    parts = rows.groupBy("source", *group, part.alias("_part")).agg(F.sum("size").alias("_size"))
    joined = join_null_safe(parts, sized(begun), "source", *group)
    running = Window.partitionBy("source").orderBy("_part")
    reached = joined.withColumn("_end", F.col("before") + F.sum("_size").over(running)).where("_end >= rest")
    found = reached.groupBy("source").agg(F.min_by(F.struct("rest", "_part", "_end", "_size"), "_part").alias("f"))
    return found.select(
        "source", "f.rest", F.col("f._part").alias("part"), (F.col("f._end") - F.col("f._size")).alias("before")
    )


def cuts(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """One row per source: source_size, target, whole ``epochs``, and ``cut_part`` and ``cut_p``, where its sample ends.

    ``rows`` are those of ``measured``, written.
    """
    goal = materialize(targets(rows, weights, share, repeats), "mix_targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    due = goal.withColumn("epochs", epochs.cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    )
    inside = due.where("rest > 0").select("source", "rest", F.lit(0).cast("bigint").alias("before"))
    for level in range(LEVELS):
        group = ["above"] if level else []
        bits = FAN_BITS * (LEVELS - level - 1)
        parted = rows.withColumn("above", F.shiftright("part", bits + FAN_BITS))
        found = materialize(first_part(parted, inside, F.shiftright("part", bits), group), f"mix_level_{level}")
        inside = found.withColumnRenamed("part", "above")
    # Some rows in 2 ** 32 of a source are left to be sorted; equal keys are repeated rows and go together.
    ends = rows.groupBy("source", "part", "p").agg(F.sum("size").alias("_size"))
    last = join_null_safe(ends, sized(found), "source", "part")
    end = F.col("before") + F.sum("_size").over(Window.partitionBy("source").orderBy("p"))
    none = found.select("source", "part", F.lit(-1.0).alias("p"), F.abs(F.col("before") - F.col("rest")).alias("off"))
    candidates = last.select("source", "part", "p", F.abs(end - F.col("rest")).alias("off")).unionByName(none)
    nearest = candidates.groupBy("source").agg(F.min(F.struct("off", "p", "part")).alias("c"))
    return materialize(
        join_null_safe(due, nearest, "source", how="left").select(
            "source",
            "source_size",
            "target",
            "epochs",
            F.coalesce("c.part", F.lit(-1)).alias("cut_part"),
            F.coalesce("c.p", F.lit(-1.0)).alias("cut_p"),
        ),
        "mix_cuts",
    )


def with_copies(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """``rows`` of ``measured`` with the columns of their source and the ``copies`` that the mix takes."""
    chosen = (F.col("part") < F.col("cut_part")) | (
        (F.col("part") == F.col("cut_part")) & (F.col("p") <= F.col("cut_p"))
    )
    return join_null_safe(rows, sized(per_source), "source").select(
        *rows.columns,
        *["source_size", "target"],
        (F.col("epochs") + chosen.cast("bigint")).alias("copies"),
    )


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """What a mix of ``share`` times all words takes of each document.

    Returns doc_id, source, size, source_size, target, copies and taken. A null text has size 0 and is
    taken without words; rows without source form a source of their own; rows with equal doc_id and text
    are taken together; an empty table gives no rows. Keys are hashes, so reruns agree.
    """
    rows = materialize(measured(docs, docs["doc_id"].alias("doc_id")), "mix_rows")
    out = with_copies(rows, cuts(rows, weights, share, repeats))
    return out.select(
        *["doc_id", "source", "size", "source_size", "target", "copies"],
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, in its own columns; texts are not shuffled."""
    rows = materialize(measured(docs), "mix_rows")
    per_source = cuts(rows, weights, share, repeats)
    taken = with_copies(measured(docs, whole_row(docs).alias("row")), per_source).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
