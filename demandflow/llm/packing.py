"""Operator 9: packing token pieces into sequences by matching large pieces and best-fitting small ones.

The length of a piece is all that decides where it goes, and there are only
``capacity`` lengths. So the layout is computed from one histogram row per
length, in blocks of equal bins, and the pieces are then dealt to the slots of
the layout by their rank within their length. Neither step needs a sort of all
pieces or sees more than a chunk of them in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandflow.llm.common import text_of
from demandflow.session import materialize, ship_package

CAPACITY = 2048
END_ID = 0  # follows every document
END_OF_TEXT = "<|endoftext|>"  # one id in both files, also inside a text
BLOCK = 4096  # characters; tiktoken's pattern runs out of stack in white space of about a million

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
SLOTS = "length bigint, first_rank bigint, items bigint, per_bin bigint, first_bin bigint, place bigint"


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a text to its token ids; ``.tiktoken`` rank files and ``.json`` files are known.

    A rank file is for texts without long white space; the others go to the ``.json`` file beside it.
    """
    if path.endswith(".tiktoken"):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        coder = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)}
        )
        whole = path.removesuffix(".tiktoken") + ".json"

        def encode(text: str) -> list[int]:
            if has_long_space(text):
                return encoder(whole)(text)
            return coder.encode(text, allowed_special="all") if END_OF_TEXT in text else coder.encode_ordinary(text)

        return encode
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def has_long_space(text: str) -> bool:
    """A block of ``text`` is all white space, as one is in every run of 2 * BLOCK - 1 characters."""
    return len(text) >= BLOCK and any(text[i : i + BLOCK].isspace() for i in range(0, len(text), BLOCK))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, but for the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(start, capacity) for start in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document: its ids followed by ``END_ID``, cut only if longer than ``capacity``.

    A null text is empty and gives one piece of one id. ``tokenizer`` is the path of
    the vocabulary file, the same on all executors. Rows are independent: a repeated
    document is packed as often as it occurs.
    """
    ship_package(docs.sparkSession)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py())
                ids.append(END_ID)
                data = np.array(ids, dtype="<u4").tobytes()
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    out.append((doc_id, i, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    return texts.mapInArrow(tokenise, PIECES)


@dataclass
class Layout:
    """Bins in blocks of equal content, by free room; ``slots`` says where the items of a length go."""

    capacity: int
    slots: list[tuple] = field(default_factory=list)
    free: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # room -> (first bin, bins)
    rooms: list[int] = field(default_factory=list)  # sorted keys of ``free``
    bins: int = 0

    def add(self, room: int, first: int, count: int) -> None:
        if count and room:
            if room not in self.free:
                self.free[room] = []
                insort(self.rooms, room)
            self.free[room].append((first, count))

    def take(self, length: int, count: int) -> tuple[int, int, int]:
        """The tightest block that ``length`` fits in, else new bins for ``count`` items."""
        i = bisect_left(self.rooms, length)
        if i == len(self.rooms):
            per = self.capacity // length
            block = (self.capacity, self.bins, -(-count // per))
            self.bins += block[2]
            return block
        room = self.rooms[i]
        first, n = self.free[room].pop()
        if not self.free[room]:
            del self.free[room]
            del self.rooms[i]
        return room, first, n

    def place(self, length: int, count: int) -> None:
        """Best fit of ``count`` items of one length, whole blocks at a time."""
        rank = 0
        while rank < count:
            room, first, n = self.take(length, count - rank)
            per = min(room // length, count - rank)
            used = min(n, (count - rank) // per)
            self.slots.append((length, rank, used * per, per, first, self.capacity - room))
            rank += used * per
            self.add(room - per * length, first, used)
            self.add(room, first + used, n - used)


def layout(histogram: dict[int, int], capacity: int = CAPACITY) -> Layout:
    """Slots for ``histogram`` (length -> items).

    Items above a third of the capacity come first, at most two of them fit into a
    bin: those above a half open one bin each, then the others are matched greedily,
    the longest first, with the tightest partner that leaves room, and what finds no
    partner is paired among itself. The smaller items, the longest first, then best-fit the
    gaps. The work depends on the number of lengths, not of items.
    """
    plan = Layout(capacity)
    large = [n for n in sorted(histogram, reverse=True) if 3 * n > capacity]
    small = [n for n in sorted(histogram, reverse=True) if 3 * n <= capacity]
    for length in large + small:
        plan.place(length, histogram[length])
    return plan


def ranked(items: DataFrame, counts: DataFrame) -> DataFrame:
    """``items`` with their ``rank`` from 0 among those of equal length.

    A length's items are split by hash into as many chunks as the square root of their number,
    numbered within the chunk and moved by the sizes of the chunks before it, so that a length that
    most items have is no heavier for a task than others.
    """
    split = F.ceil(F.sqrt("n")).cast("bigint")
    keyed = items.join(F.broadcast(counts.select("length", split.alias("_chunks"))), "length").withColumn(
        "_chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("_chunks"))
    )
    before = Window.partitionBy("length").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("length", "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("length", "_chunk").orderBy("doc_id", "piece", "ids_crc32")
    numbered = keyed.withColumn("_row", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["length", "_chunk"]).select(
        *items.columns, (F.col("_row") + F.col("_offset")).alias("rank")
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of ``docs`` with its sequence and its place there.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset; the
    pieces of a sequence follow each other from 0 without gaps and are at most
    ``capacity`` long together. An empty table gives no rows; a null doc_id is kept
    and sorts first; equal rows take neighbouring places. Columns other than doc_id
    and text are not looked at.
    """
    spark = docs.sparkSession
    items = materialize(pieces(docs, tokenizer, capacity), "pieces")
    counts = materialize(items.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "piece_lengths")
    # At most ``capacity`` rows, whatever the size of the corpus.
    plan = layout({r["length"]: r["n"] for r in counts.collect()}, capacity)
    slots = spark.createDataFrame(plan.slots, SLOTS)
    at = F.col("rank") - F.col("first_rank")
    return (
        ranked(items, counts)
        .join(F.broadcast(slots), "length")
        .where((at >= 0) & (at < F.col("items")))
        .select(
            *["doc_id", "piece", "start", "length", "ids_crc32"],
            (F.col("first_bin") + F.floor(at / F.col("per_bin"))).cast("bigint").alias("sequence_id"),
            (F.col("place") + (at % F.col("per_bin")) * F.col("length")).cast("bigint").alias("offset"),
        )
    )
