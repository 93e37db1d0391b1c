"""Operator 12: spelling variants, by k-d trees over letter-count vectors.

One inserted, deleted or replaced letter moves a word's vector of letter counts by an L1 distance of at most two: an
inserted one raises one count, a replaced one raises one and lowers another. Words of each length
are cut into cells by a k-d tree, fitted on a bounded sample. Every word is sent to the cells, of its own length and of
the next, whose box it can reach with so many raised and lowered counts; a cell searches its words
with a k-d tree of its own, compares vectors in the leaves that are left, and verifies the order of the letters. A cell
returns one row per word, its near words summed up.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import text_of
from demandflow.session import materialize, ship_package, sized

SHORTEST = 7  # code points of a word
LEAST = 2  # occurrences of a word
RATIO = 10  # times as often as a word, its form occurs
SAMPLE = 200_000  # words that the cells are fitted on
CELL = 4_000  # words of a cell, by the sample; cells of more than twice as many are searched in parts
LEAF = 48  # vectors of a leaf of a cell's tree
PAIR_BYTES = 1 << 24  # of the words verified at once
FLUSH = 1 << 18  # words counted before a task hands them on
DIMENSIONS = 32  # a to z, and the letters above in six
OTHERS = DIMENSIONS - 26

FOUND = "word string, n_near bigint, near_n bigint, near string"


def byte_table() -> bytes:
    """Latin-1 bytes to small letters of a word, A-Z alone being made small, and to spaces."""
    table = bytearray(b" " * 256)
    for c in range(ord("a"), ord("z") + 1):
        table[c] = table[c - 32] = c
    table[0xC0:] = range(0xC0, 0x100)
    return bytes(table)


TABLE = byte_table()


def runs_of(doc_id: int | None, text: str) -> Counter:
    """The words of a text with their occurrences, as Latin-1 bytes.

    The checksum of document and run decides which runs lose a letter.
    """
    runs = Counter(w for w in text.encode("latin-1", "replace").translate(TABLE).split() if len(w) >= SHORTEST)
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    words: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % 31 == 0:
            place = h % len(run)
            run = run[:place] + run[place + 1 :]
            if len(run) < SHORTEST:
                continue
        words[run] += n
    return words


def counted_words(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """word, size and n of the words found ``least`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.update(runs_of(doc_id, text.as_buffer().to_pybytes().decode("utf-8", "replace")))
                if len(held) >= FLUSH:
                    yield out()
                    held.clear()
        yield out()

    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    counts = texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least).select("word", F.length("word").alias("size"), "n")


def letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words as rows of bytes, padded with zeros, and their letter counts."""
    width = max(map(len, words), default=0)
    codes = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(len(words), width)
    dimension = np.full(256, DIMENSIONS, dtype=np.int64)
    dimension[ord("a") : ord("z") + 1] = np.arange(26)
    dimension[0xC0:] = 26 + np.arange(0x40) % OTHERS
    at = dimension[codes] + (DIMENSIONS + 1) * np.arange(len(words))[:, None]
    counts = np.bincount(at.ravel(), minlength=(DIMENSIONS + 1) * len(words)).reshape(len(words), DIMENSIONS + 1)
    # Large counts are held at 255, which brings no two words further apart.
    return codes, np.minimum(counts[:, :DIMENSIONS], 255).astype(np.uint8)


@dataclass
class Node:
    """A part of the space: ``cell``, or two parts, the first with at most ``limit`` in ``dimension``."""

    cell: int = -1
    dimension: int = 0
    limit: int = 0
    parts: list[Node] = field(default_factory=list)


def best_cut(vectors: np.ndarray) -> tuple[int, int] | None:
    """The dimension and limit that halve the vectors best, None if all are equal."""
    best, found = 0, None
    for d in np.flatnonzero(vectors.min(axis=0) != vectors.max(axis=0)):
        below = np.cumsum(np.bincount(vectors[:, d]))
        smaller = np.minimum(below, len(vectors) - below)
        limit = int(smaller.argmax())
        if smaller[limit] > best:
            best, found = int(smaller[limit]), (int(d), limit)
    return found


def grown(vectors: np.ndarray, weight: float, cells: Iterator[int]) -> Node:
    """A tree whose cells hold about ``CELL`` words, each vector standing for ``weight`` of them."""
    cut = best_cut(vectors) if len(vectors) * weight > CELL else None
    if cut is None:
        return Node(cell=next(cells))
    below = vectors[:, cut[0]] <= cut[1]
    return Node(-1, *cut, [grown(vectors[below], weight, cells), grown(vectors[~below], weight, cells)])


def reached(node: Node, vectors: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, rows) of the vectors that reach a cell by raising ``up`` and lowering ``down`` counts at most.

    Boxes are the half spaces on the way to a cell, so they hold every vector that there may be.
    """

    def visit(node: Node, rows: np.ndarray, raised: np.ndarray, lowered: np.ndarray, box: dict) -> Iterator:
        if not len(rows):
            return
        if not node.parts:
            yield node.cell, rows
            return
        values = vectors[rows, node.dimension].astype(np.int64)
        low, high = box.get(node.dimension, (0, 1 << 30))
        for part, (lo, hi) in zip(node.parts, ((low, min(high, node.limit)), (max(low, node.limit + 1), high)), strict=True):
            r = raised + np.maximum(lo - values, 0) - np.maximum(low - values, 0)
            d = lowered + np.maximum(values - hi, 0) - np.maximum(values - high, 0)
            near = (r <= up) & (d <= down)
            yield from visit(part, rows[near], r[near], d[near], box | {node.dimension: (lo, hi)})

    none = np.zeros(len(vectors), np.int64)
    yield from visit(node, np.arange(len(vectors)), none, none, {})


def fitted_trees(words: DataFrame, sample: int = SAMPLE) -> dict[int, Node]:
    """A tree per length, fitted on the ``sample`` words of smallest hash; the driver gets no more than these.

    A length that the sample missed has a single cell.
    """
    sizes = {r["size"]: r["n"] for r in words.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = words.orderBy(F.xxhash64("word"), "word").limit(sample).select("word").collect()
    by_size: dict[int, list[bytes]] = {size: [] for size in sorted(sizes)}
    for row in chosen:
        by_size[len(row["word"])].append(row["word"].encode("latin-1"))
    cells = iter(range(1 << 40))
    trees = {}
    for size, found in by_size.items():
        vectors = letters(found)[1]
        trees[size] = grown(vectors, sizes[size] / max(1, len(found)), cells)
    return trees


def routed(words: DataFrame, trees: dict[int, Node]) -> DataFrame:
    """cell, kind, word and n: every word at home (kind 0) and in the cells it searches, by its own length (1) or the next (2)."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            lengths = np.array([len(w) for w in found], dtype=np.int64)
            for size in np.unique(lengths):
                rows = np.flatnonzero(lengths == size)
                vectors = letters([found[i] for i in rows])[1]
                visits = [(0, trees[size], 0, 0), (1, trees[size], 1, 1)]
                if size + 1 in trees:
                    visits.append((2, trees[size + 1], 1, 0))
                for kind, tree, up, down in visits:
                    for cell, met in reached(tree, vectors, up, down):
                        picked = pa.array(rows[met])
                        fixed = [pa.array(np.full(len(met), v), t) for v, t in ((cell, pa.int64()), (kind, pa.int32()))]
                        columns = [*fixed, batch.column(0).take(picked), batch.column(1).take(picked)]
                        yield pa.RecordBatch.from_arrays(columns, ["cell", "kind", "word", "n"])

    return words.select("word", "n").mapInArrow(route, "cell bigint, kind int, word string, n bigint")


def in_parts(visits: DataFrame) -> DataFrame:
    """``visits`` with ``part``: cells of more than 2 * ``CELL`` words are searched in a grid of parts.

    Every part of a cell's words meets every part of those that search it, so no task holds a whole large cell.
    """
    homes = visits.where("kind = 0").groupBy("cell").agg(F.count(F.lit(1)).alias("homes")).where(F.col("homes") > 2 * CELL)
    large = homes.select("cell", F.ceil(F.col("homes") / CELL).cast("int").alias("parts"))
    large = materialize(large, "large_cells")
    split = visits.join(sized(large), "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.hash("word"), "parts")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    spread = split.select("cell", "kind", "word", "n", "parts", own.alias("own"), other.alias("other"))
    home = F.col("kind") == 0
    part = F.when(home, F.col("own")).otherwise(F.col("other")) * F.col("parts") + F.when(home, F.col("other")).otherwise(F.col("own"))
    return spread.select("cell", part.alias("part"), "kind", "word", "n")


class Tree:
    """A k-d tree over the distinct vectors of a cell's words."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        self.root = self.build(np.arange(len(vectors)))

    def build(self, rows: np.ndarray) -> tuple:
        held = self.vectors[rows]
        cut = best_cut(held) if len(rows) > LEAF else None
        box = held.min(axis=0).astype(np.int16), held.max(axis=0).astype(np.int16)
        if cut is None:
            return box, rows, None
        below = held[:, cut[0]] <= cut[1]
        return box, rows, (self.build(rows[below]), self.build(rows[~below]))

    def near(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, vector) pairs that differ by at most ``up`` raised and ``down`` lowered counts."""
        wide = queries.astype(np.int16)

        def visit(node: tuple, rows: np.ndarray) -> Iterator:
            (low, high), held, parts = node
            raised = np.maximum(low - wide[rows], 0).sum(axis=1)
            lowered = np.maximum(wide[rows] - high, 0).sum(axis=1)
            rows = rows[(raised <= up) & (lowered <= down)]
            if not len(rows):
                return
            if parts is not None:
                yield from visit(parts[0], rows)
                yield from visit(parts[1], rows)
                return
            # Single edits are a squared distance of at most two.
            q, p = queries[rows].astype(np.float32), self.vectors[held].astype(np.float32)
            squared = (q * q).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * (q @ p.T)
            i, j = np.nonzero(squared < 2.5 if down else squared < 1.5)
            yield rows[i], held[j]

        if len(queries) and len(self.vectors):
            for start in range(0, len(queries), 1 << 16):
                yield from visit(self.root, np.arange(start, min(start + (1 << 16), len(queries))))


def one_replaced(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows of equally long words that differ in one place."""
    return (x != y).sum(axis=1) == 1


def one_inserted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows of words ``y`` that are ``x`` with one letter more."""
    size = x.shape[1]
    ahead = np.cumprod(x == y[:, :size], axis=1).sum(axis=1)
    behind = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= size


def by_vector(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct vectors, and the rows of each: an order of all rows and where each vector's begin in it."""
    packed = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1]))).ravel()
    _, first, inverse = np.unique(packed, return_index=True, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    return vectors[first], order, np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(first)))])


def products(
    pairs: Iterator[tuple[np.ndarray, np.ndarray]], left: tuple, right: tuple, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, row) of the words of each pair of vectors, ``most`` at a time or those of one word on the left."""
    (order_l, at_l), (order_r, at_r) = left, right
    for u, v in pairs:
        width = (at_r[v + 1] - at_r[v]).astype(np.int64)
        # One entry per left word of a pair, then one per right word of that.
        height = at_l[u + 1] - at_l[u]
        which = np.repeat(np.arange(len(u)), height)
        lefts = order_l[np.arange(len(which)) - np.repeat(np.cumsum(height) - height, height) + at_l[u][which]]
        ends = np.cumsum(width[which])
        start = 0
        while start < len(which):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
            w = width[which[start:stop]]
            inner = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            yield np.repeat(lefts[start:stop], w), order_r[inner + np.repeat(at_r[v][which[start:stop]], w)]
            start = stop


class Best:
    """Per word the number of its near words and the one that occurs most, the first in order among equals."""

    def __init__(self, size: int) -> None:
        self.number = np.zeros(size, np.int64)
        self.n = np.full(size, -1, np.int64)
        self.row = np.full(size, -1, np.int64)

    def add(self, rows: np.ndarray, others: np.ndarray, n: np.ndarray, rank: np.ndarray) -> None:
        if not len(rows):
            return
        order = np.lexsort((rank[others], -n[others], rows))
        rows, others = rows[order], others[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        self.number[rows[first]] += np.diff(np.append(first, len(rows)))
        r, o = rows[first], others[first]
        held = self.row[r]
        better = (n[o] > self.n[r]) | ((n[o] == self.n[r]) & (rank[o] < rank[held]))
        self.n[r[better]], self.row[r[better]] = n[o[better]], o[better]


def search(kinds: np.ndarray, words: list[bytes], n: np.ndarray) -> Iterator[tuple[bytes, int, int, bytes]]:
    """(word, number of near words, occurrences and word of the best) from one part of a cell."""
    home, same, shorter = (np.flatnonzero(kinds == k) for k in (0, 1, 2))
    if not len(home):
        return
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    codes, vectors = letters([words[i] for i in home])
    held, order, begins = by_vector(vectors)
    tree = Tree(held)
    best = Best(len(words))
    for queries, up, down, near in ((same, 1, 1, one_replaced), (shorter, 1, 0, one_inserted)):
        if not len(queries):
            continue
        query_codes, query_vectors = letters([words[i] for i in queries])
        asked, asked_order, asked_begins = by_vector(query_vectors)
        most = PAIR_BYTES // codes.shape[1] + 1
        for i, j in products(tree.near(asked, up, down), (asked_order, asked_begins), (order, begins), most):
            hit = near(query_codes[i], codes[j])
            a, b = queries[i[hit]], home[j[hit]]
            best.add(a, b, n, rank)
            if not down:
                best.add(b, a, n, rank)
    for i in np.flatnonzero(best.number):
        yield words[i], int(best.number[i]), int(best.n[i]), words[best.row[i]]


def near_words(words: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """word, n_near, near_n and near (its near word of largest n) of the ``words`` that have near words."""

    def searched(part: pa.Table) -> pa.Table:
        found = [w.encode("latin-1") for w in part.column("word").to_pylist()]
        hits = list(search(part.column("kind").to_numpy(), found, part.column("n").to_numpy()))
        word, number, n, near = zip(*hits, strict=True) if hits else ((), (), (), ())
        texts = [pa.array([w.decode("latin-1") for w in column], pa.string()) for column in (word, near)]
        numbers = [pa.array(column, pa.int64()) for column in (number, n)]
        return pa.table([texts[0], *numbers, texts[1]], ["word", "n_near", "near_n", "near"])

    parts = in_parts(materialize(routed(words, fitted_trees(words, sample)), "word_visits"))
    found = parts.groupBy("cell", "part").applyInArrow(searched, FOUND)
    # Of equally frequent words the first in code-point order: the largest n, then the smallest word.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def last_forms(forms: DataFrame) -> DataFrame:
    """word and root of every row of ``forms`` (word, form): the end of the chain of forms.

    Every form occurs ``RATIO`` times as often as its word, so chains are short and without rings; each round doubles the
    distance that a word has come.
    """
    roots = materialize(forms.select("word", F.col("form").alias("root")), "word_roots")
    while True:
        step = sized(roots.select(F.col("word").alias("root"), F.col("root").alias("next")))
        moved = roots.join(step, "root", "left")
        if moved.where("next IS NOT NULL").isEmpty():
            return roots
        roots = materialize(moved.select("word", F.coalesce("next", "root").alias("root")), "word_roots")


def variants(docs: DataFrame, ratio: int = RATIO, least: int = LEAST, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``.

    Words are runs of letters (A to Z, and U+00C0 to U+00FF) of seven or more, ``least`` times or more in all; a
    run whose checksum with its doc_id says so loses a letter first. A word's form is its near word
    (one letter inserted, deleted or replaced) of largest n, if that is ``ratio`` times its own; ties go to the first in
    code-point order. root follows the forms to the last. Missing texts have no words, a missing doc_id is an empty one in
    the checksum; repeated rows count again. An empty table gives no rows; columns other than doc_id and text are
    not looked at.
    """
    ship_package(docs.sparkSession)
    words = materialize(counted_words(docs, least), "words")
    near = materialize(near_words(words, sample), "near_words")
    met = words.join(near, "word", "left")
    often = F.col("near_n") >= ratio * F.col("n")
    formed = met.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(often, F.col("near")).alias("form"),
        F.when(often, F.col("near_n")).alias("form_n"),
    )
    formed = materialize(formed, "word_forms")
    roots = last_forms(formed.where("form IS NOT NULL"))
    out = formed.join(sized(roots), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
