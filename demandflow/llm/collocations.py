"""Operator 13: collocations, by best-first branch-and-bound growth of phrases.

A phrase grows by one word on either side. The number a of a phrase bounds that of all that contain it, so
2a / (l + a), l being the number of any of its first (last) words, bounds the score of whatever it grows into on the right
(left). The frontier holds the counted phrases that have not grown. Each round grows those of the
largest bounds: one pass over the corpus counts the words beside every occurrence of them. A language is settled
when no phrase of its frontier has a bound that reaches its 2000th surviving score. A phrase survives by
its one-word extensions alone: one that is longer and frequent enough contains one of these, as frequent at
least. So every phrase that may be among the first is grown before it is judged.

Words are counted by 64-bit hashes, summed up in each task; their spelling comes from the table of frequent words.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.llm.common import text_of
from demandflow.session import materialize, ship_package, sized

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a phrase
TOP = 2_000  # phrases of a language
SCALE = 2_000_000  # of scores
ABSORBED = 80  # percent of a phrase's occurrences inside a longer one that drop it
GROWN = 5_000  # phrases of a language that grow in a round, at first
ROUND = 100_000  # phrases that grow in a round in all; they are broadcast
FLUSH = 1 << 18  # words, and
PENDING = 1 << 20  # occurrences, held by a task before it hands them on
BLOCK = 1 << 21  # bytes of texts that are looked at together
CHUNK = 1 << 18  # bytes of words that are hashed at once
LONG = 4_096  # bytes of a word; longer ones are hashed one by one
BATCH = 1 << 16  # rows that a task hands on at once
FILTER_BITS = 1 << 26  # of the fixed-size filter of frequent words

UNKNOWN = "und"
BREAK = b".,;:!?\n\x0b\x0c\r"
SEED = 131


def byte_tables() -> tuple[bytes, np.ndarray]:
    """Bytes with A-Z made small, tabs made spaces and the ends of pieces made line feeds; a random number per byte."""
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in BREAK:
        table[c] = ord("\n")
    table[ord("\t")] = ord(" ")
    values = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return bytes(table), values


TABLE, VALUES = byte_tables()
POWERS = np.cumprod(np.full(LONG, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def spread(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def hashed_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of ``text`` (bytes by ``TABLE``), and a number that differs between pieces."""
    data = np.frombuffer(text, np.uint8)
    inside = (data != ord(" ")) & (data != ord("\n"))
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    at, lengths = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths -= at
    hashes = np.empty(len(at), np.uint64)
    for i in np.flatnonzero(lengths > LONG):
        hashes[i] = xxhash.xxh64_intdigest(data[at[i] : at[i] + lengths[i]].tobytes())
    short = np.flatnonzero(lengths <= LONG)
    ends = np.cumsum(lengths[short])
    for part in np.split(short, np.searchsorted(ends, np.arange(CHUNK, ends[-1], CHUNK)) if len(ends) else []):
        if len(part):
            n = lengths[part]
            first = np.cumsum(n) - n
            place = np.arange(n.sum()) - np.repeat(first, n)
            terms = VALUES[data[np.repeat(at[part], n) + place]] * POWERS[place]
            hashes[part] = spread(np.add.reduceat(terms, first))
    return hashes, np.searchsorted(np.flatnonzero(data == ord("\n")), at)


def phrase_hash(words: list[np.ndarray], lang: str) -> np.ndarray:
    """Hash of the phrases whose k-th words are the k-th array."""
    h = np.full(len(words[0]), xxhash.xxh64_intdigest(lang.encode()), dtype=np.uint64)
    for w in words:
        h = spread(h * np.uint64(0x9E3779B97F4A7C15) + w)
    return h


def of_language(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"], F.lit(UNKNOWN)).alias("lang"), text_of(docs).alias("text"))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(lang, texts) of all rows, texts of one language joined by line feeds up to about ``BLOCK`` bytes."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = text.as_buffer().to_pybytes()
            held[lang].append(data)
            size += len(data)
            if size >= BLOCK:
                yield from ((k, b"\n".join(v).translate(TABLE)) for k, v in held.items())
                held.clear()
                size = 0
    yield from ((k, b"\n".join(v).translate(TABLE)) for k, v in held.items())


def handed_on(names: list[str], columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """``columns`` as batches of a bounded number of rows."""
    whole = pa.RecordBatch.from_arrays(columns, names)
    for start in range(0, whole.num_rows, BATCH):
        yield whole.slice(start, BATCH)


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64), pa.int64())


def counted_words(docs: DataFrame) -> DataFrame:
    """lang, phrase (a word), w (its hash) and a of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                texts = list(words)
                if not texts:
                    continue
                hashes = hashed_words(b" ".join(texts))[0]
                columns = [
                    pa.array([lang] * len(texts), pa.string()),
                    pa.array(texts, pa.binary()).view(pa.string()),
                    signed(hashes),
                    pa.array(list(words.values()), pa.int64()),
                ]
                yield from handed_on(["lang", "phrase", "w", "a"], columns)

        for lang, data in blocks(batches):
            held[lang].update(data.split())
            if sum(map(len, held.values())) >= FLUSH:
                yield from out()
                held.clear()
        yield from out()

    rows = of_language(docs).mapInArrow(count, "lang string, phrase string, w bigint, a bigint")
    return rows.groupBy("lang", "phrase").agg(F.first("w").alias("w"), F.sum("a").alias("a"))


def word_filter(words: DataFrame) -> np.ndarray:
    """A filter of the frequent words, of ``FILTER_BITS`` bits whatever their number; few others pass."""
    bit = F.pmod("w", F.lit(FILTER_BITS)) + 1  # buckets of bits are numbered from 1, and so are their bits
    seen = words.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in seen.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect():
        held = np.frombuffer(row["bits"], np.uint8)
        bits[(row["bucket"] - 1) * len(held) :][: len(held)] = held
    return bits


def summed(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ones of many pairs, and how often each is there."""
    x, y = (np.concatenate(column) for column in zip(*pairs, strict=True))
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    first = np.flatnonzero(new)
    return x[first], y[first], np.diff(np.append(first, len(x)))


def word_pairs(docs: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """lang, phrase, a and size of the pairs of words found ``least`` times or more.

    Both words of such a pair are frequent themselves: others are left out by a filter of fixed size.
    """
    bits = docs.sparkSession.sparkContext.broadcast(word_filter(words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = defaultdict(list)
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, pairs in held.items():
                first, second, n = summed(pairs)
                columns = [pa.array([lang] * len(n), pa.string()), signed(first), signed(second), pa.array(n)]
                yield from handed_on(["lang", "w", "v", "a"], columns)

        for lang, data in blocks(batches):
            w, piece = hashed_words(data)
            bit = w % np.uint64(FILTER_BITS)
            known = (bits.value[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at = np.flatnonzero(known[:-1] & known[1:] & (piece[:-1] == piece[1:]))
            held[lang].append((w[at], w[at + 1]))
            size += len(at)
            if size >= PENDING:
                yield from out()
                held.clear()
                size = 0
        yield from out()

    rows = of_language(docs).mapInArrow(count, "lang string, w bigint, v bigint, a bigint")
    pairs = materialize(rows.groupBy("lang", "w", "v").agg(F.sum("a").alias("a")).where(F.col("a") >= least), "word_pairs")
    first = words.select("lang", "w", F.col("phrase").alias("first"))
    second = words.select("lang", F.col("w").alias("v"), F.col("phrase").alias("second"))
    named = pairs.join(sized(first), ["lang", "w"]).join(sized(second), ["lang", "v"])
    return named.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", F.lit(2).alias("size"))


def beside(docs: DataFrame, words: DataFrame, frontier: DataFrame, least: int) -> DataFrame:
    """lang, phrase, a and size of the phrases found ``least`` times or more that are one of ``frontier`` and a word more.

    ``frontier`` (lang, phrase, size) has ``ROUND`` rows at most.
    """
    chosen = materialize(frontier.withColumn("node", F.monotonically_increasing_id()), "frontier")
    grown: dict[tuple[str, int], list] = defaultdict(list)
    for r in chosen.collect():
        grown[r["lang"], r["size"]].append((r["phrase"], r["node"]))
    tables = {}
    for (lang, size), rows in grown.items():
        of_words = hashed_words(" ".join(phrase for phrase, _ in rows).encode())[0].reshape(-1, size)
        hashes = phrase_hash(list(of_words.T), lang)
        order = np.argsort(hashes)
        tables[lang, size] = hashes[order], np.array([node for _, node in rows])[order]
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                nodes, w, n = summed(held)
                columns = [pa.array(nodes >> 1), pa.array((nodes & 1).astype(np.int32)), signed(w), pa.array(n)]
                yield from handed_on(["node", "ahead", "w", "a"], columns)

        quick = {}
        for key, (hashes, _) in shared.value.items():
            quick[key] = np.zeros(1 << 20, bool)
            quick[key][hashes >> np.uint64(44)] = True
        for lang, data in blocks(batches):
            w, piece = hashed_words(data)
            for size in range(2, LONGEST):
                if (lang, size) not in quick or len(w) < size:
                    continue
                hashes, nodes = shared.value[lang, size]
                last = len(w) - size + 1
                at = np.flatnonzero(piece[:last] == piece[size - 1 :])
                h = phrase_hash([w[at + k] for k in range(size)], lang)
                maybe = quick[lang, size][h >> np.uint64(44)]
                at, h = at[maybe], h[maybe]
                found = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                hit = hashes[found] == h
                at, node = at[hit], nodes[found[hit]]
                after = at + size
                ok = after < len(w)
                ok[ok] = piece[after[ok]] == piece[at[ok]]
                held.append((2 * node[ok], w[after[ok]]))
                ok = at > 0
                ok[ok] = piece[at[ok] - 1] == piece[at[ok]]
                held.append((2 * node[ok] + 1, w[at[ok] - 1]))
            if sum(len(nodes) for nodes, _ in held) >= PENDING:
                yield from out()
                held.clear()
        yield from out()

    rows = of_language(docs).mapInArrow(count, "node bigint, ahead int, w bigint, a bigint")
    sums = rows.groupBy("node", "ahead", "w").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    sums = materialize(sums, "beside")
    named = sums.join(F.broadcast(chosen), "node").join(sized(words.select("lang", "w", F.col("phrase").alias("word"))), ["lang", "w"])
    phrase = F.when(F.col("ahead") == 1, F.concat_ws(" ", "word", "phrase")).otherwise(F.concat_ws(" ", "phrase", "word"))
    return named.select("lang", phrase.alias("phrase"), "a", (F.col("size") + 1).alias("size")).distinct()


def exact(number: Column) -> Column:
    """Whole numbers of more than 64 bits."""
    return number.cast("decimal(19,0)").cast("decimal(29,0)")


def ratio(a: Column, parts: Column) -> Column:
    """floor(SCALE * a / parts) without rounding in between."""
    product = exact(a) * F.lit(SCALE).cast("decimal(8,0)")
    divisor = exact(parts)
    return ((product - product % divisor) / divisor).cast("bigint")


def scored(counted: DataFrame) -> DataFrame:
    """Phrases of two words or more with l, r and score (null while a part is not counted), bound and ``dropped``.

    bound is what growing may reach on either side; the longest phrases do not grow.
    """
    phrases = counted.where("size > 1")
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = phrases.select("lang", "phrase", "a", "size", cut)
    cuts = cuts.select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("last"),
    )
    left = counted.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = counted.select("lang", F.col("phrase").alias("last"), F.col("a").alias("r"))
    met = cuts.join(sized(left), ["lang", "first"], "left").join(sized(right), ["lang", "last"], "left")
    a, l, r = F.col("a"), F.col("l"), F.col("r")
    met = met.withColumns({"s": ratio(a, l + r), "grows_right": ratio(a, l + a), "grows_left": ratio(a, r + a)})
    by_phrase = met.groupBy("lang", "phrase", "a", "size").agg(
        F.min(F.struct("s", "k", "l", "r")).alias("worst"),
        F.count("s").alias("known"),
        F.min("grows_right").alias("grows_right"),
        F.min("grows_left").alias("grows_left"),
    )
    known = F.col("known") == F.col("size") - 1
    # Without a part the bound of the others holds.
    none = F.lit(SCALE // 2).cast("bigint")
    bound = F.greatest(F.coalesce("grows_right", none), F.coalesce("grows_left", none))
    rated = by_phrase.select(
        *["lang", "phrase", "a", "size"],
        *[F.when(known, F.col(f"worst.{c}")).alias(c) for c in ("l", "r")],
        F.when(known, F.col("worst.s")).alias("score"),
        F.when(F.col("size") < LONGEST, bound).alias("bound"),
    )
    inner = phrases.where("size > 2").select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(F.array(*[F.array_join(F.slice(words, F.lit(i), F.col("size") - 1), " ") for i in (1, 2)])).alias("phrase"),
    )
    most = materialize(inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")), "longer")
    joined = rated.join(sized(most), ["lang", "phrase"], "left")
    absorbed = exact(F.col("longer")) * 100 >= exact(F.col("a")) * ABSORBED
    return joined.withColumn("dropped", F.coalesce(absorbed, F.lit(False))).drop("longer")


def ranked(rated: DataFrame, top: int) -> DataFrame:
    """The first ``top`` survivors of every language with their rank; others are left out before the shuffle."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    live = rated.where("score IS NOT NULL AND NOT dropped")
    return live.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, grown: int = GROWN) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` collocations of every language.

    Texts are made small (A-Z), cut into pieces at marks and line ends and into words at spaces and tabs. A
    phrase of two to four words that is found ``least`` times or more scores SCALE * a / (l + r), rounded
    down, at its lowest cut into two parts found l and r times. Phrases of which a longer
    one has ``ABSORBED`` percent are dropped. n is the number of words of the language; a missing language is ``und``.
    Missing and empty texts have no words; repeated rows count again. A language without candidates gives no rows, as
    does an empty table; columns other than text and lang are not looked at.
    """
    ship_package(docs.sparkSession)
    all_words = materialize(counted_words(docs), "all_words")
    totals = all_words.groupBy("lang").agg(F.sum("a").alias("n"))
    words = materialize(all_words.where(F.col("a") >= least), "frequent_words")
    singles = words.select("lang", "phrase", "a", F.lit(1).alias("size"))
    counted = materialize(singles.unionByName(word_pairs(docs, words, least)), "phrases")
    done = materialize(counted.where("false").select("lang", "phrase"), "grown_phrases")
    while True:
        rated = materialize(scored(counted), "rated_phrases")
        # Phrases that have not grown may still be dropped; their place among the survivors is not settled.
        grew = rated.join(sized(done), ["lang", "phrase"], "left_semi")
        settled = grew.unionByName(rated.where(F.col("size") == LONGEST))
        last = ranked(settled, top).where(F.col("rank") == top).select("lang", F.col("score").alias("least_score"))
        open_ = rated.where(F.col("size") < LONGEST).join(sized(done), ["lang", "phrase"], "left_anti")
        open_ = open_.join(sized(last), "lang", "left").where("least_score IS NULL OR bound >= least_score")
        best = Window.partitionBy("lang").orderBy(F.desc("bound"), F.desc("a"), "phrase")
        first = open_.withColumn("place", F.row_number().over(best)).where(F.col("place") <= grown)
        first = first.orderBy(F.desc("bound"), "lang", "phrase").limit(ROUND)
        frontier = materialize(first.select("lang", "phrase", "size"), "frontier")
        if frontier.isEmpty():
            break
        more = materialize(beside(docs, words, frontier, least), "longer_phrases")
        counted = materialize(counted.unionByName(more).distinct(), "phrases")
        done = materialize(done.unionByName(frontier.select("lang", "phrase")), "grown_phrases")
        grown = min(2 * grown, ROUND)
    numbered = ranked(settled, top).join(sized(totals), "lang")
    return numbered.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
