"""Operator 8: near-duplicates by an inverted join over the coordinates of MinHash signatures.

Documents with the same set of shingles form a class. Every class posts its
signature as (coordinate, value) tokens. A pair that agrees in ``MIN_MATCHES`` of the ``COORDINATES`` must share a
token outside the ``MIN_MATCHES - 1`` most frequent ones of each side, so only that prefix of the rare tokens is posted
and the frequent lists are skipped. Collisions of the pairs found are counted on the whole
signatures, and what reaches the threshold is confirmed on the whole sets.

A list of thousands of near copies is never expanded into pairs. Its members are first compared with one leader,
the member with the most common tokens, and joined into components; that is repeated with another leader. What is then
left in long lists is compared by differences: lists that hang together form a group, every member is written as the
group's common shingles less some and plus some, and a pair that no member's closeness to the common shingles settles
must share enough of these differences, so only the postings of rare ones are joined. That leaves out no link: a pair
within a component could not change it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.llm.common import file_place, text_of, whole_row
from demandflow.session import materialize, ship_package, sized

WORDS = 5  # of a shingle
PERCENT = 75  # similarity of a link
COORDINATES = 64
# At a similarity of 0.75 the matches are binomial with mean 48 and deviation 3.5; fewer than 33 have a chance of 1e-5.
MIN_MATCHES = 33
STEP = 2 * (100 + PERCENT)  # what one more common shingle adds to the closeness of a pair
LEADER_ROUNDS = 2
SHORT = 4  # lists are compared pair by pair when that takes at most so many pairs a member
UNCOMPRESSED = "uncompressed"  # tables of hashes
CHUNK_BYTES = 1 << 20  # texts are hashed together up to this size
SEED = 77

PLACE = "struct<file:bigint,row:bigint>"
SIGNED = f"locator {PLACE}, doc_id bigint, n_shingles bigint, digest string, signature array<int>"
SETS = "id bigint, digest string, shingles array<bigint>"


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    """A random number per byte, the same for both cases of A-Z, 0 for white space."""
    values = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[[0x20, *range(0x09, 0x0E)]] = 0
    return values


@lru_cache(maxsize=4)
def powers(n: int) -> np.ndarray:
    base = np.full(n, 0x9E3779B97F4A7C15, dtype=np.uint64)
    base[0] = 1
    return np.cumprod(base, dtype=np.uint64)


@lru_cache(maxsize=1)
def multipliers() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED + 1)
    odd = random.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def word_hashes(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of ``data``, texts laid end to end that begin at ``begins``."""
    values = byte_values()[data]
    visible = values != 0
    start = visible.copy()
    start[1:] &= ~visible[:-1]
    begins = begins[begins < len(data)]
    start[begins] = visible[begins]
    at = np.flatnonzero(start)
    if not len(at):
        return np.empty(0, np.uint64), at
    # White space behind a word adds 0 to its sum.
    lengths = np.diff(np.append(at, len(data)))
    place = np.arange(at[0], len(data)) - np.repeat(at, lengths)
    size = 1 << max(8, int(lengths.max()).bit_length())
    terms = values[at[0] :] * powers(size)[place]
    return mixed(np.add.reduceat(terms, at - at[0])), at


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of every text."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    words, at = word_hashes(np.frombuffer(b"".join(texts), dtype=np.uint8), ends - sizes)
    first, last = np.searchsorted(at, ends - sizes), np.searchsorted(at, ends)
    factor = powers(256)[1 : WORDS + 1]
    windows = max(0, len(words) - WORDS + 1)
    sums = np.zeros(windows, dtype=np.uint64)
    for k in range(WORDS):
        sums += words[k : k + windows] * factor[k]
    sums = mixed(sums)
    for a, b in zip(first, last, strict=True):
        if b - a >= WORDS:
            yield np.unique(sums[a : b - WORDS + 1])
        elif b > a:  # a short text is one shingle, kept apart from longer ones by its number of words
            whole = (words[a:b] * factor[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mixed(np.array([whole], dtype=np.uint64))
        else:
            yield np.empty(0, np.uint64)


def chunked(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingles) of a batch of texts, a bounded number of bytes at a time."""
    rows, texts, size = [], [], 0
    column_values = batch.column(column)
    for i in range(batch.num_rows):
        text = column_values[i].as_buffer().to_pybytes()
        rows.append(i)
        texts.append(text)
        size += len(text)
        if size >= CHUNK_BYTES or i + 1 == batch.num_rows:
            yield from zip(rows, shingle_sets(texts), strict=True)
            rows, texts, size = [], [], 0


def signature(shingles: np.ndarray) -> np.ndarray:
    odd, shift = multipliers()
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(best, (shingles[i : i + 512, None] * odd + shift).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def digest_of(shingles: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(shingles.tobytes())


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *[len(a) for a in arrays]]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(kind.to_pandas_dtype()), kind))


def signed(docs: DataFrame, locator: Column) -> DataFrame:
    """Size and digest of every row's shingle set, and its signature; digest and signature are missing for empty sets."""
    names = ["locator", "doc_id", "n_shingles", "digest", "signature"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for _, shingles in chunked(batch, 2):
                sizes.append(len(shingles))
                digests.append(digest_of(shingles) if len(shingles) else None)
                signatures.append(signature(shingles) if len(shingles) else np.empty(0, np.int32))
            found = [pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), lists(signatures, pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], names)

    doc_id = docs["doc_id"].cast("bigint").alias("doc_id")
    texts = docs.select(locator.cast(PLACE).alias("locator"), doc_id, text_of(docs).alias("text"))
    return materialize(texts.mapInArrow(sign, SIGNED), "signatures", UNCOMPRESSED)


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct set: id, digest, n, doc_id (the smallest) and signature."""
    grouped = (
        rows.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n"),
            F.first("signature").alias("signature"),
        )
    )
    return materialize(grouped.withColumn("id", F.monotonically_increasing_id()), "shingle_classes", UNCOMPRESSED)


def posted(classes: DataFrame) -> DataFrame:
    """The posting lists: token, id, n and weight, of the rare tokens of every class that share theirs.

    A class with fewer than ``MIN_MATCHES`` tokens in common with any others has no partner. ``weight``
    is larger the more common a class's tokens are.
    """
    token = F.transform("signature", lambda v, k: k.cast("bigint") * (1 << 32) + v.cast("bigint"))
    tokens = classes.select("id", "n", F.explode(token).alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = tokens.join(often, "token")
    of_class = Window.partitionBy("id")  # at most COORDINATES rows
    ranked = shared.withColumns(
        {
            "rank": F.row_number().over(of_class.orderBy("often", "token")),
            "shared": F.count(F.lit(1)).over(of_class),
            "weight": F.sum(F.log2("often")).over(of_class),
        }
    )
    prefix = ranked.where(F.col("rank") <= F.col("shared") - (MIN_MATCHES - 1))
    return materialize(prefix.select("token", "id", "n", "weight"), "postings")


def sets_of(docs: DataFrame, classes: DataFrame, postings: DataFrame) -> DataFrame:
    """id, n, signature and shingles of the posted classes, read again from one text of each."""
    ids = materialize(postings.select("id").distinct(), "posted_ids")
    wanted = materialize(classes.join(sized(ids), "id", "left_semi"), "posted_classes", UNCOMPRESSED)
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"))
    keys = wanted.select(F.col("id").alias("wanted_id"), F.col("digest").alias("wanted"), F.col("doc_id").alias("first"))
    matched = texts.join(sized(keys), texts["doc_id"].eqNullSafe(keys["first"])).select("wanted_id", "wanted", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted_digests = batch.column(1).to_pylist()
            # Other rows may have the same doc_id: only the text of the class's set counts.
            found = [(i, s) for i, s in chunked(batch, 2) if len(s) and digest_of(s) == wanted_digests[i]]
            rows = pa.array([i for i, _ in found], pa.int64())
            shingles = lists([s.view(np.int64) for _, s in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), shingles], ["id", "digest", "shingles"]
            )

    sets = matched.mapInArrow(read, SETS).dropDuplicates(["id"])
    return materialize(sets.select("id", "shingles").join(wanted.select("id", "n", "signature"), "id"), "posted_sets", UNCOMPRESSED)


def connectable(sets: DataFrame) -> DataFrame:
    """id and ``shared``, the shingles that any other set has too, of the sets that may have a link.

    The part of a set that no other has is lost for every intersection, which settles most
    strongly edited copies without a comparison.
    """
    shingles = sets.select("id", F.explode("shingles").alias("shingle"))
    alone = (
        shingles.groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("often"), F.min("id").alias("id"))
        .where("often = 1")
        .select("id", F.lit(0).cast("bigint").alias("n"), F.lit(1).alias("alone"))
    )
    counted = sets.select("id", "n", F.lit(0).alias("alone")).unionByName(alone).groupBy("id")
    sizes = counted.agg(F.max("n").alias("n"), F.sum("alone").alias("alone"))
    shared = sizes.select("id", "n", (F.col("n") - F.col("alone")).alias("shared"))
    return shared.where(100 * F.col("shared") >= PERCENT * F.col("n")).select("id", "shared")


def similar(a: Column, b: Column, size_a: Column, size_b: Column) -> Column:
    """At least ``PERCENT`` of the shingles of both together are in both."""
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= PERCENT * (size_a + size_b - common)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs`` (a, b): first by the collisions of their signatures, then by their sets."""
    x = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"), F.col("shingles").alias("y"))
    collisions = F.aggregate(F.zip_with("s_a", "s_b", lambda u, v: (u == v).cast("int")), F.lit(0), lambda t, m: t + m)
    joined = pairs.join(x, "a").join(y, "b").where(collisions >= MIN_MATCHES)
    return joined.where(similar(F.col("x"), F.col("y"), F.col("n_a"), F.col("n_b"))).select("a", "b")


def connected(links: DataFrame) -> DataFrame:
    """node and root, the smallest node connected with it, of every node in ``links`` (a, b), distinct and a < b.

    Every round gives a node the smallest root among its neighbours and then that
    root's own root, so the distance to the root halves; it ends when no root changes.
    A round writes one row per node.
    """
    both = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), "a").alias("root")), "roots")
    while True:
        of_neighbours = both.join(sized(roots.select(F.col("node").alias("b"), "root")), "b").select(
            F.col("a").alias("node"), "root", F.lit(None).cast("bigint").alias("old")
        )
        own = roots.select("node", "root", F.col("root").alias("old"))
        best = of_neighbours.unionByName(own).groupBy("node").agg(F.min("root").alias("next"), F.max("old").alias("old"))
        jump = roots.select(F.col("node").alias("next"), F.col("root").alias("further"))
        moved = best.join(sized(jump), "next").select("node", F.least("next", "further").alias("root"), "old")
        moved = materialize(moved, "roots")
        roots = moved.select("node", "root")
        if moved.where("root <> old").isEmpty():
            return roots


def regrouped(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, component) after joining the components that ``links`` connect."""
    a = labels.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = labels.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    between = links.join(sized(a), "a").join(sized(b), "b").where("ca <> cb")
    roots = connected(between.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
    joined = labels.join(sized(roots.withColumnRenamed("node", "component")), "component", "left")
    return materialize(joined.select("id", F.coalesce("root", "component").alias("component")), "components")


def open_lists(postings: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """The lists that hold more than one component: token, members, largest (part, component) and leader.

    The leader is the member with the most common tokens, in later turns one by hash. Members are summed up
    before the shuffle, so a list of any length is a few rows.
    """
    order = F.col("weight") if turn == 0 else F.xxhash64("id", F.lit(turn)).cast("double")
    leader = F.max(F.struct(order.alias("order"), "id", "n", "shared", "component")).alias("leader")
    parts = postings.join(sized(labels), "id").groupBy("token", "component").agg(F.count(F.lit(1)).alias("part"), leader)
    lists_ = parts.groupBy("token").agg(
        F.count(F.lit(1)).alias("components"),
        F.sum("part").alias("members"),
        F.max(F.struct("part", "component")).alias("largest"),
        F.max("leader").alias("leader"),
    )
    return materialize(lists_.where("components > 1").drop("components"), "open_lists")


def comparable(n: Column, m: Column, shared_n: Column, shared_m: Column) -> Column:
    """Sets of sizes ``n`` and ``m`` can be similar enough, given how much of each any other set has.

    A link needs PERCENT / (100 + PERCENT) of both sizes in common, for equal sizes six sevenths of each set.
    """
    sizes = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    return sizes & ((100 + PERCENT) * F.least(shared_n, shared_m) >= PERCENT * (n + m))


def leader_pairs(members: DataFrame) -> DataFrame:
    """Pairs of each list's leader with the members outside its component."""
    far = F.col("component") != F.col("leader.component")
    close = comparable(F.col("n"), F.col("leader.n"), F.col("shared"), F.col("leader.shared"))
    return members.where(far & close).select(
        F.least("id", "leader.id").alias("a"), F.greatest("id", "leader.id").alias("b")
    )


def crossing_pairs(members: DataFrame) -> DataFrame:
    """All pairs of a list that cross components: one of them is outside its largest component."""
    names = {"id": "x", "component": "cx", "n": "nx", "shared": "sx"}
    others = members.where("component <> largest.component").select("token", *[F.col(k).alias(v) for k, v in names.items()])
    close = comparable(F.col("n"), F.col("nx"), F.col("shared"), F.col("sx"))
    met = others.join(members, "token").where((F.col("component") != F.col("cx")) & close)
    return met.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b"))


def groups_of(members: DataFrame) -> DataFrame:
    """id and group of ``members`` (id, token, leader): those whose lists hang together have one group.

    A member stands for its smallest leader, so that only the pairs of leaders that members have in common
    go through the rounds of ``connected``, not a link per member and list.
    """
    led = materialize(members.select("id", F.col("leader.id").alias("leader")).distinct(), "led")
    main = materialize(led.groupBy("id").agg(F.min("leader").alias("main")), "main_leaders")
    pairs = led.join(sized(main), "id").where("leader <> main")
    edges = pairs.select(F.least("leader", "main").alias("a"), F.greatest("leader", "main").alias("b")).distinct()
    roots = connected(edges).withColumnRenamed("node", "main")
    return main.join(sized(roots), "main", "left").select("id", F.coalesce("root", "main").alias("group"))


def common_shingles(members: DataFrame) -> DataFrame:
    """group and base, the shingles that at least half of a group's members (group, shingles) have.

    There are at most twice as many as a member has on average.
    """
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    held = members.select("group", F.explode("shingles").alias("shingle")).groupBy("group", "shingle")
    often = held.agg(F.count(F.lit(1)).alias("often")).join(sized(sizes), "group")
    return often.where("2 * often >= members").groupBy("group").agg(F.collect_list("shingle").alias("base"))


def differences(members: DataFrame) -> DataFrame:
    """id, component, group, n, in_base, closeness and delta of ``members`` (id, component, group, n, shingles).

    ``delta`` holds the base's shingles that a member lacks and its own outside the base. With c the number of
    shingles that two deltas share, the sets have in_base_x + in_base_y - |base| + c in common, whatever
    the base is. So they are linked if and only if closeness_x + closeness_y + STEP * c >= 0.
    """
    lacking = F.array_except("base", "shingles")
    both = members.join(common_shingles(members), "group", "left").withColumn(
        "base", F.coalesce("base", F.array().cast("array<bigint>"))
    )
    told = both.withColumns(
        {"in_base": F.size("base") - F.size(lacking), "delta": F.concat(lacking, F.array_except("shingles", "base"))}
    )
    closeness = STEP * F.col("in_base") - STEP // 2 * F.size("base") - 2 * PERCENT * F.col("n")
    out = told.select("id", "component", "group", "n", "in_base", closeness.cast("bigint").alias("closeness"), "delta")
    return materialize(out, "differences", UNCOMPRESSED)


def delta_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that hold every link across components within the lists of ``members``.

    Members whose closeness makes up for that of the group's closest one are linked with it, which also
    joins all pairs that are linked by closeness alone. A pair with another member, an outer one, must share a
    number of differences. So the most frequent of each delta, one less than that number, are not posted;
    at the rarest shared one, the differences behind it in either order bound how many more can be shared.
    """
    named = materialize(groups_of(members).join(sized(members.select("id", "component").distinct()), "id"), "groups")
    rows = differences(sets.select("id", "n", "shingles").join(sized(named), "id"))
    closest = rows.groupBy("group").agg(F.max(F.struct("closeness", "id", "component")).alias("closest"))
    sided = rows.join(sized(materialize(closest, "closest")), "group").withColumn(
        "outer", F.col("closeness") + F.col("closest.closeness") < 0
    )
    with_closest = sided.where(~F.col("outer") & (F.col("component") != F.col("closest.component"))).select(
        F.least("id", "closest.id").alias("a"), F.greatest("id", "closest.id").alias("b")
    )

    exploded = sided.select(*[c for c in sided.columns if c != "delta"], F.explode("delta").alias("shingle"))
    often = exploded.groupBy("group", "shingle").agg(
        F.count(F.lit(1)).alias("often"),
        F.max("outer").alias("met"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    # Differences that one component alone has, or no outer member, count for no pair that is looked for.
    useful = often.where("met AND low <> high").select("group", "shingle", "often")
    of_member = Window.partitionBy("id")  # as many rows as a delta has shingles
    ranked = exploded.join(useful, ["group", "shingle"]).withColumns(
        {
            "place": F.row_number().over(of_member.orderBy("often", "shingle")),
            "shared": F.count(F.lit(1)).over(of_member),
        }
    )
    kept = ["id", "component", "group", "n", "in_base", "closeness", "outer", "shingle", "place", "shared"]
    ranked = materialize(ranked.select(*kept, F.col("closest.closeness").alias("best")), "delta_shingles")
    bound = ranked.where("outer").groupBy("group").agg(F.max("closeness").alias("best_outer"))
    partner = F.when(F.col("outer"), F.col("best")).otherwise(F.col("best_outer"))
    needed = F.greatest(
        F.lit(1),
        F.ceil(-(F.col("closeness") + partner) / STEP),
        F.ceil(PERCENT * F.col("n") / 100) - F.col("in_base"),
    )
    postings = ranked.join(sized(bound), "group").where(F.col("place") <= F.col("shared") - needed + 1)
    postings = postings.select(
        *["group", "shingle", "id", "component", "n", "closeness", "outer"],
        (F.col("shared") - F.col("place") + 1).alias("left"),
    )
    postings = materialize(postings, "delta_postings")
    names = ("id", "component", "n", "closeness", "left")
    x = postings.where("outer").select("group", "shingle", *[F.col(c).alias(f"{c}_x") for c in names])
    most = STEP * F.least("left", "left_x")
    may_link = F.col("closeness") + F.col("closeness_x") + most >= 0
    similar_size = 100 * F.least("n", "n_x") >= PERCENT * F.greatest("n", "n_x")
    across = (F.col("component") != F.col("component_x")) & may_link & similar_size
    met = x.join(postings, ["group", "shingle"]).where(across)
    return met.select(F.least("id", "id_x").alias("a"), F.greatest("id", "id_x").alias("b")).unionByName(with_closest)


def components(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """id and component of the classes that have a link; all others are alone."""
    postings = posted(classes)
    sets = sets_of(docs, classes, postings)
    able = materialize(connectable(sets), "connectable")
    postings = materialize(postings.join(sized(able), "id"), "connectable_postings")
    labels = materialize(able.select("id", F.col("id").alias("component")), "components")
    tested: DataFrame | None = None
    for turn in range(LEADER_ROUNDS + 1):
        found = open_lists(postings, labels, turn)
        crossing = (F.col("members") - F.col("largest.part")) * F.col("members")
        cost, size = found.agg(F.sum(crossing), F.sum("members")).first()
        if not cost:
            break
        # Components only grow together, so a list that holds one of them is never open again.
        postings = materialize(postings.join(sized(found.select("token")), "token", "left_semi"), "open_postings")
        short = cost <= SHORT * size
        last = short or turn == LEADER_ROUNDS
        members = postings.join(sized(labels), "id").join(sized(found), "token")
        if short:
            pairs = crossing_pairs(members)
        else:
            pairs = delta_pairs(members, sets) if last else leader_pairs(members)
        pairs = pairs.withColumn("tested", F.lit(0))
        if tested is not None:
            pairs = pairs.unionByName(tested.withColumn("tested", F.lit(1)))
        new = pairs.groupBy("a", "b").agg(F.max("tested").alias("tested")).where("tested = 0").drop("tested")
        new = materialize(new, "candidate_pairs")
        tested = new if tested is None else tested.unionByName(new)
        links = materialize(confirmed(new, sets), "confirmed_links")
        if not links.isEmpty():
            labels = regrouped(labels, links)
        if last:
            break
    return labels


def grouped(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """locator, doc_id, n_shingles, digest, component and component_id of the signed ``rows`` of ``docs``.

    Rows with an empty set have no component.
    """
    classes = classes_of(rows)
    labels = components(docs, classes)
    named = classes.join(sized(labels), "id", "left").select(
        "digest", "doc_id", F.coalesce("component", "id").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_digest = named.join(smallest, "component").select("digest", "component", "component_id")
    return rows.select("locator", "doc_id", "n_shingles", "digest").join(by_digest, "digest", "left")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Texts of at least five words are sets of shingles, shorter ones a single shingle;
    null and empty texts have an empty set and are linked with nothing. component_id
    is the smallest doc_id that links lead to, kept says that it is the row's own.
    Rows with the same set are linked whatever their doc_id; a null doc_id is passed
    over for the smallest, and its row is kept only if the component has no other.
    Rows with equal doc_id and set are kept or not together. An empty table gives no
    rows; columns other than doc_id and text are not looked at.
    """
    ship_package(docs.sparkSession)
    out = grouped(signed(docs, F.lit(None)), docs)
    component_id = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def one_of_each(docs: DataFrame, written: bool = False) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id, in its own columns.

    Rows with empty sets stay. Of several rows with that doc_id the one of the smallest place stays. With ``written``,
    ``docs`` is one Parquet table as read, whose rows are told by file and row number; otherwise its rows are written once.
    """
    ship_package(docs.sparkSession)
    place = file_place(docs) if written else None
    if place is not None:
        stored = docs.select(whole_row(docs).alias("row"), place.alias("locator"))
    else:
        number = F.struct(F.lit(0).cast("bigint").alias("file"), F.monotonically_increasing_id().alias("row"))
        stored = materialize(docs.select(whole_row(docs).alias("row"), number.alias("locator")), "near_dup_rows")
    texts = stored.select("locator", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    found = materialize(grouped(signed(texts, F.col("locator")), texts).where("digest IS NOT NULL"), "near_dup_groups")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "locator"))
    stay = found.groupBy("component").agg(first.alias("f")).select(F.col("f.locator").alias("locator"))
    gone = materialize(found.select("locator").join(stay, "locator", "left_anti"), "near_copies")
    return stored.join(sized(gone), "locator", "left_anti").select("row.*")
