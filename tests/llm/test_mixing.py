from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import functions as F

from llm import brute
from demandflow.llm import mixing


def expected_targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while free:
        rate = left / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] >= 2 * sizes[s]}
        target |= {s: rate * weight[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        if not over:
            break
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    return target


def check(docs, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(brute.words(r["text"]))
    target = expected_targets(sizes)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-12, abs_tol=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        # Complete epochs come first.
        assert r["copies"] >= int(r["target"] // max(1, r["source_size"])) or not r["source_size"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s]
    return out


def test_targets_and_takings(docs):
    check(docs, docs.collect())


def test_the_sample_is_the_prefix_of_the_keys_nearest_to_the_rest(docs):
    rows = mixing.measured(docs, docs["doc_id"].alias("doc_id")).collect()
    copies = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    for members in by_source.values():
        any_row = copies[members[0]["doc_id"]]
        epochs = int(any_row["target"] // any_row["source_size"])
        rest = any_row["target"] - epochs * any_row["source_size"]
        members.sort(key=lambda r: r["p"])
        ends = [0]
        for r in members:
            ends.append(ends[-1] + r["size"])
        best = min(abs(e - rest) for e in ends)
        chosen = [copies[r["doc_id"]]["copies"] - epochs for r in members]
        assert chosen == sorted(chosen, reverse=True)
        assert abs(ends[sum(chosen)] - rest) == best


def test_better_documents_come_sooner(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, "plain words in this text").otherwise("## $$ ## $$ ##").alias("text"),
        F.lit("s").alias("source"),
    )
    out = mixing.mix(docs, share=0.5).groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n"))
    n = {r["odd"]: r["n"] for r in out.collect()}
    assert n[0] > 3 * n[1]


def test_sources_of_the_smallest_weight(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("## $$ ##").alias("text"), F.lit("s").alias("source"))
    rows = mixing.measured(docs, docs["doc_id"])
    assert rows.select("p").distinct().count() == 20_000
    assert rows.groupBy("part").count().agg(F.max("count")).first()[0] <= 3
    for share in (0.7, 0.99, 0.9999):
        assert abs(mixing.mix(docs, share=share).agg(F.sum("taken")).first()[0] - share * 60_000) <= 3


def test_odd_rows(odd, clashing, empty):
    out = check(odd, odd.collect())
    again = mixing.mix(clashing).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert mixing.mix(empty).collect() == []
    assert mixing.mixed_rows(empty).columns == empty.columns and mixing.mixed_rows(empty).count() == 0


def test_rows_of_the_mix_repeat_as_often_as_taken(docs, clashing):
    for table in (docs, clashing):
        rows = mixing.mixed_rows(table)
        assert rows.columns == table.columns
        n = rows.groupBy("doc_id", "text").count().collect()
        wanted = defaultdict(int)
        for r in mixing.mix(table).collect():
            wanted[r["doc_id"]] += r["copies"]
        got = defaultdict(int)
        for r in n:
            got[r["doc_id"]] += r["count"]
        assert {k: v for k, v in wanted.items() if v} == dict(got)
