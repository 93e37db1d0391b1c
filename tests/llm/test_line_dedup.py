from __future__ import annotations

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from demandflow.llm import line_dedup
from llm.brute import LOWER

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, shortest=40, documents=5):
    """(doc_id, n_lines, n_dropped, kept text) of (doc_id, text) rows, a row being a document."""
    holders = defaultdict(set)
    for place, (doc_id, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            holders[line.strip(SPACES).translate(LOWER)].add((place, -1 if doc_id is None else doc_id))
    top = {
        key: max(i for _, i in found)
        for key, found in holders.items()
        if len(key) >= shortest and len(found) >= documents
    }
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        own = -1 if doc_id is None else doc_id
        kept = [x for x in lines if own >= top.get(x.strip(SPACES).translate(LOWER), own)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return sorted(map(tuple, line_dedup.without_shared_lines(docs, **how).collect()), key=str)


NOTICE = "This notice stands below every page of the site"  # 47 code points
EDGES = "é" * 40  # 40 code points, 80 bytes
SHORT = "é" * 39


def test_shared_lines_stay_in_the_largest_document_only(spark):
    rows = [(i, f"own {i}\n \t{NOTICE.upper() if i % 2 else NOTICE}\r\n{EDGES}\n{SHORT}\n\n{NOTICE}") for i in range(9)]
    rows += [(20 + i, f"{NOTICE}{i}\n{NOTICE[:39]}") for i in range(4)] + [(40, f"{NOTICE}0"), (41, NOTICE + "\xa0")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, batches=1) == found(spark, rows, batches=4) == brute(rows)


def test_limit_is_five_documents(spark):
    four = [(i, f"{NOTICE}\n{NOTICE}") for i in range(4)]
    assert [r[2] for r in found(spark, four)] == [0] * 4
    assert sorted(r[2] for r in found(spark, [*four, (9, NOTICE)])) == [0, 2, 2, 2, 2]


def test_real_documents_equal_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows)
    low = {"shortest": 1, "documents": 2}
    assert found(spark, rows, **low) == brute(rows, **low)


def test_any_order_of_batches_gives_the_same_totals(spark):
    rows = [(i, f"{NOTICE} {i % 7}\n{NOTICE} {i % 3}") for i in range(60)]
    lines = line_dedup.line_hashes(spark.createDataFrame(rows, "doc_id bigint, text string")).cache()
    want = sorted(map(tuple, line_dedup.merged(lines.select("h", "g", F.lit(1).alias("n"), F.col("doc_id").alias("top"))).collect()))
    for order in ([0, 1, 2, 3, 4, 5], [5, 4, 3, 2, 1, 0], [3, 0, 5, 1, 4, 2]):
        index = line_dedup.LineRuns(spark)
        for k in order:
            index.add(lines.where(F.col("doc_id").between(10 * k, 10 * k + 9)))
        got = {(r["h"], r["g"]): (r["n"], r["top"]) for r in index.totals().collect()}
        # A settled line is no longer counted, so its number may be smaller, but not below the limit.
        assert {k: t for k, (_, t) in got.items()} == {(h, g): t for h, g, n, t in want if n >= 5}
        assert all(n >= 5 for n, _ in got.values())


def test_runs_are_joined_without_a_shuffle_and_merged_by_level(spark):
    rows = [(i, f"{NOTICE} {i % 7}") for i in range(60)]
    lines = line_dedup.line_hashes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    index = line_dedup.LineRuns(spark, fan=2)
    plans, write = [], index.write
    index.write = lambda run, level: (plans.append(run._jdf.queryExecution().toString()), write(run, level))
    for k in range(5):
        index.add(lines.where(F.col("doc_id") % 5 == 4 - k))
    assert index.runs == [1, 0, 1]
    joined = [p.split("== Physical Plan ==")[1] for p in plans if "LeftAnti" in p]
    assert joined
    for plan in joined:  # one exchange, that of the batch's own aggregation
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "SortMergeJoin" in plan
    index.totals()


def test_odd_rows(spark, odd, clashing, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for frame in (odd, clashing):
        got = sorted(map(tuple, line_dedup.without_shared_lines(frame).collect()), key=str)
        assert got == brute(rows)
    assert line_dedup.without_shared_lines(empty).count() == 0
    unknown = [(None, NOTICE)] * 6
    assert [r[2] for r in found(spark, unknown)] == [0] * 6
    assert sorted(r[2] for r in found(spark, [*unknown, (3, NOTICE), (3, NOTICE)])) == [0, 0] + [1] * 6


@pytest.mark.parametrize("lines", [100_000])
def test_very_long_text(spark, lines):
    text = "\n".join(f"{NOTICE} number {i % (lines // 2)}" for i in range(lines))
    rows = [(i, text) for i in range(5)]
    got = found(spark, rows)
    assert [r[2] for r in got] == [lines] * 4 + [0] and got[-1][3] == text and got[0][3] == ""
