"""The pipeline against its stages in plain Python, and the registered queries against SQL."""

from __future__ import annotations

import glob
import os
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from llm import brute
import check
import corpus_pipeline
from demandflow.session import materialize


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, folder), name)
        assert docs.columns == before.columns
        kept[name] = (before.collect(), docs.collect())
    before, after = kept["quality_rules"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert {r["doc_id"] for r in before if brute.quality(r["text"])["base_failed"]} <= gone
    before, after = kept["exact_dedup"]
    first = {}
    for r in before:
        text = brute.SPACE.sub(" ", r["text"])
        first[text] = min(first.get(text, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(first.values())
    before, after = kept["near_dedup"]
    parts = brute.components([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted({c for _, c in parts.values()})
    before, after = kept["source_mix"]
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r["source"]] += len(brute.words(r["text"]))
    for r in after:
        taken[r["source"]] += len(brute.words(r["text"]))
    assert abs(sum(taken.values()) / sum(sizes.values()) - 1.5) < 0.3
    assert max(Counter(r["doc_id"] for r in after).values()) <= 2
    last = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in last if r["piece"] == 0) == Counter(r["doc_id"] for r in after)


def test_empty_documents(spark, empty):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), name)
        assert docs.count() == 0


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(entry.LLM_SQL))
def test_query_equals_reference_sql(spark, folder, name):
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    ours = entry.queries()[name](spark, folder).toPandas()
    assert check.compare(ours, db.execute(entry.oracle_sql()[name]).df()) == "ok"


@pytest.mark.parametrize("name", sorted(set(entry.LLM_QUERIES) - {"pipeline"}))
def test_digest_columns(spark, folder, name):
    """The thin queries return a row per document or page, with digests of the operators' spans.

    Packing returns at least one, variants and collocations a row per word and phrase.
    """
    rows = entry.queries()[name](spark, folder).collect()
    if name.startswith(("op12_", "op13_")):
        return
    kind = "pages" if "op7" in name else "documents"
    n = spark.read.parquet(f"{folder}/{kind}.parquet").count()
    assert len(rows) == n or name.startswith("op9") and len(rows) > n
    if name.startswith(("op2_", "op3_")):
        plain = brute.personal if name.startswith("op2_") else brute.secrets
        texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
        for r in rows:
            spans = plain(texts[r["doc_id"]])
            assert r["base_sha256"] == brute.sha(brute.joined(spans))
            counts = Counter(k for k, _, _ in spans)
            assert all(r[c] == counts[c[2:]] for c in r.asDict() if c.startswith("n_"))
            assert set(brute.joined(spans).split(",")) - {""} <= set(r["spans"].split(","))
