from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from llm import brute
from demandflow.llm import quality_rules as rules

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judged(table):
    return rules.judged(table, rules.Rules(), table["doc_id"], table["text"])


def test_counts_equal_brute_force(docs, odd, clashing, spark):
    repeats = ["a b c a b c a b", "a a a a", "x y\nx y\n\n \nx y", "a b a b a", "one two three", "a", "É é É"]
    some = spark.createDataFrame([(i, t, "en") for i, t in enumerate(repeats)], "doc_id bigint, text string, lang string")
    for table in (docs, odd, clashing, some):
        for r in judged(table).collect():
            assert {c: r[c] for c in COUNTS} == brute.quality(r["text"]), r["text"][:200]
            assert not (r["kept"] and r["base_failed"])


def distance(p, q):
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    half = [sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x > 0) for a in (p, q)]
    return np.sqrt(sum(half) / 2)


def test_distances_equal_numpy(docs):
    reference = {r["lang"]: r for r in rules.references(docs, rules.Rules()).collect()}
    out = rules.judged(docs, rules.Rules(), docs["doc_id"], docs["text"], docs["lang"].alias("language")).collect()
    compared = 0
    for r in out:
        if r["class_distance"] is None:
            assert r["n_words"] < 80
            continue
        ref = reference[r["language"]]
        short = [w.lower() for w in brute.words(r["text"]) if len(w) <= 4]
        counts = [short.count(c) for c in ref["common"]]
        counts.append(len(short) - sum(counts))
        if sum(counts):
            assert abs(r["word_distance"] - distance(counts, ref["word_reference"])) < 1e-9
            compared += 1
    assert compared > 50
    words = [w.lower() for t in docs.where("lang = 'en'").collect() for w in brute.words(t["text"]) if len(w) <= 4]
    top = sorted(set(words), key=lambda w: (-words.count(w), w))[:3]
    assert reference["en"]["common"][:3] == top


def test_good_documents_stay_and_junk_goes(docs, folder):
    labels = docs.sparkSession.read.parquet(f"{folder}/labels.parquet")
    out = judged(docs).join(labels, "doc_id").where("n_words >= 80").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in out}
    assert n.get((1, False), 0) <= 0.02 * n[(1, True)]
    assert n.get((0, False), 0) > n.get((0, True), 0)


def test_classes_are_compared_in_small_languages_too(spark):
    good = [(i, " ".join(f"{'some words of plain text here'.split()[(i * k) % 6]}{chr(97 + k % 26)}" for k in range(120)), "en") for i in range(40)]
    plain = " ".join(f"sana{chr(97 + k % 26)}{chr(97 + k // 26)} ja" for k in range(60))
    junk = " ".join(f"#$%&|{k}***" for k in range(120))
    small = [(100, plain, "fi"), (101, junk, "fi"), (102, junk, None)]
    for table in (good + small, good[:10] + small[:2]):
        out = {r["doc_id"]: r for r in judged(spark.createDataFrame(table, "doc_id bigint, text string, lang string")).collect()}
        assert out[100]["kept"] and not out[101]["kept"] and not out[101]["base_failed"]
        assert out[100]["class_distance"] is not None and out[100]["word_distance"] is None
    assert out[101]["class_distance"] > 0.3


def test_odd_rows(odd, clashing, empty):
    a, b = (sorted(map(str, judged(t).collect())) for t in (odd, clashing))
    assert a == b and len(a) == odd.count()
    assert rules.passing(clashing).columns == clashing.columns
    assert rules.passing(empty).count() == 0 and judged(empty).count() == 0
    assert judged(odd.withColumn("lang", F.lit(None).cast("string"))).count() == odd.count()
