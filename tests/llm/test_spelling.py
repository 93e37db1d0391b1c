from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from demandflow.llm import spelling
from llm.brute import LOWER


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if n >= 2 and len(w) >= 7}


def near_of(words):
    """Words by their patterns with one place left open, and with one place left out."""
    near, held = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            held[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for alike in held.values():
        for w in alike:
            near[w] |= alike - {w}
    return near


def brute(rows):
    words = counted(rows)
    near = near_of(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, spelling.variants(frame).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 20)
    monkeypatch.setattr(spelling, "LEAF", 3)
    monkeypatch.setattr(spelling, "PAIR_BYTES", 100)


def edited(words, rng, letters):
    out = []
    for w in words:
        k = rng.randrange(len(w))
        out.append(rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]]))
    return out


@pytest.mark.parametrize("letters", ["abc", "abcdefghijklmnop", "aeßÀé×÷ÿ"])
def test_random_words_equal_brute_force(spark, small_cells, letters):
    rng = random.Random(len(letters))
    words = ["".join(rng.choices(letters, k=rng.randint(6, 12))) for _ in range(60)]
    words += edited(words, rng, letters) + edited(words, rng, letters)
    words += ["".join(rng.sample(w, len(w))) for w in words[:40]]  # equal counts in another order
    rows = [(i, " ".join(w.upper() if i % 3 == 0 else w for w in rng.choices(words, [k % 40 + 1 for k in range(len(words))], k=80))) for i in range(40)]
    got = found(frame(spark, rows))
    assert got == brute(rows) and sum(r[4] for r in got) > 50


def test_chains_of_forms_end_in_one_root(spark):
    chain = ["preceding", "precedingx", "precedingxy", "precedingxyz", "precedinxyz"]
    text = lambda i: " ".join(f"{w}." for k, w in enumerate(chain) for _ in range(3 * 11**k) if zlib.crc32(f"{i}:{w}".encode()) % 31)
    doc = next(i for i in range(100) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in chain))
    rows = [(doc, text(doc))]
    got = {r[0]: (r[1], r[2]) for r in found(frame(spark, rows))}
    assert got[chain[0]] == (chain[1], chain[-1]) and got[chain[3]] == (chain[4], chain[-1]) and got[chain[4]] == (None, chain[4])


def test_ties_go_to_the_first_in_code_point_order(spark):
    words = {"variant": 2, "variantz": 30, "variants": 30, "variantß": 30}
    doc = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in words))
    got = {r[0]: r for r in found(frame(spark, [(doc, " ".join(w for w, n in words.items() for _ in range(n)))]))}
    assert got["variant"][1:] == ("variants", "variants", 2, 3, 30) and got["variants"][4] == 3


def test_real_documents_equal_brute_force(spark, docs, small_cells):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == brute(rows)


def test_large_cells_are_searched_in_parts(spark, small_cells):
    rng = random.Random(3)
    words = list({"".join(rng.sample("abcdefgh", 8)) for _ in range(150)})  # no tree tells these apart
    words += edited(words, rng, "abcdefgh")
    rows = [(i, " ".join(words)) for i in range(4)]
    assert found(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark, odd, clashing, empty):
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert found(odd) == want and found(clashing) == want
    assert found(empty) == []


def test_very_long_words_and_texts(spark):
    long = "ab" * 20_000
    rows = [(i, f"{long} {long}c {long[:-1]}c {long[:-2]} {'word' * 2} " * 3 + "lettera letterb " * 50_000) for i in range(2)]
    assert found(frame(spark, rows)) == brute(rows)
