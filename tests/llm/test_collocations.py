from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from demandflow.llm import collocations
from llm.brute import LOWER

SCHEMA = "lang string, text string"


def brute(rows, least=30, top=2000):
    count = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    count["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in count.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        inside = defaultdict(int)
        for p, v in f.items():
            if v >= least:
                for size in range(2, len(p)):
                    for i in range(len(p) - size + 1):
                        inside[p[i : i + size]] = max(inside[p[i : i + size]], v)
        found = []
        for p, a in f.items():
            if a >= least and len(p) > 1 and 100 * inside[p] < 80 * a:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(docs, **how):
    return sorted(map(tuple, collocations.collocations(docs, **how).collect()))


def texts(rng, words, number, size):
    weights = [1 / (k + 1) for k in range(len(words))]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! "]
    return ["".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=size)) for _ in range(number)]


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "The of And in É\xa0x".split(" ") for b in "abcdefgh"]
    fixed = ["new York City is", "per se", "in the end of the day", "of of of of of of"]
    rows = [("en", t + " " + " ".join(rng.choices(fixed, k=9))) for t in texts(rng, words, 60, 120)]
    rows += [("de", t) for t in texts(rng, words[:9], 40, 90)]
    rows += [(None, t) for t in texts(rng, words[:5], 30, 60)] + [("", "a b " * 40), ("fr", None), ("fr", "")]
    return rows


def test_all_phrases_equal_brute_force(spark, mixed):
    docs = spark.createDataFrame(mixed, SCHEMA).repartition(4)
    want = brute(mixed)
    assert {r[0] for r in want} == {"en", "de", "und", ""} and {len(r[2].split()) for r in want} == {2, 3, 4}
    assert found(docs) == want


def test_first_phrases_are_settled_without_growing_all(spark, mixed, monkeypatch):
    docs = spark.createDataFrame(mixed, SCHEMA).repartition(4)
    rounds = []
    grow = collocations.beside
    monkeypatch.setattr(
        collocations, "beside", lambda d, w, frontier, least: (rounds.append(frontier.count()), grow(d, w, frontier, least))[1]
    )
    assert found(docs, least=3, top=6, grown=4) == brute(mixed, least=3, top=6)
    few = sum(rounds)
    rounds.clear()
    assert found(docs, least=3, top=100_000) == brute(mixed, least=3, top=100_000)
    assert few < sum(rounds) / 2


def test_ties_at_the_limit_are_in_byte_order(spark):
    rows = [("en", ". ".join(f"{a}x {a}y" for a in "zyxéßabc"))] * 30
    docs = spark.createDataFrame(rows, SCHEMA)
    got = found(docs, top=3, grown=1)
    assert got == brute(rows, top=3) and [r[2] for r in got] == ["ax ay", "bx by", "cx cy"]


def test_small_steps_give_the_same_rows(spark, mixed, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 500)
    monkeypatch.setattr(collocations, "CHUNK", 64)
    monkeypatch.setattr(collocations, "PENDING", 50)
    monkeypatch.setattr(collocations, "FLUSH", 10)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 15)
    assert found(spark.createDataFrame(mixed, SCHEMA).repartition(2)) == brute(mixed)


def test_hash_of_a_word_does_not_depend_on_its_place():
    long = b"x" * 5_000
    words = [b"a", b"ab", b"b", long, b"\x00", "é".encode(), long + b"y"]
    alone = np.concatenate([collocations.hashed_words(w)[0] for w in words])
    together, piece = collocations.hashed_words(b"  " + b" ".join(words[:3]) + b"\n\n" + b" ".join(words[3:]) + b" ")
    assert len(set(alone.tolist())) == len(words) and (alone == together).all()
    assert piece.tolist() == [0] * 3 + [2] * 4
    assert len(collocations.hashed_words(b"")[0]) == len(collocations.hashed_words(b" \n ")[0]) == 0


def test_scores_beyond_64_bits_are_exact(spark):
    big = 4 * 10**18
    counted = spark.createDataFrame(
        [("en", "a", big, 1), ("en", "b", big + 3, 1), ("en", "a b", big - 1, 2)], "lang string, phrase string, a bigint, size int"
    )
    row = collocations.scored(counted).first()
    assert row["score"] == 2_000_000 * (big - 1) // (2 * big + 3) and not row["dropped"]


def test_real_documents_equal_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert found(docs) == brute(rows)


def test_odd_rows(spark, odd, clashing, empty):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    want = brute(rows)
    assert found(odd) == want and found(clashing) == want
    assert found(empty) == []


def test_very_long_text_in_one_piece(spark):
    rows = [("en", "one two three four " * 100_000 + "z" * 200_000)] * 2
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
