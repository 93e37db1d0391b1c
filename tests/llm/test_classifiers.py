"""Held-out accuracy of the classifiers, and their odd cases."""

from __future__ import annotations

import zlib

import time

import numpy as np
import pytest

from demandflow.llm import byte_cnn, toxicity

LARGER = "/root/testdata/sf0.1"
SCORES = {"quality": byte_cnn.quality_scores, "toxic": toxicity.toxicity_scores}
HELD_OUT = {"quality": (5, 0), "toxic": (4, 2)}


@pytest.mark.parametrize("label", SCORES)
def test_held_out_documents(spark, label):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    scores = {r["doc_id"]: r for r in SCORES[label](docs, labels).collect()}
    assert len(scores) == docs.count()
    folds, held = HELD_OUT[label]
    for i, r in scores.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % folds == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    known = [(r[label], scores[r["doc_id"]]) for r in labels.collect()]
    outside = [(y, s["predicted"]) for y, s in known if s["held_out"]]
    right = [np.mean([p == y for y, p in outside if y == k]) for k in (0, 1)]
    assert np.mean([p == y for y, p in outside]) >= 0.965 and min(right) >= 0.85, right


@pytest.mark.parametrize("label", SCORES)
def test_odd_rows_and_missing_labels(spark, folder, odd, clashing, empty, label):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for table in (odd, clashing):
        out = SCORES[label](table, labels).collect()
        assert len(out) == odd.count()
        assert all(r["held_out"] is False for r in out if r["doc_id"] is None)
    assert SCORES[label](empty, labels).count() == 0
    nothing = SCORES[label](odd, labels.limit(0)).collect()
    assert len(nothing) == odd.count() and len({r["score"] for r in nothing}) == 1


def test_chunks_cover_the_whole_text():
    for n in (0, 1, 511, 512, 513, 768, 769, 5000):
        data = bytes(range(1, 256)) * (n // 255 + 1)
        chunks = byte_cnn.cut(data[:n])
        joined = b"".join(c[: byte_cnn.STEP].tobytes() for c in chunks[:-1]) + chunks[-1].tobytes()
        assert joined.rstrip(b"\0") == data[:n]


def test_scoring_pools_the_same_windows_as_training():
    net = byte_cnn.Net.fresh()
    scorer = byte_cnn.Scorer(net)
    data = np.random.default_rng(3).integers(1, 256, 512, dtype=np.uint8).tobytes()
    pooled, _ = byte_cnn.pool(net, byte_cnn.cut(data), np.array([512]))
    assert np.allclose(scorer.pooled(data).max(axis=0), pooled.max(axis=0), atol=1e-5)


def test_training_reads_every_chunk(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(byte_cnn, "train", lambda chunks, lengths, bad: seen.append((chunks, lengths)))
    texts = {i: f"{i} " + "né text " * (i * 997) for i in range(1, 9)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id bigint, quality int")
    byte_cnn.fitted(docs, labels)
    [(chunks, lengths)] = seen
    used = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 0]
    assert [len(c) for c in chunks] == [len(byte_cnn.cut(texts[i].encode())) for i in used] and max(map(len, chunks)) > 100
    assert all(n[-1] == len(texts[i].encode()) - byte_cnn.STEP * (len(n) - 1) for n, i in zip(lengths, used, strict=True))
    net, many = byte_cnn.Net.fresh(), np.concatenate(chunks)[:2500]
    full = np.full(len(many), byte_cnn.CHUNK)
    pooled, at = byte_cnn.pool_all(net, many, full)
    last, last_at = byte_cnn.pool(net, many[-50:], full[-50:])
    assert (pooled[-50:] == last).all() and (at[-50:] == last_at).all()


def test_whole_texts_up_to_a_size():
    sizes = [(1, 0, 50), (2, 0, 60), (3, 0, 40), (4, 1, 500), (5, 1, 300)]
    assert byte_cnn.whole_texts(sizes, 100) == {1, 3, 5}
    assert byte_cnn.whole_texts(sizes, 1000) == {1, 2, 3, 4, 5}


def test_the_end_of_a_long_text_counts(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    net = byte_cnn.fitted(docs, labels)
    good = max((r["text"] for r in docs.where("lang = 'en'").collect()), key=lambda t: byte_cnn.Scorer(net).score(t.encode()))
    scorer = byte_cnn.Scorer(net)
    junk = " ".join(f"wo{i}rd###" for i in range(300))
    assert scorer.score((good * 20 + junk).encode()) == pytest.approx(
        min(scorer.score((good * 20).encode()), scorer.score((good * 20 + junk).encode()))
    )
    assert scorer.score((good * 20 + junk).encode()) < 0.3 or scorer.score(junk.encode()) >= 0.3


def test_lexicon_terms_are_words_and_beginnings():
    reader = toxicity.Reader(toxicity.Lexicon({"scum": 3.0, "achl*": 2.5}))
    terms, addresses = reader.hits("you scum scummy xscum achlich achl. du")
    assert [(s, t) for s, t, _ in terms] == [(4, "scum"), (22, "achl*")]
    assert addresses == [0, 36]
    plain, hidden = reader.features("you are scum"), reader.features("you are s.c.u.m")
    assert plain[toxicity.NAMES.index("word_density")] > 0 and hidden[toxicity.NAMES.index("hidden_density")] > 0
    assert len(plain) == len(toxicity.NAMES)


def test_near_addresses_equal_all_pairs_and_take_linear_time():
    reader = toxicity.Reader(toxicity.Lexicon({"idiot": 3.0, "stup*": 2.5}))
    random = np.random.default_rng(4)
    place = toxicity.NAMES.index("near_second_person")
    for _ in range(50):
        text = " ".join(random.choice(["you", "idiot", "stupid", "word", "x" * 30, "ihr"], size=60))
        terms, addresses = reader.hits(text.lower())
        near = sum(any(abs(a - t[0]) <= toxicity.REACH for a in addresses) for t in terms)
        assert reader.features(text)[place] == pytest.approx(np.log1p(near))
    began = time.process_time()
    assert reader.features("you " * 250_000 + "x" * 100 + " idiot" * 250_000)[place] == 0
    assert time.process_time() - began < 15
