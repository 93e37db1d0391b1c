from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandflow.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_both_files_give_the_same_ids(ids, docs):
    fast = packing.encoder(RANKS)
    r = random.Random(6)
    characters = "aZ09 \t\n\r\x0b\x0c\x1c\x85\xa0  　​'’sßéñ漢字かな한٣४²Ⅷ\U0001f600\U0001d7d8<|endoftext|>_-.,!"
    noise = ["".join(r.choices(characters, k=80)) for _ in range(2000)]
    texts = [*noise, "a" * 3000, " " * 500 + "x", "<|endoftext|>", *(x["text"] for x in docs.limit(100).collect())]
    for text in texts:
        assert fast(text) + [0] == ids(text), text[:100]


def test_end_of_text_is_one_id(spark, ids):
    mark = "<|endoftext|>"
    texts = [mark, f"hello {mark} world", mark * 3, f"{mark}a{mark}", f" {mark} \n{mark}\n ", mark[:-1], f"a{mark} b" * 3000]
    texts += ["word " * 2046 + mark + " tail" * 3000, " " * 9000 + mark, mark + "\n" * 5000 + mark, f"<|{mark}|>"]
    assert ids(mark) == [50256, 0] and len(ids(f"hello {mark} world")) == 5
    fast = packing.encoder(RANKS)
    for text in texts:
        assert fast(text) + [0] == ids(text), text[:100]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), ids)


def test_long_white_space(spark, ids):
    r = random.Random(7)
    runs = [" " * 2_000_000 + "x", "\n" * 2_000_000, "x" + " \n" * 1_000_000, "a\u3000" + "\x1c" * 9000 + " b"]
    around = ["x" * r.randrange(5000) + " " * n + "y z" for n in (4095, 4096, 8191, 8192, 1_000_000)]
    table = spark.createDataFrame(list(enumerate([*runs, *around, "short"])), "doc_id bigint, text string")
    check(table, ids)


def check(table, ids):
    rows = table.collect()
    out = packing.pack(table, RANKS).collect()
    expected = Counter()
    for r in rows:
        numbers = np.array(ids(r["text"]), dtype="<u4")
        for i, (start, length) in enumerate(packing.cut(len(numbers), 2048)):
            expected[(r["doc_id"], i, start, length, zlib.crc32(numbers[start : start + length].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == expected
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return sequences


def test_pieces_and_sequences(docs, ids):
    sequences = check(docs, ids)
    total = sum(length for parts in sequences.values() for _, length in parts)
    assert len(sequences) <= 1.02 * total / 2048 + 1


def test_odd_rows(odd, clashing, empty, ids):
    a, b = check(odd, ids), check(clashing, ids)
    assert len(a) == len(b)
    assert packing.pack(empty, RANKS).count() == 0


@pytest.mark.parametrize("n", [1, 2, 2047, 2048, 2049, 4096, 4097, 10_000])
def test_only_the_first_piece_may_be_shorter(n):
    pieces = packing.cut(n, 2048)
    assert [s for s, _ in pieces] == list(np.cumsum([0] + [length for _, length in pieces])[:-1])
    assert sum(length for _, length in pieces) == n and all(length == 2048 for _, length in pieces[1:])
    assert 0 < pieces[0][1] <= 2048


@pytest.mark.parametrize("seed", range(6))
def test_layout_places_every_item_once(seed):
    r = random.Random(seed)
    histogram = {length: r.choice([1, 2, 7, 1000]) for length in r.sample(range(1, 65), 30)}
    plan = packing.layout(histogram, 64)
    fill, items = defaultdict(list), Counter()
    for length, first, count, per, first_bin, place in plan.slots:
        assert items[length] == first
        items[length] += count
        for i in range(count):
            fill[first_bin + i // per].append((place + i % per * length, length))
    assert items == Counter(histogram) and len(fill) == plan.bins
    for parts in fill.values():
        end = 0
        for place, length in sorted(parts):
            assert place == end
            end += length
        assert end <= 64
        assert sum(3 * length > 64 for _, length in parts) <= 2
    assert plan.bins <= 11 / 9 * (sum(k * n for k, n in histogram.items()) / 64) + sum(histogram.values()) * 0.5
