from __future__ import annotations

import random
import re
import time

from llm import brute
from demandflow.llm import pii

TRICKY = [
    "a@b.c.d@e.f x@y.z_w@q.r.",
    "a@b.c_d@e.f and a@b and @b.c and .@x.y",
    "mail: john.doe+x@mail-1.example.co.uk, next%20@a-b.c",
    "1.2.3.4.5 256.1.1.1 001.002.003.255 1.2.3 10.0.0.1.",
    "01.2.3.4.5.6.7.8 999999999999999999999.1.1.1",
    "4539 1488 0343 6467 and 4539-1488-0343-6467 45391488034364670 4539148803436467-4539148803436467",
    "card 3782 822463 10005, 6011000990139424 60110009901394240000",
    "+1 (017) 555-7713 rest +1 (171) 555-2028 0810992847249404 +12 +1() 3 +49.30.123456-78- x",
    "+1 555 +1 555 12345 ++123456789 +1((((((((((((((((((((((((((",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 but DE88370400440532013000",
    "my ssn is 123-45-6789, not 123-45-6789-1; number 123-45-6789",
    "\U0001f600 é a@b.cc \U0001f600 10.1.1.1",
    "9" * 3000 + " " + "1 " * 2000 + "a" * 3000 + "@" + "b" * 3000 + ".c" * 500,
]


def findings(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {}
    for r in pii.personal_data(docs).collect():
        out[r["doc_id"]] = [(f["kind"], f["start"], f["end"], f["score"]) for f in r["findings"]]
    return out


def test_base_spans_equal_the_plain_patterns(spark, docs):
    random.seed(4)
    alphabet = ["a", "b@", "@", ".", "1", "25", "255", ".7", "+", " ", "-", "(", ")", "4539148803436467", "_", "%", "\n"]
    noise = ["".join(random.choices(alphabet, k=60)) for _ in range(400)]
    texts = TRICKY + noise + [r["text"] for r in docs.select("text").collect()]
    for i, found in findings(spark, texts).items():
        base = [f[:3] for f in found if f[0] in brute.PERSONAL]
        assert base == brute.personal(texts[i]), texts[i][:300]


def test_checked_and_hinted_kinds(spark):
    found = findings(spark, TRICKY)
    texts = {(k, TRICKY[i][s:e]) for i, spans in found.items() for k, s, e, _ in spans if k not in brute.PERSONAL}
    assert texts == {
        ("iban", "DE89 3704 0044 0532 0130 00"),
        ("iban", "GB82WEST12345698765432"),
        ("ssn", "123-45-6789"),
    }
    near, far = findings(spark, ["phone: +1 555 123 4567", "x: +1 555 123 4567"]).values()
    assert near[0][3] > far[0][3]


def test_odd_rows(odd, clashing, empty):
    a = sorted(map(str, pii.personal_data(odd).collect()))
    assert a == sorted(map(str, pii.personal_data(clashing).collect()))
    assert len(a) == odd.count() and pii.personal_data(empty).count() == 0


def test_hints_reach_over_matches_and_blocks(spark):
    """Every span's score, by looking at the code points before it."""
    random.seed(9)
    pieces = ["phone ", "call me ", "x ", "+1 555 123 4567;", "10.1.1.1 ", "from ", "a@b.cc ", "mail:", "é\U0001f600 ", "y" * 50]
    texts = ["".join(random.choices(pieces, k=k)) for k in (3, 50, 200, 2000, 9000) for _ in range(4)]
    kinds = {k.name: k for k in pii.KINDS}
    for i, found in findings(spark, texts).items():
        assert [f[:3] for f in found if f[0] in brute.PERSONAL] == brute.personal(texts[i])
        for name, start, _, score in found:
            near = texts[i][max(0, start - pii.CONTEXT) : start].lower()
            hint = re.search(kinds[name].hints, near) is not None
            assert abs(score - kinds[name].score - 0.8 * hint * (1 - kinds[name].score)) < 1e-9, (name, near)


def test_many_matches_take_about_linear_time(spark):
    texts = [" ".join(f"user{i}@mail{i % 7}.example.com" for i in range(200_000)), "10.20.30.40, " * 200_000, "+1 555 123 4567; " * 100_000]
    found = findings(spark, ["a@b.cc"])
    began = time.time()
    found = findings(spark, texts)
    assert [len(f) for f in found.values()] == [200_000, 200_000, 100_000]
    assert time.time() - began < 60
    assert [f[:3] for f in found[0]] == brute.personal(texts[0])
