from __future__ import annotations

import random

import numpy as np
import pytest

from llm import brute
from demandflow.llm import near_dup


def check(table):
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    expected = brute.components(rows)
    out = near_dup.near_duplicates(table).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]], r["doc_id"]
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return out


def edited(random_, words, rate):
    return [w if random_.random() > rate else f"e{random_.randrange(10**9)}" for w in words]


def family(seed: int, groups: int, copies: int, shared_passage: bool) -> list[str]:
    """Groups of copies with more and more edits, some of them copies of copies, in texts of all lengths."""
    r = random.Random(seed)
    passage = [f"licence{i}" for i in range(60)]
    texts = []
    for g in range(groups):
        base = [f"g{g}w{r.randrange(400)}" for _ in range(r.choice([3, 6, 30, 150, 400]))]
        if shared_passage:
            base += passage
        members = [base]
        for _ in range(copies):
            members.append(edited(r, r.choice(members[:3]), r.choice([0.0, 0.005, 0.01, 0.02, 0.04, 0.08])))
        texts += [" ".join(m) for m in members]
    return texts


@pytest.mark.parametrize("shared_passage", [False, True])
def test_components_of_copies(spark, shared_passage):
    texts = family(3, 12, 25, shared_passage) + ["", " ", "a b", "A  b", "a b c"]
    random.Random(1).shuffle(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    out = check(table)
    assert len({r["component_id"] for r in out}) < len(out)


def test_one_large_group(spark):
    """A group whose lists are long is settled by leaders and gives the same components."""
    r = random.Random(9)
    base = [f"w{r.randrange(300)}" for _ in range(120)]
    texts = [" ".join(edited(r, base, r.choice([0.005, 0.01, 0.03, 0.06, 0.1]))) for _ in range(400)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4))


@pytest.mark.parametrize("leaders", [0, 1])
@pytest.mark.parametrize("seed", [4, 5])
def test_differences_alone_lose_no_link(spark, monkeypatch, leaders, seed):
    """Lists that are never compared pair by pair: chains of copies, several originals in one list, short texts."""
    monkeypatch.setattr(near_dup, "LEADER_ROUNDS", leaders)
    monkeypatch.setattr(near_dup, "SHORT", -1)
    r = random.Random(seed)
    texts = family(seed, 6, 30, True)
    base = [f"w{r.randrange(300)}" for _ in range(150)]
    for _ in range(120):  # a chain: far members have edits in common with near ones
        texts.append(" ".join(base))
        base = edited(r, base, r.choice([0.002, 0.006, 0.012]))
        if r.random() < 0.1:
            base = base[r.randrange(20) :] + [f"t{r.randrange(50)}" for _ in range(r.randrange(20))]
    r.shuffle(texts)
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4))


def test_members_of_many_lists_are_grouped_by_few_links(spark, monkeypatch):
    """Lists that hang together are one group, found from pairs of leaders, not from a link per member and list."""
    links, connected = [], near_dup.connected
    monkeypatch.setattr(near_dup, "connected", lambda edges: links.append(edges.count()) or connected(edges))
    rows = [(m, m * 100 + k, 1 + (m + k) % 3) for m in range(10, 210) for k in range(20)]  # leaders 1, 2, 3
    rows += [(leader, leader, leader) for leader in (1, 2, 3)]
    rows += [(m, 50_000, 300) for m in (300, 301, 302)]  # a list on its own
    members = spark.createDataFrame(rows, "id bigint, token bigint, at bigint")
    members = members.selectExpr("id", "token", "named_struct('id', at) AS leader")
    got = {r["id"]: r["group"] for r in near_dup.groups_of(members).collect()}
    assert got == {**{m: 1 for m in (1, 2, 3, *range(10, 210))}, **{m: 300 for m in (300, 301, 302)}}
    assert links[0] <= 3


def test_components_of_documents(docs):
    check(docs)


def test_odd_rows(odd, clashing, empty):
    out = near_dup.near_duplicates(odd).collect()
    by_text = {(r["doc_id"], r["n_shingles"]): r for r in out}
    assert len(out) == odd.count()
    assert by_text[(4, 0)]["component_id"] == 4 and by_text[(4, 0)]["kept"]
    assert by_text[(None, 1)]["component_id"] is None and by_text[(None, 1)]["kept"]
    assert by_text[(9, 1)]["component_id"] == 8 and by_text[(11, 1)]["component_id"] == 10
    assert sum(r["component_id"] == 1 for r in out) == 4
    assert sorted(map(str, out)) == sorted(map(str, near_dup.near_duplicates(clashing).collect()))
    assert near_dup.near_duplicates(empty).count() == 0
    for table in (odd, clashing):
        stay = near_dup.one_of_each(table)
        kept = sorted(str(r["doc_id"]) for r in stay.collect())
        # Empty texts stay, as does one row of each component, whatever other rows have its doc_id.
        assert stay.columns == table.columns
        assert kept == sorted(map(str, [1, 4, 5, 6, None, 7, 8, 10, 12, 5]))
    assert near_dup.one_of_each(empty).columns == empty.columns


def test_hashes_see_whole_words_and_case():
    def one(text: str) -> list[int]:
        return list(near_dup.shingle_sets([text.encode()]))[0].tolist()

    assert one("A b\tC\n d e f") == one("a B c d E F") and len(one("a b c d e f")) == 2
    assert one("ab c") != one("a bc") and one("É") != one("é")
    assert one("a b c d") != one("a b c d d")
    both = list(near_dup.shingle_sets([b"x y", b"", b"  ", b"x y"]))
    assert [len(s) for s in both] == [1, 0, 0, 1] and both[0] == both[3]


def test_signatures_estimate_similarity():
    r = np.random.default_rng(2)
    numbers = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    matches = []
    for i in range(40):
        part = numbers[i * 60 : i * 60 + 1400]
        a, b = part[:1200], part[200:]
        matches.append((near_dup.signature(np.sort(a)) == near_dup.signature(np.sort(b))).mean())
    assert abs(np.mean(matches) - 1000 / 1400) < 0.04
