from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm import brute
from demandflow.llm import dedup, near_dup
from demandflow.llm.common import file_place


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[brute.SPACE.sub(" ", r["text"] or "")].append(r["doc_id"])
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), brute.sha(text)) for i in ids]
    return sorted(out, key=str)


def weak(text):
    return F.substring(F.sha2(text, 256), 1, 1)


@pytest.mark.parametrize("options", [{}, {"batch_bytes": 1}, {"digest": weak}, {"digest": weak, "broadcast_digests": 0}])
@pytest.mark.parametrize("table", ["docs", "odd", "clashing"])
def test_classes_equal_brute_force(request, table, options):
    rows = request.getfixturevalue(table)
    out = dedup.duplicates(rows.repartition(4), **options).collect()
    found = sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in out), key=str)
    assert found == sorted((e[:3] for e in expected(rows.collect())), key=str)
    kept = [r["keep_id"] for r in out if r["kept"]]
    assert len(kept) == len({e[3] for e in expected(rows.collect())})
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_one_row_of_each_text_stays(odd, clashing, empty):
    for table in (odd, clashing):
        out = dedup.without_duplicates(table)
        texts = [brute.SPACE.sub(" ", r["text"] or "") for r in out.collect()]
        assert out.columns == table.columns and len(texts) == len(set(texts))
        assert len(texts) == len({e[3] for e in expected(table.collect())})
    assert dedup.duplicates(empty).count() == 0 and dedup.without_duplicates(empty).columns == empty.columns


def test_written_tables_are_not_copied(spark, odd, clashing, empty, tmp_path):
    """Rows told by file and row number give what written copies give, in both operators."""
    for i, table in enumerate((odd, clashing, empty)):
        table.repartition(3).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        for operator in (dedup.without_duplicates, near_dup.one_of_each):
            there, copied = operator(docs, written=True), operator(docs)
            assert there.columns == docs.columns
            assert sorted(str(r["doc_id"]) for r in there.collect()) == sorted(str(r["doc_id"]) for r in copied.collect())
    assert file_place(spark.range(3)) is None
