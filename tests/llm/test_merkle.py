from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOC_SCHEMA
from tidemark.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    i, text, lang, source, n = row[:5]
    fields = (i, source, lang, None if n is None else n + more, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [digest(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            steps = []
            for levels, j in ((trees[g], at), (top, place)):
                for level in levels[:-1]:
                    a = j - j % 2
                    steps.append(("".join(level[a:j]), "".join(level[j + 1:a + 2])))
                    j //= 2
            crc = zlib.crc32(("" if r[0] is None else str(r[0])).encode())
            x = leaf(r, 1 if crc % 7 == 0 else 0)
            for before, after in steps:
                x = digest(before, x, after)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0],
                        digest(*[b + a for b, a in steps]), x, x == top[-1][0]))
    return out


def same(df, rows):
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, brute(rows)))


def test_odd_rows(odd_docs, no_docs):
    same(merkle.verify(odd_docs), [tuple(r)[:5] for r in odd_docs.collect()])
    assert merkle.verify(no_docs).collect() == []


def test_groups_of_many_sizes_repeated_rows_and_a_hot_group(spark):
    langs = [None, "", "de", "en", "é", "z"]
    rows = [(i % 40 if i % 9 else None, "t" * (i % 7), langs[i % 6] if i < 400 else "hot", "s",
             i if i % 5 else None) for i in range(900)] + [(5, "x", "hot", "s", 1)] * 300
    docs = spark.createDataFrame(rows, DOC_SCHEMA).withColumns(
        {"rank": F.lit("a"), "grp": F.lit(1), "digest": F.lit(None)})
    same(merkle.verify(docs), rows)
    one = spark.createDataFrame(rows[:1], DOC_SCHEMA)
    same(merkle.verify(one), rows[:1])


def test_records_of_few_levels_wide_runs_and_chosen_requests(spark):
    rows = [(i, str(i), "en" if i % 3 else "de", "s", i) for i in range(100)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    m = merkle.manifest(docs, fanout=3, segment=2)
    assert len(m.leaf_stores) == 2 and len(m.group_stores) == 1
    root = m.root.first().digest
    got = merkle.prove(m, m.leaves.where("doc_id % 10 = 7")).select(
        "doc_id", "leaf", "digest", merkle.fold(F.col("leaf"), F.col("path")).alias("x")).collect()
    assert sorted(r.doc_id for r in got) == list(range(7, 100, 10))
    assert all(r.leaf == r.digest and r.x == root for r in got)


def test_equal_subtrees_are_stored_once(spark):
    docs = spark.createDataFrame([(1, "x", "en", "s", 1)] * 64, DOC_SCHEMA)
    m = merkle.manifest(docs, segment=2)
    assert [s.count() for s in m.leaf_stores] == [1, 1, 1]


def test_a_missing_record_ends_the_job(spark):
    docs = spark.createDataFrame([(i, "x", "en", "s", 1) for i in range(9)], DOC_SCHEMA)
    m = merkle.manifest(docs)
    m.leaf_stores[0] = m.leaf_stores[0].where("false")
    with pytest.raises(Exception, match="no record of digest"):
        merkle.prove(m).collect()
