"""Exact dedup by sorting, against grouping in plain Python."""

import collections
import hashlib
import re

import pytest

from millrace.llm import content_sort


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def expected(pairs):
    """(doc_id, keep_id, group_size, kept, sha) of every row, sorted."""
    groups = collections.defaultdict(list)
    for i, text in pairs:
        groups[normal(text)].append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), n == 0, sha) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("ranges", [None, 1, 2, 13])
def test_groups(documents, rows, ranges):
    assert got(content_sort.classes(documents, ranges)) == expected([(r["doc_id"], r["text"]) for r in rows])


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_hot_groups_over_many_ranges(spark, ranges):
    """Groups that fill whole ranges, begin and end inside one, and meet at their ends; texts that differ after a long common head."""
    head = "h" * 300
    pairs = [(i, "same  text\n") for i in range(0, 900, 3)] + [(i, head + "a") for i in range(1, 400, 3)]
    pairs += [(i, head + "b") for i in range(401, 900, 2)] + [(5000 + i, f"{head}{i % 40}") for i in range(120)]
    pairs += [(9000, "same text "), (9001, "same text"), (9002, "SAME TEXT "), (9003, "same text ")]
    df = spark.createDataFrame(pairs, "doc_id BIGINT, text STRING").repartition(5)
    assert got(content_sort.classes(df, ranges)) == expected(pairs)


def test_one_group(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN NULL ELSE '' END AS text")
    found = content_sort.classes(df, 7).collect()
    assert {(r.keep_id, r.group_size) for r in found} == {(0, 2000)}
    assert [r.doc_id for r in found if r.kept] == [0]


def test_kept_rows(documents, rows):
    """One row of each group stays, with all columns, also those named like results."""
    left = content_sort.kept(documents, 5)
    assert left.columns == documents.columns
    found = [r.asDict() for r in left.collect()]
    best = {}
    for r in rows:
        at, key = normal(r["text"]), (r["doc_id"] is None, r["doc_id"] or 0)
        best[at] = min(best.get(at, key), key)
    assert sorted((normal(r["text"]), (r["doc_id"] is None, r["doc_id"] or 0)) for r in found) == sorted(best.items())
    assert all(r in rows for r in found)


def test_rows_without_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a  b"), (None, "c"), (4, "c"), (None, None)], "doc_id BIGINT, text STRING")
    assert sorted((r.doc_id, r.text.split()) if r.text else (None, []) for r in content_sort.kept(df, 3).fillna({"doc_id": -1}).collect() if r.text) == [
        (-1, ["a", "b"]), (4, ["c"])]


def test_nothing(nothing):
    assert content_sort.classes(nothing).collect() == []
    assert content_sort.kept(nothing).collect() == []
