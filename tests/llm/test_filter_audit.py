"""The filter audit, against masks and orders in plain Python."""

import collections
import itertools
import random
import re

import pytest

from millrace.llm import filter_audit

DOCS = "doc_id BIGINT, text STRING, lang STRING, part STRING, mask INT, deal BIGINT"
LABELS = "doc_id BIGINT, quality INT, toxic INT"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def fails(text):
    words = WORD.findall(text)
    return {
        "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
    }


def expected(docs, labels):
    """Rows of the report by part, order and step."""
    least = {}
    for i, text, *_ in docs:
        key = (i is None, i)
        least[text or ""] = min(least.get(text or "", key), key)
    counts = collections.Counter()
    for i, text, lang, *_ in docs:
        found = fails(text or "") | {"E": (i is None, i) > least[text or ""]}
        good = any(d == i and q == 1 for d, q, _ in labels if i is not None)
        toxic = any(d == i and t == 1 for d, _, t in labels if i is not None)
        counts[lang or "", frozenset(f for f, bad in found.items() if bad), good, toxic] += 1
    out = {}
    for part in {k[0] for k in counts}:
        removed_by = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, own in enumerate(order, 1):
                row = collections.Counter()
                for (p, bad, good, toxic), n in counts.items():
                    if p != part:
                        continue
                    gone, removed = bool(bad & set(order[:step - 1])), own in bad and not bad & set(order[:step - 1])
                    row["kept"] += n * (not gone and own not in bad)
                    row["removed"] += n * removed
                    row["redundant"] += n * (gone and own in bad)
                    row["unique_fails"] += n * (bad == {own})
                    row["good_lost"] += n * (removed and good)
                    row["toxic_lost"] += n * (removed and toxic)
                removed_by[own] += row["removed"]
                out[part, order, step] = [row[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


def report(counts):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in filter_audit.report(counts).collect()}


@pytest.fixture(scope="module")
def corpus():
    """Copies whose smallest id comes late, over parts, with null ids and texts and repeated rows."""
    rng = random.Random(8)
    docs = []
    for i in range(240):
        kind = rng.randrange(6)
        text = [None, "", "same text", "SAME Text #", " ".join(f"w{rng.randrange(3)}" for _ in range(210)),
                " ".join(f"é{k}" for k in range(rng.choice([199, 200])))][kind]
        docs.append((500 - i if i % 2 else 1000 + i, text, rng.choice(["en", "de", "", None]), "x", 9, 1))
    docs += [(None, "same text", "en", "x", 9, 1), (None, "only without id", "de", "x", 9, 1), (None, "only without id", "en", "x", 9, 1)]
    docs += [docs[0], docs[0], (docs[3][0], docs[3][1], "fr", "x", 9, 1)]
    labels = [(d[0], rng.randrange(2), rng.randrange(2)) for d in docs[:150]] + [(docs[1][0], None, 1), (None, 1, 1), (7, None, None)]
    return docs, labels


def files(spark, tmp_path, docs, n):
    """The rows in ``n`` files, one after another."""
    path = str(tmp_path / "documents.parquet")
    for i in range(n):
        spark.createDataFrame(docs[i::n], DOCS).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("n,per_batch", [(1, 1), (4, 1), (4, 3)])
def test_report(spark, tmp_path, corpus, n, per_batch):
    docs, labels = corpus
    stream = filter_audit.stream(spark, files(spark, tmp_path, docs, n), files=per_batch)
    counts = filter_audit.counters(stream, spark.createDataFrame(labels, LABELS)).cache()
    assert report(counts) == expected(docs, labels)
    assert counts.agg({"n": "sum"}).first()[0] == len(docs)


def test_a_smaller_id_takes_back(spark, tmp_path):
    """Every batch brings a smaller id of the same text; the folder shows what was counted and taken back."""
    path, out, progress = str(tmp_path / "documents.parquet"), str(tmp_path / "out"), str(tmp_path / "progress")
    labels = spark.createDataFrame([(2, 1, 0)], LABELS)
    for i, lang in ((3, "en"), (2, "de"), (1, "en")):
        spark.createDataFrame([(i, "t", lang, "x", 9, 1)], DOCS).coalesce(1).write.mode("append").parquet(path)
        counts = filter_audit.counters(filter_audit.stream(spark, path), labels, folder=out, checkpoint=progress).collect()
    a, e = 1, 16
    changes = [sorted(tuple(r)[:4] for r in spark.read.parquet(f"{out}/batch={b}").select("part", "mask", "flags", "n").collect()) for b in range(3)]
    assert changes == [
        [("en", a, 0, 1)],
        [("de", a, 1, 1), ("en", a, 0, -1), ("en", a | e, 0, 1)],
        [("de", a, 1, -1), ("de", a | e, 1, 1), ("en", a, 0, 1)],
    ]
    assert sorted(tuple(r) for r in counts) == [("de", a | e, 1, 1), ("en", a, 0, 1), ("en", a | e, 0, 1)]


def test_hot_text_is_folded(spark):
    """A task sends one row for a text, with the counts of all its rows."""
    rows = spark.range(1000).coalesce(1).selectExpr(
        "id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'en' ELSE 'de' END AS part", "1 AS mask", "CAST('k' AS BINARY) AS text_sha", "0 AS flags")
    found = filter_audit.folded(rows).collect()
    assert len(found) == 1 and found[0].least == 0
    assert sorted(tuple(c) for c in found[0].others) == [("de", 17, 0, 500), ("en", 17, 0, 499)]


def test_settings_are_given_back(spark, tmp_path, corpus):
    before = {k: spark.conf.get(k, None) for k in filter_audit._STATE}
    filter_audit.counters(filter_audit.stream(spark, files(spark, tmp_path, corpus[0][:5], 1)), spark.createDataFrame([], LABELS))
    assert {k: spark.conf.get(k, None) for k in filter_audit._STATE} == before


def test_nothing(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([], DOCS).write.parquet(path)
    counts = filter_audit.counters(filter_audit.stream(spark, path), spark.createDataFrame([], LABELS))
    assert filter_audit.report(counts).collect() == []
