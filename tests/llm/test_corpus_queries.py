"""Corpus queries against their SQL, and those without SQL against plain Python, on the smallest tables."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from check import assert_same, connect

import __spark_entry__ as entry_point
import corpus_pipeline
from millrace.llm import catalog

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.sql("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    assert_same(QUERIES[name](spark, sf), con, ORACLES[name])


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_url_rules(spark, sf, con):
    urls = dict(con.sql("SELECT page_id, url FROM pages").fetchall())
    rules = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
    got = QUERIES["op1_url_models"](spark, sf).collect()
    assert len(got) == len(urls)
    for r in got:
        rest = urls[r.page_id].split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("#")[0].split("?")[0]
        assert (r.host, r.path) == (host, path)
        fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fits:
            assert (r.rule, r.verdict) == (max(fits)[2], max(fits)[1])
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def test_encoding_round_trip(spark, sf, texts):
    got = QUERIES["op2_max_plus"](spark, sf).collect()
    assert {r.doc_id: r.text_crc32 for r in got} == {i: zlib.crc32(t.encode()) for i, t in texts.items()}


def test_base_scores(spark, sf, texts):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    tokens = {i: [*t.encode().lower().split(), None] for i, t in texts.items()}
    counts = collections.Counter(w for i in texts if not held[i] for w in tokens[i])
    total, kinds = sum(counts.values()), len(counts)
    got = QUERIES["op3_pitman_yor"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), total)
        assert r.n_known == sum(w in counts for w in tokens[r.doc_id])
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(base)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_id_files(spark, sf, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, want = 0, {}
    for i in sorted(texts):
        ids = [*model.encode(texts[i], add_special_tokens=False).ids, 2]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op7_id_files"](spark, sf).collect()} == want


def test_toxicity_columns(spark, sf, texts):
    got = QUERIES["op4_toxicity"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_pipeline(spark, sf, texts):
    """Each stage keeps the columns and a part of the rows; the last encodes every document left."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = set(texts)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "encoding"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).cache()
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert ids and ids <= seen
        if name == "encoding":
            assert ids == seen
        else:
            assert out.columns == docs.columns
            seen, docs = ids, out
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == seen


def test_scores_do_not_follow_the_session(spark, sf):
    """The number of shuffle partitions changes no score of the language model."""
    name = "spark.sql.shuffle.partitions"
    before, found = spark.conf.get(name), []
    try:
        for n in (3, 17):
            spark.conf.set(name, n)
            found.append({r.doc_id: r.score for r in QUERIES["op3_pitman_yor"](spark, sf).collect()})
    finally:
        spark.conf.set(name, before)
    assert found[0] == found[1]


def test_stages_pass_clashing_columns(spark, sf):
    """Columns named like a stage's own results come through as they are."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).selectExpr(
        "doc_id", "text", "lang", "source", "'s' AS score", "1 AS toxic", "2 AS removed_lines", "3 AS kept", "4 AS rep", "5 AS component_id").cache()
    extra = {r.doc_id: tuple(r)[4:] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert all(extra[r.doc_id] == tuple(r)[4:] for r in out.collect())


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).collect() == []
