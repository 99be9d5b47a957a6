"""Encoding, language model and id files on small inputs."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from millrace.llm import id_files, max_plus, pitman_yor, range_coder

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def table():
    return max_plus.Pieces(MODEL)


def brute_score(table, text):
    """Best sum of scores over all segmentations."""
    best = [0.0] + [-math.inf] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - table.longest), j):
            part = text[i:j]
            s = table.score.get(part, table.unknown if j - i == 1 else -math.inf)
            best[j] = max(best[j], best[i] + s)
    return best[-1]


TEXTS = [None, "", " ", "a", "Hello  world\n\n new   line ", "é日本 🙂\t", "x" * 300, "  lead and trail  ", "no_spaces_but_long_" * 20, "The quick brown fox. " * 30, "▁mark"]


@pytest.mark.parametrize("chunk", [10 ** 6, 64, 5])
def test_encoding(spark, table, chunk):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "y"), (None, "null id", "z")], "doc_id BIGINT, text STRING, ids STRING")
    ids = max_plus.encoded(docs, MODEL, chunk)
    got = max_plus.decoded(ids, MODEL).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "null id" if r.doc_id is None else TEXTS[r.doc_id]
        assert r.text == (text or "").replace("▁", " ")
        assert r.score == pytest.approx(brute_score(table, max_plus.marked(text)))
        if chunk == 5 and len(text or "") > 20:
            assert r.chunks > 3


def test_same_ids_as_the_library(table):
    """The library's own unigram search over the same pieces."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    encoder = max_plus.Encoder(table)
    for text in ("Hello world this is a test.", "Thatblent of anth, inou", "Zu und. Dieüauß der.", "que la ciónmente"):
        assert encoder.stretch(max_plus.marked(text)).tolist() == library.encode(text)


def test_levels_of_matrices(spark, table, monkeypatch):
    monkeypatch.setattr(max_plus, "FAN", 3)
    text = "words and morewords " * 60
    docs = spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")
    (r,) = max_plus.decoded(max_plus.encoded(docs, MODEL, 17), MODEL).collect()
    assert r.text == text and r.chunks > 27
    assert r.score == pytest.approx(brute_score(table, max_plus.marked(text)))


def test_a_chunk_is_split_once(table, monkeypatch):
    """And searched once in each of the two passes."""
    text, ahead = "some words  of a chunk\nthat goes on and on " * 9 + "unti", "l here and"
    encoder, calls = max_plus.Encoder(table), []
    split = table.units
    monkeypatch.setattr(table, "units", lambda t: calls.append(t) or split(t))
    units = table.units(text)
    encoder.learn([units])
    got = encoder.matrix(text, ahead, units)
    assert calls == [text]
    assert (got == max_plus.Encoder(table).matrix(text, ahead)).all()
    calls.clear()
    (ids,) = encoder.texts([text + ahead[:1]], [1])
    assert calls == [text + ahead[:1]]
    assert ids.tolist() == encoder.stretch(text + ahead[:1], 1).tolist()


def test_pieces_of_rows_are_joined_in_arrays(table):
    pieces = pa.array(table.bytes, pa.large_binary())
    rows = [[], [5, 300, 31_000], None, [300] * 4, []]
    for lists in (pa.array(rows, pa.list_(pa.int32())), pa.array([[9], *rows, [8]], pa.list_(pa.int32())).slice(1, 5), pa.array([], pa.list_(pa.int32()))):
        parts, counts = max_plus.joined_pieces(lists, pieces)
        want = lists.to_pylist()
        assert parts.to_pylist() == [b"".join(table.bytes[i] for i in r or []) for r in want]
        assert counts.to_pylist() == [len(r or []) for r in want]


def test_nothing_to_encode(nothing):
    assert max_plus.decoded(max_plus.encoded(nothing, MODEL), MODEL).collect() == []


def test_model_is_a_distribution():
    """In each context the probabilities of all words and the unknown one add up to one."""
    rng = np.random.default_rng(0)
    words = np.sort(rng.integers(0, 2 ** 63, 40).astype(np.uint64))
    contexts = np.array([0, 7, 9], np.uint16)
    each = np.full(len(words), len(contexts), np.uint16)
    counts = (rng.integers(0, 300, len(words) * len(contexts)) * (rng.random(len(words) * len(contexts)) < 0.6)).astype(np.uint32)
    own = pitman_yor.Range([[words, each, np.tile(contexts, len(words)), counts]], 0, 1)
    drawn = list(own.samples())
    totals = np.zeros((pitman_yor.SAMPLES, pitman_yor.CONTEXTS + 1, 4))
    for s, (tables, parent) in enumerate(drawn):
        assert (tables <= own.counts).all() and ((tables >= 1) == (own.counts >= 1)).all()
        totals[s, :-1, 0] = np.bincount(own.context, own.counts, pitman_yor.CONTEXTS)
        totals[s, :-1, 1] = np.bincount(own.context, tables, pitman_yor.CONTEXTS)
        totals[s, -1] = tables.sum(), parent.sum(), own.per_word.sum(), np.count_nonzero(own.per_word)
    again = pitman_yor.Range([[words, each, np.tile(contexts, len(words)), counts]], 0, 1)
    p = pitman_yor.predicted(again, totals)
    unseen = own.per_word == 0  # each stands for the one unknown word
    for u in contexts:
        of = own.context == u
        known = of & ~unseen[own.owner]
        one_unknown = p[of & unseen[own.owner]][:1].sum()
        assert p[known].sum() + one_unknown == pytest.approx(1) or not unseen.any()


def test_seating_expectation():
    """Tables of many equal restaurants come near the process's mean, by singles and by blocks."""
    rng = np.random.default_rng(0)
    d, theta, n = 0.5, 1.0, 1000
    mean = np.prod([(theta + d + i) / (theta + i) for i in range(n)]) * theta / d - theta / d
    tables = np.ones(4000)  # a full process: the weight of a new table grows with the tables
    for j in range(1, n):
        tables += rng.random(4000) * (theta + j) < theta + d * tables
    assert tables.mean() == pytest.approx(mean, rel=0.05)
    fresh = np.full(4000, 2.0)
    one = pitman_yor.seated(np.full(4000, 60), fresh, d, rng).mean()
    t = np.ones(4000)
    for j in range(1, 60):
        t += rng.random(4000) * (2.0 + j - d * t) < 2.0
    assert one == pytest.approx(t.mean(), rel=0.05)
    assert pitman_yor.seated(np.array([0, 1, 5000]), np.ones(3), d, rng)[:2].tolist() == [0, 1]


def test_blobs():
    arrays = [np.arange(7, dtype=np.uint64), np.empty(0, np.int64), np.array([1.5, -2], np.float32)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, pitman_yor.unblob(pitman_yor.blob(*arrays))))


def test_scores(documents, rows, nothing, monkeypatch):
    held = F.coalesce(F.col("doc_id") % 5 == 0, F.lit(True))
    got = pitman_yor.scored(documents, held).collect()
    assert len(got) == len(rows)
    assert all(r.score < 0 and r.n_known <= r.n_tokens for r in got)
    lengths = sorted(len((r["text"] or "").split()) + 1 for r in rows)
    assert sorted(r.n_tokens for r in got) == lengths
    monkeypatch.setattr(pitman_yor, "SPLIT", 50)  # texts over many splits
    again = pitman_yor.scored(documents, held).collect()
    key = lambda r: (r.doc_id or -1, r.n_tokens, round(r.base_score, 6))
    assert sorted(map(key, again)) == sorted(map(key, got))
    assert sum(r.score for r in again) == pytest.approx(sum(r.score for r in got), rel=1e-3)
    assert pitman_yor.scored(nothing, held).collect() == []


def test_nothing_to_learn_from(documents):
    got = pitman_yor.scored(documents, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.base_score == 0 and r.score == 0 for r in got)


def test_seatings_use_the_sums_of_all_words(spark, monkeypatch):
    """Scores do not follow the words that share a hash range: the sums are of all ranges, not one's times their number."""
    rows = [(i, " ".join(f"w{(i * j) % 97} the w{(i + j) % 7} rare{i}x{j}" for j in range(1, 12))) for i in range(120)]
    documents, found = spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), []
    for n in (1, 64):
        monkeypatch.setattr(pitman_yor, "LEAST_RANGES", n)
        found.append(sum(r.score for r in pitman_yor.scored(documents, F.col("doc_id") % 10 == 0).collect()))
    assert found[0] == pytest.approx(found[1], rel=0.003)


def test_no_context_stands_for_another(spark):
    """A word is scored by the words seen after its own context, also if other contexts' hashes are close to that one's."""
    alike, found = {}, None
    for i in range(10_000):  # of so many some fall together, whatever the number of classes up to a few million
        h = xxhash.xxh3_64_intdigest(f"a{i}".encode()) % 4095
        if h in alike:
            found = (f"a{alike[h]}", f"a{i}")
            break
        alike[h] = i
    u, v = found
    rows = [(i, f"{u} x" if i % 2 else f"{v} y", False) for i in range(60)] + [(100, f"{u} x", True), (101, f"{u} y", True)]
    documents = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, held BOOLEAN")
    got = {r.doc_id: r for r in pitman_yor.scored(documents, F.col("held")).collect()}
    assert got[100].base_score == pytest.approx(got[101].base_score)
    assert got[100].score > got[101].score + 1


@pytest.mark.parametrize("least", [0, 100_000])
def test_scores_are_those_of_all_pairs_in_one_place(spark, monkeypatch, least):
    """However pairs are dealt, by word or, for frequent words, by context."""
    monkeypatch.setattr(pitman_yor, "LEAST_FREQUENT", least)
    rows = [(i, " ".join(f"w{(i * j) % 97} the w{(i + j) % 7} rare{i}x{j}" for j in range(1, 12))) for i in range(120)]
    got = pitman_yor.scored(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), F.col("doc_id") % 10 == 0).collect()
    texts_ = {i: ["", *t.split(), ""] for i, t in rows}  # the end of a text, as a word, also stands before the first
    names = {w: k for k, w in enumerate(sorted({w for t in texts_.values() for w in t}))}
    pairs = sorted({(names[w], names[u]) for t in texts_.values() for u, w in zip(t, t[1:])})
    counts = collections.Counter((names[w], names[u]) for i, t in texts_.items() if i % 10 for u, w in zip(t, t[1:]))
    word, context = map(np.array, zip(*pairs))
    known, each = np.unique(word, return_counts=True)
    asks = [[known.astype(np.uint64), each, context, np.array([counts[p] for p in pairs])]]
    own = pitman_yor.Range(asks, 0, 1, len(names))
    totals = [own.sums(*drawn) for drawn in own.samples()]
    p = dict(zip(pairs, pitman_yor.predicted(pitman_yor.Range(asks, 0, 1, len(names)), totals)))
    want = {i: sum(math.log10(p[names[w], names[u]]) for u, w in zip(t, t[1:])) for i, t in texts_.items()}
    assert sum(r.score for r in got) == pytest.approx(sum(want.values()), rel=0.005)
    assert all(r.score == pytest.approx(want[r.doc_id], rel=0.05) for r in got)


def test_scores_do_not_follow_the_homes(spark, monkeypatch):
    """The tables of contexts are the same wherever they are summed."""
    rows = [(i, " ".join(f"w{(i * j) % 97} the w{(i + j) % 7} rare{i}x{j}" for j in range(1, 12))) for i in range(60)]
    documents, found = spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), []
    monkeypatch.setattr(pitman_yor, "LEAST_RANGES", 19)
    for n in (pitman_yor.HOMES, 1):
        monkeypatch.setattr(pitman_yor, "HOMES", n)
        found.append({r.doc_id: r.score for r in pitman_yor.scored(documents, F.col("doc_id") % 10 == 0).collect()})
    assert found[0] == found[1]


def test_places_and_steps():
    rng = np.random.default_rng(0)
    for n, m in ((1, 1), (5, 3), (100_000, 200_000)):
        places = rng.integers(0, n, m)
        stored = pitman_yor.unblob(pitman_yor.blob(*pitman_yor.by_frequency(places, n)))
        assert (pitman_yor.from_frequency(*stored) == places).all()
    rows = [rng.integers(0, 300, 50) for _ in range(4)]
    assert (pitman_yor.steps(rows) >= 0).all()
    assert (pitman_yor.from_steps(pitman_yor.steps(rows), 4) == np.stack(rows)).all()


STREAMS = [[], [0], [2 ** 32 - 1, 5], list(range(9000)), [7] * 5000, [1, 2, 3] * 4000]


@pytest.mark.parametrize("ids", STREAMS, ids=range(len(STREAMS)))
def test_coder_round_trip(ids):
    assert range_coder.unpacked(range_coder.packed(np.array(ids, np.int64))).tolist() == ids


def test_coder_random_and_skewed(monkeypatch):
    monkeypatch.setattr(range_coder, "BLOCK", 257)
    monkeypatch.setattr(range_coder, "LANES", 5)
    rng = np.random.default_rng(2)
    for ids in (rng.integers(0, 60_000, 8000), np.minimum(rng.zipf(1.3, 8000), 50_000), np.repeat(rng.integers(0, 9, 100), 90)):
        assert (range_coder.unpacked(range_coder.packed(ids)) == ids).all()


def test_coder_learns():
    rng = np.random.default_rng(2)
    phrase = rng.integers(0, 50_000, 40)
    assert len(range_coder.packed(np.tile(phrase, 400))) < 0.15 * 2 * 16_000
    skewed = np.minimum(rng.zipf(1.5, 400_000), 50_000)
    p = np.bincount(skewed) / len(skewed)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert 8 * len(range_coder.packed(skewed)) / len(skewed) < 1.25 * entropy


def test_damage_is_seen():
    raw = bytearray(range_coder.packed(np.arange(20_000) % 977))
    raw[-100] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        range_coder.unpacked(bytes(raw))
    with pytest.raises(ValueError, match="not a coded stream"):
        range_coder.unpacked(b"12345678")


def test_class_sizes_are_powers_of_two():
    """Shares within a class are cut by shifts."""
    assert (np.bincount(range_coder.CLASS) == 1 << range_coder.SHIFT).all()


def test_units_have_the_ids_of_whole_texts(monkeypatch):
    """Also beside rarer blanks and added tokens; a word is given to the tokenizer once."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", "\u200b", "a", "we'll", "Word", "12", "\u00e9", "\u65e5\u672c", "!", "<|endoftext|>", "\u0120", "\x00", "x" * 70]
    weights = [8, 3, 4, 2, 1, *[0.1] * 6, *[3] * 7, 0.2, 1, 1, 1]
    rng = np.random.default_rng(5)
    texts = ["", *("".join(rng.choice(parts, n, p=np.array(weights) / sum(weights))) for n in rng.integers(0, 40, 3000))]
    want = [np.array(c.ids, "<u4").tobytes() for c in model.encode_batch_fast(texts, add_special_tokens=False)]
    for memo in (id_files.MEMO, 20):
        monkeypatch.setattr(id_files, "MEMO", memo)
        units = id_files.Units(model)
        assert [raw for a in range(0, len(texts), 500) for raw in units.encoded(texts[a:a + 500])] == want
    given, coded = [], units._coded
    monkeypatch.setattr(units, "_coded", lambda found: given.extend(found) or coded(found))
    units.clear()
    units.encoded([" one two" * 500, " two one" * 500])
    assert sum(map(len, given)) == len(" one two")


def test_a_word_is_tokenized_once_beside_any_sign(monkeypatch):
    """Signs, digits and ends of words are units of their own, cut where the tokenizer cuts."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    units, given = id_files.Units(model), []
    coded = units._coded
    monkeypatch.setattr(units, "_coded", lambda found: given.extend(found) or coded(found))
    signs = ["", ",", ".", "!?", "'s", "12", "-", "...", "_", "\x00"]
    texts = [f" one{a} two{b} one\nthr\u00e9e{a}one{b}\n" for a in signs for b in signs]
    want = [np.array(c.ids, "<u4").tobytes() for c in model.encode_batch_fast(texts, add_special_tokens=False)]
    assert units.encoded(texts) == want
    assert "".join(given).count("one") == 3 and "".join(given).count("two") == 1  # " one", "one" and the end of a longer word


def test_units_end_where_the_tokenizer_cuts():
    """Beside letters and signs that are not in ASCII too, which may go on a run."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(7)
    parts = list("abZ09'.,-_!? \n\t") + ["'s", "'ll", "'x", "\u00e9", "\u00df", "\u0436", "\u65e5", "\u0301", "\u00b2", "\u00bd", "\u0663", "\u00aa", "\u00d7", "\u2014", "\x00", "\x7f"]
    texts = ["".join(rng.choice(parts, n)) for n in rng.integers(1, 40, 5000)]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)}'ll 1{chr(c)}.{chr(c)}?" for c in range(0x500)]
    want = [np.array(c.ids, "<u4").tobytes() for c in model.encode_batch_fast(texts, add_special_tokens=False)]
    assert id_files.Units(model).encoded(texts) == want


def test_other_tokenizers_get_whole_texts():
    from tokenizers import Tokenizer, normalizers

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.normalizer = normalizers.Lowercase()
    units = id_files.Units(model)
    assert not units.cuts
    assert units.encoded(["Some Words", ""]) == [np.array(model.encode("Some Words", add_special_tokens=False).ids, "<u4").tobytes(), b""]


def test_files(spark, documents, rows, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    monkeypatch.setattr(id_files, "FILE_IDS", 3000)
    made = id_files.write(documents, str(tmp_path / "ids"), path).collect()
    assert len(made) > 5 and sum(r.docs for r in made) == len(rows)
    got = id_files.read(spark, str(tmp_path / "ids")).orderBy("file", "at").collect()
    assert [r.doc_id for r in got] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i))
    want = sorted([(r["doc_id"] if r["doc_id"] is not None else -1, [*model.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in rows])
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == want
    short = id_files.starts(id_files.summaries(spark, str(tmp_path / "ids"))).orderBy("file", "at").collect()
    at = 0
    for a, b in zip(short, got):
        assert (a.start, a.n_tokens, a.ids_crc32) == (at, len(b.ids), zlib.crc32(np.array(b.ids, "<u4").tobytes()))
        at += a.n_tokens


def test_no_files(spark, nothing, tmp_path):
    assert id_files.write(nothing, str(tmp_path / "none"), public_tokenizers.path("byte_bpe_50k.json")).collect() == []
    assert id_files.starts(id_files.summaries(spark, str(tmp_path / "none"))).collect() == []
