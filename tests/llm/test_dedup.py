"""Line spread, near duplicates, decontamination and unit hashing against brute force."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import lower_words, prose

import corpus_pipeline
from millrace.llm import bottom_k, line_spread, spaced_seeds, unit_hashes


def test_boilerplate_lines(documents, rows):
    sites = defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if line.split() and r["source"]:
                sites[line.strip()].add(r["source"])
    known = {x for x, s in sites.items() if len(s) >= 4}
    assert known

    def expected(text):
        lines = (text or "").split("\n")
        return "\n".join(x for x in lines if x.strip() not in known) if known & {x.strip() for x in lines} else text

    for most in (line_spread.MOST_BROADCAST, 0):  # both ways of reaching the texts
        got = line_spread.cleaned(documents, 4, most_broadcast=most)
        assert got.columns == [*documents.columns, "removed_lines"]
        found = [(r.doc_id, r.text) for r in got.collect()]
        want = [(r["doc_id"], expected(r["text"])) for r in rows]
        assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("most", [line_spread.MOST_BROADCAST, 0])
def test_every_boilerplate_line_is_cut(spark, most):
    """Also from texts that hold little or nothing else."""
    long = "All rights reserved by the owners of this and of all the other sites"
    data = [(i, f"own text {i} {'of some length ' * 9}\n{long}", f"s{i}", 0) for i in range(4)]
    data += [(4, f"short\n{long}", "s4", 0), (5, long, "s5", 0), (6, f"{long}\n\n{long}", "s5", 0), (7, "short\nowned", "s5", 0)]
    docs = spark.createDataFrame(data, "doc_id BIGINT, text STRING, source STRING, n_chars BIGINT")
    got = {r.doc_id: (r.text, r.removed_lines) for r in line_spread.cleaned(docs, 4, most_broadcast=most).collect()}
    assert got == {i: (t[:-len(long) - 1], 1) for i, t, _, _ in data[:4]} | {4: ("short", 1), 5: ("", 1), 6: ("", 2), 7: ("short\nowned", 0)}


def test_pipeline_cuts_every_boilerplate_line(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source", "n_chars")
    header = "A header that every one of these sites shows above its pages"
    extra = spark.createDataFrame([(10 ** 9 + i, f"{header}\npage {i}", f"site{i}", 0) for i in range(12)], docs.schema)
    out = corpus_pipeline.drop_boilerplate(spark, docs.union(extra), sf).where("doc_id >= 1000000000").collect()
    assert {(r.text, r.n_chars) for r in out} == {(f"page {i}", len(f"page {i}")) for i in range(12)}


def test_sketch_and_exact_counts_agree(spark):
    data = [(i, f"line {k} text", f"site{s}") for k in range(1, 40) for i, s in enumerate(range(k))]
    docs = spark.createDataFrame(data, "doc_id BIGINT, text STRING, source STRING")
    for least in (1, 2, 10, 30):
        assert line_spread.boilerplate(docs, least).count() == 40 - least


def test_no_lines(nothing):
    assert line_spread.cleaned(nothing, 2).collect() == []


@pytest.mark.parametrize("percent", [85, 50])
def test_components(documents, rows, brute_links, percent):
    want = brute_links(percent)
    got = bottom_k.linked(documents, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    assert max(np.unique([c for _, c in want.values()], return_counts=True)[1]) > 10


def test_components_from_sketches(documents, brute_links, monkeypatch):
    """Sets larger than a sketch: candidates come from sketches, and the full sets decide."""
    monkeypatch.setattr(bottom_k, "FULL", 100)
    monkeypatch.setattr(bottom_k, "K", 64)
    want = brute_links(85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in bottom_k.linked(documents, 85).collect() if r.doc_id is not None}
    assert got == want


def test_small_blocks_lose_no_link(documents, brute_links, monkeypatch):
    monkeypatch.setattr(bottom_k, "BLOCK_ROWS", 3)
    want = brute_links(60)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in bottom_k.linked(documents, 60).collect() if r.doc_id is not None}
    assert got == want


def test_one_of_each_group_stays(documents, rows, brute_links):
    got = bottom_k.kept(documents, 80)
    assert got.columns == documents.columns
    want = [r["doc_id"] for r in rows if r["doc_id"] is None or brute_links(80)[r["doc_id"]][1] == r["doc_id"]]
    assert sorted(r.doc_id or -1 for r in got.collect()) == sorted(i or -1 for i in want)


def test_no_documents(nothing):
    assert bottom_k.linked(nothing).collect() == []
    assert bottom_k.kept(nothing).collect() == []


def test_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 140)] + [(5, 9), (9, 7), (7, 5)], "a BIGINT, b BIGINT")
    got = {r.doc: r.component for r in bottom_k.components(links).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {5: 5, 7: 5, 9: 5}


ITEMS = [(0, " ".join(f"q{i}" for i in range(30))), (1, "short item of seven words it is"), (2, "too short"), (3, None), (None, "x " * 20),
         (4, " ".join(f"q{i}" for i in range(15)) + " " + " ".join(f"z{i}" for i in range(15))), (4, " ".join(f"q{i}" for i in range(15)) + " " + " ".join(f"z{i}" for i in range(15)))]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "e") for i, t in ITEMS], "item_id BIGINT, text STRING, doc_id STRING")


def brute_overlap(doc, item, least, percent):
    """Longest stretch on any diagonal that starts and ends equal and is equal enough, and holds a seed."""
    best = 0
    for shift in range(-len(item), len(doc)):
        equal = [0 <= i + shift < len(doc) and doc[i + shift] == item[i] for i in range(len(item))]
        places = [i for i, e in enumerate(equal) if e]
        for a in places:
            for b in places:
                if b - a + 1 > best and b - a + 1 >= min(least, len(item)) and 100 * sum(equal[a:b + 1]) >= percent * (b - a + 1):
                    if any(all(i + k < len(item) and equal[i + k] for k in mask) for mask in spaced_seeds.MASKS for i in range(a, b + 1)) or len(item) < spaced_seeds.SPAN and all(equal):
                        best = b - a + 1
    return best


def test_overlaps(spark, documents, items):
    rng = np.random.default_rng(1)
    own = [(5000, "w " * 40 + ITEMS[0][1] + " v" * 10)]
    for n in range(12):  # substituted tokens
        words = ITEMS[0][1].split()
        for k in rng.choice(30, n, replace=False):
            words[k] = f"other{k}"
        own.append((5001 + n, "a b c d e " + " ".join(words).upper() + " f g"))
    own += [(6000, "Short Item of seven words it is"), (6001, "short item of eight words it is"), (6002, " ".join(f"q{i}" for i in range(12))), (6003, " ".join(f"q{i}" for i in range(13))),
            (6004, ("noise " * 3000) + " ".join(f"z{i}" for i in range(15)) + " end" * 3000), (6005, None), (None, ITEMS[0][1]), (5000, "w " * 40 + ITEMS[0][1] + " v" * 10)]
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(own, "doc_id BIGINT, text STRING")).withColumnRenamed("n", "item_id")
    got = {(r.doc_id, r.item_id): r for r in spaced_seeds.overlaps(docs, items, 13, 80).collect()}
    want = {}
    for d, text in own:
        for i, item in ITEMS:
            if d is not None and i is not None and item and len(item.split()) >= spaced_seeds.SHORT:
                n = brute_overlap([w.lower() for w in (text or "").split()], item.split(), 13, 80)
                if n:
                    want[d, i] = n
    assert {k: r.n_tokens for k, r in got.items()} == want
    assert got[5000, 0].start == 40 and got[5000, 0].n_equal == 30
    assert {i for i in range(5001, 5007)} <= {d for d, _ in got}
    left = spaced_seeds.kept(docs, items)
    assert {d for d, _ in want}.isdisjoint(r.doc_id for r in left.collect())
    assert left.count() == docs.count() - sum(d in {a for a, _ in want} for d, _ in own)


def test_masks_miss_no_substitutions():
    """Every overlap of 13 to 20 tokens, ends equal, with as many substitutions as 80 percent allows."""
    for n in range(spaced_seeds.SHORT, 21):
        masks = spaced_seeds.MASKS if n >= 13 else spaced_seeds.short_masks(n, 80)
        fitted = [frozenset(i + p for p in m) for m in masks for i in range(n - m[-1])]
        for gone in itertools.combinations(range(1, n - 1), n // 5):
            assert any(f.isdisjoint(gone) for f in fitted), (n, gone)


def test_masks_miss_no_longer_overlap():
    """The fewest substitutions that keep all masks out of 13 to 33 tokens are more than 80 percent allows.

    A longer overlap holds one of these: one half of it is equal enough, and is so without unequal ends.
    """
    span = max(m[-1] for m in spaced_seeds.MASKS)
    masks = [sum(1 << (m[-1] - p) for p in m) for m in spaced_seeds.MASKS]
    fewest = {1: 0}  # by the last tokens as bits, set if equal
    for n in range(2, 34):
        equal, other = {}, {}
        for last, gone in fewest.items():
            bits = last << 1
            other[bits % (1 << span)] = min(gone + 1, other.get(bits % (1 << span), n))
            if not any((bits | 1) & m == m for m in masks):
                key = (bits | 1) % (1 << span)
                equal[key] = min(gone, equal.get(key, n))
        assert n < 13 or min(equal.values()) > n // 5
        fewest = other | equal


def test_substituted_overlaps_are_found(spark):
    """Patterns that four masks of seven places missed, and short items with a substituted word."""
    whole = [(0, [f"a{i}" for i in range(13)], (4, 8)), (1, [f"b{i}" for i in range(15)], (3, 7, 11)), (2, [f"c{i}" for i in range(20)], (4, 8, 12, 16))]
    whole += [(n, [f"n{n}x{i}" for i in range(n)], (n // 2,) if n < 10 else (3, n - 4)) for n in range(5, 13)]
    whole.append((50, [f"d{i}" for i in range(9)], (3, 6)))  # too few are equal
    items = spark.createDataFrame([(i, " ".join(w)) for i, w, _ in whole], "item_id BIGINT, text STRING")
    docs = spark.createDataFrame(
        [(100 + i, " ".join(["y"] * 20 + [f"other{k}" if k in gone else x for k, x in enumerate(w)] + ["z"] * 20)) for i, w, gone in whole], "doc_id BIGINT, text STRING")
    got = {tuple(r) for r in spaced_seeds.overlaps(docs, items, 13, 80).collect()}
    assert got == {(100 + i, i, 20, len(w), len(w) - len(gone)) for i, w, gone in whole if i < 50}


def test_long_overlaps_are_whole(spark):
    """A long item copied whole, and one with a long part replaced in the middle: one overlap each, of all tokens."""
    a, b = [f"a{i}" for i in range(3000)], [f"b{i}" for i in range(400)]
    items = spark.createDataFrame([(0, " ".join(a)), (1, " ".join(b))], "item_id BIGINT, text STRING")
    docs = spark.createDataFrame(
        [(10, " ".join(["y"] * 500 + a + ["z"] * 500)), (11, " ".join(["y"] * 7 + b[:170] + ["other"] * 70 + b[240:]))], "doc_id BIGINT, text STRING")
    got = {tuple(r) for r in spaced_seeds.overlaps(docs, items, 13, 80).collect()}
    assert got == {(10, 0, 500, 3000, 3000), (11, 1, 7, 400, 330)}


def test_longest_overlap():
    rng = np.random.default_rng(4)
    for _ in range(300):
        equal = rng.random(rng.integers(1, 40)) < 0.75
        fits = [(lo - hi, lo, hi) for lo in np.flatnonzero(equal) for hi in np.flatnonzero(equal) + 1 if hi - lo >= 5 and 100 * equal[lo:hi].sum() >= 80 * (hi - lo)]
        assert spaced_seeds.longest_overlap(equal, 5, 80) == (min(fits)[1:] if fits else None)


def test_nothing_to_overlap(spark, documents, nothing, items):
    none = spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert spaced_seeds.overlaps(nothing, items).collect() == []
    assert spaced_seeds.overlaps(documents, none).collect() == []
    assert spaced_seeds.kept(documents, none).count() == documents.count()


@pytest.mark.parametrize("by", ["line", "paragraph"])
def test_units(documents, rows, by):
    import re

    first, want = {}, set()
    seen = {}
    for r in sorted((r for r in rows if r["doc_id"] is not None), key=lambda r: r["doc_id"]):
        if r["doc_id"] in seen:
            continue
        seen[r["doc_id"]] = r["text"]
        text, at = r["text"] or "", 0
        gap = r"\n" if by == "line" else r"\n[ \t\x0b-\r]*\n\s*"
        ends = [(m.start(), m.end()) for m in re.finditer(gap, text)] + [(len(text), len(text))]
        for i, (a, b) in enumerate(ends):
            unit = tuple(lower_words(text[at:a]))
            if len(unit) >= unit_hashes.MIN_WORDS:
                if unit in first:
                    want.add((r["doc_id"], i, at, a - at, *first[unit]))
                else:
                    first[unit] = (r["doc_id"], i)
            at = b
    assert want
    assert {tuple(r) for r in unit_hashes.repeats(documents, by).collect()} == want


def test_units_cut(documents, rows):
    gone = {(r.doc_id, r.unit) for r in unit_hashes.repeats(documents).collect()}
    got = unit_hashes.cleaned(documents)
    texts = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)

    def left(r):
        if r["text"] is None or r["doc_id"] is None:
            return r["text"]
        lines = r["text"].split("\n")
        keep = [x + "\n" * (i < len(lines) - 1) for i, x in enumerate(lines) if (r["doc_id"], i) not in gone]
        return "".join(keep)

    assert texts == sorted(((r["doc_id"], left(r)) for r in rows), key=repr)
    assert got.columns == [*documents.columns, "removed"]


def test_passages_inside_lines(spark):
    """A run of 60 words shared inside longer lines, broken into lines elsewhere, with a changed word: all but its ends."""
    rng = np.random.default_rng(6)
    own = lambda n: [f"u{i}" for i in rng.integers(0, 10 ** 9, n)]
    shared = own(60)
    other = [*shared[:30], "changed", *shared[31:]]
    texts = [" ".join(own(40) + shared + own(40)), " ".join(own(33)) + "  é " + " ".join(shared).upper() + " " + " ".join(own(7)),
             "\n".join(shared[i:i + 7] and " ".join(shared[i:i + 7]) for i in range(0, 60, 7)) + "\n" + " ".join(own(20)), " ".join(own(9) + other + own(9)), " ".join(own(50))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    assert unit_hashes.repeats(docs, "line").collect() == []
    words = defaultdict(set)
    for r in unit_hashes.repeats(docs, "passage").collect():
        unit = texts[r.doc_id][r.start:r.start + r.n_chars].lower().split()
        assert len(unit) >= unit_hashes.MIN_WORDS and r.first_doc_id < r.doc_id
        assert " ".join(unit) in " ".join(texts[r.first_doc_id].lower().split())
        words[r.doc_id] |= set(unit)
    assert {d: w <= set(shared) for d, w in words.items()} == {1: True, 2: True, 3: True}
    assert len(words[1]) >= 35 and len(words[2]) >= 35 and len(words[3]) >= 15


def test_passages_part_a_text(documents, rows):
    got = {(r.doc_id, r.unit): r for r in unit_hashes.units(documents, "passage", 0).collect()}
    for r in rows:
        if r["doc_id"] is not None:
            mine = sorted((u for (d, _), u in got.items() if d == r["doc_id"]), key=lambda u: u.unit)
            assert [w for u in mine for w in lower_words(r["text"][u.start:u.start + u.n_chars])] == lower_words(r["text"])


def longest_repeats(texts, inside):
    """For each id, the most words in a row that an earlier text, or with ``inside`` the same one before, holds too; runs of ten words and more."""
    seen, out = set(), {}
    for i in sorted(texts):
        words = lower_words(texts[i])
        grams = [tuple(words[k:k + 10]) for k in range(len(words) - 9)]
        run = best = 0
        for g in grams:
            run = run + 1 if g in seen else 0
            best = max(best, run + 9 if run else 0)
            if inside:
                seen.add(g)
        seen.update(grams)
        out[i] = best
    return out


def test_runs_against_all_word_runs(spark):
    """On the given texts: all repeats of 50 words across documents are found, texts without a repeat of 30 words are left alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    found = {}
    for r in unit_hashes.runs(docs).collect():
        span = texts[r.doc_id][r.start:r.start + r.n_chars]
        assert len(lower_words(span)) == r.n_words and (r.first_doc_id, r.first_start) < (r.doc_id, r.start)
        found[r.doc_id] = max(found.get(r.doc_id, 0), r.n_words)
    want = {i for i, n in longest_repeats(texts, False).items() if n >= 50}
    assert len(want) > 50 and len(want & set(found)) >= 0.98 * len(want)
    longest = longest_repeats(texts, True)
    assert all(longest[i] >= 30 for i in found)


def test_planted_runs(spark):
    """Passages across lines and inside them, with other line ends and case; boilerplate lines and short repeats are no runs."""
    rng = random.Random(4)
    passage = [prose(rng, n, 10 ** 6) for n in (55, 60, 80, 200)]
    texts = {}
    for i in range(160):
        own = [prose(rng, rng.randint(20, 60), 10 ** 6) for _ in range(3)]
        if i % 2:
            own.insert(rng.randrange(4), passage[i // 2 % 4].replace(" ", "\n" if i % 3 else "  ", 7).upper())
        texts[i] = "\n".join([*own, "All rights reserved by the owners of this site and of others"]) if i % 5 else " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING").repartition(4)
    found = {r.doc_id for r in unit_hashes.runs(docs).collect()}
    assert found <= {i for i in texts if i % 2 and i > 7}
    assert len(found) >= 0.97 * len([i for i in texts if i % 2 and i > 7])


def test_hot_digest(spark):
    """A unit that most rows hold is joined apart from the others."""
    docs = spark.range(400).selectExpr("id AS doc_id", "CASE WHEN id % 4 = 0 THEN concat('only here number ', id, ' and so on') ELSE 'the same line in all of them' END AS text")
    found = unit_hashes.repeats(docs).collect()
    assert {r.doc_id for r in found} == {i for i in range(400) if i % 4} - {1} and {r.first_doc_id for r in found} == {1}


def test_no_units(nothing):
    assert unit_hashes.repeats(nothing).collect() == []
    assert unit_hashes.cleaned(nothing).collect() == []
    assert unit_hashes.runs(nothing).collect() == []
