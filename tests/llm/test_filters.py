"""URL models, toxicity and quality rules on small inputs."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import adaptive_rules, toxicity, url_models
from pyspark.sql import functions as F

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"))


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id BIGINT, url STRING, host STRING, score INT")


def test_rules_and_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://NET", "http://net/", "HTTP://A.Net/x?y#z", "http://example.net/en/1", "x://sub.example.net/en",
            "http://examplenet/en/", "http://a.net?q=/", "http://a.net/x://b", "http://é.net/é", "http://a.net/" + "p" * 5000, "http://a.net/x", "http://a.net/x"]
    got = {r.page_id: r for r in url_models.filtered(pages(spark, urls), RULES).collect()}
    assert len(got) == len(urls)
    assert [(got[i].host, got[i].path) for i in range(4)] == [("", "")] * 4
    assert (got[4].host, got[4].path, got[4].rule) == ("net", "", None)
    assert (got[5].rule, got[5].verdict) == ("net/", "block")
    assert (got[6].host, got[6].path, got[6].rule) == ("a.net", "/x", "net/")
    assert (got[7].rule, got[7].verdict) == ("example.net/en/", "allow")
    assert (got[8].path, got[8].rule) == ("/en", "net/")
    assert got[9].rule is None and got[10].rule is None
    assert (got[11].host, got[11].path) == ("a.net", "/x://b")
    assert got[14].verdict == got[15].verdict == "block"


def test_no_pages_and_one_class(spark):
    assert url_models.filtered(pages(spark, []), RULES).collect() == []
    only = url_models.filtered(pages(spark, ["http://a.net/", "http://b.org/"]), RULES).collect()
    assert sorted((r.rule, r.verdict) for r in only if r.rule) == [("net/", "block")]
    assert [r.verdict for r in only if not r.rule] == ["allow"]


def brute_log_probability(train, text, grams, order):
    """Interpolated Witten-Bell over kept grams, straight from the definition."""
    counts = Counter(t[i:i + n] for t in train for n in range(1, order + 2) for i in range(len(t) - n + 1))
    del counts[url_models.BEGIN]
    total = sum(len(t) - 1 for t in train)
    kept = {g: c for g, c in counts.items() if c * grams >= total}
    follow = defaultdict(dict)
    for g, c in kept.items():
        follow[g[:-1]][g[-1]] = c

    def p(context, char):
        lower = p(context[1:], char) if context else 1 / url_models.ALPHABET
        seen = follow.get(context)
        if not seen:
            return lower
        return (seen.get(char, 0) + len(seen) * lower) / (sum(seen.values()) + len(seen))

    return sum(math.log(p(text[max(0, i - order):i], text[i])) for i in range(1, len(text)))


def test_weights_add_up_to_the_models(spark):
    b, e = url_models.BEGIN, url_models.END
    good = [b + t + e for t in ("a.org/en/one", "b.org/en/two", "a.org/en/three")]
    bad = [b + t + e for t in ("spam.biz/win", "spam.biz/winner", "x.biz/cash")]
    urls = spark.createDataFrame([(t, True) for t in good] + [(t, False) for t in bad], "_text STRING, accepted BOOLEAN")
    weights = {r.gram: r.weight for r in url_models.weights(urls).collect()}
    base = []
    for t in [*good, *bad, b + "c.org/win" + e, b + "zzz" + e]:
        got = sum(weights.get(t[i:i + n], 0) for n in range(1, url_models.ORDER + 2) for i in range(len(t) - n + 1))
        want = brute_log_probability(good, t, url_models.GRAMS, url_models.ORDER) - brute_log_probability(bad, t, url_models.GRAMS, url_models.ORDER)
        base.append((want - got) / (len(t) - 1))
    # The back-off to the base is the same for every character, and left out.
    assert max(base) - min(base) < 1e-9


def test_plain_native_plan(spark, sf, capsys):
    url_models.filtered(spark.read.parquet(f"{sf}/pages.parquet"), RULES).explain()
    adaptive_rules.judged(spark.read.parquet(f"{sf}/documents.parquet")).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Arrow", "Pandas"))


def test_model_tells_hosts_apart(spark):
    urls = [f"http://good{i}.example.net/en/{i}" for i in range(80)] + [f"http://bad{i}.shop.net/buy/{i}" for i in range(80)]
    urls += ["http://good.example.com/en/7", "http://bad.shop.com/buy/7"]
    got = url_models.filtered(pages(spark, urls), RULES).collect()
    free = {r.host: r.verdict for r in got if r.rule is None}
    assert free == {"good.example.com": "allow", "bad.shop.com": "block"}


def test_query_and_odd_urls_are_judged_by_the_models(spark):
    """What follows ? or #, and a URL without a scheme, are part of what the models see."""
    urls = [f"http://shop.net/p{i}?spam=win&cash={i}" for i in range(80)] + [f"http://example.net/en/p{i}?page={i}" for i in range(80)]
    urls += ["http://a.com/p7?page=7", "http://a.com/p7?spam=win&cash=7", "http://a.com/p7#page=7", "http://a.com/p7#spam=win&cash=7", "page=7", "spam=win&cash=7"]
    got = sorted(url_models.filtered(pages(spark, urls), RULES).collect(), key=lambda r: r.page_id)[160:]
    assert all(good.score > 0.1 + bad.score for good, bad in zip(got[::2], got[1::2]))
    assert [r.path for r in got] == ["/p7"] * 4 + [""] * 2


def test_whole_urls(spark):
    urls = [None, "", "No Scheme", "HTTP://A.Net", "HTTP://A.Net/X?Y#Z", "http://A.net?Q", "x://", "http://a.net/x://B"]
    want = ["", "", "No Scheme", "HTTP://a.net", "HTTP://a.net/X?Y#Z", "http://a.net?Q", "x://", "http://a.net/x://B"]
    assert [r[0] for r in pages(spark, urls).orderBy("page_id").select(url_models.full(F.col("url"))).collect()] == want


def test_rare_grams_count_at_any_size(spark, monkeypatch):
    """Grams far below a fixed share of the input have weights, and are found by either join."""
    b, e = url_models.BEGIN, url_models.END
    monkeypatch.setattr(url_models, "GRAMS", 20)
    rows = [(b + "http://a.org/" + e, True)] * 300 + [(b + "http://b.org/" + e, False)] * 300 + [(b + "http://a.org/zq" + e, False)] * 2
    weights = {r.gram: r.weight for r in url_models.weights(spark.createDataFrame(rows, "_text STRING, accepted BOOLEAN")).collect()}
    assert weights["/zq"] < 0

    urls = [f"http://a{i}.shop.net/{i}" for i in range(60)] + [f"http://b{i}.example.net/en/{i}" for i in range(60)] + ["http://c.com/en/7", "http://shop.com/7", "", None]
    one = {r.page_id: r for r in url_models.filtered(pages(spark, urls), RULES).collect()}
    monkeypatch.setattr(url_models, "MOST_BROADCAST", 0)
    two = {r.page_id: r for r in url_models.filtered(pages(spark, urls), RULES).collect()}
    assert len(two) == len(urls)
    for i, r in one.items():
        assert two[i].score == pytest.approx(r.score, abs=1e-9) and two[i][:4] == r[:4] and two[i].verdict == r.verdict


def brute_counts(text):
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    windows = defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts(documents, rows):
    got = adaptive_rules.judged(documents).collect()
    want = Counter((r["doc_id"], *brute_counts(r["text"])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_limits_adapt(spark):
    """Many symbols are an outlier in one source and the style of another."""
    plain, odd = "plain words make a text of some ten words here ", "# code & more | of it < here > and there * so "
    data = [(i, plain * 3 + str(i), "en", "a") for i in range(300)] + [(i, odd * 3 + str(i), "en", "b") for i in range(300, 600)]
    data = [(i, "".join(f"{w}{i}{k} " for k, w in enumerate(t.split())), lang, s) for i, t, lang, s in data]
    data.append((999, " ".join(f"#$%{i}" for i in range(40)), "en", "a"))
    got = {r.doc_id: r.kept for r in adaptive_rules.judged(spark.createDataFrame(data, "doc_id BIGINT, text STRING, lang STRING, source STRING")).collect()}
    assert got.pop(999) is False
    assert all(got.values())


def test_junk_does_not_set_its_own_limit(spark):
    """A source with a quarter of its texts full of symbols, and a third of all rows, keeps none of these."""
    plain = lambda i: " ".join(f"word{i}x{k}" for k in range(30))
    junk = lambda i: " ".join(f"#$%{i}x{k}" for k in range(30))
    data = [(i, plain(i), "en", "ab"[i % 2]) for i in range(600)] + [(i, (plain if i % 4 else junk)(i), "en", "hot") for i in range(600, 900)]
    # One symbol, one repeated line or one repeated window is no pattern.
    data += [(1000, plain(500) + " $", "en", "a"), (1001, "one line\n" * 2 + plain(501), "en", "b"), (1002, plain(502) + " " + " ".join(plain(502).split()[:5]) + " " + plain(503), "en", "a")]
    got = {r.doc_id: r.kept for r in adaptive_rules.judged(spark.createDataFrame(data, "doc_id BIGINT, text STRING, lang STRING, source STRING")).collect()}
    assert {i for i, kept in got.items() if not kept} == set(range(600, 900, 4))


def test_nothing_to_judge(nothing):
    assert adaptive_rules.judged(nothing).collect() == []


def test_bins_hold_their_values(spark):
    values = spark.range(0, 5000).withColumn("bin", adaptive_rules.bin_of(F.col("id")))
    got = values.withColumn("low", adaptive_rules.low_end(F.col("bin"))).orderBy("id").collect()
    assert all(r.low <= r.id <= r.low * 1.04 for r in got)
    assert all(a.bin <= b.bin for a, b in zip(got, got[1:]))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    clean = [f"word{i}" for i in range(800)]
    out = []
    for i in range(1200):
        w = list(rng.choice(clean, rng.integers(5, 120)))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.integers(0, len(w)), rng.choice(["Idiot!", "moron", "scum,"]))
        out.append((i, " ".join(w), "en" if i % 2 else "de", int(toxic)))
    return out


def test_toxicity_held_out(spark, labelled):
    docs = spark.createDataFrame([r[:3] for r in labelled], "doc_id BIGINT, text STRING, lang STRING")
    labels = spark.createDataFrame([(r[0], 0, r[3]) for r in labelled] + [(None, 0, 1), (5000, 0, None), (0, 0, 1)], "doc_id BIGINT, quality INT, toxic INT")
    model = toxicity.fitted(docs, labels, F.col("doc_id") % 4 != 2)
    more = [(9000, None, "en"), (9001, "", None), (9002, "clean " * 200_000 + "moron", "xx"), (None, "you idiot scum moron", "en")]
    extra = spark.createDataFrame([r[:3] for r in labelled] + more, "doc_id BIGINT, text STRING, lang STRING").withColumn("score", F.lit("x")).withColumn("toxic", F.lit(7))
    got = toxicity.scored(extra, model).collect()
    assert len(got) == len(labelled) + len(more)
    by = {r.doc_id: r for r in got}
    out = [(by[i].score >= 0.3, t == 1) for i, _, _, t in labelled if i % 4 == 2]
    assert sum(a == b for a, b in out) >= 0.97 * len(out)
    assert by[9000].score == by[9001].score and not by[9000].toxic
    assert by[9002].score > 0.3 and by[None].score > 0.3


def test_language_is_no_input(labelled):
    model = toxicity.train([(t.encode(), y, lang) for _, t, lang, y in labelled[:400]], 0.2)
    assert set(model.by_language) <= {"en", "de"}
    one = toxicity.Scorer(model).logits([labelled[0][1].encode()])
    assert one[0] == pytest.approx(toxicity.Scorer(model).logits([b"x y z", labelled[0][1].encode()])[1])


def test_blocks_do_not_matter(labelled, monkeypatch):
    model = toxicity.train([(t.encode(), y, lang) for _, t, lang, y in labelled[:300]], 0.2)
    texts = [t.encode() for _, t, _, _ in labelled[:40]] + [None, b"", b"a", b"a b c " * 500]
    whole = toxicity.Scorer(model).logits(texts)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    monkeypatch.setattr(toxicity, "MEMO", 20)
    assert np.allclose(whole, toxicity.Scorer(model).logits(texts), atol=1e-4)


def test_no_labels(spark, nothing):
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    model = toxicity.fitted(nothing, labels, F.lit(True))
    assert toxicity.scored(nothing, model).collect() == []
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id BIGINT, text STRING, lang STRING")
    assert toxicity.scored(docs, model).first().score < 0.3


def test_every_labelled_text_is_learned_from(spark):
    """All rows of all shards, whatever their number and length."""
    def word(i):
        return f"own{i}x"

    data = [(i, f"{word(i)} {'idiot' if i % 3 == 0 else 'fine'} words", "en") for i in range(7000)]
    data += [(i, "calm " * 5000 + f"{word(i)} end", "en") for i in range(7000, 7010)]
    docs = spark.createDataFrame(data + data[:5], "doc_id BIGINT, text STRING, lang STRING")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _, _ in data], "doc_id BIGINT, toxic INT")
    model = toxicity.fitted(docs, labels, F.lit(True), toxicity.Fit(shard=2000, epochs=1, steps=1))
    seen = [model.whole[toxicity.buckets(word(i).encode())[0]].any() for i in range(7010)]
    assert 0.75 * 7010 < sum(seen) < 0.85 * 7010  # the others are kept for calibration
    assert 4 <= sum(seen[7000:]) <= 10
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert min(got[i] for i in range(0, 7000, 3)) > 0.5 > max(got[i] for i in range(7000) if i % 3)


def test_long_texts_alone_can_be_learned(spark):
    data = [(i, "calm words " * 2500 + ("moron" if i % 2 else "fine"), "en") for i in range(60)]
    docs = spark.createDataFrame(data, "doc_id BIGINT, text STRING, lang STRING")
    model = toxicity.fitted(docs, spark.createDataFrame([(i, i % 2) for i, _, _ in data], "doc_id BIGINT, toxic INT"), F.lit(True), toxicity.Fit(steps=60))
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert all((got[i] > 0.5) == (i % 2 == 1) for i in got)
