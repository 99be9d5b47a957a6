import random

import pytest

# Every column may be null; some names are those of operators' own results.
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING, kept INT, value INT, n INT, hash STRING"


def lower_words(text):
    return (text or "").encode().lower().split()


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Small corpus with nulls, empty and blank texts, a long text, copies, near copies and repeated rows."""
    rng = random.Random(5)
    out = []

    def add(text, **other):
        i = len(out)
        out.append({"doc_id": i, "text": text, "lang": rng.choice(["en", "de", None]), "source": f"s{rng.randrange(6)}", "n_chars": len(text or ""),
                    "score": "x", "kept": 1, "value": None, "n": 2, "hash": "h"} | other)

    shared = prose(rng, 60)
    for i in range(60):
        add("\n".join(prose(rng, rng.randint(1, 40)) for _ in range(rng.randint(1, 5))))
    for i in range(12):  # a passage that many share
        add(prose(rng, 30, 5000) + "\n" + shared + "\nBoiler plate of the site", source=f"s{i % 6}")
    base = prose(rng, 150, 3000).split()
    for i in range(15):  # near copies
        near = list(base)
        for _ in range(i % 4):
            near[rng.randrange(len(near))] = f"new{rng.randrange(10 ** 6)}"
        add(" ".join(near))
    for text in (None, "", "   \n\t ", "one", "Two words", "a b c d e", "é日本 🙂 x", "word " * 30, "!!! ### $$$", "\n\nline\n\nline\n"):
        add(text)
        add(text, lang=None, source=None, n_chars=None)
    add(" ".join(prose(rng, 900, 9000) for _ in range(30)))  # long
    add("x" * 30_000)  # one long word
    out += [dict(out[3]), dict(out[70])]  # repeated rows
    out.append(dict(out[5], doc_id=None))
    out.append(dict(out[5], doc_id=None, text=None))
    return out


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def brute_links(rows):
    """Component and set size of each id, from all pairs."""
    def at(percent):
        sets = {}
        for r in rows:
            w = lower_words(r["text"])
            if r["doc_id"] is not None:
                k = min(5, len(w))
                sets[r["doc_id"]] = frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()
        low = {i: i for i in sets}
        linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        moved = True
        while moved:
            moved = False
            for a, b in linked:
                m = min(low[a], low[b])
                moved |= low[a] != m or low[b] != m
                low[a] = low[b] = m
        return {i: (len(sets[i]), low[i]) for i in sets}

    return at
