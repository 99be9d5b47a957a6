"""Fill-in-middle over compressed frames, against plain slicing."""

import hashlib
import io
import random
import re

import pytest
import zstandard

from millrace.llm import fim_frames

UNIT = {"line": r"[^\n]*\n|[^\n]+", "char": r"(?s)."}


def expected(i, text, unit, percent=100, spm=50):
    """n, form, prefix and middle characters, and output."""
    text = text or ""
    parts = re.findall(UNIT[unit], text)
    sha = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(sha[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted(x % (len(parts) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(parts), "plain", None, None, text
    pre, mid, suf = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < spm:
        return len(parts), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(parts), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(df, pairs, unit, frame, **shares):
    store = fim_frames.stored(df, unit, frame).cache()
    output = fim_frames.transformed(store, unit=unit, **shares).cache()
    want = sorted([(i, *expected(i, t, unit, **{k.removesuffix("_percent"): v for k, v in shares.items()})) for i, t in pairs], key=repr)
    got = sorted([tuple(r) for r in output.select("doc_id", "n", "form", "prefix_chars", "middle_chars").collect()], key=repr)
    assert got == sorted([w[:5] for w in want], key=repr)
    found = fim_frames.digests(output).collect()
    assert sorted(((r.doc_id, r.output_sha256, r.restored_sha256) for r in found), key=repr) == sorted(
        [(i, sha(expected(i, t, unit, **{k.removesuffix("_percent"): v for k, v in shares.items()})[4]), sha(t or "")) for i, t in pairs], key=repr)
    assert sorted(((r.doc_id, r.text) for r in fim_frames.restored(output).collect()), key=repr) == sorted([(i, t or "") for i, t in pairs], key=repr)
    assert sorted(((r.doc_id, r.text) for r in fim_frames.texts(output).collect()), key=repr) == sorted([(w[0], w[5]) for w in want], key=repr)
    return store, output


@pytest.mark.parametrize("unit,frame", [("line", 1 << 16), ("line", 64), ("char", 64)])
def test_texts(documents, rows, unit, frame):
    check(documents, [(r["doc_id"], r["text"]) for r in rows], unit, frame)


def test_cuts_in_every_frame(spark):
    """Lines longer and shorter than frames, characters of several bytes at frame ends, no line end at the end."""
    rng = random.Random(3)
    pairs = [(i, "".join(rng.choice(["\n", "é", "🙂", "a", "bb", "<", "<S", "P>", " "]) * rng.randint(1, 40) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    pairs += [(1000, "no line end"), (1001, "\n"), (1002, "\n\n\n"), (1003, "x" * 5000), (1004, "a<P>b"), (1005, "<"), (1006, "<S\n<M"), (1007, "<" * 200)]
    df = spark.createDataFrame(pairs, "doc_id BIGINT, text STRING")
    for frame in (1, 7, 100):
        check(df, pairs, "line", frame)


def test_shares(documents, rows):
    pairs = [(r["doc_id"], r["text"]) for r in rows]
    check(documents, pairs, "line", 4096, percent=40, spm_percent=100)
    check(documents, pairs, "line", 4096, percent=100, spm_percent=0)


def test_frames_are_apart_and_in_order(spark):
    """Each frame opens by itself, counts are cumulative, and frames in a row are one zstandard stream."""
    text = "".join(f"line {i} é\n" for i in range(5000))
    store, output = check(spark.createDataFrame([(8, text)], "doc_id BIGINT, text STRING"), [(8, text)], "line", 1000)
    for made, want in ((store, text), (output, expected(8, text, "line")[4])):
        frames = made.first().frames
        assert len(frames) > 50
        seen = ""
        for f in frames:
            assert (f.units, f.chars) == (seen.count("\n"), len(seen))
            raw = zstandard.ZstdDecompressor().decompress(bytes(f.data))
            assert len(raw) == f.bytes
            seen += raw.decode()
        assert seen == want
        stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(b"".join(bytes(f.data) for f in frames)), read_across_frames=True)
        assert stream.read().decode() == want


def test_whole_frames_are_taken_over(spark, monkeypatch):
    """Only frames with a cut are opened and packed again."""
    text = "".join(f"line {i}\n" for i in range(3000))
    unit, pack, open_ = fim_frames.Lines(), zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    frames = fim_frames.Frames(unit, pack)
    for piece in fim_frames.pieces(text.encode(), 500):
        frames.add(piece)
    seek = fim_frames.Seek(frames.rows, unit, 3000, len(text), open_)
    opened = []
    real = seek.raw
    monkeypatch.setattr(seek, "raw", lambda i: opened.append(i) or real(i))
    a, b, out = seek.place(1000), seek.place(2000), fim_frames.Frames(unit, pack)
    seek.copy(out, a, b)
    assert b"".join(fim_frames.opened(out.rows, open_)).decode() == "".join(f"line {i}\n" for i in range(1000, 2000))
    assert set(opened) <= {a[0], b[0]} and len(frames.rows) > 40


def test_nothing(nothing):
    assert fim_frames.digests(fim_frames.transformed(fim_frames.stored(nothing))).collect() == []
