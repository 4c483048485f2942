import random
import re

import numpy as np
import pyarrow as pa

from costlens.llm import textbytes as tb

TEXTS = ["", None, "  ", "one", "One TWO\tthree\x0bfour\n five six", "é ü Ä B C d", "a b c d e f " * 50, "漢 字 😀 x y z", "\x1c a\x85b c d e f g"]


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def test_words_and_shingles_match_the_definition():
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("ab") for _ in range(rng.randrange(9))) for _ in range(300)]
    sets = []
    for limit in (1, 1 << 21):  # every text a slice of its own, and all together
        old, tb.SLICE_BYTES = tb.SLICE_BYTES, limit
        got = []
        offsets, data = tb.buffers(pa.array(texts))
        for i, j in tb.slices(offsets, limit):
            part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            row, start, end = tb.words(part, off)
            row, value = tb.distinct_sorted(*tb.shingle_hashes(row, tb.word_hashes(part, start, end), j - i, 5))
            got += [frozenset(value[row == k].tolist()) for k in range(j - i)]
        tb.SLICE_BYTES = old
        sets.append(got)
    assert sets[0] == sets[1]
    want = []
    for t in texts:
        w = words_of(t)
        want.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    ids = {}
    for mine, theirs in zip(want, sets[0], strict=True):
        assert len(mine) == len(theirs)
        if len(mine) == 1:  # equal sets have equal hashes, others not
            assert ids.setdefault(next(iter(mine)), theirs) == theirs
    assert len(set(ids.values())) == len(ids)


def test_letter_stream():
    def plain(text):
        out = " "
        for c in text or "":
            c = c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " "
            out += c
        return re.sub(" +", " ", out + " ")

    offsets, data = tb.buffers(pa.array(TEXTS))
    points, bounds = tb.letter_stream(data, offsets)
    for i, text in enumerate(TEXTS):
        got = "".join(map(chr, points[bounds[i] : bounds[i + 1]]))
        assert got.replace("  ", " ") == plain(text), text


def test_invalid_utf8_is_repaired():
    raw = np.frombuffer(b"abc\xff\xfedef" + b"ghi", np.uint8)
    points, bounds = tb.letter_stream(raw, np.array([0, 8, 11]))
    assert "".join(map(chr, points[bounds[1] : bounds[2]])) == " ghi "


def test_lookup():
    rng = np.random.default_rng(0)
    known = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    look = tb.Lookup(known)
    probe = np.concatenate((known[:10], rng.integers(0, 1 << 63, 5000, dtype=np.uint64)))
    at, index = look.find(probe)
    assert set(at.tolist()) == set(range(10)) and (look.hashes[index] == probe[at]).all()
    assert len(tb.Lookup(np.zeros(0, np.uint64)).find(probe)[0]) == 0
