"""Repeated passages: the per-text parts against brute force."""

import random

import numpy as np
import pytest

from tidemark.llm import repeats


def covered(texts, length):
    """Removed bytes of each text by the definition."""
    seen = {}
    for k, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            seen.setdefault(t[p:p + length], []).append((k, p))
    out = [set() for _ in texts]
    for where in seen.values():
        if len(where) > 1:
            for k, p in where:
                out[k].update(range(p, p + length))
    return out


def some_texts(seed, n=12, alphabet=b"abcd"):
    rng = random.Random(seed)
    word = lambda k: bytes(rng.choice(alphabet) for _ in range(k))
    shared = [word(rng.randrange(20, 80)) for _ in range(3)]
    out = []
    for _ in range(n):
        t = b""
        for _ in range(rng.randrange(1, 5)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            t += word(rng.randrange(0, 40)) + s[a:a + rng.randrange(5, 80)]
        out.append(t)
    return [*out, out[0], b"", b"a" * 90]


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("length", [3, 16, 24])
def test_marks_of_whole_texts(seed, length):
    texts = some_texts(seed)
    units = [bytes([k]) for k in range(len(texts))]
    got = [set() for _ in texts]
    for u, a, b in repeats.marked([(u, 0, t) for u, t in zip(units, texts, strict=True)], length):
        got[u[0]].update(range(a, b))
    assert got == covered(texts, length)


def test_repeats_are_maximal_with_all_occurrences():
    found = repeats.maximal_repeats([b"xABCDEFGHIJy", b"zABCDEFGHIJw", b"zABCDEFGHIJv"], 8)
    assert sorted((size, sorted(where)) for size, where in found) == [
        (10, [(0, 1), (1, 1), (2, 1)]), (11, [(1, 0), (2, 0)])]


@pytest.mark.parametrize("seed", range(4))
def test_equal_strings_share_an_anchor(seed):
    rng = np.random.default_rng(seed)
    passage = rng.integers(97, 100, 60, dtype=np.uint8).tobytes()
    texts = [rng.integers(97, 100, k, dtype=np.uint8).tobytes() + passage + b"end" * k for k in (0, 7, 90)]
    places = []
    for t in texts:
        p, k = repeats.anchors(t, 50, 8)
        at = t.index(passage)
        for s in range(len(t) - 50 + 1):  # every string holds an anchor
            assert ((p >= s) & (p + 8 <= s + 50)).any()
        inside = (p >= at) & (p + 8 <= at + 60)
        places.append({(int(a) - at, int(b)) for a, b in zip(p[inside], k[inside], strict=True)})
    assert places[0] & places[1] & places[2]


def test_one_long_text_of_near_equal_lines():
    import tracemalloc

    line = bytes(random.Random(5).randrange(97, 123) for _ in range(290))
    numbered = b"".join(line + b"%09d\n" % (i * 7919) for i in range(1500))
    for text, least in ((numbered, 1500 * 290), ((line + b"\n") * 400, 400 * 291)):
        tracemalloc.start()
        got = repeats.marked([(b"u", 0, text)], 200)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 350 * len(text)  # the suffixes of one class are 750 times the text
        assert sum(b - a for a, b in repeats.merged([(a, b) for _, a, b in got])) >= least


@pytest.mark.parametrize("size", [1, 256, 1 << 20])
def test_suffixes_sorted_by_slices(monkeypatch, size):
    monkeypatch.setattr(repeats, "SLICE_BYTES", size)
    texts = [*some_texts(3), b"ab" * 300, b"ab" * 200, b"ab" * 300 + b"c"]
    at = [(s, p) for s, t in enumerate(texts) for p in range(len(t))]
    order, common = repeats._sorted_suffixes(at, texts)
    assert order == sorted(at, key=lambda x: (texts[x[0]][x[1]:], x))
    plain = [repeats._common(texts[a][p:], texts[b][q:]) for (a, p), (b, q) in zip(order, order[1:])]
    assert common == [-1, *plain]
