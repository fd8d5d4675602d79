"""The randomness tests, their levels and the spans they add, in plain Python."""

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import prose
from tidemark.llm import secrets

ALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def tail(z):
    z = max(-8.0, min(8.0, z))
    return 1 / (1 + math.exp(1.5976 * z + 0.070566 * z ** 3))


def p_value(token, alphabet):
    k, n = len(alphabet), len(token)
    at = [alphabet.index(c) for c in token]
    expected = n / k
    chi = sum((at.count(i) - expected) ** 2 / expected for i in range(k))
    spread = 2 / (9 * (k - 1))
    z_chi = ((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    upper = [a >= k / 2 for a in at]
    high, runs = sum(upper), 1 + sum(a != b for a, b in zip(upper, upper[1:]))
    two = 2 * high * (n - high)
    var = two * (two - n) / (n * n * (n - 1))
    z_runs = abs(runs - two / n - 1) / math.sqrt(var) if var > 0 else 8.0
    middle = (k - 1) / 2
    ss = sum((a - middle) ** 2 for a in at)
    sp = sum((a - middle) * (b - middle) for a, b in zip(at, at[1:]))
    z_serial = abs(sp / ss) * math.sqrt(n) if ss > 0 else 8.0
    return 1 - (1 - min(tail(z_chi), 2 * tail(z_runs), 2 * tail(z_serial), 1.0)) ** 3


def tokens_of(text):
    """(start, end, encoding, length class, p, value) of the tested tokens."""
    base = brute.secret_base(text)
    found = {m.span() for pattern in secrets.CANDIDATES.values() for m in re.finditer(pattern, text)}
    for a, b in sorted(found):
        if any(x < b and a < y for _, x, y in base):
            continue
        value = text[a:b]
        for name, (alphabet, holds) in secrets.ENCODINGS.items():
            if re.search(holds, value):
                yield a, b, name, sum(len(value) >= least for least in secrets.LENGTHS) - 1, p_value(value, alphabet), value
                break


def levels_of(tokens):
    groups = {}
    for _, _, name, size, p, value in tokens:
        groups.setdefault((name, size), {})[value] = p
    out = {}
    for key, ps in groups.items():
        counts = [sum(p > level for p in ps.values()) for level in secrets.LEVELS]
        estimate = counts[-1] / (1 - secrets.LEVELS[-1])
        for i, level in enumerate(secrets.LEVELS):
            if not counts[i]:
                continue
            false = max(0.0, counts[i] - estimate * (1 - level))
            if false <= secrets.FDR * counts[i] or counts[i] < secrets.FEW and even(counts[i:], secrets.LEVELS[i:]):
                out[key] = level
                break
    return out


def even(counts, above):
    for left, level in list(zip(counts, above))[1:]:
        q = (1 - level) / (1 - above[0])
        if sum(math.comb(counts[0], j) * q ** j * (1 - q) ** (counts[0] - j) for j in range(left + 1)) < 0.05:
            return False
    return True


def spans_of(texts):
    tokens = [list(tokens_of(t or "")) for t in texts]
    level = levels_of([x for found in tokens for x in found])
    out = []
    for text, found in zip(texts, tokens, strict=True):
        good = [x for x in found if x[4] > level.get(x[2:4], 2)]
        wide = [x for x in good if re.search("[+/_-]", x[5])]
        good = [x for x in good if x in wide or not any(w[0] <= x[0] and x[1] <= w[1] for w in wide)]
        order = {k: i for i, k in enumerate(("assign", "access", "hex", "random"))}
        spans = brute.secret_base(text or "") + [("random", a, b) for a, b, *_ in good]
        out.append(brute.written(sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))))
    return out


def test_p_values_equal_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for name, (alphabet, _) in secrets.ENCODINGS.items():
        for n in (20, 21, 40, 130):
            rows += [(name, "".join(rng.choice(alphabet) for _ in range(n))) for _ in range(4)]
            rows += [(name, (alphabet[:7] * n)[:n]), (name, alphabet[0] * n), (name, (alphabet[0] + alphabet[-1]) * (n // 2))]
    df = spark.createDataFrame(rows, "name string, value string")
    for name, (alphabet, _) in secrets.ENCODINGS.items():
        for r in df.where(F.col("name") == name).select("value", secrets._least_p(F.col("value"), F.lit(alphabet)).alias("p")).collect():
            assert abs(r["p"] - p_value(r["value"], alphabet)) < 1e-9


def test_p_values_of_random_tokens_are_even():
    """The battery keeps its level: of random tokens about a share x has p <= x."""
    rng = random.Random(2)
    for name in ("hex", "base36", "base64"):
        alphabet = secrets.ENCODINGS[name][0]
        p = np.array([p_value("".join(rng.choice(alphabet) for _ in range(48)), alphabet) for _ in range(1500)])
        for x in (0.05, 0.25, 0.5, 0.75):
            assert abs((p <= x).mean() - x) < 0.08, (name, x)
    for z in np.linspace(-4, 4, 81):
        assert abs(tail(z) - math.erfc(z / math.sqrt(2)) / 2) < 2e-4


def test_spans_equal_brute_force(spark):
    rng = random.Random(3)
    token = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    alphabets = [a for a, _ in secrets.ENCODINGS.values()]
    texts = []
    for i in range(400):
        parts = [prose(i, rng.randrange(3, 12))]
        for _ in range(rng.randrange(0, 4)):
            kind = rng.randrange(6)
            if kind < 3:
                parts.append(token(rng.choice(alphabets), rng.choice([20, 22, 26, 36, 45, 60, 100, 140])))
            elif kind == 3:
                parts.append("-".join(prose(500 + i, 4).split()) + "/" + token(ALL[:62], 24) + "_" + prose(600 + i, 1))
            elif kind == 4:
                parts.append("secret = " + token(ALL, 30))
            else:
                parts.append("ThisIsALongName" + "Abc1" * rng.randrange(2, 9))
            parts.append(prose(900 + i, 2))
        texts.append(" ".join(parts))
    texts += texts[:20] + [None, ""]
    want = spans_of(texts)
    assert sum("random:" in w for w in want) > 50
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == want
