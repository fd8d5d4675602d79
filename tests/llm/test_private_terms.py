"""Disclosing terms against a brute-force co-occurrence; hostile texts."""

import math
import random
import re
import time
from collections import defaultdict

from tests.llm import brute
from tests.llm.conftest import prose
from tidemark.llm import private

TERM = re.compile(r"[^\W_]+")


def entities_of(text):
    out = set()
    for kind, a, b in brute.private_base(text):
        value = text[a:b]
        out.add((kind, value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value)))
    return out


def outside(text):
    taken = [(a, b) for _, a, b in brute.private_base(text)]
    for m in TERM.finditer(text):
        if not any(a < m.end() and m.start() < b for a, b in taken):
            yield m[0].lower(), m.start(), m.end()


def term_spans(rows, disclosure=0.9, support=3):
    """(start, end) of the disclosing terms of each row."""
    texts = [t or "" for _, t in rows]
    n, having, with_entity = len(texts), defaultdict(int), defaultdict(list)
    for k, t in enumerate(texts):
        for w in {m.lower() for m in TERM.findall(t)}:
            having[w] += 1
        for e in entities_of(t):
            with_entity[e].append(k)
    out = [set() for _ in texts]
    for ks in with_entity.values():
        bits = math.log2(n / len(ks))
        if len({texts[k] for k in ks}) < support or bits <= 0:
            continue
        seen = defaultdict(list)
        for k in ks:
            for w in {w for w, _, _ in outside(texts[k])}:
                seen[w].append(k)
        for w, together in seen.items():
            if len({texts[k] for k in together}) >= support and \
                    math.log2(n * len(together) / (len(ks) * having[w])) >= disclosure * bits:
                for k in together:
                    out[k] |= {(a, b) for x, a, b in outside(texts[k]) if x == w}
    return [sorted(x) for x in out]


def found(spark, rows):
    out = {}
    for r in private.find(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        spans = [x.split(":") for x in r["spans"].split(",") if x.startswith("term:")]
        out[r["doc_id"]] = sorted((int(a), int(b)) for _, a, b in spans)
    return [out[i] for i, _ in rows]


def people(seed, n):
    """Letters, lists and forms that name people beside their addresses."""
    rng = random.Random(seed)
    who = [(f"Name{k}aldo", f"Sur{k}vik", f"user{k}@mail{k % 3}.example.org", f"10.0.{k}.7") for k in range(12)]
    rows = []
    for i in range(n):
        text = prose(seed * 1000 + i, rng.randrange(5, 60))
        for k in rng.sample(range(12), rng.choice([0, 0, 1, 1, 2])):
            first, last, mail, ip = who[k]
            # A name on another line, far off, before or after; some without one.
            words = text.split()
            for w in rng.sample([f"{first}\n", f"{last},", mail, ip if rng.random() < 0.5 else "nothing"], rng.choice([2, 3, 4])):
                words.insert(rng.randrange(len(words) + 1), w)
            text = " ".join(words)
        rows.append((i, text))
    together = " ".join(f"list{k}@group.example.net" for k in range(6))
    rows += [(n + i, f"{prose(seed + i, 9)} Assembly {together} Quorumix") for i in range(4)]
    return rows + [(n + 10 + i, rows[3][1]) for i in range(3)] + [(n + 20, None), (n + 21, "")]


def test_terms_equal_brute_force(spark):
    for seed in (1, 2):
        rows = people(seed, 250)
        want = term_spans(rows)
        assert sum(map(len, want)) > 100
        assert found(spark, rows) == want


def test_letters_whose_lower_case_is_longer(spark):
    rows = [(i, f"{prose(i, 20)} İstanbul Quarzon ŞİŞLİ me@istanbul.example.org {prose(100 + i, 20)}") for i in range(5)]
    rows += [(100 + i, prose(300 + i, 40)) for i in range(80)]
    want = term_spans(rows)
    assert all(len(w) == 3 for w in want[:5])
    assert found(spark, rows) == want


def test_long_runs_of_digits_are_read_once(spark):
    texts = ["0" * 5000 + "1.2.3.4", "1.2.3." + "0" * 5000 + "256", "9" * 200_000, "1." * 100_000, ("9" * 50_000 + ".") * 4, "1.2.3.4.5.6.7.8.9",
             "1..2.3.4.5", "1.2.3.4.", ".1.2.3.4", "1.2.3.256.1.2.3.4", "01.002.0003.4 999.1.1.1.1"]
    start = time.process_time()
    for t in texts:
        if len(t) < 10_000:
            assert [(k, a, b) for k, a, b in private.base_spans(t) if k == "ip"] == [
                (k, a, b) for k, a, b in reference_ips(t)]
        else:
            private.base_spans(t)
    assert time.process_time() - start < 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["n_ip"] for r in private.find(df).orderBy("doc_id").collect()][:2] == [1, 0]


def reference_ips(text):
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all((p.lstrip("0") or "0").__len__() <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()


def test_addresses_at_random():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice("0125.. a") for _ in range(rng.randrange(0, 40)))
        assert [x for x in private.base_spans(text) if x[0] == "ip"] == list(reference_ips(text))
