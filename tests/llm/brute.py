"""Plain-Python results of the numbered queries, by their definitions."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = hashlib.sha256(b"").hexdigest()


def quality(text):
    words = WORD.findall(text or "")
    grams = defaultdict(list)
    for i in range(len(words) - 7):
        grams[tuple(words[i:i + 8])].append(i)
    inside = {p + k for at in grams.values() if len(at) > 1 for p in at for k in range(8)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": dup, "n_repeat_words": len(inside), "base_failed": n < 20 or 100 * len(inside) > 30 * n}


def warc(pages, least_bytes=0):
    """pages: (page_id, html)."""
    groups = defaultdict(list)
    for p, html in pages:
        groups[(html or "").encode()].append(p)
    out = []
    for payload, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        for i in ids:
            revisit = first is not None and i != first and len(payload) >= least_bytes
            out.append({"page_id": i, "payload_bytes": len(payload),
                        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                        "record_type": "revisit" if revisit else "response", "refers_to": first if revisit else None})
    return out


def packed_pieces(text, tokenizer, capacity=4096):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    out = []
    for k, start in enumerate(range(0, len(ids), capacity)):
        part = ids[start:start + capacity]
        out.append((k, start, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))))
    return out


ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
                    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_base(text):
    """(kind, start, end) by start, then kind as listed."""
    text, out = text or "", []
    for order, (kind, found) in enumerate((
            ("assign", [m for m in ASSIGN.finditer(text) if len(m[2]) >= 8]),
            ("access", [m for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]),
            ("hex", [m for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]))):
        out += [(m.start(), order, kind, m.end()) for m in found]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def private_base(text):
    """(kind, start, end) by kind as listed, then start."""
    text, out = text or "", []
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15))
    for kind, pattern, holds in rules:
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if holds(m[0])]
    return out


def repeats(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    texts = [(t or "").encode() for t in texts]
    count = defaultdict(int)
    for t in texts:
        for p in range(len(t) - length + 1):
            count[hash(t[p:p + length])] += 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if count[hash(t[p:p + length])] > 1:
                gone[p:p + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def url(u, rules=RULES, default="allow"):
    """host, path, rule, verdict."""
    host = path = ""
    if u and "://" in u:
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for action, h, p in rules:
        if (host == h or host.endswith(f".{h}")) and path.startswith(p):
            key = (len(h) + len(p), len(h.split(".")), action == "block")
            if best is None or key > best[0]:
                best = (key, h + p, action)
    return host, path, best and best[1], best[2] if best else default


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(docs, threshold=0.8):
    """docs: (doc_id, text).  (doc_id, class_id, text_id, n_links) of each."""
    ids = defaultdict(list)
    for d, t in docs:
        ids[t or ""].append(d)
    low = lambda xs: min((x for x in xs if x is not None), default=None)
    texts = list(ids)
    sets = [shingles(t) for t in texts]
    by = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            by[x].append(k)
    common = defaultdict(int)
    for ks in by.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1:]:
                common[a, b] += 1
    links, root = [0] * len(texts), list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in common.items():
        if c >= threshold * (len(sets[a]) + len(sets[b]) - c) - 1e-12:
            links[a] += 1
            links[b] += 1
            root[top(a)] = top(b)
    classes = defaultdict(list)
    for k, t in enumerate(texts):
        classes[top(k)] += ids[t]
    return [(d, low(classes[top(k)]), low(ids[t]), links[k]) for k, t in enumerate(texts) for d in ids[t]]
