"""Secret scans: base patterns, plus a randomness test battery with
length-aware false-discovery control.  Built-in functions only.

Base kinds are leftmost non-overlapping matches of fixed patterns.  Match
positions come from splitting a text by the pattern and adding up the lengths
of the parts and of the matches.

The method: every long token of an encoding alphabet (hex, base32 and base36
of either case, base64, URL-safe base64, the latter two also without digits) is
tested against "its symbols are random".  Runs with separators are tested
whole, where they are of one alphabet, and in their parts:

* chi-squared test of a uniform alphabet (Wilson-Hilferty);
* runs test of the upper and lower half of the alphabet;
* lag-1 serial correlation.

The least of the three p-values, corrected for taking the least, is uniform
for random tokens and near 0 for written ones.  Short tokens give the tests
little power, so the acceptance level is set for each encoding and length
class from the p-values of the distinct tokens of the whole corpus: twice the
tokens above 1/2 estimates how many random ones there are, and the lowest level
is taken at which at most ``fdr`` of the accepted tokens are not random.  Fewer
than ``FEW`` accepted tokens give no estimate; they are also accepted if their
p-values can be uniform ones (a lone token: if its own is above 0.05).

Defined results: a null text counts as empty and has no spans; repeated rows
give repeated results; an empty table gives an empty result; other columns are
not read by :func:`scan` and kept by :func:`redact`.  Texts are scanned whole;
positions are code points.  ``n_*`` count base spans.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import only, settled, text_or_empty

# The base kinds in the order they are listed.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "random")

# Encoding alphabets in symbol order, and what a token of the
# encoding has to hold (letters and digits, or both cases, mixed, so words of
# one case are no candidates).  The first that matches is tested; symbols that
# random tokens of a wider alphabet happen to lack leave them uniform.
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = {
    "hex": (_DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    "HEX": (_DIGITS + "ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    "base32": (_UPPER + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$"),
    "base32lower": (_LOWER + "234567", r"^(?=.*[2-7])(?=.*[a-z])[a-z2-7]+$"),
    "base36": (_DIGITS + _LOWER, r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$"),
    "BASE36": (_DIGITS + _UPPER, r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z]+$"),
    "letters": (_UPPER + _LOWER, r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$"),
    "letters64": (_UPPER + _LOWER + "+/", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z+/]+$"),
    "letters64url": (_UPPER + _LOWER + "-_", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z_-]+$"),
    "base64": (_UPPER + _LOWER + _DIGITS + "+/", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$"),
    "base64url": (_UPPER + _LOWER + _DIGITS + "-_", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$"),
}
#: Tested tokens, of 20 symbols or more: maximal runs without - and _, maximal
#: runs without + and /, and their parts without any of the four.
CANDIDATES = {"std": r"[A-Za-z0-9+/]{20,}", "url": r"[A-Za-z0-9_-]{20,}", "part": r"[A-Za-z0-9]{20,}"}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Candidates start a new length class at each of these lengths.
LENGTHS = (20, 24, 32, 40, 48, 64, 96, 128)
#: Levels an encoding and length class can be given.
LEVELS = (0.001, 0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)
FDR = 0.05
#: Fewer tokens than this above a level are no estimate of how many are random.
FEW = 10
MARK = "[SECRET]"
_BLOCK = 256


def _sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def _before(lens: Column) -> Column:
    """Sums of all earlier lengths, by blocks: a text with very many matches
    costs each of them a block and the number of blocks."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lens) / _BLOCK).cast("int")),
                         lambda j: _sum(F.slice(lens, j * _BLOCK + 1, _BLOCK)))
    return F.transform(lens, lambda _, i: _sum(
        F.slice(blocks, 1, F.floor(i / _BLOCK).cast("int")))
        + _sum(F.slice(lens, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)))


def _matches(df: DataFrame, text: str, out: str, pattern: str, seems: Column, group: int = 0) -> DataFrame:
    """Adds ``out``: array of (start, end, value) of the pattern's matches.
    ``seems`` is a cheap test that no text with a match fails."""
    p, found, part = F.lit(pattern), f"{out}_found", f"{out}_part"
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    df = df.withColumns({
        found: F.when(seems, F.regexp_extract_all(text, p, F.lit(0))),
        f"{out}_value": F.when(seems, F.regexp_extract_all(text, p, F.lit(group)))})
    some = F.size(F.coalesce(F.col(found), F.array().cast("array<string>"))) > 0
    df = df.withColumn(part, F.when(some, F.transform(
        F.split(text, pattern, -1), lambda x: F.length(x))))
    df = df.withColumn(f"{out}_at", F.when(some, F.transform(
        found, lambda m, i: F.get(part, i) + F.length(m))))
    df = df.withColumn(f"{out}_at", F.when(some, _before(F.col(f"{out}_at"))))
    df = df.withColumn(out, F.when(some, F.transform(found, lambda m, i: F.struct(
        (F.get(f"{out}_at", i) + F.get(part, i)).alias("start"),
        (F.get(f"{out}_at", i) + F.get(part, i) + F.length(m)).alias("end"),
        F.get(f"{out}_value", i).alias("value")))).otherwise(none))
    return df.drop(found, part, f"{out}_value", f"{out}_at")


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic form, error < 2e-4)."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z))


def _least_p(value: Column, alphabet: Column) -> Column:
    """The battery's p-value of one token of the alphabet."""
    k, n = F.length(alphabet).cast("double"), F.length(value).cast("double")
    at = F.transform(F.split(value, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
    # chi-squared: k/n times the squared counts, less n
    counts = F.transform(F.split(alphabet, ""),
                         lambda c: (F.length(value) - F.length(F.replace(value, c, F.lit("")))).cast("double"))
    squares = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x)
    df = k - 1
    chi = F.greatest(squares * k / n - n, F.lit(0.0))
    z_chi = (F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))

    def rest(xs: Column) -> Column:
        # one pass: last symbol, runs, symbols of the upper half, sums
        start = F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high"),
                         F.lit(0.0).alias("s"), F.lit(0.0).alias("ss"), F.lit(0.0).alias("sp"))
        half = lambda x: x >= k / 2
        m = (k - 1) / 2
        return F.aggregate(xs, start, lambda a, x: F.struct(
            x.alias("last"),
            (a["runs"] + F.when((a["last"] < 0) | (half(a["last"]) != half(x)), 1.0).otherwise(0.0)).alias("runs"),
            (a["high"] + F.when(half(x), 1.0).otherwise(0.0)).alias("high"),
            (a["s"] + x).alias("s"),
            (a["ss"] + (x - m) * (x - m)).alias("ss"),
            (a["sp"] + F.when(a["last"] < 0, 0.0).otherwise((a["last"] - m) * (x - m))).alias("sp")),
            lambda a: F.array(*[a[f] for f in ("runs", "high", "ss", "sp")]))

    def combine(r: Column) -> Column:
        runs, high, ss, sp = (F.get(r, F.lit(i)) for i in range(4))
        two = 2 * high * (n - high)
        var = two * (two - n) / (n * n * (n - 1))
        z_runs = F.when(var > 0, F.abs(runs - two / n - 1) / F.sqrt(var)).otherwise(8.0)
        z_serial = F.when(ss > 0, F.abs(sp / ss) * F.sqrt(n)).otherwise(8.0)
        return F.least(_tail(z_chi), 2 * _tail(z_runs), 2 * _tail(z_serial))

    least = F.get(F.transform(F.array(rest(at)), combine), F.lit(0))
    return 1 - F.pow(1 - F.least(least, F.lit(1.0)), F.lit(3.0))


def _length_class(n: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(LENGTHS):
        out = F.when(n >= least, i).otherwise(out)
    return out


def annotate(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` (whose column ``text`` is a non-null string) with ``_base``
    (sorted base spans) and ``_tokens`` (tested tokens outside base spans)."""
    t = F.col(text)
    df = _matches(docs, text, "_assign", ASSIGN,
                  (F.contains(t, F.lit("=")) | F.contains(t, F.lit(":"))) & t.rlike(ASSIGN), 2)
    df = _matches(df, text, "_access", ACCESS, F.contains(t, F.lit("AKIA")))
    df = _matches(df, text, "_hex", f"{HEX[:-1]}{{{LEAST['hex']},}}", t.rlike(f"{HEX[:-1]}{{{LEAST['hex']}}}"))
    for name, pattern in CANDIDATES.items():
        df = _matches(df, text, f"_{name}", pattern, t.rlike(CANDIDATE))
    kinds = []
    for order, kind in enumerate(KINDS[:-1]):
        kinds.append(_spans(F.col(f"_{kind}"), order, kind))
    df = df.withColumn("_base", F.sort_array(F.concat(*kinds)))
    # A run without separators is found by all three.
    df = df.withColumn("_token", F.array_distinct(F.concat(*[f"_{name}" for name in CANDIDATES])))
    df = df.withColumn("_token", F.filter("_token", lambda m: ~F.exists(
        "_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))))
    kind = lambda v: F.coalesce(*[F.when(v.rlike(p), F.lit(e)) for e, (_, p) in ENCODINGS.items()])
    df = df.withColumn("_token", F.filter(F.transform("_token", lambda m: F.struct(
        m["start"], m["end"], kind(m["value"]).alias("encoding"),
        _length_class(F.length(m["value"])).alias("length_class"), m["value"])),
        lambda m: m["encoding"].isNotNull()))

    def tested(m: Column) -> Column:
        alphabet = F.coalesce(*[F.when(m["encoding"] == e, F.lit(a)) for e, (a, _) in ENCODINGS.items()])
        return F.struct(m["start"], m["end"], m["encoding"], m["length_class"],
                        _least_p(m["value"], alphabet).alias("p"), F.xxhash64(m["value"]).alias("token"),
                        m["value"].rlike(r"[+/_-]").alias("wide"))

    return settled(df.withColumn("_tokens", F.transform("_token", tested))
                   .drop("_assign", "_access", "_hex", "_token", *[f"_{name}" for name in CANDIDATES]))


def _spans(found: Column, order: int, kind: str) -> Column:
    least = LEAST[kind]
    return F.transform(
        F.filter(found, lambda m: F.length(m["value"]) >= least),
        lambda m: F.struct(m["start"], F.lit(order).alias("order"), m["end"], F.lit(kind).alias("kind")))


def levels(annotated: DataFrame, fdr: float = FDR) -> dict[tuple[str, int], float]:
    """Acceptance level of each encoding and length class, from the p-values
    of its distinct tokens: copies are one.  At most len(ENCODINGS) *
    len(LENGTHS) rows of counts come to the driver."""
    above = {f"a{i}": F.sum((F.col("p") > level).cast("bigint")) for i, level in enumerate(LEVELS)}
    rows = (annotated.select(F.explode("_tokens").alias("t")).select("t.encoding", "t.length_class", "t.token", "t.p")
            .distinct().groupBy("encoding", "length_class")
            .agg(*[c.alias(k) for k, c in above.items()]).collect())
    out = {}
    for r in rows:
        counts = [r[f"a{i}"] for i in range(len(LEVELS))]
        random = counts[-1] / (1 - LEVELS[-1])
        for i, level in enumerate(LEVELS):
            accepted = counts[i]
            if accepted and (max(0.0, accepted - random * (1 - level)) <= fdr * accepted
                             or accepted < FEW and _even(counts[i:], LEVELS[i:])):
                out[r["encoding"], r["length_class"]] = level
                break
    return out


def _even(counts: list[int], above: Sequence[float], least: float = 0.05) -> bool:
    """Whether the p-values above the first level can be uniform ones: at no
    other level are so few left that chance explains it too seldom."""
    n = counts[0]
    for left, level in zip(counts[1:], above[1:], strict=True):
        q = (1 - level) / (1 - above[0])
        if sum(math.comb(n, k) * q ** k * (1 - q) ** (n - k) for k in range(left + 1)) < least:
            return False
    return True


def with_spans(annotated: DataFrame, level: dict[tuple[str, int], float]) -> DataFrame:
    """Adds ``_spans``: base spans and accepted tokens by start, then kind."""
    accepted = F.lit(False)
    random = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    if level:
        def accept(m: Column) -> Column:
            out = accepted
            for (encoding, length), p in sorted(level.items()):
                out = out | ((m["encoding"] == encoding) & (m["length_class"] == length) & (m["p"] > p))
            return out
        # Accepted parts of an accepted run are no spans of their own.
        annotated = annotated.withColumn("_accepted", F.filter("_tokens", accept))
        annotated = annotated.withColumn("_wide", F.filter("_accepted", lambda m: m["wide"]))
        random = F.transform(F.filter("_accepted", lambda m: m["wide"] | ~F.exists(
            "_wide", lambda w: (w["start"] <= m["start"]) & (m["end"] <= w["end"]))), lambda m: F.struct(
            m["start"], F.lit(len(KINDS) - 1).alias("order"), m["end"], F.lit("random").alias("kind")))
    return annotated.withColumn("_spans", F.sort_array(F.concat("_base", random)))


def _written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """A row per document: base counts, digest of the base spans, all spans."""
    df = only(docs, [doc_id, text]).toDF("doc_id", "text")
    df = annotate(df.select("doc_id", text_or_empty(F.col("text")).alias("text")), "text")
    df = with_spans(df, levels(df, fdr))
    of = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("bigint")
    return df.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(_written("_base").cast("binary"), 256).alias("base_sha256"), _written("_spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text", fdr: float = FDR, mark: str = MARK) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` (spans that
    overlap get one mark); other columns, and null texts, stay."""
    row = F.struct(*[F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(docs.columns)])
    df = docs.select(row.alias("row"), text_or_empty(F.col(f"`{text}`")).alias("text"))
    df = annotate(df, "text")
    df = with_spans(df, levels(df, fdr))
    state = lambda at, out: F.struct(at.alias("at"), out.alias("out"))
    clean = F.aggregate(
        "_spans", state(F.lit(0), F.lit("")),
        lambda a, s: F.when(s["start"] < a["at"], state(F.greatest(a["at"], s["end"]), a["out"])).otherwise(
            state(s["end"], F.concat(a["out"], F.substring("text", a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))),
        lambda a: F.concat(a["out"], F.substring("text", a["at"] + 1, F.length("text"))))
    df = df.withColumn("_clean", F.when(F.size("_spans") > 0, clean).otherwise(F.col("text")))
    return df.select(*[
        (F.when(F.col("row")[str(i)].isNotNull(), F.col("_clean")) if c == text else F.col("row")[str(i)]).alias(c)
        for i, c in enumerate(docs.columns)])
