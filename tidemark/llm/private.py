"""Personal data: base patterns, and information-theoretic sanitisation.

Base kinds are leftmost non-overlapping matches of fixed patterns; those that
fail a kind's test are dropped, without another try.

The method: a matched value is a protected entity.  Terms of its documents may
reveal it even when it is removed.  How strongly is estimated from the corpus:
with probabilities as shares of documents, a term discloses the pointwise
mutual information
``log2(p(e, t) / (p(e) p(t)))`` of the ``-log2 p(e)`` bits the entity holds.
A term that discloses at least ``DISCLOSURE`` of them, seen with the entity in
``SUPPORT`` different texts or more, is a span of kind ``term`` wherever it
stands in a document of the entity, outside base spans.  Sanitising generalises base spans to their kind and
numeric terms to ``[NUMBER]``, and removes other terms.

Terms are counted over all documents by the function that marks them, combined
by batch before the shuffle.  Entities in fewer than ``SUPPORT`` texts and terms
too frequent to disclose enough of an entity, however often they are together,
go before pairs are made.  Entities that stand in the same documents (a list of
addresses that is copied) are one *group*, since each term is with all of them
alike: a document gives a row for each group and term that is left in it, not
for each entity.

Defined results: a null text counts as empty; repeated rows give repeated
results, and copies of a text count as one in ``SUPPORT``; an empty table gives
an empty result; other columns are not read by :func:`find` and kept by
:func:`sanitise`.  Positions are code points.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm.common import fresh, only, ship, text_or_empty
from tidemark.sources.scratch import materialise

KINDS = ("email", "ip", "card", "phone", "term")
DISCLOSURE = 0.9
SUPPORT = 3
#: Most frequent terms that leave before the shuffle (the rest leave after it).
COMMON = 50_000

# The base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W_]+")


def _luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four runs of digits with dots between, from the left; those with a part
    over 255 are matches that are dropped.  A run of digits and dots is parted
    at its dots once, however long its parts are."""
    for m in _DOTTED.finditer(text):
        run = m[0]
        if run.count(".") < 3:
            continue
        at, found = m.start(), []
        for part in run.split("."):
            found = [*found, (at, part)] if part else []
            at += len(part) + 1
            if len(found) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for _, p in found):
                    yield found[0][0], at - 1
                found = []


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", a, b) for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m[0])) if len(m[0]) < 40 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else ''.join(_DIGIT.findall(value))}"


def terms_outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the words outside all spans."""
    taken, i, until = sorted((a, b) for _, a, b in spans), 0, 0
    for m in _TERM.finditer(text):
        while i < len(taken) and taken[i][0] < m.end():
            until = max(until, taken[i][1])
            i += 1
        if m.start() >= until:
            yield m[0].lower(), *m.span()


_SPAN = StructType().add("kind", "string").add("start", "long").add("end", "long")


def _scan(docs: DataFrame) -> DataFrame:
    """``docs``: id, text.  Written: id, row, copy (a hash of the text), base
    spans, and for rows with any the entities and the text."""
    schema = StructType([docs.schema["id"], StructField("copy", LongType()), StructField("base", ArrayType(_SPAN)),
                         StructField("entities", ArrayType(StringType())), StructField("text", StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, base, entities, texts = [], [], [], []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                entities.append(sorted({_entity(k, text[a:b]) for k, a, b in spans}))
                texts.append(text if spans else None)
                copies.append(xxhash.xxh3_64_intdigest(text) - (1 << 63) if spans else 0)
            span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(copies, pa.int64()), pa.array(base, pa.list_(span)),
                 pa.array(entities, pa.list_(pa.string())), pa.array(texts, pa.string())], names=schema.names)

    ship(docs.sparkSession)
    return materialise(docs.select("id", "text").mapInArrow(scan, schema)
                       .withColumn("row", F.monotonically_increasing_id()), "private")


def _triples(base: list[dict]) -> list[tuple[str, int, int]]:
    return [(x["kind"], x["start"], x["end"]) for x in base]


def _revealing(docs: DataFrame, scanned: DataFrame, disclosure: float, support: int) -> DataFrame:
    """row, terms: the terms of a row that disclose too much of its entities."""
    held = scanned.where(F.size("entities") > 0).select("row", "copy", F.explode("entities").alias("entity"))
    known = (held.groupBy("entity", "copy").agg(
                 F.count("*").alias("n"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("b"))
             .groupBy("entity").agg(F.count("*").alias("texts"), F.sum("n").alias("n_entity"), F.sum("a").alias("a"), F.bit_xor("b").alias("b"))
             .where(F.col("texts") >= support))
    # Entities of the same documents, told by 128 bits, are one group.
    groups = F.concat_ws(":", F.pmod("a", F.lit(1 << 62).cast("decimal(38,0)")).cast("string"), F.col("b").cast("string"))
    entities = materialise(known.select("entity", "n_entity", groups.alias("group")), "entities")
    live = materialise(held.join(entities, "entity").select("row", "group", "n_entity").distinct(), "live")
    n = max(scanned.count(), 1)
    # A term is with an entity in at most n_term of its documents; a little
    # more is let through here, the test below decides.
    most = lambda x: F.pow(x.cast("double"), F.lit(disclosure)) * (float(n) ** (1 - disclosure) * 1.000001)
    limit = entities.agg(F.max(most(F.col("n_entity")))).first()[0] or 0.0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                seen.update(set(map(str.lower, _TERM.findall(text))))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             names=["term", "n"])

    terms = materialise(docs.select("text").mapInArrow(count, "term string, n bigint").groupBy("term")
                        .agg(F.sum("n").alias("n_term")).where(F.col("n_term") >= support), "terms")
    common = terms.where(F.col("n_term") > limit).orderBy(F.desc("n_term")).limit(COMMON).select("term")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, copy, base, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = sorted({t for t, _, _ in terms_outside(text, _triples(base))})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(found), pa.int64()), pa.array([copy] * len(found), pa.int64()),
                     pa.array(found, pa.string())], names=["row", "copy", "term"])

    seen = (scanned.join(live.select("row").distinct(), "row", "left_semi").select("row", "copy", "base", "text")
            .mapInArrow(emit, "row bigint, copy bigint, term string").join(F.broadcast(common), "term", "left_anti")
            .join(terms.where(F.col("n_term") <= limit), "term"))
    together = materialise(seen.join(live, "row").where(F.col("n_term") <= most(F.col("n_entity"))), "together")
    total = F.log2(F.lit(float(n)))
    bits = total - F.log2("n_entity")
    disclosed = total + F.log2("together") - F.log2("n_entity") - F.log2("n_term")
    pairs = (together.groupBy("group", "n_entity", "term", "n_term", "copy").agg(F.count("*").alias("n"))
             .groupBy("group", "n_entity", "term", "n_term").agg(F.count("*").alias("texts"), F.sum("n").alias("together"))
             .where((F.col("texts") >= support) & (bits > 0) & (disclosed >= disclosure * bits)).select("group", "term"))
    return together.join(pairs, ["group", "term"]).groupBy("row").agg(F.collect_set("term").alias("terms"))


def _spans(docs: DataFrame, disclosure: float, support: int) -> DataFrame:
    """id, row, base and terms (arrays of spans) of every row of ``docs``."""
    scanned = _scan(docs)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            out = []
            for base, text, terms in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                terms = set(terms)
                out.append([{"kind": "term", "start": a, "end": b}
                            for t, a, b in terms_outside(text, _triples(base)) if t in terms])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], names=["row", "terms"])

    found = (scanned.select("row", "base", "text").join(_revealing(docs, scanned, disclosure, support), "row")
             .mapInArrow(mark, StructType().add("row", "long").add("terms", ArrayType(_SPAN))))
    none = F.array().cast(ArrayType(_SPAN))
    return scanned.select("id", "row", "base").join(found, "row", "left").select(
        "id", "row", "base", F.coalesce("terms", none).alias("terms"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """A row per document: base counts, digest of the base spans, all spans."""
    df = only(docs, [doc_id, text]).toDF("id", "text").select("id", text_or_empty(F.col("text")).alias("text"))
    found = _spans(df, disclosure, support)
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"), *[of(k) for k in KINDS[:-1]],
        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _written(F.concat("base", "terms")).alias("spans"))


def sanitise(docs: DataFrame, text: str = "text", disclosure: float = DISCLOSURE,
             support: int = SUPPORT) -> DataFrame:
    """``docs`` with spans of ``text`` generalised or removed.  Spans that
    overlap take the first's replacement."""
    row = fresh(docs, "row")
    whole = F.struct(*[F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(docs.columns)])
    df = docs.select(whole.alias("id"), text_or_empty(F.col(f"`{text}`")).alias("text"))
    found = _spans(df, disclosure, support).withColumnRenamed("row", row)
    at = docs.columns.index(text)
    original = F.col("id")[str(at)].cast("string")
    state = lambda end, out: F.struct(end.alias("end"), out.alias("out"))
    piece = lambda s: F.substring(original, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    by = lambda s: F.when(s["kind"] != "term", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).when(
        piece(s).rlike("^[0-9]+$"), F.lit("[NUMBER]")).otherwise(F.lit(""))
    spans = F.array_sort(F.concat("base", "terms"), lambda a, b: F.when(a["start"] < b["start"], -1).when(
        a["start"] > b["start"], 1).when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0))
    zero = F.lit(0).cast("bigint")
    clean = F.aggregate(
        spans, state(zero, F.lit("")),
        lambda a, s: F.when(s["start"] < a["end"], state(F.greatest(a["end"], s["end"]), a["out"])).otherwise(state(
            s["end"], F.concat(a["out"], F.substring(original, (a["end"] + 1).cast("int"), (s["start"] - a["end"]).cast("int")), by(s)))),
        lambda a: F.concat(a["out"], F.substring(original, (a["end"] + 1).cast("int"), F.length(original))))
    return found.select(*[
        (F.when(original.isNotNull(), clean) if i == at else F.col("id")[str(i)]).alias(c)
        for i, c in enumerate(docs.columns)])
