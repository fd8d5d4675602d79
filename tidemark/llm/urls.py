"""URL filters: a sort-merge range join of urls with host and path rules.

Method: a host's canonical key is its labels from last to first, each closed
by a zero; all subdomains of a host then share its key as a prefix, and a rule
covers an interval of the sorted urls.  Urls and rules are range-partitioned
and sorted by key together, so a rule stands where its interval begins; the
rules whose interval began before a partition are those whose key is a prefix
of the partition's first key, found by a join on its prefixes.  Each partition
is swept once, with a stack of the rules whose interval holds the current url.
Nested rules lie above each other on the stack.

Urls are split into ranges of about ``per_part`` rows and ties on the key are
split by position, so one host with most of the urls spreads over many tasks.
Neither keys nor rules come to the driver.

A rule fits its host and all subdomains if the url's path starts with the
rule's path.  The longest rule (host and path) wins; among equally long ones
the deeper host, then block.  Without a rule the verdict is ``default``.

Defined results: a null url, or one without ``://``, has an empty host and
path, so no rule fits.  An empty path starts no rule path but the empty one.
Repeated rows are judged each; empty tables give an empty result; rules with a
null host are ignored, a null path counts as empty; other columns are not
read.
"""

from __future__ import annotations

import math
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import only, ship
from tidemark.sources.scratch import materialise

PER_PART = 100_000
_OUT = "page_id {id}, host string, path string, rule string, verdict string"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, by the contract's split."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    part = lambda pattern: F.coalesce(F.regexp_extract(rest, pattern, 1), F.lit(""))
    return _ascii_lower(part(r"^([^/?#]*)")), part(r"^[^/?#]*([^?#]*)")


def host_key(host: Column) -> Column:
    """Labels from last to first, each closed by a zero.  Zeros and ones in
    labels are escaped, so that no label contains the mark."""
    escaped = F.replace(F.replace(host, F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01"))
    labels = F.reverse(F.split(escaped, "\\."))
    return F.concat(F.array_join(labels, "\x00"), F.lit("\x00"))


class _Host:
    """The rules of one host: by path, and the lengths paths have."""

    def __init__(self, key: str) -> None:
        self.key, self.by_path = key, {}

    def add(self, path: str, rule: str, action: str) -> None:
        known = self.by_path.get(path)
        if known is None or (known[1] != "block" and action == "block"):
            self.by_path[path] = (rule, action)

    def seal(self) -> None:
        self.lengths = sorted({len(p) for p in self.by_path}, reverse=True)

    def best(self, path: str) -> tuple[str, str] | None:
        for n in self.lengths:
            found = self.by_path.get(path[:n]) if n <= len(path) else None
            if found:
                return found
        return None


def sweep(urls: list[tuple[str, str]], rules: list[tuple[str, str, str, str]]) -> list[tuple[str, str] | None]:
    """For urls sorted by key, ``(key, path)``, the winning (rule, action).
    ``rules``: ``(key, path, rule, action)``."""
    hosts: list[_Host] = []
    for key, path, rule, action in sorted(rules):
        if not hosts or hosts[-1].key != key:
            hosts.append(_Host(key))
        hosts[-1].add(path, rule, action)
    for h in hosts:
        h.seal()
    out, stack, at = [], [], 0
    for key, path in urls:
        while at < len(hosts) and hosts[at].key <= key:
            while stack and not hosts[at].key.startswith(stack[-1].key):
                stack.pop()
            stack.append(hosts[at])
            at += 1
        while stack and not key.startswith(stack[-1].key):
            stack.pop()
        best = None
        for h in stack:
            found = h.best(path)
            if found and (best is None or len(found[0]) >= len(best[0])):
                best = found
        out.append(best)
    return out


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
          default: str = "allow", per_part: int = PER_PART) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.
    ``rules``: columns action (``allow``/``block``), host, path."""
    ship(pages.sparkSession)
    df = only(pages, [page_id, url]).toDF("page_id", "url")
    host, path = host_and_path(F.col("url").cast("string"))
    df = df.select("page_id", host.alias("host"), path.alias("path"))
    n = max(1, math.ceil(df.count() / per_part))  # counted from file footers
    id_type = dict(df.dtypes)["page_id"]
    keyed = rules.where(F.col("host").isNotNull()).select(
        host_key(_ascii_lower(F.col("host"))).alias("key"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.concat(_ascii_lower(F.col("host")), F.coalesce("path", F.lit(""))).alias("rule"), "action")
    # Rules come before the urls of the same key.
    urls = df.withColumns({"key": host_key(F.col("host")), "n": F.monotonically_increasing_id()})
    both = keyed.withColumn("n", F.lit(-1).cast("bigint")).unionByName(urls, allowMissingColumns=True)
    both = materialise(both.repartitionByRange(n, "key", "n").withColumn("part", F.spark_partition_id()), "urls")
    here = both.where(F.col("n") < 0).select("part", "key", "path", "rule", "action")
    # Rules that reach in from before: their keys are prefixes of the first key,
    # of no more labels than a rule has.
    labels = keyed.agg(F.max(F.size(F.split("key", "\x00")))).first()[0] or 0
    known = F.split("first", "\x00")
    prefix = lambda k: F.concat(F.array_join(F.slice(known, F.lit(1), k), "\x00"), F.lit("\x00"))
    most = F.least(F.size(known) - 1, F.lit(labels))
    firsts = both.groupBy("part").agg(F.min("key").alias("first")).where(most > 0).select(
        "part", F.explode(F.transform(F.sequence(F.lit(1), most), prefix)).alias("key"))
    dealt = materialise(here.unionByName(firsts.join(keyed, "key").select(*here.columns)).distinct(), "rules")
    df = both.where(F.col("n") >= 0).select("part", "key", "page_id", "host", "path")

    def swept(urls: pa.Table, found: pa.Table) -> pa.Table:
        urls = urls.sort_by("key")
        best = sweep(list(zip(urls["key"].to_pylist(), urls["path"].to_pylist(), strict=True)),
                     list(zip(*(found[c].to_pylist() for c in ("key", "path", "rule", "action")), strict=True)))
        return pa.table({
            "page_id": urls["page_id"], "host": urls["host"], "path": urls["path"],
            "rule": pa.array([b and b[0] for b in best], pa.string()),
            "verdict": pa.array([b[1] if b else default for b in best], pa.string())})

    return (df.groupBy("part").cogroup(dealt.groupBy("part"))
            .applyInArrow(swept, _OUT.format(id=id_type)))
