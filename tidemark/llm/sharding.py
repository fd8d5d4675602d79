"""Sharding: a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets that fit into memory, by a
seeded hash of their id and text; pass two shuffles each bucket by Fisher and
Yates and writes it.  The buckets one after another are the shuffled table;
cut into equal runs it gives shards whose row counts are at most one apart.

The result depends on the rows and the seed, not on how the input is split.
Copies of a row (same id and text) hash alike: copies that would overfill a
bucket are found by an aggregation (a key and its bytes per row, combined
before the shuffle) and scattered by their number among such rows of their
partition; only for them does the result depend on how the input is split.
These numbers run from 0 in every partition in whatever order its rows come,
so rows that are computed again after a lost executor fill the same buckets to
the same counts.

Buckets' places are sums over ranges of buckets, joined to the rows by bucket,
by which they are dealt anyway; nothing that grows with the rows is broadcast
or seen by one task.

Defined results: a null text has no bytes and stays null; rows with a null id
are scattered by their text; repeated rows each get a slot; an empty table
gives no shards; other columns ride along inside ``row``, whatever their
names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import ship
from tidemark.sources.scratch import scratch_path

SHARDS = 8
SEED = 20240607
BUCKET_BYTES = 16 << 20
#: Buckets whose offsets are summed by one task.
RANGE = 1 << 14


def _deal(bucket_rows: pa.Table, seed: int, starts: np.ndarray) -> pa.Table:
    """One bucket in its canonical order, shuffled, with shard and slot."""
    t = bucket_rows.sort_by("key")
    bucket, offset = t["bucket"][0].as_py(), t["offset"][0].as_py()
    order = np.random.default_rng([seed, bucket]).permutation(t.num_rows)  # Fisher-Yates
    t = t.take(pa.array(order))
    at = offset + np.arange(t.num_rows)
    shard = np.searchsorted(starts, at, side="right") - 1
    return pa.table({"row": t["row"], "slot": pa.array(at - starts[shard], pa.int64()),
                     "shard": pa.array(shard, pa.int32())})


def _offsets(df: DataFrame) -> DataFrame:
    """bucket and offset: how many rows earlier buckets have."""
    counts = df.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("range", F.floor(F.col("bucket") / RANGE))
    ranges = counts.groupBy("range").agg(F.sum("n").alias("n"))
    ahead = ranges.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("ahead"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("bucket")) - F.col("n")
    return counts.select("bucket", "range", inside.alias("inside")).join(ahead, "range").select(
        "bucket", (F.col("ahead") + F.col("inside")).alias("offset"))


def shuffle_to_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                      shards: int = SHARDS, seed: int = SEED,
                      bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes the shards below ``path`` (a folder per shard) and reads them
    back: ``row`` (all columns of ``docs``), ``shard`` and ``slot``."""
    spark = docs.sparkSession
    ship(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    df = docs.select(row.alias("row"), F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("key"),
                     (F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)) + 1)
                     .cast("bigint").alias("size"))

    seen, hot_path = Observation(), scratch_path(spark, "hot-rows")
    (df.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
     .observe(seen, F.sum("size").alias("bytes"), F.sum("n").alias("rows"))
     .where((F.col("n") > 1) & (F.col("size") > bucket_bytes // 4)).select("key").write.parquet(hot_path))
    total = seen.get
    n_rows = total["rows"] or 0
    n_buckets = max(1, math.ceil((total["bytes"] or 0) / bucket_bytes))
    starts = np.array([s * n_rows // shards for s in range(shards)], dtype=np.int64)

    hot = spark.read.schema("key bigint").parquet(hot_path)
    cold = df.join(hot, "key", "left_anti").withColumn("salt", F.lit(0).cast("bigint"))
    copies = df.join(hot, "key", "left_semi").withColumn("salt", F.monotonically_increasing_id() + 1)
    bucket = F.when(F.col("salt") == 0, F.xxhash64(F.lit(seed + 1), "key")).otherwise(F.xxhash64(F.lit(seed + 1), "salt"))
    df = cold.unionByName(copies).withColumn("bucket", F.pmod(bucket, F.lit(n_buckets))).drop("salt", "size")
    df = df.join(_offsets(df), "bucket")

    def deal(rows: pa.Table) -> pa.Table:
        return _deal(rows, seed, starts)

    dealt = StructType([df.schema["row"]]).add("slot", "long").add("shard", "integer")
    df.groupBy("bucket").applyInArrow(deal, dealt).write.partitionBy("shard").parquet(path)
    return spark.read.schema(dealt).parquet(path)
