"""Connected components of an edge table by label propagation with pointer
jumping.  Every round is written to the shared folder, and the round before the
last one is deleted; only whether a label has changed comes to the driver.

Defined results: repeated edges count once; an edge of a node with itself, or
with a null end, connects nothing and gives no row; no edges give no rows;
other columns are not read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import materialise, release


def components(edges: DataFrame) -> DataFrame:
    """``edges``: u, v (bigint, any direction, repeats and loops allowed).
    Returns node, root: every node of an edge with the least node it reaches.

    Hubs are no bottleneck: labels are combined by ``min`` before the shuffle.
    """
    both = materialise(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
                       .where("u <> v").distinct(), "edges")
    label = materialise(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("root")),
                        "labels")
    while True:
        seen = (both.join(label, both["v"] == label["node"]).groupBy("u").agg(F.min("root").alias("near")))
        near = (label.join(seen, label["node"] == seen["u"], "left")
                .select("node", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("root")))
        above = label.select(F.col("node").alias("up"), F.col("root").alias("up_root"))
        new = materialise(near.join(above, near["root"] == above["up"], "left")
                          .select("node", "old", F.least("root", F.coalesce("up_root", "root")).alias("root")), "labels")
        release(label)  # ``new`` is written, nothing reads it any more
        if new.where("old <> root").isEmpty():
            release(both)
            return new.select("node", "root")
        label = new.select("node", "root")
