"""Ingest job: submission files -> typed events of one run.

CSV and JSON roots are scanned as text, parsed row-locally, unioned and
written as ``run_id=<id>/partition=<T|Q|B>``.  Per-partition counts are
measured with ``observe`` during the write — one pass, nothing cached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schema
from tidemark.operators import parse, quality
from tidemark.sources import sinks, text


def parse_roots(spark: SparkSession, csv_root: str, json_root: str,
                ntz: bool = False) -> DataFrame:
    """Common events of both roots (lazy)."""
    csv = parse.parse_csv_lines(text.read_lines(spark, csv_root), ntz=ntz)
    js = parse.parse_json_lines(text.read_lines(spark, json_root), ntz=ntz)
    return parse.union_events(csv, js)


def run_ingest(spark: SparkSession, csv_root: str, json_root: str, out_base: str,
               run_id: str | None = None, ntz: bool = False) -> tuple[str, dict]:
    """Parse both roots and write one run.  Returns (run_id, counts) with
    counts ``{"rows": n, "Q": n, "T": n, "B": n}``."""
    run_id = run_id or sinks.new_run_id()
    events = parse_roots(spark, csv_root, json_root, ntz)
    events, obs = quality.observe_counts(
        events, f"ingest_{run_id}", "partition",
        [schema.QUOTE, schema.TRADE, schema.BAD])
    sinks.write_run(events, out_base, run_id)
    return run_id, dict(obs.get)
