"""Driver contract: entry, queries, oracle SQL (checked at sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidemark import schema
from tidemark.plans import oracle, registry

FAST = ["csv_parse_events", "json_parse_events", "eod_trades_latest",
        "latest_with_tiebreaker", "trade_moving_average", "previous_close",
        "forward_fill_quotes", "quote_trade_analytics", "job_status_upsert",
        "correction_counts", "top_quotes", "csv_parse_timestamps",
        "json_parse_timestamps", "text_scan", "ingest_job", "retried_run",
        "analytics_job", "string_time_analytics", "latest_run", "latest_trade_date"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == schema.ANALYTIC_COLUMNS
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(oracle.ORACLES) == set(registry.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(rows):
    def n(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(n(v) for v in r) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{SF_SMALL}/events.parquet'")
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    exp = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    got = [r.asDict() for r in df.collect()]
    assert _norm([[r[c] for c in cols] for r in got]) == \
        _norm([[r[c] for c in cols] for r in exp])
