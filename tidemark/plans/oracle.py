"""Oracle SQL (DuckDB dialect) for the registered queries.

Each text computes the expected result directly from the ``events`` view
in the plainest form — whole-key windows, a union, row_number — i.e. the
reference formulation, not ours.  Values that both sides must share (the
market-data mapping, the line variations, the run ids) are the fixed values
of :mod:`tidemark.plans.market_feed` and :mod:`tidemark.plans.registry`.
"""

from __future__ import annotations

from tidemark.plans import registry as R

BASE = """base as (
  select cast(ts as date) as trade_dt,
         case when event_type in ('purchase', 'click') then 'T'
              when event_type in ('view', 'signup') then 'Q' else 'X' end as rec_type,
         concat('S', cast(user_id % 3 as varchar)) as symbol,
         case when event_id % 2 = 0 then 'NYSE' else 'NASDAQ' end as exchange,
         ts as event_tm, event_id as event_seq_nb, ts as arrival_tm,
         value as pr, event_id % 500 + 1 as sz
  from events)"""

FEED = BASE + """,
feed0 as (
  select * from base
  union all
  select trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb,
         arrival_tm + interval '1' hour, pr + 1.0, sz
  from base where event_seq_nb % 10 = 0),
feed as (
  select trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm,
         case when rec_type = 'T' then pr end as trade_pr,
         case when rec_type = 'Q' then pr end as bid_pr,
         case when rec_type = 'Q' then sz end as bid_size,
         case when rec_type = 'Q' then pr + 0.05::double end as ask_pr,
         case when rec_type = 'Q' then sz end as ask_size,
         case when rec_type in ('T', 'Q') then rec_type else 'B' end as partition
  from feed0)"""

EOD = FEED + """,
trades as (
  select trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr
  from (select *, row_number() over (
                    partition by trade_dt, symbol, exchange, event_tm, event_seq_nb
                    order by arrival_tm desc, trade_pr desc) as rn
        from feed where partition = 'T') t
  where rn = 1),
quotes as (
  select trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm,
         bid_pr, bid_size, ask_pr, ask_size
  from (select *, row_number() over (
                    partition by trade_dt, symbol, exchange, event_tm, event_seq_nb
                    order by arrival_tm desc, bid_pr desc) as rn
        from feed where partition = 'Q') t
  where rn = 1)"""

MOV = EOD + """,
mov as (
  select *, avg(trade_pr) over (
              partition by trade_dt, symbol, exchange
              order by cast(floor(epoch(event_tm)) as bigint)
              range between 1800 preceding and current row) as mov_avg_pr
  from trades)"""

TIMELINE = MOV + """,
timeline as (
  select trade_dt, 'T' as rec_type, symbol, event_tm, event_seq_nb, exchange,
         cast(null as double) as bid_pr, cast(null as bigint) as bid_size,
         cast(null as double) as ask_pr, cast(null as bigint) as ask_size,
         trade_pr, mov_avg_pr, 0 as rec_sort
  from mov
  union all
  select trade_dt, 'Q', symbol, event_tm, event_seq_nb, exchange, bid_pr, bid_size,
         ask_pr, ask_size, cast(null as double), cast(null as double), 1
  from quotes)"""

FILLED = TIMELINE + """,
filled as (
  select *,
         last_value(trade_pr ignore nulls) over w as last_trade_pr,
         last_value(mov_avg_pr ignore nulls) over w as last_mov_avg_pr
  from timeline
  window w as (partition by trade_dt, symbol, exchange
               order by event_tm, event_seq_nb, rec_sort
               rows between unbounded preceding and current row))"""

CLOSES = """,
day_last as (
  select trade_dt, symbol, exchange, trade_pr
  from (select *, row_number() over (
                    partition by trade_dt, symbol, exchange
                    order by event_tm desc, event_seq_nb desc) as rn
        from trades) t
  where rn = 1),
closes as (
  select cast(trade_dt + 1 as date) as trade_dt, symbol, exchange, trade_pr as close_pr
  from day_last)"""

ANALYTICS = FILLED + CLOSES + """,
analytics as (
  select f.symbol, f.exchange, f.trade_dt, f.rec_type, f.event_tm, f.event_seq_nb,
         f.bid_pr, f.bid_size, f.ask_pr, f.ask_size, f.trade_pr,
         round(f.mov_avg_pr, 6) as mov_avg_pr, f.rec_sort, f.last_trade_pr,
         round(f.last_mov_avg_pr, 6) as last_mov_avg_pr, c.close_pr,
         f.bid_pr - c.close_pr as bid_pr_mv, f.ask_pr - c.close_pr as ask_pr_mv
  from filled f
  left join closes c
    on f.trade_dt = c.trade_dt and f.symbol = c.symbol and f.exchange = c.exchange
  where f.rec_type = 'Q')"""

# Parsed CSV lines: quote lines of every 13th event lack ask_size (bad);
# times are cut to milliseconds by the text format.
CSV_EXPECTED = """csv_expected as (
  select trade_dt, rec_type, symbol, exchange,
         date_trunc('millisecond', event_tm) as event_tm, event_seq_nb,
         date_trunc('millisecond', arrival_tm) as arrival_tm,
         case when rec_type = 'T' then pr end as trade_pr,
         case when rec_type = 'Q' and event_seq_nb % 13 <> 0 then pr end as bid_pr,
         case when rec_type = 'Q' and event_seq_nb % 13 <> 0 then sz end as bid_size,
         case when rec_type = 'Q' and event_seq_nb % 13 <> 0
              then pr + 0.05::double end as ask_pr,
         case when rec_type = 'Q' and event_seq_nb % 13 <> 0 then sz end as ask_size,
         case when rec_type = 'T' then 'T'
              when rec_type = 'Q' and event_seq_nb % 13 <> 0 then 'Q'
              else 'B' end as partition
  from base)"""

# Parsed JSON lines: every 7th line lacks its closing brace (NULL map).
def _json_expected(name: str, where: str = "true") -> str:
    return f"""{name} as (
  select case when bad then null else trade_dt end as trade_dt,
         case when bad then null else rec_type end as rec_type,
         case when bad then null else symbol end as symbol,
         case when bad then null else exchange end as exchange,
         case when bad then null else date_trunc('millisecond', event_tm) end as event_tm,
         case when bad then null else event_seq_nb end as event_seq_nb,
         case when bad then null else date_trunc('millisecond', arrival_tm) end as arrival_tm,
         case when not bad and rec_type = 'T' then pr end as trade_pr,
         case when not bad and rec_type = 'Q' then pr end as bid_pr,
         case when not bad and rec_type = 'Q' then sz end as bid_size,
         case when not bad and rec_type = 'Q' then pr + 0.05::double end as ask_pr,
         case when not bad and rec_type = 'Q' then sz end as ask_size,
         case when not bad and rec_type in ('T', 'Q') then rec_type else 'B' end as partition
  from (select *, event_seq_nb % 7 = 0 as bad from base where {where}) b)"""


JSON_EXPECTED = _json_expected("json_expected")

EVENT_COLS = ("trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm, "
              "trade_pr, bid_pr, bid_size, ask_pr, ask_size, partition")

def _ingest_rows() -> str:
    # CSV lines of even events, JSON lines of odd events (the truncated ones
    # lose their sequence, so odd events are chosen before blanking).
    return f"""with {BASE}, {CSV_EXPECTED},
{_json_expected("json_odd", "event_seq_nb % 2 = 1")},
ingest as (
  select {EVENT_COLS} from csv_expected where event_seq_nb % 2 = 0
  union all
  select {EVENT_COLS} from json_odd)"""


def _run_rows(run_id: str) -> str:
    return f"select {EVENT_COLS}, '{run_id}' as run_id from feed"


ORACLES: dict[str, str] = {
    "csv_parse_events": f"with {BASE}, {CSV_EXPECTED} select * from csv_expected",
    "json_parse_events": f"with {BASE}, {JSON_EXPECTED} select * from json_expected",
    "csv_parse_timestamps": f"with {BASE}, {CSV_EXPECTED} select * from csv_expected",
    "json_parse_timestamps": f"with {BASE}, {JSON_EXPECTED} select * from json_expected",
    "text_scan": """
select case when event_id % 2 = 0 then 'csv' else 'json' end as root,
       event_id % 2 = 1 as is_json, count(*) as n_lines
from events group by all
union all
select case when event_id % 2 = 0 then 'json' else 'csv' end, event_id % 2 = 1, count(*)
from events where event_id % 5 = 0 group by all""",
    "ingest_job": _ingest_rows()
    + " select partition, count(*) as n_written, count(*) as n_observed from ingest group by partition",
    "retried_run": f"""with {FEED}
select '{R.RUN_NEW}' as run_id, partition, count(*) as n_rows from feed
where partition <> 'B' group by partition
union all
select '{R.RUN_OLD}', case when rec_type in ('T', 'Q') then rec_type else 'B' end, count(*)
from base group by all""",
    "analytics_job": f"""with {ANALYTICS}
select * from analytics where trade_dt = (select max(trade_dt) from trades)""",
    "string_time_analytics": f"""with {ANALYTICS}
select * from analytics where trade_dt = (select max(trade_dt) from trades)""",
    "ingest_union": _ingest_rows() + " select * from ingest",
    "ingest_partition_counts": _ingest_rows()
    + " select partition, count(*) as n_rows from ingest group by partition",
    "bad_record_routing": f"""with {BASE}, {CSV_EXPECTED}, {JSON_EXPECTED}
select * from csv_expected where partition = 'B'
union all
select * from json_expected where partition = 'B'""",
    "parquet_partition_roundtrip": f"with {FEED} "
    + _run_rows(R.RUN_NEW) + " where partition = 'T'",
    "latest_run": f"with {FEED} " + _run_rows(R.RUN_NEW),
    "latest_trade_date": f"""with {EOD}
select max(trade_dt) as latest_dt, cast(max(trade_dt) - 1 as date) as previous_dt
from trades""",
    "previous_trade_date": f"""with {EOD}
select max(trade_dt) as previous_dt from trades
where trade_dt < (select max(trade_dt) from trades)""",
    "eod_trades_latest": f"with {EOD} select * from trades",
    "eod_quotes_latest": f"with {EOD} select * from quotes",
    "latest_with_tiebreaker": f"""with {FEED}
select {EVENT_COLS} from (
  select *, row_number() over (
              partition by trade_dt, symbol, exchange
              order by arrival_tm desc, event_seq_nb desc, rec_type desc) as rn
  from feed) t
where rn = 1""",
    "eod_counts_by_date": f"""with {EOD}
select trade_dt, count(*) as n_rows, 'trade' as table_name from trades group by trade_dt
union all
select trade_dt, count(*) as n_rows, 'quote' as table_name from quotes group by trade_dt""",
    "eod_incremental": f"""with {EOD}
select trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr, 'T' as rec_type,
       cast(null as double) as bid_pr, cast(null as bigint) as bid_size, cast(null as double) as ask_pr,
       cast(null as bigint) as ask_size from trades
union all
select trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, null, 'Q', bid_pr, bid_size, ask_pr, ask_size
from quotes""",
    "eod_footer_counts": f"""with {EOD}
select trade_dt, count(*) as n_rows, min(event_seq_nb) as min_event_seq_nb, max(event_seq_nb) as max_event_seq_nb,
       'trade' as table_name from trades group by trade_dt
union all
select trade_dt, count(*), min(event_seq_nb), max(event_seq_nb), 'quote' from quotes group by trade_dt""",
    "clustered_lookup": f"""with {EOD}
select * from trades where symbol = '{R.LOOKUP_SYMBOL}' and exchange = '{R.LOOKUP_EXCHANGE}'""",
    "quote_row_reconciliation": f"""with {EOD},
q as (select trade_dt, symbol, exchange, event_tm, event_seq_nb, bid_pr, bid_size, ask_pr, ask_size,
             row_number() over (partition by trade_dt order by event_tm, event_seq_nb, symbol, exchange) as up,
             row_number() over (partition by trade_dt order by event_tm desc, event_seq_nb desc, symbol desc, exchange desc) as down
      from quotes),
damaged as (select q.* exclude (up, down) from q, range(2) as t(k) where (k = 0 and up > 1) or (k = 1 and down = 1)),
lost as (select trade_dt, count(*) as n from (
           select * exclude (up, down) from q except all select * from damaged) x group by trade_dt),
n_in as (select trade_dt, count(*) as n from quotes group by trade_dt),
n_out as (select trade_dt, count(*) as n from damaged group by trade_dt)
select 'enriched' as table_name, trade_dt, n as n_in, n as n_out, true as same_count, true as same_rows from n_in
union all
select 'damaged', i.trade_dt, i.n, o.n, i.n = o.n, i.n = o.n and l.n is null
from n_in i join n_out o using (trade_dt) left join lost l using (trade_dt)""",
    "correction_counts": f"""with {EOD},
before as (select partition as rec_type, count(*) as n_before from feed
           where partition <> 'B' group by partition),
after as (select 'T' as rec_type, count(*) as n_after from trades
          union all select 'Q', count(*) from quotes)
select b.rec_type, b.n_before, a.n_after from before b join after a using (rec_type)""",
    "trade_moving_average": f"""with {MOV}
select trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr,
       round(mov_avg_pr, 6) as mov_avg_pr
from mov""",
    "previous_close": f"with {EOD} {CLOSES} select * from closes",
    "previous_close_available": f"""with {EOD} {CLOSES},
dates as (select distinct trade_dt as d from quotes),
prev as (select d, (select max(trade_dt) from trades t where t.trade_dt < d) as p
         from dates)
select l.symbol, l.exchange, prev.d as trade_dt, l.trade_pr as close_pr
from day_last l join prev on l.trade_dt = prev.p""",
    "close_join": f"""with {EOD} {CLOSES}
select q.trade_dt, q.symbol, q.exchange, q.event_tm, q.event_seq_nb, q.arrival_tm,
       q.bid_pr, q.bid_size, q.ask_pr, q.ask_size, c.close_pr,
       q.bid_pr - c.close_pr as bid_pr_mv, q.ask_pr - c.close_pr as ask_pr_mv
from quotes q left join closes c
  on q.trade_dt = c.trade_dt and q.symbol = c.symbol and q.exchange = c.exchange""",
    "event_timeline": f"""with {TIMELINE}
select trade_dt, rec_type, symbol, event_tm, event_seq_nb, exchange, bid_pr, bid_size,
       ask_pr, ask_size, trade_pr, round(mov_avg_pr, 6) as mov_avg_pr, rec_sort
from timeline""",
    "forward_fill_quotes": f"""with {FILLED}
select trade_dt, rec_type, symbol, event_tm, event_seq_nb, exchange, bid_pr, bid_size,
       ask_pr, ask_size, trade_pr, round(mov_avg_pr, 6) as mov_avg_pr, rec_sort,
       last_trade_pr, round(last_mov_avg_pr, 6) as last_mov_avg_pr
from filled where rec_type = 'Q'""",
    "quote_trade_analytics": f"with {ANALYTICS} select * from analytics",
    "latest_date_analytics": f"""with {ANALYTICS}
select * from analytics where trade_dt = (select max(trade_dt) from trades)""",
    "quote_reconciliation": f"""with {ANALYTICS}
select (select count(*) from quotes) as n_in, (select count(*) from analytics) as n_out,
       (select count(*) from quotes) = (select count(*) from analytics) as matched""",
    "null_fill_count": f"""with {ANALYTICS}
select count(*) as n_null from analytics where last_trade_pr is null""",
    "top_quotes": f"""with {ANALYTICS}
select * from analytics order by symbol, event_tm, exchange, event_seq_nb
limit {R.TOP_N}""",
}

JOBS = """ev as (select *, cast(ts as date) as day from events),
current_jobs as (
  select concat(event_type, '_', strftime(day, '%Y-%m-%d')) as job_id,
         'success' as status, max(ts) as updated_time
  from ev group by event_type, day),
updates as (
  select concat('error_', strftime(day, '%Y-%m-%d')) as job_id, 'retried' as status,
         min(ts) as updated_time
  from ev where event_type = 'error' group by day
  union all
  select concat('audit_', strftime(day, '%Y-%m-%d')), 'success', max(ts)
  from ev group by day),
upserted as (
  select * from updates
  union all
  select * from current_jobs c
  where c.job_id not in (select job_id from updates))"""

ORACLES["job_status_upsert"] = f"with {JOBS} select * from upserted"
ORACLES["job_status_lookup"] = (f"with {JOBS} select * from upserted "
                                f"where job_id = '{R.LOOKUP_JOB}'")
