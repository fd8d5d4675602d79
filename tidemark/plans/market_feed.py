"""Market data derived from the ``events`` table.

The test tables hold no exchange data, so the registered queries derive it
from ``events`` with one fixed mapping (identical in the DuckDB oracle):

* ``purchase``/``click`` -> trade ``T``; ``view``/``signup`` -> quote ``Q``;
  anything else -> type ``X`` (a bad record).
* symbol ``S<user_id % 3>`` (three hot symbols, a third of the rows each),
  exchange ``NYSE`` for even ``event_id`` else ``NASDAQ``.
* event and arrival time ``ts``; sequence ``event_id``; price ``value``;
  size ``event_id % 500 + 1``; ask = bid + 0.05.
* every tenth event is re-sent one hour later with price + 1.0 (a
  correction that the end-of-day step must prefer).

The mapping and the line builders are row-local projections: they scale
with the ``events`` table and add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.sources import text

# Fixed values of the mapping (shared with the oracle SQL).
TRADE_EVENTS = ("purchase", "click")
QUOTE_EVENTS = ("view", "signup")
SYMBOLS = 3
CORRECTION_EVERY = 10
ASK_SPREAD = 0.05
SIZE_MOD = 500
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
DATE_TEXT = "yyyy-MM-dd"
# Line variations used by the parser checks.
SHORT_QUOTE_EVERY = 13     # quote line without ask_size -> bad record
EXTRA_FIELD_EVERY = 11     # trade line with one extra field -> still a trade
TRUNCATED_JSON_EVERY = 7   # JSON line without the closing brace -> bad
REC_TYPE_KEY_EVERY = 3     # JSON type under "rec_type" instead of "event_type"


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# The mapping as SQL expressions: one round trip per column when the plan is
# built, and the same text as the oracle's.
_BASE = [
    "cast(ts as date) as trade_dt",
    f"case when event_type in ({_in(TRADE_EVENTS)}) then 'T' "
    f"when event_type in ({_in(QUOTE_EVENTS)}) then 'Q' else 'X' end as rec_type",
    f"concat('S', cast(user_id % {SYMBOLS} as string)) as symbol",
    "case when event_id % 2 = 0 then 'NYSE' else 'NASDAQ' end as exchange",
    "ts as event_tm",
    "event_id as event_seq_nb",
    "ts as arrival_tm",
    "value as pr",
    f"event_id % {SIZE_MOD} + 1 as sz",
]
_TYPED = [
    "trade_dt", "rec_type", "symbol", "exchange", "event_tm", "event_seq_nb",
    "arrival_tm",
    "case when rec_type = 'T' then pr end as trade_pr",
    "case when rec_type = 'Q' then pr end as bid_pr",
    "case when rec_type = 'Q' then sz end as bid_size",
    f"case when rec_type = 'Q' then pr + cast({ASK_SPREAD} as double) end as ask_pr",
    "case when rec_type = 'Q' then sz end as ask_size",
    f"case when rec_type in ('T', 'Q') then rec_type else '{schema.BAD}' end as partition",
]


def _base(events: DataFrame) -> DataFrame:
    return events.selectExpr(*_BASE)


def _typed(df: DataFrame) -> DataFrame:
    return df.selectExpr(*_TYPED)


def market_events(events: DataFrame, corrections: bool = True) -> DataFrame:
    """Common events (``timestamp_ntz`` times) derived from ``events``."""
    base = _base(events)
    if corrections:
        # One scan: the row, and for some its correction, from one array.
        base = base.selectExpr(
            "trade_dt", "rec_type", "symbol", "exchange", "event_tm", "event_seq_nb", "sz",
            f"""inline(filter(array(
                named_struct('arrival_tm', arrival_tm, 'pr', pr),
                if(event_seq_nb % {CORRECTION_EVERY} = 0,
                   named_struct('arrival_tm', arrival_tm + INTERVAL 1 HOUR, 'pr', pr + 1.0D),
                   null)), x -> x is not null)) as (arrival_tm, pr)""")
    return _typed(base)


def _num(c: Column) -> Column:
    return c.cast("string")


def csv_lines(events: DataFrame) -> DataFrame:
    """One comma-separated submission line per event (column ``value``)."""
    b = _base(events)
    tm = lambda c: F.date_format(c, TIME_TEXT)
    head = [F.date_format("trade_dt", DATE_TEXT), tm("arrival_tm"), F.col("rec_type"),
            F.col("symbol"), tm("event_tm"), _num(F.col("event_seq_nb")),
            F.col("exchange")]
    pr, sz, ask = _num(F.col("pr")), _num(F.col("sz")), _num(F.col("pr") + F.lit(ASK_SPREAD))
    seq = F.col("event_seq_nb")
    quote = F.when(seq % SHORT_QUOTE_EVERY == 0, F.concat_ws(",", *head, pr, sz, ask)) \
        .otherwise(F.concat_ws(",", *head, pr, sz, ask, sz))
    trade = F.when(seq % EXTRA_FIELD_EVERY == 0, F.concat_ws(",", *head, pr, F.lit("extra"))) \
        .otherwise(F.concat_ws(",", *head, pr))
    other = F.concat_ws(",", *head, pr, sz, pr, sz)
    rt = F.col("rec_type")
    return b.select(F.when(rt == "Q", quote).when(rt == "T", trade).otherwise(other)
                    .alias("value"))


def json_lines(events: DataFrame) -> DataFrame:
    """One JSON object per event (column ``value``)."""
    b = _base(events)
    s = lambda k, c: F.concat(F.lit(f'"{k}":"'), c, F.lit('"'))
    n = lambda k, c: F.concat(F.lit(f'"{k}":'), _num(c))
    seq = F.col("event_seq_nb")
    type_key = F.when(seq % REC_TYPE_KEY_EVERY == 0, F.lit("rec_type")).otherwise("event_type")
    common = [
        s("trade_dt", F.date_format("trade_dt", DATE_TEXT)),
        s("file_tm", F.date_format("arrival_tm", TIME_TEXT)),
        s("event_tm", F.date_format("event_tm", TIME_TEXT)),
        n("event_seq_nb", seq),
        F.concat(F.lit('"'), type_key, F.lit('":"'), F.col("rec_type"), F.lit('"')),
        s("symbol", F.col("symbol")), s("exchange", F.col("exchange")),
    ]
    rt = F.col("rec_type")
    prices = F.when(rt == "T", n("trade_pr", F.col("pr"))).otherwise(
        F.concat_ws(",", n("bid_pr", F.col("pr")), n("bid_size", F.col("sz")),
                    n("ask_pr", F.col("pr") + F.lit(ASK_SPREAD)), n("ask_size", F.col("sz"))))
    body = F.concat(F.lit("{"), F.concat_ws(",", *common, prices))
    return b.select(F.when(seq % TRUNCATED_JSON_EVERY == 0, body)
                    .otherwise(F.concat(body, F.lit("}"))).alias("value"))


def write_submissions(spark: SparkSession, events: DataFrame, root: str,
                      noise_every: int = 5) -> tuple[str, str]:
    """Write a CSV root and a JSON root of submission files below ``root``.

    Even ``event_id`` go to the CSV root, odd ones to the JSON root.  Each
    root also gets lines of the other format (every ``noise_every``-th event
    of the other half, to be dropped by the parser) and a non-``.txt``
    folder (ignored by the scan).  Returns (csv_root, json_root).
    """
    even = F.col("event_id") % 2 == 0
    noise = F.col("event_id") % noise_every == 0
    csv_root, json_root = f"{root}/csv", f"{root}/json"
    text.write_lines(csv_lines(events.where(even)), f"{csv_root}/day1")
    text.write_lines(json_lines(events.where(~even & noise)), f"{csv_root}/mixed")
    text.write_lines(json_lines(events.where(~even)), f"{json_root}/day1")
    text.write_lines(csv_lines(events.where(even & noise)), f"{json_root}/mixed")
    for r in (csv_root, json_root):
        (events.select("event_id").write.mode("overwrite").json(f"{r}/not_text"))
    return csv_root, json_root
