"""Column layouts of the data model.

Fixed values: these names, orders and types must equal the reference data
model so that tables written by one side can be read by the other.
"""

from pyspark.sql import types as T

# The common event layout, in output order.
EVENT_COLUMNS = [
    "trade_dt", "rec_type", "symbol", "exchange", "event_tm", "event_seq_nb",
    "arrival_tm", "trade_pr", "bid_pr", "bid_size", "ask_pr", "ask_size",
    "partition",
]

# End-of-day trade and quote layouts.
TRADE_COLUMNS = [
    "trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb", "arrival_tm",
    "trade_pr",
]
QUOTE_COLUMNS = [
    "trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb", "arrival_tm",
    "bid_pr", "bid_size", "ask_pr", "ask_size",
]

# The business key of an event version (correction key).
EVENT_KEY = ["trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb"]

# Record types and the bad-record partition.
QUOTE, TRADE, BAD = "Q", "T", "B"

# The analytical output layout, in output order.
ANALYTIC_COLUMNS = [
    "symbol", "exchange", "trade_dt", "rec_type", "event_tm", "event_seq_nb",
    "bid_pr", "bid_size", "ask_pr", "ask_size", "trade_pr", "mov_avg_pr",
    "rec_sort", "last_trade_pr", "last_mov_avg_pr", "close_pr", "bid_pr_mv",
    "ask_pr_mv",
]


def event_schema(ntz: bool = False) -> T.StructType:
    ts = T.TimestampNTZType() if ntz else T.TimestampType()
    return T.StructType([
        T.StructField("trade_dt", T.DateType()),
        T.StructField("rec_type", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("event_tm", ts),
        T.StructField("event_seq_nb", T.LongType()),
        T.StructField("arrival_tm", ts),
        T.StructField("trade_pr", T.DoubleType()),
        T.StructField("bid_pr", T.DoubleType()),
        T.StructField("bid_size", T.LongType()),
        T.StructField("ask_pr", T.DoubleType()),
        T.StructField("ask_size", T.LongType()),
        T.StructField("partition", T.StringType()),
    ])


