"""Quote analytics in plain Python, trade by trade, for small fixtures."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

EPOCH = dt.datetime(1970, 1, 1)
KEYS = ("trade_dt", "symbol", "exchange")


def _second(row):
    t = row["event_tm"]
    return None if t is None else int((t - EPOCH).total_seconds() // 1)


def _average(trade, trades, seconds):
    """Mean price of the trades within the seconds up to the trade's own; a
    trade without a time sees those without a time."""
    own = _second(trade)
    near = [x["trade_pr"] for x in trades if x["trade_pr"] is not None and (
        _second(x) is None if own is None else _second(x) is not None and own - seconds <= _second(x) <= own)]
    return sum(near) / len(near) if near else None


def averages(trades, keys=KEYS, seconds=1800):
    """``trades`` (dicts) with ``mov_avg_pr``."""
    groups = defaultdict(list)
    for t in trades:
        groups[tuple(t[k] for k in keys)].append(t)
    return [t | {"mov_avg_pr": _average(t, group, seconds)} for group in groups.values() for t in group]


def filled(events, keys=KEYS):
    """``events`` with the last price and the last average so far."""
    out, last = [], defaultdict(lambda: [None, None])
    early = lambda v: (v is not None, v)  # noqa: E731  NULL comes first
    for e in sorted(events, key=lambda e: (early(e["event_tm"]), early(e["event_seq_nb"]), e["rec_sort"])):
        held = last[tuple(e[k] for k in keys)]
        for i, c in enumerate(("trade_pr", "mov_avg_pr")):
            if e.get(c) is not None:
                held[i] = e[c]
        out.append(e | {"last_trade_pr": held[0], "last_mov_avg_pr": held[1]})
    return out


def analytics(trades, quotes, close, keys=KEYS):
    """A dict per quote; ``close``: price by key."""
    events = [t | {"rec_sort": 0} for t in averages(trades, keys)]
    events += [q | {"rec_sort": 1, "rec_type": "Q", "trade_pr": None, "mov_avg_pr": None} for q in quotes]
    out = []
    for e in filled(events, keys):
        if e["rec_sort"]:
            key = tuple(e[k] for k in keys)
            c = None if None in key else close.get(key)  # a NULL key has no close
            move = lambda p, c=c: None if p is None or c is None else p - c
            out.append(e | {"close_pr": c, "bid_pr_mv": move(e["bid_pr"]), "ask_pr_mv": move(e["ask_pr"])})
    return out


def dicts(df):
    return [r.asDict() for r in df.collect()]


def rows(found, cols):
    def norm(v):
        return round(v, 8) if isinstance(v, float) else v
    out = [tuple(norm(r[c]) for c in cols) for r in found]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
