"""Parser edge rows (CSV and JSON) with their expected routing."""

from tidemark.operators import parse
from tidemark import schema

H = "2020-08-05,2020-08-05 09:30:00.000"
E = "2020-08-05 09:34:51.505"

CSV_CASES = [
    (f"{H},Q,SYMA,{E},1,NASDAQ,75.30,100,75.35,100", "Q"),
    (f"{H},T,SYMA,{E},1,NASDAQ,75.30", "T"),
    (f"{H},T,SYMA,{E},1,NASDAQ,75.30,100,extra", "T"),
    (f"{H},Q,SYMA,{E},1,NASDAQ,75.30,100,75.35", "B"),
    (f"{H},T,SYMA,{E},1,NASDAQ", "B"),
    (f"{H},Q,SYMA,{E},1,NASDAQ,,,,", "Q"),
    (f"2020-08-05,2020-08-05 09:30:00.000, T,SYMA,{E},1,NASDAQ,75.30", "B"),
    ("not-a-date,bad,T,SYMA,bad,xx,NASDAQ,zz", "T"),
    (f"{H},X,SYMA,{E},1,NASDAQ,75.30,1,1,1", "B"),
    ("garbage", "B"),
    ("", "B"),
    ("  {\"a\":1}", None),
    ("\t{\"a\":1}", "B"),
]


def _lines(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_csv_routing(spark):
    rows = parse.parse_csv_lines(_lines(spark, [c for c, _ in CSV_CASES])).collect()
    expected = [p for _, p in CSV_CASES if p is not None]
    assert [r.partition for r in rows] == expected
    assert rows[0].bid_pr == 75.3 and rows[0].bid_size == 100 and rows[0].ask_pr == 75.35
    assert rows[0].trade_pr is None
    assert rows[1].trade_pr == 75.3 and rows[1].bid_pr is None
    assert rows[2].trade_pr == 75.3
    # short quote line: bad, typed columns NULL, rec_type kept
    assert rows[3].rec_type == "Q" and rows[3].bid_pr is None
    # trailing commas: valid quote with NULL prices
    assert rows[5].bid_pr is None and rows[5].ask_size is None
    # unparseable cells stay in their partition with NULLs
    bad_cells = rows[7]
    assert (bad_cells.trade_dt, bad_cells.arrival_tm, bad_cells.event_tm,
            bad_cells.event_seq_nb, bad_cells.trade_pr) == (None,) * 5
    assert rows[8].rec_type == "X"
    assert rows[9].trade_dt is None and rows[10].symbol is None


def test_csv_schema(spark):
    df = parse.parse_csv_lines(_lines(spark, ["x"]))
    assert df.schema == schema.event_schema()
    df = parse.parse_csv_lines(_lines(spark, ["x"]), ntz=True)
    assert df.schema == schema.event_schema(ntz=True)


JSON_CASES = [
    ('{"trade_dt":"2020-08-05","file_tm":"2020-08-05 09:30:00.000",'
     '"event_tm":"2020-08-05 09:34:51.505","event_seq_nb":1,"event_type":"Q",'
     '"symbol":"SYMA","exchange":"NASDAQ","bid_pr":75.30,"bid_size":100,'
     '"ask_pr":75.35,"ask_size":"100.0"}', "Q"),
    ('{"trade_dt":"2020-08-05","rec_type":"T","trade_pr":75.3,"event_seq_nb":2}', "T"),
    ('{"event_type":null,"rec_type":"T"}', "T"),
    ('{"event_type":"X","rec_type":"T"}', "B"),
    ('{"event_type":"Q"', "B"),
    ("{}", "B"),
    ('{"event_type":["Q"]}', "B"),
    ("Q,notjson", None),
]


def test_json_routing(spark):
    rows = parse.parse_json_lines(_lines(spark, [c for c, _ in JSON_CASES])).collect()
    assert [r.partition for r in rows] == [p for _, p in JSON_CASES if p is not None]
    q = rows[0]
    assert (q.bid_pr, q.bid_size, q.ask_pr, q.ask_size) == (75.3, 100, 75.35, 100)
    assert q.arrival_tm is not None and q.event_seq_nb == 1
    assert rows[1].trade_pr == 75.3 and rows[1].event_seq_nb == 2
    assert rows[3].rec_type == "X"
    assert rows[4].rec_type is None and rows[4].trade_dt is None


def test_json_lookup_first_duplicate_and_trailing_text(spark):
    lines = ['{"event_type":"T","trade_pr":1,"trade_pr":2}',
             '{"event_type":"T","trade_pr":3} trailing']
    rows = parse.parse_json_lines(_lines(spark, lines)).collect()
    assert rows[0].trade_pr == 1.0
    assert rows[1].trade_pr == 3.0 and rows[1].partition == "T"


def test_union_by_name(spark):
    csv = parse.parse_csv_lines(_lines(spark, [CSV_CASES[1][0]]))
    js = parse.parse_json_lines(_lines(spark, [JSON_CASES[1][0]]))
    out = parse.union_events(csv, js)
    assert out.columns == schema.EVENT_COLUMNS and out.count() == 2
