"""Hand-made rows with stated results: null words, keys, parsing, errors, invariants."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import black, casting, keys, money, tenors
from tidemark.operators import bars, conform, curves, fill, filters, ingest, mutate, options
from tidemark.operators.segments import history_columns
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import landing, sinks
from tidemark.sources.store import Store

UTC = dt.timezone.utc
RUN_TS = dt.datetime(2024, 6, 3, tzinfo=UTC)


def values(df, column):
    return [r[column] for r in df.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_column_counts():
    assert len(schemas.INSTRUMENT_COLUMNS) == 38 and len(schemas.INSTRUMENT_TABLE) == 43
    assert len(schemas.PRICE_COLUMNS) == 50 and len(schemas.PRICE_TABLE) == 54
    assert set(schemas.PRICE_COLUMNS) == {
        *schemas.PRICE_TEXT, *schemas.PRICE_TIMES, *schemas.PRICE_COUNTS, *schemas.PRICE_NUMBERS}
    assert len(schemas.CURRENCIES) == 29 and len(schemas.UNITS) == 14
    assert len(schemas.RATE_SOURCES) == 15


def test_null_words(spark):
    words = ["nan", "None", "<NA>", "NaT", "NaN", "", "x"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, symbol string")
    assert values(conform.clean_instruments(df).orderBy("i"), "symbol") == [
        None, None, None, None, "NaN", "", "x"]
    assert values(conform.clean_prices(df).orderBy("i"), "symbol") == [
        None, None, "<NA>", "NaT", None, None, "x"]


def test_expiry_text_stays_null(spark):
    df = spark.createDataFrame([(None,), ("2024-01",)], "displaycontractexpdate string")
    assert values(conform.clean_prices(df), "displaycontractexpdate") == [None, "2024-01"]


def test_number_parsing(spark):
    words = ["12.9", "-12.9", "x", "nan", "inf", " 7 ", "1_000", "1.0d", "1e3", "", "."]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, t string").orderBy("i")
    assert values(df.select(casting.parse_int(F.col("t")).alias("v")), "v") == [
        12, -12, None, None, None, 7, 1000, None, 1000, None, None]
    floats = values(df.select(casting.parse_float(F.col("t")).alias("v")), "v")
    assert math.isnan(floats[3]) and math.isinf(floats[4])
    assert floats[:3] + floats[5:] == [12.9, -12.9, None, 7.0, 1000.0, None, 1000.0, None, None]
    numeric = values(df.select(casting.to_numeric(F.col("t")).alias("v")), "v")
    assert numeric[3] is None and numeric[6] is None and numeric[0] == 12.9


def test_date_parsing(spark):
    words = ["1/3/2024 1:02:03 PM", "2024-01-02T03:04:05", "2024-01-02 03:04:05", "junk",
             "13/40/2024", "20240105", "2024-13-01", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, t string").orderBy("i")
    text = F.date_format(casting.parse_datetime(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("v")
    assert values(df.select(text), "v") == [
        "2024-01-03 13:02:03", "2024-01-02 03:04:05", "2024-01-02 03:04:05", None, None,
        "2024-01-05 00:00:00", None, None]


def test_strip_equals_python(spark):
    words = ["  a ", "\t\na\r", " a　", "a b", "\x1fa\x85", ""]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, t string").orderBy("i")
    got = values(df.select(casting.strip(F.col("t")).alias("v")), "v")
    assert got == [w.strip() for w in words]


def test_price_key(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 100000, tzinfo=UTC)
    rows = [(" A ", t, None), ("a", t.replace(microsecond=900000), None), ("a", None, None),
            (None, None, "PS")]
    df = spark.createDataFrame(rows, "symbol string, tradedatetimeutc timestamp, pricesymbol string")
    got = values(df.select(keys.price_hash(df).alias("k")), "k")
    assert got[0] == got[1] == sha("symbol:a|tradedatetimeutc:2024-01-01 00:00:00")
    assert got[2] == sha("symbol:a") and got[3] == sha("pricesymbol:ps")


def test_instrument_key_and_fallback(spark):
    df = spark.createDataFrame(
        [("S", "X", None), (None, None, " Only This "), (None, None, None)],
        "symbol string, exchange_code string, description string")
    got = values(df.select(keys.instrument_hash(df).alias("k")), "k")
    assert got == [sha("exchange_code:x|symbol:s"), sha("description:only this"), None]


def test_null_key_part_is_quarantined(spark):
    df = spark.createDataFrame(
        [("A", "2024-01-01", "1"), ("A", "bad", "2"), ("A", "worse", "3"), ("x" * 256, "2024-01-01", "4")],
        "symbol string, tradedatetimeutc string, close string")
    reasons = values(jobs.keyed(df, jobs.PRICES).orderBy("close"), "reason")
    assert reasons == [None, "trade time missing", "trade time missing", "text too long"]


def test_error_payloads(spark):
    bodies = ['{"error": 1}', "  {", "Error: x", "symbol,close\nA,1", "a" * 100 + "error"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").orderBy("i")
    got = values(df.select(landing.is_error_payload(F.col("b")).alias("v")), "v")
    assert got == [True, True, True, False, False]


def test_landed_files(spark, tmp_path):
    (tmp_path / "A.csv").write_text('symbol,close\nA,"1,5"\nB\n001,\n')
    (tmp_path / "B.csv").write_text("Some ERROR\n")
    assert [r.source_file.rsplit("/", 1)[1] for r in
            landing.error_files(spark, str(tmp_path)).collect()] == ["B.csv"]
    rows = landing.read_landed(spark, str(tmp_path / "A.csv"), ["symbol", "close"])
    good, bad = landing.split_corrupt(rows)
    assert [(r.symbol, r.close) for r in good.collect()] == [("A", "1,5"), ("001", None)]
    assert values(bad, "content") == ["B"]


def test_typed_parser_by_suffix(spark):
    df = spark.createDataFrame([("1.5", "2.9", "x")], "a string, b string, c string")
    row = landing.typed(df, {"Req-a": "float", "b": "int", "nope": "int"}).first()
    assert (row.a, row.b, row.c) == (1.5, 2, "x")
    with pytest.raises(ValueError):
        landing.typed(df, {"a": "decimal"})


def test_unequal_arrays_fail(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1.0, 2.0, 3.0])], "SYMBOL array<int>, CLOSE array<double>")
    with pytest.raises(Exception, match="differ in length"):
        conform.columnar_to_rows(df, ["SYMBOL", "CLOSE"]).collect()
    with pytest.raises(ValueError):
        conform.columnar_to_rows(df, ["SYMBOL", "HIGH"])


def test_fields(spark):
    df = spark.createDataFrame([("a", 1.0)], "symbol string, close double")
    assert conform.select_fields(df, ['"close"', ["symbol", F.upper]]).first().asDict() == {
        "close": 1.0, "symbol": "A"}
    for wrong in (["nope"], [["close", "float"]], [5], "NOPRESET"):
        with pytest.raises(ValueError):
            conform.select_fields(df, wrong)


def test_arguments_are_checked(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        fill.fill(df, ["id"], "d", "v", "guess")
    with pytest.raises(ValueError):
        bars.aggregate_hours(df, 3)
    with pytest.raises(ValueError):
        bars.bars(df, 0)
    with pytest.raises(ValueError):
        filters.corrections(df, ["id"], ["id"], "X")
    with pytest.raises(ValueError):
        curves.daily_curve(df, curvedate=dt.date(2024, 1, 1), curvedateend=dt.date(2024, 1, 2))
    for size in (0, 1.5, True):
        with pytest.raises(ValueError):
            curves.daily_curve(df, curvesize=size)
    with pytest.raises(ValueError):
        curves.curve_values(df, 9)
    with pytest.raises(ValueError):
        ingest.first_by_key(df, ["id"], [])


def test_missing_root_fails(spark):
    points = spark.createDataFrame([("A",), ("B",)], "curveroot string")
    curves.check_roots(["A", "B"], points, "curveroot")
    with pytest.raises(ValueError, match="unknown roots: Z"):
        curves.check_roots(["A", "Z"], points, "curveroot")


def test_segments_cross_borders(spark):
    """Values carry over empty segments, and every tie order is honoured."""
    start = dt.datetime(2024, 1, 1, 23, 59, tzinfo=UTC)
    rows = [("A", start, 1, 10.0), ("A", start, 2, None), ("A", start + dt.timedelta(hours=30), 3, 5.0),
            ("B", start, 1, None)]
    df = spark.createDataFrame(rows, "k string, t timestamp, s int, v double")
    out = history_columns(df, ["k"], "t", ["t", "s"], {"prev": "v"}, {"total": "v"},
                          {"known": ["v", "t"]}, "hour").orderBy("k", "s").collect()
    assert [r.prev for r in out] == [None, 10.0, None, None]
    assert [r.total for r in out] == [10.0, 10.0, 15.0, None]
    assert [r.known and r.known.v for r in out] == [10.0, 10.0, 5.0, None]


def test_fill_keeps_observed_values(spark):
    day = dt.date(2024, 1, 4)  # a Thursday
    rows = [("A", day, 1.0), ("A", day + dt.timedelta(days=5), 6.0), ("B", day, 3.0)]
    df = spark.createDataFrame(rows, "symbol string, day date, v double")

    def run(method, calendar="sevendays", end=None):
        out = fill.fill(df, ["symbol"], "day", "v", method, calendar, end)
        return [(r.symbol, r.day.day, r.v) for r in out.orderBy("symbol", "day").collect()]

    assert run("forward") == [("A", d, 1.0) for d in (4, 5, 6, 7, 8)] + [("A", 9, 6.0), ("B", 4, 3.0)]
    assert run("backward", "business") == [("A", 4, 1.0), ("A", 5, 6.0), ("A", 8, 6.0), ("A", 9, 6.0),
                                           ("B", 4, 3.0)]
    assert run("average", "sixdays")[2] == ("A", 6, 3.5)
    assert [v for s, _, v in run("interpolate") if s == "A"] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    end = run("projected", end=dt.date(2024, 1, 11))
    assert end[-3:] == [("B", d, 3.0) for d in (9, 10, 11)] and ("A", 11, 8.0) in end
    assert run("nofill") == [("A", 4, 1.0), ("A", 9, 6.0), ("B", 4, 3.0)]


def test_tenors(spark):
    as_of = F.lit(dt.date(2024, 11, 20))
    wanted = {"M01": "2024-12-01", "M14": "2026-01-01", "Q01": "2025-01-01", "Y01": "2025-01-01",
              "2025M06": "2025-06-01", "2025Q03": "2025-07-01", "F25": "2025-01-01",
              "Z24": "2024-12-01", "X99x": None, "2025M13": None}
    df = spark.createDataFrame([(t,) for t in wanted], "t string")
    got = {r.t: r.d and str(r.d) for r in
           df.select("t", tenors.tenor_start(F.col("t"), as_of).alias("d")).collect()}
    assert got == wanted


def test_wildcard_escapes():
    assert tenors.like_pattern("/G_L<*>") == "/G\\_L%"


def test_prompt_contract_rolls_after_last_business_day(spark):
    # March 2024 ends on a Sunday: its last business day is Friday the 29th.
    df = spark.createDataFrame([(dt.date(2024, 3, 29),), (dt.date(2024, 3, 30),)], "d date")
    got = values(df.select(tenors.prompt_contract(F.col("d")).alias("c")), "c")
    assert got == [dt.date(2024, 4, 1), dt.date(2024, 5, 1)]


def test_conversion_formula(spark):
    df = spark.createDataFrame(
        [("S", "", "", None, 0.0), ("S", "EUR", "ECB", "BBL", 7.5), ("S", "EUR", "", "", 0.0)],
        "s string, c string, r string, u string, f double")
    got = values(df.select(money.conversion_formula(*[F.col(c) for c in "scruf"]).alias("v")), "v")
    assert got == ["S", '=""S"";[@EUR:ECB,@BBL:7.5]', '=""S"";[@EUR]']


def test_normal_distribution(spark):
    xs = [-38.0, -8.0, -3.0, -1.0, -1e-9, 0.0, 0.5, 2.0, 6.9, 9.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for row in df.select("x", black.normal_cdf(F.col("x")).alias("n")).collect():
        assert abs(row.n - 0.5 * math.erfc(-row.x / math.sqrt(2))) < 1e-14


def test_put_call_parity_and_implied_volatility(spark):
    rows = [(str(i), side, dt.date(2025, 1, 1), 80.0 + 5 * i, 100.0, 0.1 + 0.05 * i)
            for i in range(9) for side in "CP"]
    chain = spark.createDataFrame(
        rows, "symbol string, callput string, expiry date, strike double, underprice double, vol double")
    out = options.analytics(chain, dt.date(2024, 1, 2), rate=0.05, dividend=0.02)
    t = 365 / 365
    pairs = {}
    for r in out.collect():
        pairs.setdefault(r.strike, {})[r.callput] = r
    for strike, p in pairs.items():
        parity = 100 * math.exp(-0.02 * t) - strike * math.exp(-0.05 * t)
        assert abs(p["C"].value - p["P"].value - parity) < 1e-9
        assert abs(p["C"].gamma - p["P"].gamma) < 1e-12
    back = options.analytics(out.select(*chain.columns, F.col("value").alias("p")),
                             dt.date(2024, 1, 2), rate=0.05, dividend=0.02, contract_price=["p"])
    for r in back.collect():
        assert abs(r.impvol - r.vol) < 1e-8
    silly = options.analytics(chain.withColumn("p", F.lit(1e6)), dt.date(2024, 1, 2),
                              contract_price=["p"])
    assert set(values(silly, "impvol")) == {None}


def test_upsert_then_delete_restores_the_rest(spark):
    stored = spark.createDataFrame(
        [("A", "CLOSE", None, 1, 1.0), ("A", "CLOSE", dt.date(2024, 1, 1), 1, 2.0), ("B", "HIGH", None, 1, 3.0)],
        "symbol string, field string, ondate date, index int, value double")
    new = spark.createDataFrame([("A", "CLOSE", None, 1, 9.0), ("C", "CLOSE", None, 1, 4.0)], stored.schema)
    both = mutate.update_timeseries(stored, new)
    assert sorted(values(both, "value")) == [2.0, 3.0, 4.0, 9.0]
    items = new.select("symbol", "field", F.col("ondate").alias("curvedate"), F.array("index").alias("indexes"))
    assert sorted(values(mutate.delete_timeseries(both, items), "value")) == [2.0, 3.0]


def test_folders(spark):
    stored = spark.createDataFrame([("R/A", "S1", "Load"), ("R/A/B", "S2", "Load"), ("R/AB", "S3", "Load")],
                                   "path string, symbol string, reason string")
    assert values(mutate.delete_folder(stored, ["R/A"]), "symbol") == ["S3"]
    body = spark.createDataFrame([("R", [("N",)], [("S9",)], "why")],
                                 "folderId string, folders array<struct<name:string>>, "
                                 "content array<struct<symbol:string>>, reason string")
    added = mutate.update_folder(stored, body)
    assert {(r.path, r.symbol) for r in added.where("reason = 'why'").collect()} == {("R/N", None), ("R", "S9")}


def test_quoted_csv(spark):
    df = spark.createDataFrame([('a"b', 1.5, None), ("c", 2.0, "x,y")], "N string, V double, T string").coalesce(1)
    path = shared_dir(spark, "quoted")
    sinks.write_csv_quoted(df, path)
    assert sorted(values(spark.read.text(path), "value")) == sorted(
        ['"N","V","T"', '"a""b",1.5,""', '"c",2.0,"x,y"'])


def _run(spark, df, root, run):
    return jobs.run_ingest(spark, df, jobs.PRICES, Store(root), run, RUN_TS)


def test_replay_and_order(spark):
    rows = [("A", "2024-01-01", "1"), ("a ", "2024-01-01", "2"), ("B", "2024-02-01", "3"), (None, "2024-01-01", "4")]
    schema = "symbol string, tradedatetimeutc string, close string"
    root = shared_dir(spark, "replay")
    first = _run(spark, spark.createDataFrame(rows, schema).coalesce(1), root, "r1")
    assert first == {"inserted": 2, "skipped": 1, "failed": 1}
    again = _run(spark, spark.createDataFrame(rows[::-1], schema).coalesce(1), root, "r2")
    assert again == {"inserted": 0, "skipped": 3, "failed": 1}
    stored = Store(root).read(spark, "prices")
    assert sorted(values(stored, "close")) == [1.0, 3.0]
    assert jobs.already_ran(spark, Store(root), "r2") and not jobs.already_ran(spark, Store(root), "r3")


def test_empty_batch(spark):
    root = shared_dir(spark, "empty")
    df = spark.createDataFrame([], "symbol string, tradedatetimeutc string, close string")
    assert _run(spark, df, root, "r1") == {"inserted": 0, "skipped": 0, "failed": 0}


def test_fill_runs_from_the_first_to_the_last_row(spark):
    from tidemark.operators.fill import fill

    rows = [("A", dt.date(2024, 1, d), v) for d, v in ((1, None), (2, 1.0), (4, 3.0), (6, None))]
    df = spark.createDataFrame(rows, "symbol string, day date, value double")

    def values(method: str) -> list:
        return [r.value for r in fill(df, ["symbol"], "day", "value", method).orderBy("day").collect()]

    assert values("forward") == [None, 1.0, 1.0, 3.0, 3.0, 3.0]
    assert values("backward") == [1.0, 1.0, 3.0, 3.0, None, None]
    assert values("interpolate") == [None, 1.0, 2.0, 3.0, None, None]


def test_expired_and_flat_options_do_not_stop_the_chain(spark):
    from tidemark.operators.options import analytics

    day = dt.date(2024, 1, 15)
    rows = [("live", dt.date(2024, 7, 15), "C", 100.0, 105.0, 0.2, 9.0), ("expired", day, "C", 100.0, 105.0, 0.2, 5.0),
            ("put", day, "P", 100.0, 105.0, 0.2, 0.0), ("flat", dt.date(2024, 7, 15), "C", 100.0, 105.0, 0.0, 5.0),
            ("free", dt.date(2024, 7, 15), "C", 0.0, 105.0, 0.2, 105.0)]
    df = spark.createDataFrame(rows, "symbol string, expiry date, callput string, strike double, underprice double, vol double, price double")
    got = {r.symbol: r for r in analytics(df, day, contract_price=["price"]).collect()}
    assert got["expired"].value == 5.0 and got["put"].value == 0.0 and got["expired"].delta is None
    assert got["flat"].value == 5.0 and got["free"].value == 105.0 and got["expired"].impvol is None
    assert got["live"].delta > 0.5 and 0.1 < got["live"].impvol < 0.4


def test_double_texts_are_the_shortest(spark):
    from tidemark.functions.keys import double_text

    values = [0.0, 1.0, 1.5, 12345678.0, 123456789.25, 1e15, 1e16, 1.5e16, 2.5e300, 0.001, 0.00025, 1e-4, 1.5e-5, 1e-7, -12345678.5]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(double_text(F.col("v"))).collect()]
    assert got == [str(v) for v in values]


def test_wildcards_and_missing_keys(spark):
    from tidemark.operators import filters

    names = spark.createDataFrame([("CAT_F",), ("CATXF",), ("CAT\\F",)], "symbol string")
    assert [r.symbol for r in filters.wildcard_search(names, "CAT_F").collect()] == ["CAT_F"]
    assert filters.wildcard_search(names, "CAT%").count() == 3
    rows = spark.createDataFrame([(None, 1, 5), (None, 2, 5), ("k", None, 5)], "key string, stamp int, x int")
    got = {(r.key, r.stamp): r.updatetype for r in filters.revisions(rows, ["key"], ["stamp"]).collect()}
    assert got == {(None, 1): "I", (None, 2): "U", ("k", None): "I"}


def test_every_row_has_session_fields(spark):
    """NULL symbols and NULL times, in segments by calendar and by size; a NULL time comes last."""
    from tidemark.operators import history
    from tidemark.operators.segments import balanced_segments

    t = [dt.datetime(2024, m, 1, tzinfo=dt.timezone.utc) for m in (1, 2, 3)]
    rows = [("A", t[0], 1, 1.0), ("A", None, 2, 4.0), ("A", t[2], 3, 2.0), (None, t[1], 4, 7.0), (None, None, 5, 9.0), ("B", None, 6, 5.0), ("A", None, 7, 8.0)]
    df = spark.createDataFrame(rows, "symbol string, tradedatetimeutc timestamp, seq long, close double")
    want = {1: None, 3: 1.0, 2: 2.0, 7: 4.0, 4: None, 5: 7.0, 6: None}
    for given in (df, balanced_segments(df, ["symbol"], ["tradedatetimeutc", "seq"], 4)):
        got = history.session_fields(given, tie=["seq"]).collect()
        assert {r.seq: r.lastclose for r in got} == want and len(got) == len(rows)
        assert {r.seq: r.tradedatetimeutc is None for r in got} == {s: x is None for _, x, s, _ in rows}


def test_as_of_merge_keeps_every_left_row(spark):
    """Ties of time, one moment with most rows, missing keys and times, keys on one side only."""
    from tidemark.operators.convert import as_of_merge

    t = [dt.datetime(2024, 1, 1, h, tzinfo=dt.timezone.utc) for h in range(6)]
    right = spark.createDataFrame([("A", t[1], 1.0), ("A", t[3], 3.0), ("B", t[2], 2.0), (None, t[0], 9.0), ("A", None, 8.0)], "k string, ts timestamp, v double")
    rows = [("A", t[0], 0), ("A", t[1], 1), ("A", t[2], 2), ("A", None, 3), ("B", t[1], 4), ("B", t[5], 5), (None, t[5], 6), ("C", t[5], 7)]
    rows += [("A", t[4], 100 + i) for i in range(500)]
    got = {r.id: r.v for r in as_of_merge(spark.createDataFrame(rows, "k string, ts timestamp, id int"), right, ["k"], "ts", ["v"]).collect()}
    want = {0: None, 1: 1.0, 2: 1.0, 3: None, 4: None, 5: 2.0, 6: None, 7: None} | {100 + i: 3.0 for i in range(500)}
    assert got == want


def test_pages_by_counted_ranges(spark, monkeypatch):
    monkeypatch.setattr(filters, "HEAD_ROWS", 5)
    rows = [(None if i % 11 == 0 else i * 7 % 50, i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for number, size in ((1, 3), (1, 120), (2, 40), (3, 100), (4, 100), (5, 70), (300, 1), (301, 1)):
        got = filters.page(df, ["a", "b"], number, size).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(order[(number - 1) * size:number * size], key=repr)
    assert filters.max_rows(df, ["a", "b"], 200).count() == 200


def test_converted_symbols_are_checked(spark):
    from tidemark.plans.requests import ConvertedSymbol, MarketData

    data = MarketData({"prices": spark.createDataFrame([("A", RUN_TS, 1.0)], "symbol string, tradedatetimeutc timestamp, close double")})
    for wrong in (lambda: ConvertedSymbol("A<*>"), lambda: ConvertedSymbol("A", "XXX"), lambda: ConvertedSymbol("A", unit="XXX"),
                  lambda: data.get_daily(["A", ConvertedSymbol("A", "EUR")]), lambda: data.get_daily(ConvertedSymbol("A", "EUR"), currency="USD"),
                  lambda: data.get_daily(ConvertedSymbol("A", "EUR"))):
        with pytest.raises(ValueError):
            wrong()
    assert data.get_daily([ConvertedSymbol("A")]).first().close == 1.0


def test_an_expired_option_is_not_discounted(spark):
    terms = black.model_terms(F.lit("C"), F.lit(100.0), F.lit(90.0), F.lit(-1.0), F.lit(0.2), F.lit(0.5), F.lit(0.5))
    row = spark.range(1).select(*[c.alias(n) for n, c in terms.items()]).first()
    assert row["_strike"] == 90.0 and row["_spot"] == 100.0 and row["_root"] is None


def test_pages_keep_to_their_ranges(spark):
    """The rows of a page in the middle come from a filter on the order's columns, which reaches the scan."""
    path = shared_dir(spark, "pages")
    spark.range(40_000).selectExpr("id as a", "id % 7 as b").write.parquet(path)
    got = filters.page(spark.read.parquet(path), ["a"], 3, 6_000)
    assert sorted(r.a for r in got.collect()) == list(range(12_000, 18_000))


def test_files_with_another_header_or_an_error_spoil_nothing(spark):
    path = shared_dir(spark, "mixed")
    files = ["symbol,close\nA,1\n\n\"B, x\",2\n   \nC,3,4\n", "close,symbol\n9,Z\n", "\n{\"error\": 1}\n", "\"symbol\", \"close\"\r\nD,5\r\n", "symbol,close\n", ""]
    for f in files:
        spark.createDataFrame([(f,)], "value string").coalesce(1).write.mode("append").text(path)
    refused = landing.refused_files(spark, path, ["symbol", "close"])
    assert sorted(values(refused, "reason")) == ["error payload", "unexpected header"]
    rows, malformed = landing.landed_rows(spark, path, ["symbol", "close"], refused)
    assert sorted((r.symbol, r.close) for r in rows.collect()) == [("A", "1"), ("B, x", "2"), ("D", "5")]
    assert values(malformed, "content") == ["C,3,4"]


@pytest.mark.parametrize("method", ["forward", "backward", "average", "interpolate"])
def test_columns_filled_together_equal_each_alone(spark, method):
    import random

    from tidemark.operators.fill import fill, fill_all

    rng, start = random.Random(7), dt.date(2024, 1, 1)
    rows = [(s, start + dt.timedelta(days=d), *[rng.choice([None, None, float(rng.randint(1, 9))]) for _ in range(2)], None)
            for s in ("A", "B", "C") for d in rng.sample(range(60), 14)]
    rows += [("D", start, None, None, None), ("D", start + dt.timedelta(days=3), None, None, None), ("A", start, 1.0, None, None)]
    df = spark.createDataFrame(rows, "symbol string, day date, x double, y double, z double")
    for calendar in ("sevendays", "business"):
        got = {(r.symbol, r.day): (r.x, r.y, r.z) for r in fill_all(df, ["symbol"], "day", ["x", "y", "z"], method, calendar).collect()}
        alone = {v: {(r.symbol, r.day): r[v] for r in fill(df, ["symbol"], "day", v, method, calendar).collect()} for v in ("x", "y", "z")}
        assert set(got) == set().union(*alone.values()) and not any(s == "D" for s, _ in got)
        assert got == {k: tuple(alone[v].get(k) for v in ("x", "y", "z")) for k in got}
