"""All 36 request functions exist, check their arguments and run on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.requests import market

D = dt.date
NAMES = """get_daily get_intraday get_quote get_historical_tick update_data update_data_status get_chain
get_daily_curve search_curves update_curves get_table get_curve_timeseries update_timeseries
delete_timeseries get_calendar get_calendar_details get_contract_details get_metadata search_metadata
update_metadata delete_metadata get_folder update_folder delete_folder symbol_search
symbol_search_by_exchange get_symbol_information get_instrument_list delete_symbol get_currency_list
get_exchange_list get_timezones get_unit_list get_permissioned_roots get_option_analytics
get_option_analytics_single""".split()


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    m = market(spark, sf_dir)
    typed = m.tables["instruments"].withColumn("unit", F.lit("BBL"))
    prices = m.tables["prices"].withColumns(
        {"optionroot": F.lit("/GCL"), "securitytype": F.lit("f"), "settledate": F.col("tradedatetimeutc")})
    extra = {
        "instruments": typed, "prices": prices,
        "units": spark.sql("SELECT 'BBL' unit, 'GAL' to_unit, 42D factor"),
        "grants": typed.select("option_root").limit(1),
        "currencies": prices.select("currency"), "exchanges": typed.select("exchange_code"),
        "timezones": spark.sql("SELECT 'Eastern' timezone, 'America/New_York' iana_code"),
        "audit": spark.sql("SELECT 'r1' run_id, 5L inserted"),
        "curve_config": spark.sql("SELECT 'C1' symbol, 'HUSA' holiday"),
        "curve_inputs": spark.sql("SELECT 'C1' symbol, 'INPUT_A' role"),
        "curve_points": spark.sql("SELECT 'C1' symbol, DATE'2024-03-01' onDate, 'CURVE' field, 'M01' tenor, "
                                  "1D value, 'a' reason"),
    }
    for name, df in extra.items():
        m = m.with_table(name, df)
    return m


def test_every_function_is_there(data):
    assert len(NAMES) == 36 and all(callable(getattr(data, n)) for n in NAMES)


def test_history(data):
    one = data.get_daily("P1", ["symbol", "close"], settledonly=True, maxrows=3)
    assert one.count() == 3 and one.columns == ["symbol", "close"]
    assert data.get_daily(["P1", "P2"], recordsback=1).count() == 2
    assert data.get_daily("click", aggregatetype=2).count() > 0
    assert data.get_daily("P1", ondate=D(1990, 1, 1)).count() == 0
    assert data.get_intraday("click", intradaybarinterval=60, recordsback=4).count() == 4
    assert data.get_historical_tick("click", ["symbol", "last"], daysback=2).count() > 0
    assert data.get_quote("P1", "STANDARD").count() == 1
    for wrong in (dict(fill="guess"), dict(aggregatetype=5), dict(currency="XXX"), dict(lotunits="XXX")):
        with pytest.raises(ValueError):
            data.get_daily("P1", **wrong)


def test_units(data):
    with_unit = data.with_table("prices", data.tables["prices"].withColumn("unit", F.lit("BBL")))
    plain = {r.tradedatetimeutc: r.close for r in with_unit.get_daily("P1").collect()}
    gallons = {r.tradedatetimeutc: r.close for r in with_unit.get_daily("P1", lotunits="GAL").collect()}
    assert gallons == {t: v * 42 for t, v in plain.items()}


def test_curves(data, spark):
    assert data.get_chain("/GCL", "ALL", "f", D(1998, 1, 1)).count() > 0
    with pytest.raises(ValueError):
        data.get_chain("/GCL", "ALL", "x")
    assert data.get_daily_curve("PROMO", curvesize=2).count() > 0
    with pytest.raises(Exception, match="unknown root"):
        data.get_daily_curve("NOSUCH").collect()
    assert data.get_daily_curve("NOSUCH", ignoreerrors=True).count() == 0
    assert data.get_table("PROMO", ["tenor", "value", "change"], "latest").count() > 0
    assert data.search_curves(holiday="HUSA").count() == 1
    body = spark.sql("SELECT 'C1' symbol, DATE'2024-03-01' onDate, 'CURVE' field, 'b' reason, "
                     "array(named_struct('tenor','M01','value',2D), named_struct('tenor','M02','value',3D)) tenors")
    assert sorted(r.value for r in data.update_curves(body).collect()) == [2.0, 3.0]
    latest = data.get_curve_timeseries("P1", "latest", timezone="America/New_York")
    assert latest.count() > 0


def test_series_updates(data, spark):
    body = spark.sql("SELECT 'N' SYMBOL, 'CLOSE' FIELD, '' ONDATE, '2024-03-09T00:00:00Z' INDEX, 1.5D VALUE")
    before = data.tables["series"].count()
    after = data.update_timeseries(body, "1M")
    assert after.count() == before + 1
    assert after.where("symbol = 'N'").first()["index"] == dt.datetime(2024, 3, 1)
    items = spark.sql("SELECT 'N' symbol, 'CLOSE' field, CAST(NULL AS DATE) curvedate, "
                      "array(TIMESTAMP'2024-03-01') indexes")
    assert data.with_table("series", after).delete_timeseries(items).count() == before
    wide = spark.sql("SELECT 'N' SYMBOL, '01-04-2023' DATE, 10.1D CLOSE, 'USD' CURRENCY, 45 `*DENSITY`, "
                     "'\\\\DOC\\\\SPOT' FOLDER_PATH")
    parts = data.update_data(wide, "why")
    row = parts["series"].first()
    assert (row.field, row["index"], row.value, row.reason) == ("CLOSE", dt.datetime(2023, 4, 1), 10.1, "why")
    assert {(r.property, r.value) for r in parts["metadata"].collect()} == {("CURRENCY", "USD"), ("DENSITY", "45")}
    assert parts["folders"].first().path == "DOC/SPOT"
    assert data.update_data_status("r1").first().inserted == 5


def test_calendars(data):
    assert data.get_calendar(["1-URGENT"], "Expiry").count() == 1
    days = data.get_calendar_details("1-URGENT", D(1997, 1, 1), D(1997, 12, 31), quoting=True)
    assert 240 < days.count() < 262
    tenors = data.get_calendar_details("1-URGENT", D(1997, 1, 1), D(1997, 12, 31), tenor=["M01", "1997Q03"])
    assert tenors.count() == 2
    assert data.get_contract_details(["1-URGENT", "2-HIGH"], D(1997, 1, 1), D(1997, 12, 31), "M02").count() == 2
    with pytest.raises(ValueError):
        data.get_contract_details("1-URGENT", "1997-01-01", D(1997, 12, 31))


def test_reference_and_symbols(data, spark):
    assert data.get_metadata("P1", ["brand"]).columns == ["symbol", "brand"]
    assert data.get_metadata("P1").count() == 3
    assert data.search_metadata(type=["PROMO"]).count() > 0
    items = spark.sql("SELECT 'P1' SYMBOL, 'v' PROP1")
    more = data.update_metadata(items)
    assert more.count() == data.tables["metadata"].count() + 1
    gone = spark.sql("SELECT 'P1' symbol, array('PROP1', 'brand') properties")
    assert data.with_table("metadata", more).delete_metadata(gone).count() == more.count() - 2
    path = data.tables["folders"].first().path
    assert data.get_folder(path).count() > 0
    assert data.delete_folder([path]).where(F.col("path") == path).count() == 0
    assert data.symbol_search("p1").count() > 0
    assert data.symbol_search_by_exchange("Brand#1", recordsback=2).count() <= 2
    assert data.get_symbol_information("P1").count() == 1
    assert data.get_symbol_information("P1", D(2002, 1, 1), "versions").count() >= 1
    assert data.get_symbol_information("C1", info="inputs").count() == 1
    assert data.get_instrument_list(symbol="P1").count() == 1
    left = data.delete_symbol(["P1"])
    assert left["prices"].where("symbol = 'P1'").count() == 0 and "series" in left
    assert data.get_currency_list().count() == 5
    assert data.get_exchange_list().count() == 25
    assert data.get_permissioned_roots(["option_root"]).count() == 1
    assert data.get_timezones(ianaCodes=["America/New_York"]).count() == 1
    assert data.get_unit_list("P1").first().to_unit == "GAL"
    with pytest.raises(ValueError):
        data.get_unit_list(None)
    with pytest.raises(ValueError, match="needs the table"):
        type(data)({}).get_currency_list()


def test_options(data):
    out = data.get_option_analytics_single(["symbol", "delta"], D(2024, 1, 2), "P1", volatility=0.2)
    assert out.count() == 1
    with pytest.raises(ValueError):
        data.get_option_analytics(["symbol"], D(2024, 1, 2), optionmodel="tree")


def test_update_folder(data, spark):
    body = spark.sql("SELECT 'R' folderId, array(named_struct('name','N')) folders, "
                     "array(named_struct('symbol','S9')) content, CAST(NULL AS STRING) reason")
    m = data.with_table("folders", spark.sql("SELECT 'R' path, 'S1' symbol, 'x' reason"))
    assert sorted(r.reason for r in m.update_folder(body, "doc").collect()) == ["doc", "doc", "x"]
