"""Requests as a client would send them, over the views of the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from checks.fills import LINE, OBS, checksum, checksum_sql, factors
from checks.history import BAR_SQL, TAGGED
from tidemark.plans.requests import ConvertedSymbol, MarketData
from tidemark.sources import views

ANCHOR = dt.datetime(2024, 1, 25, tzinfo=dt.timezone.utc)


def market(spark: SparkSession, sf_dir: str) -> MarketData:
    holidays = views.holidays(spark, sf_dir)
    return MarketData({
        "prices": views.daily(spark, sf_dir), "ticks": views.ticks(spark, sf_dir),
        "curves": views.curve(spark, sf_dir), "series": views.series(spark, sf_dir),
        "instruments": views.instruments(spark, sf_dir), "rates": views.rates(spark, sf_dir).withColumn("to_currency", F.lit("EUR")),
        "metadata": views.metadata(spark, sf_dir), "folders": views.folders(spark, sf_dir),
        "chain": views.chain(spark, sf_dir), "holidays": holidays,
        "calendars": holidays.select("calendar", F.lit("Expiry").alias("calendartype")).distinct(),
    }, {"prices": ["ord"], "ticks": ["seq"]})


@check("request_daily_interpolated", over("daily", then=f"""{OBS}
    SELECT symbol, day::TIMESTAMP AS tradedatetimeutc, round({LINE} + 1e-7::DOUBLE, 5) AS close
    FROM dense WHERE isodow(day) <= 5
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY day DESC) <= 5"""))
def request_daily_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five newest business days per symbol of the interpolated daily history."""
    out = market(spark, sf_dir).get_daily("P<*>", fill="interpolate", recordsback=5)
    return out.select("symbol", F.col("tradedatetimeutc").cast("timestamp").alias("tradedatetimeutc"),
                      F.round(F.col("close") + 1e-7, 5).alias("close"))


@check("request_daily_converted", over("daily", "rates", then="""
    , d AS (SELECT *, CASE currency WHEN 'USC' THEN 'USD' WHEN 'GBC' THEN 'GBP' ELSE currency END AS major,
                CASE WHEN currency IN ('USC', 'GBC') THEN 100 ELSE 1 END AS parts
            FROM daily WHERE tradedatetimeutc >= DATE '1996-01-01'
                         AND tradedatetimeutc < DATE '1998-01-01')
    SELECT d.symbol, d.tradedatetimeutc, (d.close - 1) / d.parts * r.rate AS open,
           (d.close + 2) / d.parts * r.rate AS high, d.close / d.parts * r.rate AS close, volume, 'EUR' AS currency
    FROM d ASOF LEFT JOIN (SELECT * FROM rates WHERE source = 'USF') r
         ON d.major = r.currency AND d.tradedatetimeutc >= r.ts"""))
def request_daily_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All price columns change with the currency, the volume does not."""
    prices = views.daily(spark, sf_dir).withColumns({"open": F.col("close") - 1, "high": F.col("close") + 2})
    return market(spark, sf_dir).with_table("prices", prices).get_daily(
        "P<*>", ["symbol", "tradedatetimeutc", "open", "high", "close", "volume", "currency"],
        startdate=dt.date(1996, 1, 1), enddate=dt.date(1997, 12, 31), currency="EUR",
        currencysource="USF")


@check("request_daily_filled_fields", over("daily", then=f"""{OBS}, filled AS (
        SELECT symbol, day, {LINE} AS close FROM dense WHERE isodow(day) <= 5)
    SELECT symbol, count(*) AS days, {checksum_sql('close', 'day')} AS closes,
           {checksum_sql('(close + 2)', 'day')} AS highs FROM filled GROUP BY 1"""))
def request_daily_filled_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interpolated history in two price columns, every day of it in a checksum."""
    prices = views.daily(spark, sf_dir).withColumn("high", F.col("close") + 2)
    out = market(spark, sf_dir).with_table("prices", prices).get_daily(
        "P<*>", ["symbol", "tradedatetimeutc", "close", "high"], fill="interpolate")
    return out.groupBy("symbol").agg(
        F.count("*").alias("days"), checksum("close", "tradedatetimeutc").alias("closes"),
        checksum("high", "tradedatetimeutc").alias("highs"))


@check("request_daily_corrections", over("corrections", then=TAGGED + """
    SELECT symbol, tradedatetimeutc, close, lastupdatetime, updatetype FROM tagged
    WHERE updatetype = 'U'"""))
def request_daily_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    revised = views.corrections(spark, sf_dir)
    return market(spark, sf_dir).with_table("prices", revised).get_daily(
        "P<*>", ["symbol", "tradedatetimeutc", "close", "lastupdatetime", "updatetype"],
        updatetype="U")


@check("request_intraday_bars", over("ticks", then=f"""
    , t AS (SELECT symbol, ts - INTERVAL 5 HOUR AS ts, last, volume, seq FROM ticks
            WHERE ts >= TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-25')
    SELECT symbol, time_bucket(INTERVAL 60 MINUTE, ts) AS bar, {BAR_SQL} FROM t
    WHERE isodow(ts) <= 5 AND hour(ts) BETWEEN 7 AND 22 GROUP BY 1, 2"""))
def request_intraday_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak hours of ten days as hourly bars in New York time."""
    return market(spark, sf_dir).get_intraday(
        "<*>", daysback=10, anchor=ANCHOR, aggregatetype=1, intradaybarinterval=60,
        timezone="America/New_York")


@check("request_quotes", over("daily", then="""
    SELECT symbol, tradedatetimeutc, close, lag(close) OVER w AS lastclose,
           close - lag(close) OVER w AS netchange, sum(volume) OVER w AS historicvolume
    FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY tradedatetimeutc)
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY tradedatetimeutc DESC) = 1"""),
       digits=None)
def request_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market(spark, sf_dir).get_quote(
        "P<*>", ["symbol", "tradedatetimeutc", "close", "lastclose", "netchange",
                 "historicvolume"])


@check("request_daily_curve", over("curve", then=f"""
    , v AS (SELECT *, value - lag(value) OVER (PARTITION BY curveroot, curvedate ORDER BY contract)
                   AS spread, row_number() OVER (PARTITION BY curveroot, curvedate ORDER BY contract)
                   AS position FROM curve)
    SELECT curveroot, {day('curvedate')} AS curvedate, {day('contract')} AS contract, spread AS value
    FROM v WHERE curveroot IN ('PROMO', 'ECONOMY') AND position <= 6"""), digits=None)
def request_daily_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market(spark, sf_dir).get_daily_curve(
        ["PROMO", "ECONOMY"], ["curveroot", "curvedate", "contract", "value"], curvesize=6,
        curvevaluetype=1)


@check("request_option_analytics", over("chain", then=f"""
    , near AS (SELECT *, row_number() OVER (PARTITION BY underlier, expiry, callput
               ORDER BY abs(strike - underprice), strike, symbol) AS near FROM chain
               WHERE callput = 'C')
    SELECT symbol, underlier, {day('expiry')} AS expiry, strike, round(vol, 4) AS impvol
    FROM near WHERE near <= 3"""), digits=4)
def request_option_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three calls nearest the money per underlier and expiry, priced, and implied back."""
    valued = dt.date(2024, 1, 2)
    data = market(spark, sf_dir)
    priced = data.get_option_analytics(
        ["symbol", "underlier", "expiry", "callput", "strike", "underprice", "vol",
         ["value", lambda c: c]], valued, "C", 3, interestrate=0.02
    ).withColumnRenamed("value", "settle")
    return data.with_table("chain", priced).get_option_analytics(
        ["symbol", "underlier", "expiry", "strike", "impvol"], valued, interestrate=0.02,
        contractpriceselection=["settle"])


@check("request_converted_symbols", over("daily", "rates", then="""
    , d AS (SELECT *, CASE currency WHEN 'USC' THEN 'USD' WHEN 'GBC' THEN 'GBP' ELSE currency END AS major,
                   CASE WHEN currency IN ('USC', 'GBC') THEN 100 ELSE 1 END AS parts, row_number() OVER (ORDER BY symbol) AS r FROM daily
            WHERE symbol IN ('P1', 'P2', 'P3', 'P4'))
    SELECT symbol, tradedatetimeutc, CASE symbol WHEN 'P2' THEN close / parts * r.rate WHEN 'P3' THEN close / parts * r.rate * 42
                                                 WHEN 'P4' THEN close * 2.5::DOUBLE ELSE close END AS close,
           CASE WHEN symbol IN ('P2', 'P3') THEN 'EUR' ELSE d.currency END AS currency,
           CASE symbol WHEN 'P3' THEN 'GAL' WHEN 'P4' THEN 'MT' ELSE 'BBL' END AS unit
    FROM d ASOF LEFT JOIN (SELECT * FROM rates WHERE source = 'USF') r ON d.major = r.currency AND d.tradedatetimeutc >= r.ts"""))
def request_converted_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and converted symbols in one request: a currency, a currency and a unit, a unit by a factor of its own."""
    data = market(spark, sf_dir).with_table("units", factors(spark)).with_table(
        "prices", views.daily(spark, sf_dir).withColumn("unit", F.lit("BBL")))
    return data.get_daily(
        ["P1", ConvertedSymbol("P2", "EUR", "USF"), ConvertedSymbol("P3", "EUR", "USF", "GAL"), ConvertedSymbol("P4", unit="MT", unit_factor=2.5)],
        ["symbol", "tradedatetimeutc", "close", "currency", "unit"])


@check("request_intraday_converted", over("ticks", then="""
    , t AS (SELECT * FROM ticks WHERE symbol IN ('view', 'click'))
    SELECT symbol, time_bucket(INTERVAL 60 MINUTE, ts) AS bar, max(CASE WHEN symbol = 'view' THEN last * 7.33::DOUBLE ELSE last END) AS high
    FROM t GROUP BY 1, 2"""))
def request_intraday_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of a symbol in another unit beside one that stays as it is."""
    data = market(spark, sf_dir).with_table("units", factors(spark)).with_table(
        "ticks", views.ticks(spark, sf_dir).withColumn("unit", F.lit("MT")))
    return data.get_intraday([ConvertedSymbol("view", unit="BBL"), "click"], intradaybarinterval=60).select("symbol", "bar", "high")


@check("request_daily_peak_local", over("ticks", then="""
    , l AS (SELECT *, (ts::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local FROM ticks)
    SELECT symbol, local::DATE::TIMESTAMP AS tradedatetimeutc, max(last) AS high, min(last) AS low, sum(volume)::BIGINT AS volume FROM l
    WHERE isodow(local) <= 5 AND hour(local) BETWEEN 7 AND 22 AND local::DATE NOT IN (DATE '2024-01-03', DATE '2024-01-10') GROUP BY 1, 2"""))
def request_daily_peak_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars over the peak hours of New York days, without two holidays."""
    days = spark.createDataFrame([("NY", dt.date(2024, 1, 3)), ("NY", dt.date(2024, 1, 10)), ("X", dt.date(2024, 1, 4))], "calendar string, holiday date")
    out = market(spark, sf_dir).with_table("holidays", days).get_daily("<*>", aggregatetype=1, timezone="America/New_York", holidays="NY")
    return out.select("symbol", F.col("tradedatetimeutc").cast("timestamp").alias("tradedatetimeutc"), "high", "low", "volume")


@check("request_fetch_plan", over("daily", "instruments", then="""
    , plan AS (SELECT symbol, CASE WHEN length(symbol) % 2 = 0 THEN 2 ELSE 5 END AS depth FROM (SELECT DISTINCT symbol FROM instruments) WHERE symbol NOT LIKE '%7')
    SELECT d.symbol, d.tradedatetimeutc, d.close FROM daily d JOIN plan USING (symbol)
    QUALIFY row_number() OVER (PARTITION BY d.symbol ORDER BY d.tradedatetimeutc DESC, d.ord DESC) <= any_value(depth) OVER (PARTITION BY d.symbol)"""))
def request_fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many newest records per symbol as a plan has for it, in one request; symbols without a depth give none."""
    listed = views.instruments(spark, sf_dir).select("symbol").distinct().where(~F.col("symbol").endswith("7"))
    plan = listed.withColumn("recordsback", F.when(F.length("symbol") % 2 == 0, 2).otherwise(5))
    return market(spark, sf_dir).get_daily("P<*>", ["symbol", "tradedatetimeutc", "close"], recordsback=plan)


@check("request_settled_revision", over("corrections", then="""
    SELECT symbol, tradedatetimeutc, close FROM (
        SELECT *, line % 2 = 0 AS ok FROM corrections
        QUALIFY row_number() OVER (PARTITION BY symbol, tradedatetimeutc ORDER BY lastupdatetime DESC, ord DESC) = 1) WHERE ok"""))
def request_settled_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled rows only: where the newest revision is not settled, no older one stands in for it."""
    revised = views.corrections(spark, sf_dir).withColumn("settledate", F.when(F.col("line") % 2 == 0, F.col("tradedatetimeutc")))
    return market(spark, sf_dir).with_table("prices", revised).get_daily("P<*>", ["symbol", "tradedatetimeutc", "close"], settledonly=True)
