"""History filters, limits, quotes, session fields, bars and resampling."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from checks.keys import ZONE_SQL, zone_of
from tidemark.operators import bars, filters, history
from tidemark.operators.segments import balanced_segments
from tidemark.sources import views

TIME = "tradedatetimeutc"


def _settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ord"), "o_orderstatus")
    return views.trades(spark, sf_dir).join(orders, "ord").withColumn(
        "settledate", F.when(F.col("o_orderstatus") == "F", F.col(TIME)))


@check("symbol_list", over("daily", then="""
    SELECT symbol, tradedatetimeutc, close FROM daily WHERE symbol IN ('P1', 'P17', 'P42')"""))
def symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.for_symbols(views.daily(spark, sf_dir), ["P1", "P17", "P42"]).select(
        "symbol", TIME, "close")


@check("symbol_frame", over("daily", then="""
    SELECT symbol, tradedatetimeutc, close FROM daily
    WHERE symbol IN (SELECT 'P' || p_partkey FROM part WHERE p_type = 'PROMO')"""))
def symbol_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long symbol list comes as a frame and is semi-joined."""
    wanted = views.instruments(spark, sf_dir).where(F.col("security_type") == "PROMO")
    return filters.for_symbols(views.daily(spark, sf_dir), wanted.select("symbol")).select(
        "symbol", TIME, "close")


@check("symbol_wildcard", over("daily", then="""
    SELECT symbol, count(*) AS n FROM daily WHERE starts_with(symbol, 'P1') GROUP BY 1"""))
def symbol_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.for_symbols(views.daily(spark, sf_dir), "P1<*>").groupBy("symbol").agg(
        F.count("*").alias("n"))


@check("named_symbols", """
    SELECT p_partkey FROM part WHERE p_size % 3 = 2""")
def named_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_size") % 3
    part = views.table(spark, sf_dir, "part").select(
        "p_partkey", F.when(kind == 1, "").when(kind == 2, F.col("p_name")).alias("symbol"))
    return filters.named(part).select("p_partkey")


@check("text_contains", """
    SELECT doc_id FROM documents WHERE contains(text, 'the')""")
def text_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.contains(views.table(spark, sf_dir, "documents"), "text", "the").select("doc_id")


@check("symbol_search", over("instruments", then="""
    SELECT symbol, description FROM instruments
    WHERE contains(lower(symbol), 'ring') OR contains(lower(description), 'ring')"""))
def symbol_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.symbol_search(views.instruments(spark, sf_dir), "RING").select(
        "symbol", "description")


@check("wildcard_symbol_search", over("instruments", then="""
    SELECT symbol FROM instruments WHERE symbol LIKE 'P1%5'"""))
def wildcard_symbol_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.wildcard_search(views.instruments(spark, sf_dir), "P1%5").select("symbol")


@check("date_range", over("daily", then="""
    SELECT symbol, tradedatetimeutc, close FROM daily
    WHERE tradedatetimeutc >= DATE '1997-02-01' AND tradedatetimeutc < DATE '1997-03-16'"""))
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.between(
        views.daily(spark, sf_dir), TIME, dt.date(1997, 2, 1), dt.date(1997, 3, 15)
    ).select("symbol", TIME, "close")


@check("days_back", over("ticks", then="""
    SELECT symbol, ts, last FROM ticks
    WHERE ts >= (SELECT max(ts) FROM ticks) - INTERVAL 3 DAY"""))
def days_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.days_back(views.ticks(spark, sf_dir), "ts", 3).select("symbol", "ts", "last")


@check("settled_only", """
    SELECT 'P' || l_partkey AS symbol, l_shipdate AS settledate, l_extendedprice AS close
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'""")
def settled_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.settled_only(_settled(spark, sf_dir)).select("symbol", "settledate", "close")


@check("one_version", over("trades", then="""
    SELECT symbol, tradedatetimeutc, close FROM trades WHERE version = 'R'"""))
def one_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.of_version(views.trades(spark, sf_dir), "R").select("symbol", TIME, "close")


TAGGED = """, tagged AS (
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY symbol, tradedatetimeutc
        ORDER BY lastupdatetime, ord) = 1 THEN 'I' ELSE 'U' END AS updatetype FROM corrections)"""


@check("corrections_all", over("corrections", then=TAGGED + """
    SELECT symbol, tradedatetimeutc, lastupdatetime, close, updatetype FROM tagged"""))
def corrections_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.corrections(
        views.corrections(spark, sf_dir), ["symbol", TIME], ["lastupdatetime", "ord"]
    ).select("symbol", TIME, "lastupdatetime", "close", "updatetype")


@check("corrections_updates_since", over("corrections", then=TAGGED + """
    SELECT symbol, tradedatetimeutc, lastupdatetime, close, updatetype FROM tagged
    WHERE updatetype = 'U' AND lastupdatetime > TIMESTAMP '1997-01-26 04:00:00'"""))
def corrections_updates_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.corrections(
        views.corrections(spark, sf_dir), ["symbol", TIME], ["lastupdatetime", "ord"], "U",
        dt.datetime(1997, 1, 26, 4, 0, tzinfo=dt.timezone.utc),
    ).select("symbol", TIME, "lastupdatetime", "close", "updatetype")


@check("latest_revision", over("corrections", then="""
    SELECT symbol, tradedatetimeutc, lastupdatetime, close FROM corrections
    QUALIFY row_number() OVER (PARTITION BY symbol, tradedatetimeutc
                               ORDER BY lastupdatetime DESC, ord DESC) = 1"""))
def latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.latest_revision(
        views.corrections(spark, sf_dir), ["symbol", TIME], ["lastupdatetime", "ord"]
    ).select("symbol", TIME, "lastupdatetime", "close")


@check("search_by_exchange", over("instruments", then="""
    SELECT symbol, security_type FROM instruments
    WHERE exchange_code = 'Brand#2' AND security_type = 'ECONOMY' ORDER BY symbol LIMIT 5"""))
def search_by_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recordsback is the feature here: the first five by symbol."""
    return filters.search_by_exchange(
        views.instruments(spark, sf_dir), "Brand#2", "ECONOMY", n=5
    ).select("symbol", "security_type")


@check("search_by_exchange_dates", """
    SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH'
    AND o_orderdate >= DATE '1997-05-01' AND o_orderdate >= DATE '1998-04-24' - INTERVAL 30 DAY""")
def search_by_exchange_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text dates of an instrument table: created at the order date, expiring 30 days later."""
    listed = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("exchange_code"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("datecreated"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd")
        .alias("expiration_date"),
    )
    return filters.search_by_exchange(
        listed, "2-HIGH", expires_from=dt.date(1998, 4, 24), created_from=dt.date(1997, 5, 1)
    ).select("o_orderkey")


@check("instrument_list", over("instruments", then="""
    SELECT symbol FROM instruments WHERE exchange_code = 'Brand#3' AND option_root = '/SMALL'"""))
def instrument_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.instrument_list(
        views.instruments(spark, sf_dir), "Brand#3", "/SMALL").select("symbol")


@check("symbol_coverage", over("trades", then="""
    SELECT symbol, min(tradedatetimeutc) AS first_time, max(tradedatetimeutc) AS last_time,
           count(*) AS records FROM trades GROUP BY 1"""))
def symbol_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.symbol_coverage(views.trades(spark, sf_dir))


@check("symbol_versions", over("trades", then="""
    SELECT DISTINCT symbol, version FROM trades WHERE tradedatetimeutc < DATE '1997-08-15'"""))
def symbol_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.symbol_versions(views.trades(spark, sf_dir), dt.date(1997, 8, 14))


@check("historical_ticks", over("ticks", then="""
    SELECT symbol, ts, last FROM ticks
    WHERE ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-15' ORDER BY symbol, ts"""))
def historical_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    anchor = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)
    return filters.days_back(views.ticks(spark, sf_dir), "ts", 7, anchor).select(
        "symbol", "ts", "last").orderBy("symbol", "ts")


@check("records_back", over("daily", then="""
    SELECT symbol, tradedatetimeutc, close FROM daily
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY tradedatetimeutc DESC) <= 5"""))
def records_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.records_back(views.daily(spark, sf_dir), ["symbol"], TIME, 5).select(
        "symbol", TIME, "close")


@check("records_back_deep", over("ticks", then="""
    SELECT symbol, ts, seq, last FROM ticks
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) <= 1500"""))
def records_back_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows per symbol than a rank limit before the shuffle allows: ranked in salted parts."""
    return filters.records_back(
        views.ticks(spark, sf_dir), ["symbol"], "ts", 1500, ["seq"]
    ).select("symbol", "ts", "seq", "last")


@check("value_on_date", over("daily", then="""
    SELECT symbol, tradedatetimeutc, close FROM daily WHERE tradedatetimeutc < DATE '1998-02-02'
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY tradedatetimeutc DESC) = 1"""))
def value_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.as_of(
        views.daily(spark, sf_dir), ["symbol"], TIME, dt.date(1998, 2, 1)
    ).select("symbol", TIME, "close")


@check("max_rows", over("trades", then="""
    SELECT symbol, tradedatetimeutc, ord, line, close FROM trades
    ORDER BY symbol, tradedatetimeutc, ord, line LIMIT 250"""))
def max_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """maxrows is the feature here."""
    return filters.max_rows(
        views.trades(spark, sf_dir), ["symbol", TIME, "ord", "line"], 250
    ).select("symbol", TIME, "ord", "line", "close")


@check("first_exchanges", """
    SELECT DISTINCT p_brand AS exchange_code FROM part ORDER BY 1 LIMIT 6""")
def first_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap on exchanges per cycle is the feature here."""
    codes = views.instruments(spark, sf_dir).select("exchange_code").distinct()
    return filters.max_rows(codes, ["exchange_code"], 6)


@check("preview", over("instruments", then="""
    SELECT symbol, description FROM instruments ORDER BY symbol LIMIT 20"""))
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.max_rows(views.instruments(spark, sf_dir), ["symbol"], 20).select(
        "symbol", "description")


@check("result_page", over("instruments", then="""
    SELECT symbol, description FROM instruments ORDER BY symbol LIMIT 30 OFFSET 60"""))
def result_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is the feature here."""
    return filters.page(views.instruments(spark, sf_dir), ["symbol"], 3, 30).select(
        "symbol", "description")


@check("result_page_deep", """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice, l_orderkey, l_linenumber
    LIMIT 20000 OFFSET 20000""")
def result_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page in the middle of a large table, found by the counts of the order's ranges."""
    rows = views.table(spark, sf_dir, "lineitem")
    return filters.page(rows, ["l_extendedprice", "l_orderkey", "l_linenumber"], 2, 20_000).select("l_orderkey", "l_linenumber", "l_extendedprice")


@check("result_page_after_key", over("instruments", then="""
    SELECT symbol, description FROM instruments WHERE symbol > 'P15' ORDER BY symbol LIMIT 30"""))
def result_page_after_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.page_after(views.instruments(spark, sf_dir), "symbol", "P15", 30).select(
        "symbol", "description")


@check("search_union", over("instruments", then="""
    SELECT symbol FROM instruments WHERE contains(description, 'ring')
    UNION ALL SELECT symbol FROM instruments WHERE symbol LIKE 'P1%'"""))
def search_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    instruments = views.instruments(spark, sf_dir)
    return filters.contains(instruments, "description", "ring").select("symbol").unionByName(
        filters.wildcard_search(instruments, "P1%").select("symbol"))


@check("search_union_distinct", over("instruments", then="""
    SELECT symbol FROM instruments WHERE contains(description, 'ring')
    UNION SELECT symbol FROM instruments WHERE symbol LIKE 'P1%' ORDER BY symbol"""))
def search_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_union(spark, sf_dir).distinct().orderBy("symbol")


@check("latest_quotes", over("ticks", then="""
    SELECT symbol, ts, last, seq, user_id FROM ticks
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) = 1"""))
def latest_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.latest_quote(
        views.ticks(spark, sf_dir), ["last", "seq", "user_id"], "ts", ["seq"])


@check("session_fields", over("daily", then="""
    SELECT symbol, tradedatetimeutc, close, lag(close) OVER w AS lastclose,
           lag(volume) OVER w AS lastvolume, close - lag(close) OVER w AS netchange,
           100 * (close / nullif(lag(close) OVER w, 0) - 1) AS percentchange,
           sum(volume) OVER w AS historicvolume, close AS mostrecentvalue,
           tradedatetimeutc AS mostrecentvaluedate
    FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY tradedatetimeutc)"""), digits=None)
def session_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.session_fields(views.daily(spark, sf_dir), grain="year").select(
        "symbol", TIME, "close", "lastclose", "lastvolume", "netchange", "percentchange",
        "historicvolume", "mostrecentvalue", "mostrecentvaluedate")


@check("session_fields_nulls", over("trades", then="""
    , n AS (SELECT CASE WHEN length(symbol) = 3 THEN NULL ELSE symbol END AS symbol, CASE WHEN ord % 5 = 0 THEN NULL ELSE tradedatetimeutc END AS t,
                   ord * 10 + line AS seq, close, volume FROM trades)
    SELECT symbol, t AS tradedatetimeutc, seq, lag(close) OVER w AS lastclose, sum(volume) OVER w AS historicvolume
    FROM n WINDOW w AS (PARTITION BY symbol ORDER BY t NULLS LAST, seq, close, volume)"""), digits=None)
def session_fields_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a symbol are one history, rows without a time come last: every row is there."""
    rows = views.trades(spark, sf_dir).select(
        F.when(F.length("symbol") != 3, F.col("symbol")).alias("symbol"), F.when(F.col("ord") % 5 != 0, F.col(TIME)).alias(TIME),
        (F.col("ord") * 10 + F.col("line")).alias("seq"), "close", "volume")
    return history.session_fields(rows, tie=["seq", "close", "volume"], grain="year").select("symbol", TIME, "seq", "lastclose", "historicvolume")


@check("session_prices", over("daily", then="""
    SELECT symbol, tradedatetimeutc, lag(close - 1) OVER w AS lastopen, lag(close + 2) OVER w AS lasthigh,
           lag(close - 3) OVER w AS lastlow
    FROM daily WINDOW w AS (PARTITION BY symbol ORDER BY tradedatetimeutc)"""), digits=None)
def session_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The open, high and low of the session before."""
    close = F.col("close")
    bars = views.daily(spark, sf_dir).withColumns({"open": close - 1, "high": close + 2, "low": close - 3})
    return history.session_fields(bars, grain="year").select("symbol", TIME, "lastopen", "lasthigh", "lastlow")


@check("tick_session_fields", over("ticks", then="""
    SELECT seq, lag(last) OVER w AS prevlast, sign(last - lag(last) OVER w)::DOUBLE
               AS lasttradedirection, (sum(volume) OVER w)::BIGINT AS historicvolume
    FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq)"""))
def tick_session_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous trade, direction and running volume over ticks, cut into hours."""
    return history.session_fields(
        views.ticks(spark, sf_dir), "ts", ["seq"], grain="hour"
    ).select("seq", "prevlast", "lasttradedirection", "historicvolume")


@check("balanced_session_fields", over("ticks", then="""
    SELECT seq, lag(last) OVER w AS prevlast, (sum(volume) OVER w)::BIGINT AS historicvolume
    FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq)"""))
def balanced_session_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over segments cut by row count, whatever share of the ticks a symbol has."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ticks = balanced_segments(views.ticks(spark, sf_dir), ["symbol"], ["ts", "seq"], partitions)
    return history.session_fields(ticks, "ts", ["seq"]).select("seq", "prevlast", "historicvolume")


@check("most_recent_value", over("ticks", then="""
    SELECT seq, last_value(CASE WHEN user_id % 4 = 0 THEN last END IGNORE NULLS) OVER w
               AS mostrecentvalue,
           last_value(CASE WHEN user_id % 4 = 0 THEN ts END IGNORE NULLS) OVER w
               AS mostrecentvaluedate
    FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY ts, seq
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def most_recent_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of four ticks carry no close: the last known one is carried over segment borders."""
    ticks = views.ticks(spark, sf_dir).withColumn(
        "close", F.when(F.col("user_id") % 4 == 0, F.col("last"))).drop("last", "volume")
    return history.session_fields(ticks, "ts", ["seq"], grain="hour").select(
        "seq", "mostrecentvalue", "mostrecentvaluedate")


@check("tick_counts", over("ticks", then=f"""
    SELECT symbol, {day('ts')} AS day, count(*) AS tickcount FROM ticks GROUP BY 1, 2"""))
def tick_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.tick_counts(views.ticks(spark, sf_dir))


BAR_SQL = """arg_min(last, (ts, seq)) AS open, max(last) AS high, min(last) AS low,
    arg_max(last, (ts, seq)) AS close, sum(volume)::BIGINT AS volume"""


@check("intraday_bars", over("ticks", then=f"""
    SELECT symbol, time_bucket(INTERVAL 60 MINUTE, ts) AS bar, {BAR_SQL} FROM ticks
    GROUP BY 1, 2"""))
def intraday_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.bars(views.ticks(spark, sf_dir), 60, tie=["seq"])


@check("intraday_bars_quarter_hour", over("ticks", then=f"""
    SELECT symbol, time_bucket(INTERVAL 15 MINUTE, ts) AS bar, {BAR_SQL} FROM ticks
    GROUP BY 1, 2"""))
def intraday_bars_quarter_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.bars(views.ticks(spark, sf_dir), 15, tie=["seq"])


LOCAL = f""", local AS (
    SELECT event_type AS symbol, ts, value AS last, 1 AS volume, event_id AS seq,
           (ts::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE ({ZONE_SQL}) AS lt FROM events),
    marked AS (SELECT *, isodow(lt) <= 5 AND hour(lt) BETWEEN 7 AND 22 AS peak FROM local)"""


@check("daily_all_hours", over("ticks", then=f"""{LOCAL}
    SELECT symbol, {day('lt')} AS day, {BAR_SQL} FROM marked GROUP BY 1, 2"""))
def daily_all_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.aggregate_hours(
        views.ticks(spark, sf_dir), 0, zone_of(F.col("symbol")), tie=["seq"])


@check("daily_peak_hours", over("ticks", then=f"""{LOCAL}
    SELECT symbol, {day('lt')} AS day, {BAR_SQL} FROM marked WHERE peak GROUP BY 1, 2"""))
def daily_peak_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.aggregate_hours(
        views.ticks(spark, sf_dir), 1, zone_of(F.col("symbol")), tie=["seq"])


@check("daily_offpeak_hours_holidays", over("ticks", then=f"""{LOCAL},
    off AS (SELECT DISTINCT min(ts)::DATE + 5 AS d FROM events GROUP BY event_type)
    SELECT symbol, {day('lt')} AS day, {BAR_SQL} FROM marked
    WHERE NOT peak OR lt::DATE IN (SELECT d FROM off) GROUP BY 1, 2"""))
def daily_offpeak_hours_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Off-peak hours with a holiday list taken from the ticks: the sixth day of each symbol."""
    ticks = views.ticks(spark, sf_dir)
    off = ticks.groupBy("symbol").agg(
        F.date_add(F.to_date(F.min("ts")), 5).alias("holiday"))
    return bars.aggregate_hours(ticks, 2, zone_of(F.col("symbol")), off, tie=["seq"])


def _resample_sql(period: str, price: str = "close") -> str:
    return over("daily", then=f"""
    SELECT symbol, {day(period)} AS period, arg_min(close, tradedatetimeutc) AS open,
           max(close) AS high, min(close) AS low, arg_max(close, tradedatetimeutc) AS close,
           sum(volume) AS volume FROM daily GROUP BY 1, 2""")


for _name, _unit in (("weeks", "week"), ("months", "month"), ("quarters", "quarter"),
                     ("years", "year")):
    def _resampled(spark: SparkSession, sf_dir: str, frequency: str = _name) -> DataFrame:
        return bars.resample(views.daily(spark, sf_dir), frequency)

    check(f"resample_{_name}", _resample_sql(f"date_trunc('{_unit}', tradedatetimeutc)"))(_resampled)


@check("resample_days", over("ticks", then=f"""
    SELECT symbol, {day('ts')} AS period, {BAR_SQL} FROM ticks GROUP BY 1, 2"""))
def resample_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.resample(views.ticks(spark, sf_dir), 1, "last", "ts", tie=["seq"])


@check("resample_intraday", over("ticks", then=f"""
    SELECT symbol, time_bucket(INTERVAL 240 MINUTE, ts) AS period, {BAR_SQL} FROM ticks
    GROUP BY 1, 2"""))
def resample_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.resample(views.ticks(spark, sf_dir), 7, "last", "ts", tie=["seq"], minutes=240)


LAST_WEEKDAY = "last_day(tradedatetimeutc) - greatest(isodow(last_day(tradedatetimeutc)) - 5, 0)::INT"


@check("resample_contract_months", _resample_sql(f"""date_trunc('month', tradedatetimeutc)
    + to_months(CASE WHEN tradedatetimeutc::DATE <= {LAST_WEEKDAY} THEN 1 ELSE 2 END)"""))
def resample_contract_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.resample(views.daily(spark, sf_dir), 4)


@check("midpoints", over("ticks", then="""
    SELECT seq, CASE WHEN user_id % 2 = 0 THEN (last + (last + 0.1::DOUBLE)) / 2
                     ELSE (last + 2 + last) / 2 END AS midpoint
    FROM ticks"""), digits=None)
def midpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid and ask where quoted, else high and low."""
    even = F.col("user_id") % 2 == 0
    quotes = views.ticks(spark, sf_dir).select(
        "seq", F.when(even, F.col("last")).alias("bid"),
        F.when(even, F.col("last") + 0.1).alias("ask"),
        (F.col("last") + 2).alias("high"), F.col("last").alias("low"))
    return quotes.select("seq", bars.midpoint(quotes).alias("midpoint"))
