"""Gap filling, lead/lag, and currency and unit conversion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from checks.base import check, day, over
from tidemark.operators import convert, fill
from tidemark.sources import views

END = dt.date(2001, 12, 31)
KEYS = ["symbol"]

# Each part's price by day: a sparse series per symbol.
OBS = """, obs AS (SELECT symbol, tradedatetimeutc::DATE AS day, close AS value FROM daily),
    grid AS (SELECT symbol, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day
             FROM obs GROUP BY symbol),
    dense AS (SELECT g.symbol, g.day, o.value,
        last_value(o.value IGNORE NULLS) OVER back AS pv,
        last_value(CASE WHEN o.value IS NOT NULL THEN g.day END IGNORE NULLS) OVER back AS pd,
        first_value(o.value IGNORE NULLS) OVER fore AS nv,
        first_value(CASE WHEN o.value IS NOT NULL THEN g.day END IGNORE NULLS) OVER fore AS nd
      FROM grid g LEFT JOIN obs o ON g.symbol = o.symbol AND g.day = o.day
      WINDOW back AS (PARTITION BY g.symbol ORDER BY g.day
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             fore AS (PARTITION BY g.symbol ORDER BY g.day
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
LINE = """CASE WHEN value IS NOT NULL THEN value
          ELSE pv + (nv - pv) * date_diff('day', pd, day) / date_diff('day', pd, nd) END"""


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = views.daily(spark, sf_dir)
    return daily.select(
        "symbol", F.to_date("tradedatetimeutc").alias("day"), F.col("close").alias("value"))


def checksum(value: str, date: str) -> Column:
    n = F.datediff(date, F.lit(dt.date(1995, 1, 1))).cast("long")
    return F.sum(F.floor(F.col(value) * 1000 + 0.0137).cast("long") * (n * n % 7919))


def checksum_sql(value: str, date: str) -> str:
    n = f"date_diff('day', DATE '1995-01-01', {date})"
    return f"sum(floor({value} * 1000 + 0.0137::DOUBLE)::BIGINT * ({n} * {n} % 7919))::BIGINT"


def _summary(df: DataFrame) -> DataFrame:
    """Per symbol and year, what a wrong date or value would change.

    The checksum weighs the thousandths of every single day by a number of that day, in whole numbers:
    errors of two days do not cancel. The small offsets move values off rounding ties.
    """
    n = F.datediff("day", F.lit(dt.date(1995, 1, 1)))
    return df.groupBy("symbol", F.year("day").alias("year")).agg(
        F.count("*").alias("days"), F.round(F.sum("value") + 1e-5, 3).alias("total"),
        F.round(F.sum(F.col("value") * n) / F.sum(n) + 1e-5, 3).alias("weighted"),
        checksum("value", "day").alias("checksum"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
    )


def _summary_sql(value: str, keep: str = "true", source: str = "dense") -> str:
    n = "date_diff('day', DATE '1995-01-01', day)"
    return over("daily", then=f"""{OBS}, filled AS (
        SELECT symbol, day, {value} AS value FROM {source} WHERE {keep})
    SELECT symbol, year(day)::INT AS year, count(*) AS days, round(sum(value) + 1e-5::DOUBLE, 3) AS total,
           round(sum(value * {n}) / sum({n}) + 1e-5::DOUBLE, 3) AS weighted,
           {checksum_sql('value', 'day')} AS checksum,
           {day('min(day)')} AS first_day, {day('max(day)')} AS last_day
    FROM filled GROUP BY 1, 2""")


@check("fill_forward", _summary_sql("pv"))
def fill_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(fill.fill(_observed(spark, sf_dir), KEYS, "day", "value", "forward"))


@check("fill_backward_business", _summary_sql("nv", "isodow(day) <= 5"))
def fill_backward_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(
        fill.fill(_observed(spark, sf_dir), KEYS, "day", "value", "backward", "business"))


@check("fill_average_six_days", _summary_sql(
    "CASE WHEN value IS NOT NULL THEN value ELSE (pv + nv) / 2 END", "isodow(day) <= 6"))
def fill_average_six_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(
        fill.fill(_observed(spark, sf_dir), KEYS, "day", "value", "average", "sixdays"))


@check("fill_interpolate", _summary_sql(LINE))
def fill_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(fill.fill(_observed(spark, sf_dir), KEYS, "day", "value", "interpolate"))


@check("fill_projected", over("daily", then=f"""{OBS},
    tail AS (SELECT symbol, day, value, lag(day) OVER w AS pday, lag(value) OVER w AS pvalue,
                    lead(day) OVER w AS nday
             FROM obs WINDOW w AS (PARTITION BY symbol ORDER BY day)),
    beyond AS (SELECT symbol, value, pvalue, pday, day AS last,
                      unnest(generate_series(day + 1, DATE '2001-12-31', INTERVAL 1 DAY))::DATE AS day
               FROM tail WHERE nday IS NULL),
    every AS (SELECT symbol, day, {LINE} AS value FROM dense
              UNION ALL
              SELECT symbol, day, value + coalesce((value - pvalue) / date_diff('day', pday, last), 0)
                     * date_diff('day', last, day) FROM beyond)
    SELECT symbol, year(day)::INT AS year, count(*) AS days, round(sum(value) + 1e-5::DOUBLE, 3) AS total,
           round(sum(value * date_diff('day', DATE '1995-01-01', day))
                 / sum(date_diff('day', DATE '1995-01-01', day)) + 1e-5::DOUBLE, 3) AS weighted,
           {checksum_sql('value', 'day')} AS checksum,
           {day('min(day)')} AS first_day, {day('max(day)')} AS last_day
    FROM every GROUP BY 1, 2"""))
def fill_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(fill.fill(
        _observed(spark, sf_dir), KEYS, "day", "value", "projected", enddate=END))


@check("fill_none", _summary_sql("value", source="obs"))
def fill_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(fill.fill(_observed(spark, sf_dir), KEYS, "day", "value", "nofill"))


@check("fill_forward_ticks", over("ticks", then=f""", d AS (
        SELECT symbol, user_id, ts::DATE AS day, arg_max(last, (ts, seq)) AS last
        FROM ticks GROUP BY 1, 2, 3),
    g AS (SELECT symbol, user_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE
                 AS day FROM d GROUP BY 1, 2)
    SELECT symbol, user_id, {day('day')} AS day, last_value(d.last IGNORE NULLS) OVER (
        PARTITION BY symbol, user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS last
    FROM g LEFT JOIN d USING (symbol, user_id, day)"""))
def fill_forward_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks are first reduced to the last of each day, then filled."""
    keys = ["symbol", "user_id"]
    last = fill.daily_last(views.ticks(spark, sf_dir), keys, "ts", "last", ["seq"])
    return fill.fill(last, keys, "day", "last", "forward")


@check("lag_quoted_days", over("daily", then=f""", obs AS (
        SELECT symbol, tradedatetimeutc::DATE AS day, close AS value FROM daily)
    SELECT symbol, {day('day')} AS day, value,
           lag(value, 2) OVER (PARTITION BY symbol ORDER BY day) AS shifted
    FROM obs"""))
def lag_quoted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill.lead_lag(_observed(spark, sf_dir), KEYS, "day", "value", 2, "quoteddays")


@check("lead_calendar_days", over("daily", then=f""", obs AS (
        SELECT symbol, tradedatetimeutc::DATE AS day, close AS value FROM daily)
    SELECT a.symbol, {day('a.day')} AS day, a.value, b.value AS shifted
    FROM obs a LEFT JOIN obs b ON a.symbol = b.symbol AND b.day = a.day + 10"""))
def lead_calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill.lead_lag(_observed(spark, sf_dir), KEYS, "day", "value", -10, 0)


@check("lag_weeks", over("daily", then=f""", obs AS (
        SELECT symbol, tradedatetimeutc::DATE AS day, close AS value FROM daily)
    SELECT a.symbol, {day('a.day')} AS day, a.value, b.value AS shifted
    FROM obs a LEFT JOIN obs b ON a.symbol = b.symbol AND b.day = a.day - 21"""))
def lag_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill.lead_lag(_observed(spark, sf_dir), KEYS, "day", "value", 3, "weeks")


PRICED = """, priced AS (
    SELECT *, CASE currency WHEN 'USC' THEN 'USD' WHEN 'GBC' THEN 'GBP' ELSE currency END AS major,
           CASE WHEN currency IN ('USC', 'GBC') THEN close / 100 ELSE close END AS v FROM trades)"""


@check("convert_currency", over("trades", "rates", then=f"""{PRICED}
    SELECT p.symbol, p.ord, p.line, p.tradedatetimeutc, p.currency, r.rate, p.v * r.rate AS converted
    FROM priced p ASOF LEFT JOIN (SELECT * FROM rates WHERE source = 'ECB') r
         ON p.major = r.currency AND p.tradedatetimeutc >= r.ts"""), digits=None)
def convert_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trade in its currency's major unit at the rate in force at its time."""
    return convert.convert_currency(
        views.trades(spark, sf_dir), views.rates(spark, sf_dir), "ECB"
    ).select("symbol", "ord", "line", "tradedatetimeutc", "currency", "rate", "converted")


@check("as_of_join_sparse", over("ticks", then="""
    SELECT t.seq, q.last AS quote, q.ts AS quote_ts
    FROM ticks t ASOF LEFT JOIN (SELECT user_id, ts, last FROM ticks WHERE symbol = 'view') q
         ON t.user_id = q.user_id AND t.ts >= q.ts"""))
def as_of_join_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tick with its user's latest view tick: many segments hold no right row at all."""
    ticks = views.ticks(spark, sf_dir)
    quotes = ticks.where(F.col("symbol") == "view").select(
        "user_id", "ts", F.col("last").alias("quote"), F.col("ts").alias("quote_ts"))
    return convert.as_of_join(
        ticks, quotes, ["user_id"], "ts", ["quote", "quote_ts"]
    ).select("seq", "quote", "quote_ts")


def quotes_of_seconds(ticks: DataFrame) -> DataFrame:
    """``last + s`` for each of the 20 seconds ``s`` from a tick on, the highest where several meet.

    The ticks move, to the one or two minutes their seconds lie in, and become quotes there. Only ticks of one
    symbol and fraction of a second can meet: each gives the quotes up to the next of them, and knows those before it.
    """
    second, at, s = F.col("second"), F.col("at"), F.coalesce(F.col("at") - F.col("second"), F.lit(19))
    highest = ticks.groupBy("symbol", "ts").agg(F.max("last").alias("last")).select(
        "symbol", "last", F.unix_seconds("ts").alias("second"), F.pmod(F.unix_micros("ts"), F.lit(1000000)).alias("micro"))
    near = highest.withColumn("minute", F.explode(F.array_distinct(F.array(_minute(second), _minute(second + 19)))))
    alike = W.partitionBy("minute", "micro", "symbol").orderBy("second")
    spread = near.select("*", F.least(second + 19, F.lead("second").over(alike) - 1).alias("until"),
                         F.collect_list(F.struct("second", "last")).over(alike.rangeBetween(-19, 0)).alias("met")
                         ).withColumn("at", F.explode_outer(F.sequence("second", "until"))).where(F.col("minute").eqNullSafe(_minute(at)))
    best = F.array_max(F.transform(F.filter("met", lambda x: at - x["second"] <= 19), lambda x: x["last"] + (at - x["second"])))
    return spread.select("symbol", F.timestamp_micros(at * 1000000 + F.col("micro")).alias("ts"),
                         F.when(F.size("met") == 1, F.col("last") + s).otherwise(best).alias("quote"))


def _minute(second: Column) -> Column:
    return F.floor(second / 60)


@check("as_of_merge_dense", over("ticks", then="""
    , q AS (SELECT symbol, ts + to_seconds(s) AS ts, max(last + s) AS quote FROM ticks, range(20) AS r(s) GROUP BY 1, 2),
    t AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'view' ELSE symbol END AS symbol, ts + INTERVAL 7 SECOND AS ts, seq FROM ticks)
    SELECT t.seq, q.quote FROM t ASOF LEFT JOIN q ON t.symbol = q.symbol AND t.ts >= q.ts"""))
def as_of_merge_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of every second after a tick against ticks of which a third share a symbol."""
    ticks = views.ticks(spark, sf_dir)
    quotes = quotes_of_seconds(ticks)
    asked = ticks.select(F.when(F.col("user_id") % 3 == 0, "view").otherwise(F.col("symbol")).alias("symbol"),
                         (F.col("ts") + F.expr("interval 7 seconds")).alias("ts"), "seq")
    return convert.as_of_merge(asked, quotes, ["symbol"], "ts", ["quote"]).select("seq", "quote")


@check("convert_currency_merged", over("trades", "rates", then=f"""{PRICED}
    SELECT p.symbol, p.ord, p.line, r.rate, p.v * r.rate AS converted
    FROM priced p ASOF LEFT JOIN (SELECT * FROM rates WHERE source = 'ECB') r
         ON p.major = r.currency AND p.tradedatetimeutc >= r.ts"""), digits=None)
def convert_currency_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversion of every trade with both sides merged in time order."""
    return convert.convert_currency(
        views.trades(spark, sf_dir), views.rates(spark, sf_dir), "ECB", grain=None
    ).select("symbol", "ord", "line", "rate", "converted")


FACTORS = [("BBL", "GAL", 42.0), ("MT", "BBL", 7.33), ("MMB", "THM", 10.0), ("KWH", "MWH", 0.001)]
FACTOR_SQL = "(VALUES " + ", ".join(
    f"('{a}', '{b}', {f}::DOUBLE)" for a, b, f in FACTORS) + ") f(unit, to_unit, factor)"


def factors(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM {FACTOR_SQL.replace('::DOUBLE', 'D')}")


def unit_of(k):
    return F.element_at(F.array(*[F.lit(u) for u in ("BBL", "MT", "MMB", "GJ")]),
                        (k % 4 + 1).cast("int"))


def to_unit_of(k):
    return F.element_at(F.array(*[F.lit(u) for u in ("GAL", "BBL", "THM", "MWH")]),
                        (k % 4 + 1).cast("int"))


@check("convert_units", f"""
    SELECT l_orderkey, l_partkey, l_linenumber,
           coalesce(nullif(CASE WHEN l_linenumber = 1 THEN 2.5::DOUBLE
                                WHEN l_linenumber = 2 THEN 0 END, 0), f.factor) AS factor,
           l_extendedprice * coalesce(nullif(CASE WHEN l_linenumber = 1 THEN 2.5::DOUBLE
                 WHEN l_linenumber = 2 THEN 0 END, 0), f.factor) AS converted
    FROM lineitem LEFT JOIN {FACTOR_SQL}
         ON f.unit = (['BBL','MT','MMB','GJ'])[l_suppkey % 4 + 1]
        AND f.to_unit = (['GAL','BBL','THM','MWH'])[l_suppkey % 4 + 1]""", digits=None)
def convert_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit table lookup; a row's own factor wins, 0 is unset, an unknown pair gives NULL."""
    k = F.col("l_suppkey")
    prices = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").alias("close"),
        unit_of(k).alias("unit"), to_unit_of(k).alias("to_unit"),
        F.when(F.col("l_linenumber") == 1, 2.5).when(F.col("l_linenumber") == 2, 0.0)
        .alias("unit_factor"),
    )
    return convert.convert_units(prices, factors(spark)).select(
        "l_orderkey", "l_partkey", "l_linenumber", "factor", "converted")


@check("conversion_spec", over("trades", "rates", then=f"""{PRICED}
    SELECT p.symbol, p.ord, p.line, CASE WHEN s.p_size % 3 = 0 THEN 'EUR' END AS to_currency, 'ECB' AS currency_source, 'BBL' AS to_unit,
           CASE WHEN s.p_size % 4 = 0 THEN 7.5::DOUBLE END AS unit_factor
    FROM priced p JOIN part s ON p.symbol = 'P' || s.p_partkey"""))
def conversion_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each symbol's wanted conversion; empty text and factor 0 count as unset."""
    size = F.col("p_size")
    spec = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"),
        F.when(size % 3 == 0, "EUR").otherwise("").alias("to_currency"),
        F.lit("ECB").alias("currency_source"), F.lit("BBL").alias("to_unit"),
        F.when(size % 4 == 0, 7.5).otherwise(0.0).alias("unit_factor"),
    )
    return convert.with_conversion_spec(views.trades(spark, sf_dir), spec).select(
        "symbol", "ord", "line", "to_currency", "currency_source", "to_unit", "unit_factor")


@check("convert_by_spec", over("trades", "rates", then=f"""{PRICED}
    , wish AS (SELECT 'P' || p_partkey AS symbol, CASE WHEN p_size % 3 = 0 THEN 'EUR' END AS to_currency,
                      CASE WHEN p_size % 2 = 0 THEN 'USF' ELSE 'ECB' END AS source,
                      CASE WHEN p_size % 5 = 0 THEN 'BBL' END AS to_unit,
                      CASE WHEN p_size % 4 = 0 THEN 7.5::DOUBLE END AS unit_factor FROM part)
    SELECT p.symbol, p.ord, p.line, CASE WHEN w.to_currency IS NULL THEN p.currency ELSE 'EUR' END AS currency,
           CASE WHEN w.to_unit IS NULL THEN 'MT' ELSE 'BBL' END AS unit,
           (CASE WHEN w.to_currency IS NULL THEN p.close ELSE p.v * r.rate END)
           * (CASE WHEN w.to_unit IS NULL THEN 1 ELSE coalesce(w.unit_factor, 7.33::DOUBLE) END) AS close
    FROM (SELECT p.*, w.source AS wished FROM priced p JOIN wish w USING (symbol)) p JOIN wish w ON w.symbol = p.symbol
    ASOF LEFT JOIN rates r ON p.wished = r.source AND p.major = r.currency AND p.tradedatetimeutc >= r.ts"""), digits=None)
def convert_by_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each symbol's own target currency, source, unit and factor, applied."""
    size = F.col("p_size")
    spec = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"),
        F.when(size % 3 == 0, "EUR").otherwise("").alias("to_currency"),
        F.when(size % 2 == 0, "USF").otherwise("ECB").alias("currency_source"),
        F.when(size % 5 == 0, "BBL").otherwise("").alias("to_unit"),
        F.when(size % 4 == 0, 7.5).otherwise(0.0).alias("unit_factor"),
    )
    rates = views.rates(spark, sf_dir).withColumn("to_currency", F.lit("EUR"))
    units = spec.limit(1).select(F.lit("MT").alias("unit"), F.lit("BBL").alias("to_unit"), F.lit(7.33).alias("factor"))
    prices = views.trades(spark, sf_dir).withColumn("unit", F.lit("MT"))
    return convert.convert_by_spec(prices, spec, rates, units, ["close"]).select(
        "symbol", "ord", "line", "currency", "unit", "close")
