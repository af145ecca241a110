"""Forward curves, curve tables and bitemporal series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from tidemark.operators import curves
from tidemark.schemas import CURVE_VALUES
from tidemark.sources import views

POINT = f"curveroot, {day('curvedate')} AS curvedate, {day('contract')} AS contract"
ALONG = "(PARTITION BY curveroot, curvedate ORDER BY contract)"
THROUGH = "(PARTITION BY curveroot, contract ORDER BY curvedate)"


@check("option_chain", over("daily", then="""
    , typed AS (SELECT d.*, '/' || p.p_type AS optionroot,
                CASE WHEN p_size % 2 = 0 THEN 'fo' ELSE 'f' END AS securitytype
         FROM daily d JOIN part p ON d.symbol = 'P' || p.p_partkey)
    SELECT symbol, optionroot, tradedatetimeutc, close FROM typed
    WHERE optionroot IN ('/PROMO', '/SMALL') AND securitytype = 'fo'
      AND tradedatetimeutc < DATE '1998-04-16'
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY tradedatetimeutc DESC) = 1"""))
def option_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"),
        F.concat(F.lit("/"), "p_type").alias("optionroot"),
        F.when(F.col("p_size") % 2 == 0, "fo").otherwise("f").alias("securitytype"))
    prices = views.daily(spark, sf_dir).join(kinds, "symbol")
    return curves.option_chain(
        prices, ["/PROMO", "/SMALL"], "fo", dt.date(1998, 4, 15)
    ).select("symbol", "optionroot", "tradedatetimeutc", "close")


@check("curve_one_date", over("curve", then=f"""
    SELECT {POINT}, value FROM curve WHERE curvedate = DATE '1997-06-01'"""), digits=None)
def curve_one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.daily_curve(views.curve(spark, sf_dir), curvedate=dt.date(1997, 6, 1)).drop(
        "position")


@check("curve_range_front", over("curve", then=f"""
    SELECT {POINT}, value, row_number() OVER {ALONG} AS position FROM curve
    WHERE curvedate BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
    QUALIFY position <= 4"""), digits=None)
def curve_range_front(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.daily_curve(
        views.curve(spark, sf_dir), curvedatestart=dt.date(1996, 1, 1),
        curvedateend=dt.date(1998, 12, 31), curvesize=4
    ).withColumn("position", F.col("position").cast("bigint"))


VALUE_SQL = {
    "price": "value",
    "spread": f"value - lag(value) OVER {ALONG}",
    "spreadpercent": f"100 * (value / nullif(lag(value) OVER {ALONG}, 0) - 1)",
    "relative": f"value - first_value(value) OVER {ALONG}",
    "relativepercent": f"100 * (value / nullif(first_value(value) OVER {ALONG}, 0) - 1)",
    "spreadwave": f"value - lag(value) OVER {THROUGH}",
    "spreadpercentwave": f"100 * (value / nullif(lag(value) OVER {THROUGH}, 0) - 1)",
    "spread100percentwave": f"100 * (value / nullif(lag(value) OVER {THROUGH}, 0))",
    "spreadavg": "value - avg(value) OVER (PARTITION BY curveroot, curvedate)",
}

for _code, _name in CURVE_VALUES.items():
    if _name == "spreadavg":
        continue

    def _derived(spark: SparkSession, sf_dir: str, code: int = _code) -> DataFrame:
        return curves.curve_values(views.curve(spark, sf_dir), code)

    check(f"curve_{_name}", over("curve", then=f"""
    SELECT {POINT}, {VALUE_SQL[_name]} AS value FROM curve"""), digits=None)(_derived)


@check("curve_spreadavg", over("curve", then=f"""
    SELECT {POINT}, round({VALUE_SQL['spreadavg']} + 1e-9::DOUBLE, 6) AS value FROM curve"""))
def curve_spreadavg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small offset moves values off the rounding ties that averages of cents often hit."""
    derived = curves.curve_values(views.curve(spark, sf_dir), "spreadavg")
    return derived.withColumn("value", F.col("value") + 1e-9)


TABLE_SQL = f""", tabled AS (
    SELECT *, value - lag(value) OVER {THROUGH} AS change FROM curve)
    SELECT {POINT}, value, change,
           ('FGHJKMNQUVXZ')[month(contract)] || strftime(contract, '%y') AS tenor,
           strftime(contract, '%YM%m') AS absolute,
           'M' || lpad(date_diff('month', curvedate, contract)::VARCHAR, 2, '0') AS relative,
           {day('contract')} AS start, {day('last_day(contract)')} AS end,
           {day('(contract - 1) - greatest(isodow(contract - 1) - 5, 0)::INT')} AS expiry
    FROM tabled"""


@check("curve_table_range", over("curve", then=TABLE_SQL + """
    WHERE curvedate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"""), digits=None)
def curve_table_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.curve_table(
        views.curve(spark, sf_dir), start=dt.date(1997, 1, 1), end=dt.date(1997, 12, 31))


@check("curve_table_latest", over("curve", then=TABLE_SQL + """ t
    WHERE curvedate = (SELECT max(curvedate) FROM curve c WHERE c.curveroot = t.curveroot)"""), digits=None)
def curve_table_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.curve_table(views.curve(spark, sf_dir), "latest")


@check("series_as_of_date", over("series", then=f"""
    SELECT symbol, field, {day('ondate')} AS ondate, index, value FROM series
    WHERE ondate = DATE '1997-07-11' AND index >= DATE '1995-01-01' AND index < DATE '2000-01-01'"""))
def series_as_of_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.series_as_of(
        views.series(spark, sf_dir), dt.date(1997, 7, 11), dt.date(1995, 1, 1),
        dt.date(1999, 12, 31))


@check("series_latest", over("series", then=f"""
    SELECT symbol, field, {day('ondate')} AS ondate, index, value FROM series s
    WHERE ondate = (SELECT max(ondate) FROM series x WHERE x.symbol = s.symbol)"""))
def series_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.series_as_of(views.series(spark, sf_dir), "latest")


@check("search_curves", """
    SELECT p_partkey FROM part WHERE p_type = 'PROMO' AND p_brand = 'Brand#1'""")
def search_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = views.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("holiday"), F.col("p_brand").alias("quotecal"))
    return curves.search_curves(config, holiday="PROMO", quotecal="Brand#1").select("p_partkey")


@check("missing_roots", over("curve", then="""
    SELECT DISTINCT p_brand AS curveroot FROM part
    UNION SELECT 'NOSUCH' EXCEPT SELECT curveroot FROM curve"""))
def missing_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = views.table(spark, sf_dir, "part").select(F.col("p_brand").alias("curveroot"))
    requested = requested.unionByName(spark.sql("SELECT 'NOSUCH' AS curveroot")).distinct()
    return curves.missing_roots(requested, views.curve(spark, sf_dir), "curveroot")
