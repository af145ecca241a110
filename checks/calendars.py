"""Calendars, tenors and contracts, with holidays taken from the orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from tidemark.operators import calendars as cal
from tidemark.sources import views

START, END = dt.date(1995, 1, 1), dt.date(1998, 12, 31)
SPAN = "DATE '1995-01-01', DATE '1998-12-31'"


def _calendars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.holidays(spark, sf_dir).select("calendar").distinct()


QUOTING = f""", days AS (
    SELECT calendar, unnest(generate_series(DATE '1994-12-01', DATE '1999-03-31', INTERVAL 1 DAY))::DATE
           AS day FROM calendars),
    quoting AS (SELECT d.calendar, d.day FROM days d
        LEFT JOIN holidays h ON d.calendar = h.calendar AND d.day = h.holiday
        WHERE isodow(d.day) <= 5 AND h.holiday IS NULL),
    contracts AS (SELECT calendar, (date_trunc('month', day) + INTERVAL 1 MONTH)::DATE AS start,
                         max(day) AS expiry FROM quoting GROUP BY 1, 2)"""


@check("calendar_list", over("holidays", then="""
    SELECT calendar, CASE WHEN calendar LIKE '%-%' AND calendar < '3' THEN 'Expiry'
           ELSE 'Holiday' END AS calendartype, count(*) AS holidays
    FROM holidays WHERE calendar IN ('1-URGENT', '2-HIGH', '5-LOW') AND calendar < '3'
    GROUP BY 1, 2"""))
def calendar_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = views.holidays(spark, sf_dir).groupBy("calendar").agg(
        F.count("*").alias("holidays")).withColumn(
        "calendartype", F.when(F.col("calendar") < "3", "Expiry").otherwise("Holiday"))
    return cal.list_calendars(table, ["1-URGENT", "2-HIGH", "5-LOW"], "Expiry")


@check("quoting_days", over("calendars", then=f"""{QUOTING}
    SELECT calendar, {day('day')} AS day FROM quoting
    WHERE day BETWEEN DATE '1995-01-01' AND DATE '1998-12-31'"""))
def quoting_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar_details(
        _calendars(spark, sf_dir), views.holidays(spark, sf_dir), START, END, quoting=True)


@check("holiday_dates", over("holidays", then=f"""
    SELECT calendar, {day('holiday')} AS day FROM holidays
    WHERE holiday BETWEEN DATE '1995-01-01' AND DATE '1998-12-31'"""))
def holiday_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar_details(
        _calendars(spark, sf_dir), views.holidays(spark, sf_dir), START, END, quoting=False)


@check("expiry_dates", over("calendars", then=f"""{QUOTING}
    SELECT calendar, {day('expiry')} AS day FROM contracts
    WHERE expiry BETWEEN DATE '1995-01-01' AND DATE '1998-12-31'"""))
def expiry_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar_details(
        _calendars(spark, sf_dir), views.holidays(spark, sf_dir), START, END, quoting=False,
        kind="rollover")


TENORS = """tenors AS (SELECT * FROM (VALUES ('M01', DATE '1997-04-01', 1), ('M02', DATE '1997-05-01', 1),
    ('1997Q03', DATE '1997-07-01', 3), ('1998M06', DATE '1998-06-01', 1),
    ('Y01', DATE '1998-01-01', 12)) t(tenor, start, months))"""


@check("contract_details", over("calendars", then=f"""{QUOTING}, {TENORS}
    SELECT k.calendar, t.tenor, {day('t.start')} AS start,
           {day('(t.start + to_months(t.months))::DATE - 1')} AS end, {day('c.expiry')} AS expiry
    FROM calendars k CROSS JOIN tenors t
         LEFT JOIN contracts c ON c.calendar = k.calendar AND c.start = t.start"""))
def contract_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.contract_details(
        _calendars(spark, sf_dir), views.holidays(spark, sf_dir),
        ["M01", "M02", "1997Q03", "1998M06", "Y01"], START, END, dt.date(1997, 3, 21))


@check("tenor_expiry_dates", over("calendars", then=f"""{QUOTING}
    SELECT c.calendar, t.tenor, {day('c.expiry')} AS day FROM contracts c
    JOIN (VALUES ('M01', DATE '1995-02-01'), ('1998Q03', DATE '1998-07-01')) t(tenor, start)
         ON c.start = t.start"""))
def tenor_expiry_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar_details(
        _calendars(spark, sf_dir), views.holidays(spark, sf_dir), START, END, quoting=False,
        kind="rollover", tenors=["M01", "1998Q03"])


@check("prompt_contracts", over("calendars", then=f"""{QUOTING.replace("1994-12-01", "1990-12-01").replace("1999-03-31", "2003-03-31")}
    SELECT o.o_orderkey, {day('min(c.start)')} AS contract, {day('min(c.expiry)')} AS expiry
    FROM orders o LEFT JOIN contracts c ON o.o_orderpriority = c.calendar AND c.expiry >= o.o_orderdate::DATE
         AND c.start <= o.o_orderdate::DATE + 70
    GROUP BY 1"""))
def prompt_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every order the contract trading on its day, in the calendar of its priority."""
    orders = views.table(spark, sf_dir, "orders")
    span = orders.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    table = cal.contracts(_calendars(spark, sf_dir), views.holidays(spark, sf_dir),
                          span[0], span[1] + dt.timedelta(days=62))
    dates = orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("calendar"),
        F.to_date("o_orderdate").alias("day"))
    return cal.prompt_contracts(dates, table).select("o_orderkey", "contract", "expiry")
