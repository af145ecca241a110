"""Calendars, tenors and contracts (rows D-1 to D-3, J-7)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import tenors as tn


def list_calendars(calendars: DataFrame, names: Sequence[str] | None = None,
                   calendartype: str | None = None) -> DataFrame:
    if names is not None:
        calendars = calendars.where(F.col("calendar").isin(*names))
    return calendars if calendartype is None else calendars.where(
        F.col("calendartype") == calendartype
    )


def quoting_days(calendars: DataFrame, holidays: DataFrame, start: dt.date,
                 end: dt.date) -> DataFrame:
    """Business days per calendar that are not among its holidays."""
    days = calendars.select(
        "calendar", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day")
    ).where(F.weekday("day") < 5)
    closed = holidays.where(F.col("holiday").between(start, end)).select(
        "calendar", F.col("holiday").alias("day")
    )
    return days.join(closed, ["calendar", "day"], "left_anti")


def holiday_dates(holidays: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return holidays.where(F.col("holiday").between(start, end)).select(
        "calendar", F.col("holiday").alias("day")
    )


def contracts(calendars: DataFrame, holidays: DataFrame, start: dt.date,
              end: dt.date) -> DataFrame:
    """Monthly contracts starting in the range: start, end, expiry.

    Expiry is the last quoting day before the contract month starts.
    """
    first = start.replace(day=1)
    before = (first - dt.timedelta(days=1)).replace(day=1)
    expiry = (
        quoting_days(calendars, holidays, before, end)
        .groupBy("calendar", F.add_months(F.trunc("day", "month"), 1).alias("start"))
        .agg(F.max("day").alias("expiry"))
    )
    return expiry.where(F.col("start").between(first, end)).select(
        "calendar", "start", F.last_day("start").alias("end"), "expiry"
    )


def expiry_dates(calendars: DataFrame, holidays: DataFrame, start: dt.date,
                 end: dt.date) -> DataFrame:
    """Expiry dates that fall in the range."""
    later = end + dt.timedelta(days=62)
    return (
        contracts(calendars, holidays, start, later)
        .where(F.col("expiry").between(start, end)).select("calendar", F.col("expiry").alias("day"))
    )


def calendar_details(calendars: DataFrame, holidays: DataFrame, start: dt.date, end: dt.date,
                     quoting: bool, kind: str = "holiday",
                     tenors: Sequence[str] | None = None) -> DataFrame:
    """Quoting days, or holiday dates, or expiry dates (optionally of chosen tenors)."""
    if quoting:
        return quoting_days(calendars, holidays, start, end)
    if kind == "holiday":
        return holiday_dates(holidays, start, end)
    if tenors is None:
        return expiry_dates(calendars, holidays, start, end)
    return contract_details(calendars, holidays, tenors, start, end).select(
        "calendar", "tenor", F.col("expiry").alias("day")
    )


def contract_details(calendars: DataFrame, holidays: DataFrame, tenors: Sequence[str],
                     start: dt.date, end: dt.date, ondate: dt.date | None = None) -> DataFrame:
    """Start, end and expiry per calendar and tenor; relative tenors are seen from ``ondate``
    (default: the range's start). The expiry is that of the period's first month, NULL where that
    lies outside the range; a tenor that cannot be read has no dates."""
    if not tenors or not all(isinstance(t, str) for t in tenors):
        raise ValueError("tenors is a non-empty list of text")
    as_of = F.lit(ondate or start)
    # The requested tenors are an argument list: a literal array, not a table.
    wanted = calendars.select(
        "calendar", F.explode(F.array(*[F.lit(t) for t in tenors])).alias("tenor")
    )
    resolved = wanted.withColumn("start", tn.tenor_start(F.col("tenor"), as_of)).withColumn(
        "end", F.date_sub(F.add_months("start", tn.tenor_months(F.col("tenor"))), 1)
    )
    monthly = contracts(calendars, holidays, start, end).select("calendar", "start", "expiry")
    return resolved.join(monthly, ["calendar", "start"], "left").select(
        "calendar", "tenor", "start", "end", "expiry"
    )


def prompt_contracts(dates: DataFrame, contract_table: DataFrame, day: str = "day") -> DataFrame:
    """For each (calendar, day) the contract trading on it: the earliest one not yet expired; NULL
    where the table has none. No date is dropped.

    Contracts follow each other without gaps, so each is prompt from the day after the previous
    expiry up to its own. That interval is spread over the months it touches, which makes the range
    join an equi-join on (calendar, month): both sides hash-partition, nothing is compared crosswise.
    """
    w = W.partitionBy("calendar").orderBy("start")
    spans = contract_table.withColumn(
        "_from", F.coalesce(F.date_add(F.lag("expiry").over(w), 1), F.trunc("expiry", "month"))
    ).withColumn(
        "_month",
        F.explode(F.sequence(F.trunc("_from", "month"), F.trunc("expiry", "month"),
                             F.expr("interval 1 month"))),
    ).select("calendar", "_month", "_from", F.col("expiry"), F.col("start").alias("contract"))
    asked = dates.withColumn("_month", F.trunc(day, "month")).alias("d")
    trades = ((F.col("d.calendar") == F.col("s.calendar")) & (F.col("d._month") == F.col("s._month"))
              & (F.col("d." + day) >= F.col("s._from")) & (F.col("d." + day) <= F.col("s.expiry")))
    return asked.join(spans.alias("s"), trades, "left").select(
        *[F.col("d." + c) for c in dates.columns], "s.contract", "s.expiry")
