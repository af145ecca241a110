"""Forward curves (rows C-1 to C-5, C-7, J-8).

A curve point is ``(curveroot, curvedate, contract, value)``, unique per contract. One curve has as
many points as there are contract months, and one contract as many as there are curve dates, so the
windows below run over groups bounded by the calendar, not by the number of trades behind a point.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import tenors as tn
from tidemark.operators.filters import as_of
from tidemark.schemas import CURVE_VALUES, SECURITY_TYPES


def check_roots(requested: Sequence[str], available: DataFrame, column: str) -> None:
    """Fail when a requested root does not exist.

    This runs a query at once: an error left inside a lazy plan may be optimised away with an empty
    side. It brings back at most as many names as were requested.
    """
    known = available.where(F.col(column).isin(*requested)).select(column).distinct().collect()
    missing = sorted(set(requested) - {row[0] for row in known})
    if missing:
        raise ValueError(f"unknown roots: {', '.join(missing)}")


def missing_roots(requested: DataFrame, available: DataFrame, column: str) -> DataFrame:
    return requested.join(available.select(column).distinct(), column, "left_anti")


def option_chain(prices: DataFrame, roots: str | Sequence[str], securitytype: str | None = None,
                 ondate: dt.date | None = None, time: str = "tradedatetimeutc",
                 tie: Sequence[str] = ()) -> DataFrame:
    """Latest row per contract of the roots, on or before a date."""
    if securitytype is not None and securitytype not in SECURITY_TYPES:
        raise ValueError(f"security type not allowed: {securitytype}")
    names = [roots] if isinstance(roots, str) else list(roots)
    found = prices.where(F.col("optionroot").isin(*names))
    if securitytype is not None:
        found = found.where(F.col("securitytype") == securitytype)
    return as_of(found, ["symbol"], time, ondate or dt.date(9999, 12, 30), tie)


def daily_curve(points: DataFrame, roots: Sequence[str] | None = None,
                curvedate: dt.date | None = None, curvedatestart: dt.date | None = None,
                curvedateend: dt.date | None = None, curvesize: int | None = None) -> DataFrame:
    """First contracts of each curve for one date or a range of dates, with their position."""
    if curvedate is not None and (curvedatestart is not None or curvedateend is not None):
        raise ValueError("a curve date cannot be combined with a range")
    if curvesize is not None and (isinstance(curvesize, bool) or not isinstance(curvesize, int)
                                  or curvesize <= 0):
        raise ValueError("the curve size is a positive whole number")
    if roots is not None:
        points = points.where(F.col("curveroot").isin(*roots))
    if curvedate is not None:
        points = points.where(F.col("curvedate") == F.lit(curvedate))
    if curvedatestart is not None:
        points = points.where(F.col("curvedate") >= F.lit(curvedatestart))
    if curvedateend is not None:
        points = points.where(F.col("curvedate") <= F.lit(curvedateend))
    position = F.row_number().over(W.partitionBy("curveroot", "curvedate").orderBy("contract"))
    placed = points.withColumn("position", position)
    return placed if curvesize is None else placed.where(F.col("position") <= curvesize)


def curve_values(points: DataFrame, valuetype: int | str = 0) -> DataFrame:
    """Derived curve: spreads to the neighbour, the front, the average, or the previous date.

    The wave types compare a contract with itself on the previous curve date it was quoted on.
    """
    name = CURVE_VALUES.get(valuetype, valuetype)
    if name not in CURVE_VALUES.values():
        raise ValueError(f"unknown curve value type: {valuetype}")
    along = W.partitionBy("curveroot", "curvedate").orderBy("contract")
    over_time = W.partitionBy("curveroot", "contract").orderBy("curvedate")
    whole = W.partitionBy("curveroot", "curvedate")
    v = F.col("value")
    if name == "price":
        return points
    if name == "spreadavg":
        return points.withColumn("value", v - F.avg("value").over(whole))
    if "wave" in name:
        other = F.lag("value").over(over_time)
    elif name.startswith("relative"):
        other = F.first("value").over(along)
    else:
        other = F.lag("value").over(along)
    based = points.withColumn("_base", other)
    ratio = v / F.nullif(F.col("_base"), F.lit(0.0))
    if name == "spread100percentwave":
        out = 100 * ratio
    elif "percent" in name:
        out = 100 * (ratio - 1)
    else:
        out = v - F.col("_base")
    return based.withColumn("value", out).drop("_base")


def curve_table(points: DataFrame, curvedate: dt.date | str | None = None,
                start: dt.date | None = None, end: dt.date | None = None,
                version: str | None = None) -> DataFrame:
    """Curve rows with tenor texts, contract period, expiry and change since the previous date.

    The change is taken before the date filter, so that the first row of a range has one too.
    """
    if version is not None:
        points = points.where(F.col("curveversion") == version)
    over_time = W.partitionBy("curveroot", "contract").orderBy("curvedate")
    table = points.withColumn("change", F.col("value") - F.lag("value").over(over_time))
    if isinstance(curvedate, str):
        if curvedate.lower() != "latest":
            raise ValueError("a curve date is a date or 'latest'")
        newest = points.groupBy("curveroot").agg(F.max("curvedate").alias("curvedate"))
        table = table.join(newest, ["curveroot", "curvedate"], "left_semi")
    elif curvedate is not None:
        table = table.where(F.col("curvedate") == F.lit(curvedate))
    if start is not None:
        table = table.where(F.col("curvedate") >= F.lit(start))
    if end is not None:
        table = table.where(F.col("curvedate") <= F.lit(end))
    contract = F.col("contract")
    return table.withColumns(
        {
            "tenor": tn.month_code(contract),
            "absolute": tn.absolute_tenor(contract),
            "relative": tn.relative_tenor(contract, F.col("curvedate")),
            "start": contract,
            "end": F.last_day(contract),
            "expiry": tn.last_business_day(F.add_months(contract, -1)),
        }
    )


def series_as_of(series: DataFrame, ondate: dt.date | str, start: dt.date | None = None,
                 end: dt.date | None = None) -> DataFrame:
    """A bitemporal series as known on one as-of date, or on each symbol's latest."""
    if isinstance(ondate, str):
        if ondate.lower() != "latest":
            raise ValueError("an as-of date is a date or 'latest'")
        newest = series.groupBy("symbol").agg(F.max("ondate").alias("ondate"))
        found = series.join(newest, ["symbol", "ondate"], "left_semi")
    else:
        found = series.where(F.col("ondate") == F.lit(ondate))
    if start is not None:
        found = found.where(F.col("index") >= F.lit(start))
    if end is not None:
        found = found.where(F.col("index") < F.lit(end + dt.timedelta(days=1)))
    return found


def search_curves(config: DataFrame, **wanted: str) -> DataFrame:
    """Curves whose configuration has all the given values."""
    for name, value in wanted.items():
        config = config.where(F.col(name) == value)
    return config
