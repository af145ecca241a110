"""Gap filling on a date grid and lead/lag (rows W-7 to W-13).

The input is one row per (key, day): reduce intraday data first (that aggregation combines before
the shuffle). A key's rows are then bounded by the days of its history, whatever its share of the
raw data, so a window per key is safe. The grid is not built and joined: each observation is
expanded up to the next one, which needs one window and no join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.schemas import FILL_CALENDARS, FILL_METHODS, LEAD_LAG_TYPES


def on_calendar(day: Column, calendar: str) -> Column:
    if calendar not in FILL_CALENDARS:
        raise ValueError(f"unknown fill calendar: {calendar}")
    return {"business": F.weekday(day) < 5, "sixdays": F.weekday(day) < 6,
            "sevendays": F.lit(True)}[calendar]


def daily_last(df: DataFrame, keys: Sequence[str], time: str, value: str,
               tie: Sequence[str] = ()) -> DataFrame:
    """Last value of each key and day."""
    return df.groupBy(*keys, F.to_date(time).alias("day")).agg(
        F.max_by(value, F.struct(time, *tie)).alias(value)
    )


def fill(daily: DataFrame, keys: Sequence[str], day: str, value: str, method: str,
         calendar: str = "sevendays", enddate: dt.date | None = None) -> DataFrame:
    """Values on every grid date from a key's first to its last row, whether observed or NULL there.

    A date without the neighbour that its method needs is NULL: before the first observation all
    methods but ``backward``, after the last one all but ``forward`` and ``projected``. Keys that were
    never observed have no grid. There must be one row per key and day (see ``daily_last``); where a
    day repeats, the greatest value counts. ``projected`` also runs on to ``enddate`` along the line of the last two observations.
    Observed values on grid dates never change. ``enddate`` bounds how far a sparse key may grow.
    """
    if method not in FILL_METHODS:
        raise ValueError(f"unknown fill method: {method}")
    if method == "nofill":
        return daily.select(*keys, day, value)
    w = W.partitionBy(*keys).orderBy(day)
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # in the order of w: one sort serves both
    rows = daily.groupBy(*keys, day).agg(F.max(value).alias(value)).withColumns(
        {"_begin": F.min(day).over(whole), "_end": F.max(day).over(whole)})
    spans = rows.where(F.col(value).isNotNull()).withColumns({"_first": F.row_number().over(w) == 1}).withColumns(
        {"_day": F.lead(day).over(w), "_value": F.lead(value).over(w)}
        | ({"_pday": F.lag(day).over(w), "_pvalue": F.lag(value).over(w)}
           if method == "projected" else {})
    )
    stop = F.date_sub("_day", 1)
    if method == "projected" and enddate is not None:
        stop = F.coalesce(stop, F.greatest(F.col("_end"), F.lit(enddate)))
    else:
        stop = F.coalesce(stop, F.col("_end"))
    start_at = F.when(F.col("_first"), F.col("_begin")).otherwise(F.col(day))
    grid = spans.withColumn("_grid", F.explode(F.sequence(start_at, stop)))
    grid = grid.where(on_calendar(F.col("_grid"), calendar))

    start = F.col(value)
    after = F.datediff("_grid", day)
    line = start + (F.col("_value") - start) * after / F.datediff("_day", day)
    filled = {
        "forward": start,
        "backward": F.col("_value"),
        "average": (start + F.col("_value")) / 2,
        "interpolate": line,
    }
    if method == "projected":
        slope = (start - F.col("_pvalue")) / F.datediff(day, "_pday")
        beyond = start + F.coalesce(slope, F.lit(0.0)) * after
        filled["projected"] = F.when(F.col("_day").isNull(), beyond).otherwise(line)
    leading = start if method == "backward" else F.lit(None).cast("double")
    return grid.select(
        *keys, F.col("_grid").alias(day),
        F.when(after == 0, start).when(after < 0, leading).otherwise(filled[method]).alias(value),
    )


def daily_rows(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str],
               tie: Sequence[str] = ()) -> DataFrame:
    """Last row of each key and day, with the named values."""
    at = F.struct(time, *tie)
    return df.groupBy(*keys, F.to_date(time).alias("day")).agg(*[F.max_by(v, at).alias(v) for v in values])


def fill_all(daily: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], method: str,
             calendar: str = "sevendays", enddate: dt.date | None = None, newest: int | None = None) -> DataFrame:
    """``fill`` for several value columns on one grid.

    The rows of a key are sorted once up and once down; each carries, for every column, the last observation
    up to it and the next one after it, and is expanded up to the next row. Only ``projected``, which looks two
    observations back, fills one row per (key, day, column) and puts the columns together again.

    A caller that only wants a key's ``newest`` rows says how many: the grid then begins late, early enough to
    hold as many days of the calendar, with the same values. Other days may come with them."""
    if method == "nofill":
        return daily.select(*keys, day, *values)
    if method not in FILL_METHODS:
        raise ValueError(f"unknown fill method: {method}")
    if method != "projected":
        return _fill_together(daily, keys, day, values, method, calendar, newest)
    long = daily.select(*keys, day, *[F.col(v).cast("double").alias(v) for v in values]).unpivot(
        [*keys, day], list(values), "_field", "_filled")
    filled = fill(long, [*keys, "_field"], day, "_filled", method, calendar, enddate)
    return filled.groupBy(*keys, day).agg(
        *[F.max(F.when(F.col("_field") == v, F.col("_filled"))).alias(v) for v in values])


def _fill_together(daily: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], method: str,
                   calendar: str, newest: int | None = None) -> DataFrame:
    up, down = W.partitionBy(*keys).orderBy(day), W.partitionBy(*keys).orderBy(F.desc(day))
    rows = daily.groupBy(*keys, day).agg(*[F.max(F.col(v).cast("double")).alias(v) for v in values])
    seen = {v: F.when(F.col(v).isNotNull(), F.struct(F.col(day).alias("day"), F.col(v).alias("value"))) for v in values}
    upto, after = up.rowsBetween(W.unboundedPreceding, W.currentRow), down.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({"_day": F.lead(day).over(up)} | {f"_at_{v}": F.last(s, ignorenulls=True).over(upto) for v, s in seen.items()})
    rows = rows.withColumns({f"_to_{v}": F.last(s, ignorenulls=True).over(after) for v, s in seen.items()})
    rows = rows.where(F.coalesce(*[F.col(f"_{side}_{v}.day") for v in values for side in ("at", "to")]).isNotNull())
    stop = F.coalesce(F.date_sub("_day", 1), F.col(day))
    start = F.col(day)
    if newest is not None:
        # Every seven days hold five of each calendar at least, and the last row's day may be off it.
        late = F.date_sub(F.max(day).over(up.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), 7 * (max(newest, 0) // 5 + 1))
        rows = rows.withColumn("_late", late).where(F.col(day).isNotNull() & (stop >= F.col("_late")))
        start = F.greatest(start, F.col("_late"))
    grid = rows.withColumn("_grid", F.explode(F.sequence(start, stop))).where(on_calendar(F.col("_grid"), calendar))

    def filled(v: str) -> Column:
        start, end = F.col(f"_at_{v}.value"), F.col(f"_to_{v}.value")
        since = F.datediff("_grid", F.col(f"_at_{v}.day"))
        line = start + (end - start) * since / F.datediff(F.col(f"_to_{v}.day"), F.col(f"_at_{v}.day"))
        between = {"forward": start, "backward": end, "average": (start + end) / 2, "interpolate": line}[method]
        return F.when(since == 0, start).otherwise(between)

    return grid.select(*keys, F.col("_grid").alias(day), *[filled(v).alias(v) for v in values])


def lead_lag(daily: DataFrame, keys: Sequence[str], day: str, value: str, n: int,
             kind: int | str = "quoteddays", out: str = "shifted") -> DataFrame:
    """Value ``n`` steps earlier (negative: later).

    Quoted days count rows; calendar days and weeks ask for the exact date, by an equi-join, and
    give NULL where nothing was observed on it.
    """
    name = LEAD_LAG_TYPES.get(kind, kind)
    if name not in LEAD_LAG_TYPES.values():
        raise ValueError(f"unknown lead/lag type: {kind}")
    if name == "quoteddays":
        return daily.withColumn(
            out, F.lag(value, n).over(W.partitionBy(*keys).orderBy(day))
        )
    step = n * (7 if name == "weeks" else 1)
    moved = daily.select(
        *keys, F.date_add(day, step).alias(day), F.col(value).alias(out)
    )
    return daily.join(moved, [*keys, day], "left")
