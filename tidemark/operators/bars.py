"""Bars and resampling (rows A-8 to A-11, W-14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.tenors import prompt_contract
from tidemark.schemas import AGGREGATE_TYPES, FREQUENCIES

PEAK_HOURS = (7, 22)


# Fixed value: more than twice the largest 64-bit tie value, so that ties never reach the next time.
TIE_SPAN = "20000000000000000000"


def moment(df: DataFrame, time: str, tie: Sequence[str] = ()) -> Column:
    """What rows are ordered by: the time, then the tie columns.

    Ordering by a struct makes Spark aggregate by sorting. The usual case, a timestamp and one whole
    number, is packed into one decimal instead, which keeps the hash aggregation.
    """
    if not tie:
        return F.col(time)
    kinds = dict(df.dtypes)
    if len(tie) == 1 and kinds[time] == "timestamp" and kinds[tie[0]] in ("bigint", "int"):
        micros = F.unix_micros(time).cast("decimal(18,0)")
        return (micros * F.lit(TIE_SPAN).cast("decimal(20,0)")
                + F.col(tie[0]).cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.struct(time, *tie)


def ohlcv(price: str, volume: str | None, high: str | None = None, low: str | None = None,
          open_: str | None = None) -> list[Column]:
    """First, highest, lowest, last price and summed volume of a group ordered by ``_at``.

    All of them combine before the shuffle, so a hot group sends one row per map task.
    """
    out = [
        F.min_by(open_ or price, "_at").alias("open"),
        F.max(high or price).alias("high"),
        F.min(low or price).alias("low"),
        F.max_by(price, "_at").alias("close"),
    ]
    return out + ([F.sum(volume).alias("volume")] if volume else [])


def bars(ticks: DataFrame, minutes: int, price: str = "last", time: str = "ts",
         volume: str | None = "volume", tie: Sequence[str] = ()) -> DataFrame:
    """Bars of N minutes, left-closed, labelled by their start, aligned to the epoch."""
    if not isinstance(minutes, int) or minutes <= 0:
        raise ValueError("the bar interval is a positive number of minutes")
    return (
        ticks.withColumn("_at", moment(ticks, time, tie))
        .groupBy("symbol", F.window(time, f"{minutes} minutes")["start"].alias("bar"))
        .agg(*ohlcv(price, volume))
    )


def is_peak(local: Column, hours: tuple[int, int] = PEAK_HOURS) -> Column:
    """Monday to Friday, hour beginning within the given hours, both included."""
    return (F.weekday(local) < 5) & F.hour(local).between(*hours)


def in_hours(ticks: DataFrame, local: Column, aggregatetype: int, holidays: DataFrame | None = None,
             hours: tuple[int, int] = PEAK_HOURS) -> DataFrame:
    """Ticks of peak (1) or off-peak (2) hours of their local time; a holiday has no peak hours."""
    peak, kept = is_peak(local, hours), ticks.columns
    if holidays is not None:
        off = holidays.select(F.to_date("holiday").alias("_day"), F.lit(True).alias("_off")).distinct()
        ticks = ticks.withColumn("_day", F.to_date(local)).join(off, "_day", "left")
        peak = peak & F.col("_off").isNull()
    return ticks.where(peak if aggregatetype == 1 else ~peak).select(*kept)


def aggregate_hours(ticks: DataFrame, aggregatetype: int, zone: Column | str = "UTC",
                    holidays: DataFrame | None = None, hours: tuple[int, int] = PEAK_HOURS,
                    price: str = "last", time: str = "ts", volume: str | None = "volume",
                    tie: Sequence[str] = ()) -> DataFrame:
    """Daily bars over all (0), peak (1) or off-peak (2) hours of the local day.

    ``holidays`` has one row per date in its column ``holiday``; a holiday has no peak hours.
    """
    if aggregatetype not in AGGREGATE_TYPES:
        raise ValueError(f"unknown aggregate type: {aggregatetype}")
    local = ticks.withColumns(
        {"_at": moment(ticks, time, tie), "_local": F.from_utc_timestamp(time, zone)}
    ).withColumn("day", F.to_date("_local"))
    if aggregatetype:
        local = in_hours(local, F.col("_local"), aggregatetype, holidays, hours)
    return local.groupBy("symbol", "day").agg(*ohlcv(price, volume))


def period_start(time: Column, frequency: int | str, minutes: int = 60) -> Column:
    """First day (or bar start, for intraday) of the period a time falls in."""
    name = FREQUENCIES.get(frequency, frequency)
    if name == "intraday":
        return F.window(time, f"{minutes} minutes")["start"]
    if name == "contract_months":
        return prompt_contract(F.to_date(time))
    units = {"days": "day", "weeks": "week", "months": "month", "quarters": "quarter",
             "years": "year"}
    if name not in units:
        raise ValueError(f"unknown frequency: {frequency}")
    return F.to_date(F.date_trunc(units[name], time))


def resample(df: DataFrame, frequency: int | str, price: str = "close",
             time: str = "tradedatetimeutc", volume: str | None = "volume",
             tie: Sequence[str] = (), minutes: int = 60) -> DataFrame:
    return (
        df.withColumn("_at", moment(df, time, tie))
        .groupBy("symbol", period_start(F.col(time), frequency, minutes).alias("period"))
        .agg(*ohlcv(price, volume))
    )


def latest_quote(ticks: DataFrame, fields: Sequence[str], time: str = "ts",
                 tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per symbol; one candidate per symbol leaves each map task. Each field is taken by
    itself, which keeps hash aggregation for plain types."""
    placed = ticks.withColumn("_at", moment(ticks, time, tie))
    return placed.groupBy("symbol").agg(
        *[F.max_by(c, "_at").alias(c) for c in dict.fromkeys([time, *fields])])


def midpoint(df: DataFrame) -> Column:
    """Mean of bid and ask, else of high and low."""
    def mean(a: str, b: str) -> Column:
        return (F.col(a) + F.col(b)) / 2

    parts = [mean(a, b) for a, b in (("bid", "ask"), ("high", "low"))
             if a in df.columns and b in df.columns]
    return F.coalesce(*parts) if parts else F.lit(None).cast("double")
