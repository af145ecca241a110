"""Predicates of the request vocabulary (rows P-1 to P-14, C-6, L-3 to L-5)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casting import parse_datetime
from tidemark.functions.tenors import like_pattern
from tidemark.operators.bars import moment
from tidemark.operators.ingest import first_by_key

UPDATE_TYPES = ["U", "UI"]


def for_symbols(df: DataFrame, symbols: str | Sequence[str] | DataFrame,
                column: str = "symbol") -> DataFrame:
    """Rows of the listed symbols; ``<*>`` in a text is a wildcard, a frame is semi-joined."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(F.col(symbols.columns[0]).alias(column)), column,
                       "left_semi")
    names = [symbols] if isinstance(symbols, str) else list(symbols)
    plain = [s for s in names if "<*>" not in s]
    keep = F.col(column).isin(plain) if plain else F.lit(False)
    for wildcard in (s for s in names if "<*>" in s):
        keep = keep | F.col(column).like(like_pattern(wildcard))
    return df.where(keep)


def named(df: DataFrame, column: str = "symbol") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-sensitive substring; NULL does not match."""
    return df.where(F.coalesce(F.col(column).contains(text), F.lit(False)))


def symbol_search(instruments: DataFrame, pattern: str) -> DataFrame:
    """Case-insensitive substring of symbol or description."""
    if pattern is None:
        raise ValueError("pattern is required")
    text = F.lit(pattern.lower())
    return instruments.where(
        F.coalesce(F.contains(F.lower("symbol"), text), F.lit(False))
        | F.coalesce(F.contains(F.lower("description"), text), F.lit(False))
    )


def wildcard_search(df: DataFrame, symbol: str, column: str = "symbol") -> DataFrame:
    """``%`` wildcard search; without a wildcard it is an exact match. Nothing else is special."""
    return df.where(F.col(column).like(re.sub(r"([\\_])", r"\\\1", symbol)))


def between(df: DataFrame, time: str, start: dt.date | None = None,
            end: dt.date | None = None) -> DataFrame:
    """Inclusive range. A plain end date covers that whole day. Compares the bare column, so the
    bounds reach the Parquet scan."""
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start))
    if end is not None:
        if isinstance(end, dt.datetime):
            df = df.where(F.col(time) <= F.lit(end))
        else:
            df = df.where(F.col(time) < F.lit(end + dt.timedelta(days=1)))
    return df


def days_back(df: DataFrame, time: str, days: int, anchor: dt.datetime | None = None) -> DataFrame:
    """Rows of the last ``days`` days before the anchor (default: the newest time in the data).

    Without an anchor the newest time is a one-row scalar subquery over the time column.
    """
    if anchor is not None:
        return df.where(
            (F.col(time) >= F.lit(anchor - dt.timedelta(days=days)))
            & (F.col(time) <= F.lit(anchor))
        )
    newest = df.groupBy().agg(F.max(time)).scalar()
    return df.where(F.col(time) >= newest - F.make_dt_interval(days=F.lit(days)))


def settled_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("settledate").isNotNull())


def of_version(df: DataFrame, version: str, column: str = "version") -> DataFrame:
    return df.where(F.col(column) == version)


def revisions(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Tag each revision of a key: ``I`` for the first, ``U`` for later ones.

    The first revision of each key comes from an aggregation that combines before the shuffle, and
    is joined back; a key with very many revisions is then a skewed join, which AQE splits. NULL key
    parts compare as equal. A row without a stamp comes after those with one; rows with the same
    stamp and tie are one revision and get the same tag.
    """
    placed = df.withColumn("_at", moment(df, order[0], order[1:]))
    first = placed.groupBy(*keys).agg(F.min("_at").alias("_first"))
    same = [F.col("d." + k).eqNullSafe(F.col("f." + k)) for k in keys]
    tag = F.when(F.col("_at").eqNullSafe(F.col("_first")), "I").otherwise("U").alias("updatetype")
    return placed.alias("d").join(first.alias("f"), same).select(
        *[F.col("d." + c) for c in df.columns], tag)


def corrections(df: DataFrame, keys: Sequence[str], order: Sequence[str], updatetype: str = "UI",
                since: dt.datetime | None = None, updated: str = "lastupdatetime") -> DataFrame:
    """Corrections feed: ``U`` keeps updates, ``UI`` also inserts; ``since`` is exclusive."""
    if updatetype not in UPDATE_TYPES:
        raise ValueError(f"unknown update type: {updatetype}")
    tagged = revisions(df, keys, order)
    if updatetype == "U":
        tagged = tagged.where(F.col("updatetype") == "U")
    return tagged if since is None else tagged.where(F.col(updated) > F.lit(since))


def latest_revision(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_by_key(df, keys, [F.desc(c) for c in order])


def as_of(df: DataFrame, keys: Sequence[str], time: str, ondate: dt.date,
          tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per key on or before a date."""
    return first_by_key(between(df, time, end=ondate), keys,
                        [F.desc(time), *[F.desc(c) for c in tie]])


def records_back(df: DataFrame, keys: Sequence[str], time: str, n: int,
                 tie: Sequence[str] = (), salts: int = 64) -> DataFrame:
    """The n newest rows per key.

    A first round keeps the n newest of each of a key's ``salts`` parts, spread over as many tasks;
    the final round ranks at most ``n * salts`` rows of a key. The same plan serves every n.
    """
    newest = [F.desc(time), *[F.desc(c) for c in tie]]

    def limited(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*groups).orderBy(*newest))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

    part = F.monotonically_increasing_id() % salts  # any part will do, and this one costs nothing
    return limited(limited(df.withColumn("_part", part), [*keys, "_part"]).drop("_part"), keys)


def records_back_by_plan(df: DataFrame, plan: DataFrame, time: str, tie: Sequence[str] = (),
                         key: str = "symbol", depth: str = "recordsback") -> DataFrame:
    """The newest rows per key, as many as the plan has for it; keys that are not in the plan give none.

    The greatest depth of the plan, one number, bounds what a task keeps of a key.
    """
    wanted = plan.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_wanted")).agg(F.max(depth).alias("_depth"))
    most = wanted.agg(F.max("_depth")).first()[0] or 0
    near = records_back(df.join(wanted, F.col(key) == F.col("_wanted")).drop("_wanted"), [key], time, most, tie)
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc(time), *[F.desc(c) for c in tie]))
    return near.withColumn("_rank", rank).where("_rank <= _depth").drop("_rank", "_depth")


#: Rows up to which a sorted head is taken directly, in one task at the end.
HEAD_ROWS = 10_000


def max_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n) if n <= HEAD_ROWS else page(df, order, 1, n)


def page(df: DataFrame, order: Sequence[str], number: int, size: int) -> DataFrame:
    """Page by position (first page is 1); the rows come in any order.

    The order's columns alone are cut into ranges and counted; the counts, one row a range, tell which ranges
    the page reaches into. Of the rows themselves, those of ranges that lie wholly inside the page are
    filtered out, and only the first and the last range are sorted. Pages that end within ``HEAD_ROWS`` are
    taken directly.
    """
    first, last = (number - 1) * size, number * size
    if last <= HEAD_ROWS:
        return df.orderBy(*order).offset(first).limit(size)
    place = F.struct(*order)
    counted = (df.select(*order).repartitionByRange(*order).groupBy(F.spark_partition_id().alias("run"))
               .agg(F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high")))
    parts, before = [], 0
    for run in sorted(counted.collect(), key=lambda r: r["run"]):
        low, high = max(first - before, 0), min(last - before, run["n"])
        if low < high:
            parts.append((run, low, high))
        before += run["n"]
    kinds = df.select(place.alias("p")).schema["p"].dataType

    def between(a: Row, b: Row) -> DataFrame:
        ends = df.sparkSession.createDataFrame([(a["low"], b["high"])], T.StructType(
            [T.StructField("low", kinds), T.StructField("high", kinds)]))
        low, high = (ends.select(c).scalar() for c in ("low", "high"))
        return df.where((place >= low) & (place <= high))

    whole = [run for run, low, high in parts if (low, high) == (0, run["n"])]
    pieces = [between(whole[0], whole[-1])] if whole else []
    for run, low, high in parts:
        if (low, high) != (0, run["n"]):
            pieces.append(between(run, run).orderBy(*order).offset(low).limit(high - low))
    return reduce(DataFrame.unionByName, pieces) if pieces else df.limit(0)


def page_after(df: DataFrame, key: str, last: object, size: int) -> DataFrame:
    """Page by unique key: cost does not grow with the depth of the page."""
    return df.where(F.col(key) > F.lit(last)).orderBy(key).limit(size)


def search_by_exchange(instruments: DataFrame, exchange: str, security_type: str | None = None,
                       expires_from: dt.date | None = None, created_from: dt.date | None = None,
                       n: int | None = None) -> DataFrame:
    keep: Column = F.col("exchange_code") == exchange
    if security_type is not None:
        keep = keep & (F.col("security_type") == security_type)
    if expires_from is not None:
        keep = keep & (F.to_date(parse_datetime(F.col("expiration_date"))) >= F.lit(expires_from))
    if created_from is not None:
        keep = keep & (F.to_date(parse_datetime(F.col("datecreated"))) >= F.lit(created_from))
    found = instruments.where(keep)
    return found if n is None else found.orderBy("symbol").limit(n)


def instrument_list(instruments: DataFrame, exchange: str | None = None,
                    option_root: str | None = None,
                    symbols: str | Sequence[str] | None = None) -> DataFrame:
    if exchange is not None:
        instruments = instruments.where(F.col("exchange_code") == exchange)
    if option_root is not None:
        instruments = instruments.where(F.col("option_root") == option_root)
    return instruments if symbols is None else for_symbols(instruments, symbols)


def symbol_coverage(prices: DataFrame, time: str = "tradedatetimeutc") -> DataFrame:
    """First and last time and number of records per symbol."""
    return prices.groupBy("symbol").agg(
        F.min(time).alias("first_time"), F.max(time).alias("last_time"),
        F.count("*").alias("records"),
    )


def symbol_versions(prices: DataFrame, ondate: dt.date | None = None,
                    time: str = "tradedatetimeutc") -> DataFrame:
    """Distinct versions of each symbol known on a date, one row each."""
    return between(prices, time, end=ondate).where(F.col("version").isNotNull()).select(
        "symbol", "version"
    ).distinct()
