"""Currency and unit conversion (rows J-5, J-6, S-11, S-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.money import major_currency, major_value
from tidemark.session import shared_dir


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str,
               values: Sequence[str], grain: str = "day") -> DataFrame:
    """For each left row the right row in force at its time (same or earlier time), or NULLs.

    A window over the union of both sides would put a key's whole history, left rows included, into
    one task. Instead each key is cut into time segments: the right rows of a segment, plus the one
    in force when it begins, get validity intervals, and left rows meet them in an equi-join on
    (key, segment) with a range condition. The left side is only ever hash-partitioned by
    (key, segment), or stays in place when the planner finds the right side small enough to
    broadcast; a skewed segment is split by AQE. ``right`` has one row per (key, time).
    """
    seg, since, until = "_segment", "_since", "_until"
    l_seg = left.withColumn(seg, F.date_trunc(grain, F.col(time)))
    payload = F.struct(*values)
    points = right.select(
        *keys, F.date_trunc(grain, F.col(time)).alias(seg), F.col(time).alias(since),
        payload.alias("_payload"),
    )
    ends = points.groupBy(*keys, seg).agg(
        F.max_by(F.struct(since, "_payload"), since).alias("_end")
    )
    wanted = l_seg.select(*keys, seg).distinct()
    segments = wanted.withColumn("_wanted", F.lit(True)).join(ends, [*keys, seg], "full")
    before = W.partitionBy(*keys).orderBy(seg).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        segments.withColumn("_end", F.last("_end", ignorenulls=True).over(before))
        .where(F.col("_wanted") & F.col("_end").isNotNull())
        .select(*keys, seg, F.col("_end")[since].alias(since),
                F.col("_end")["_payload"].alias("_payload"))
    )
    following = W.partitionBy(*keys, seg).orderBy(since)
    spans = points.unionByName(carried).withColumn(until, F.lead(since).over(following))
    names = {k: f"_key_{i}" for i, k in enumerate([*keys, seg])}
    spans = spans.withColumnsRenamed(names)
    on = [F.col(k) == F.col(n) for k, n in names.items()]
    on.append(F.col(since) <= F.col(time))
    on.append(F.col(until).isNull() | (F.col(time) < F.col(until)))
    return l_seg.join(spans, on, "left").select(
        *left.columns, *[F.col("_payload")[v].alias(v) for v in values]
    )


def _asked_for(right: DataFrame, left: DataFrame, names: Sequence[str]) -> DataFrame:
    """The right rows that some left row can be in force with, and the last of each key and ten seconds.

    Among the rows of its key and ten seconds, a right row that the next right row follows with no left row
    between is in force for none. Left rows count once for each key and time, so that ten seconds hold no
    more rows than they have moments, on either side. The rows are written to the shared folder: later steps read
    them several times.
    """
    asked = left.select(*names, "_time").where(" and ".join(f"{c} is not null" for c in [*names, "_time"])).distinct()
    marks = (right.withColumn("_side", F.lit(0)).unionByName(asked.withColumn("_side", F.lit(1)), allowMissingColumns=True)
             .withColumn("_block", F.expr("unix_seconds(cast(_time as timestamp)) div 10")))
    following = W.partitionBy("_block", *names).orderBy("_time", "_side")
    needed = marks.withColumn("_next", F.lead("_side", 1, 1).over(following)).where("_side = 0 and _next = 1").select(right.columns)
    path = shared_dir(left.sparkSession, "asked")
    needed.write.parquet(path)
    return left.sparkSession.read.schema(needed.schema).parquet(path)


def as_of_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """What ``as_of_join`` gives, for right sides with very many rows to a key and segment.

    Right rows that no left row can ask for are dropped first, by one sorted pass over the times of each key and
    ten seconds; of a right side far denser than the left one, about as many rows stay as there are left rows.
    Both sides are then cut at common points: one exchange by sampled ranges of (key, time), and rows of one key and
    time are spread further, so that no run is large, however hot a key or a moment is. Inside a run the last
    right row is carried down by one sorted pass; what a run inherits is the last right row of the key's runs
    before it, one row for each key and run. No row ever meets more than one right row. Left rows with a NULL
    key or time keep NULLs; right rows with one are not used.
    """
    names = [f"_key_{i}" for i in range(len(keys))]
    known = right.where(" and ".join(f"`{c}` is not null" for c in [*keys, time]))
    payload = known.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(time).alias("_time"),
                           F.struct(*values).alias("_payload"))
    rows = left.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(time).alias("_time"),
                       F.struct(*left.columns).alias("_row"))
    payload = _asked_for(payload, rows, names)
    both = (payload.withColumn("_side", F.lit(0)).unionByName(rows.withColumn("_side", F.lit(1)), allowMissingColumns=True)
            .withColumn("_copy", F.monotonically_increasing_id()))
    path = shared_dir(left.sparkSession, "merge")
    ranged = both.repartitionByRange(*names, "_time", "_side", "_copy").withColumn("_run", F.spark_partition_id()).drop("_copy")
    ranged.write.parquet(path)
    stored = left.sparkSession.read.schema(ranged.schema).parquet(path)
    ends = stored.where("_side = 0").groupBy(*names, "_run").agg(F.max_by("_payload", "_time").alias("_end"))
    # A run without right rows inherits too; it holds one row of a key here.
    runs = stored.select(*names, "_run").distinct().join(ends, [*names, "_run"], "left")
    before = W.partitionBy(*names).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    carried = runs.select(*names, "_run", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    inside = W.partitionBy(*names, "_run").orderBy("_time", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    held = (stored.join(carried, [*names, "_run"], "left").withColumn("_here", F.last("_payload", ignorenulls=True).over(inside))
            .where("_side = 1").withColumn("_found", F.when(F.col("_time").isNotNull(), F.coalesce("_here", "_carried"))))
    return held.select("_row.*", *[F.col("_found")[v].alias(v) for v in values])


def _with_rate(prices: DataFrame, rates: DataFrame, keys: dict[str, str], time: str, grain: str | None) -> DataFrame:
    """``prices`` with ``rate``: that of the row's major currency and of the rate columns named by
    ``keys`` (rate column to price column), in force at its time. ``grain`` None merges both in time order."""
    major = prices.withColumn("_ccy", major_currency(F.col("currency")))
    quoted = rates.select(F.col("currency").alias("_ccy"), *[F.col(r).alias(c) for r, c in keys.items()],
                          F.col("ts").alias(time), "rate")
    if grain is None:
        return as_of_merge(major, quoted, ["_ccy", *keys.values()], time, ["rate"]).drop("_ccy")
    return as_of_join(major, quoted, ["_ccy", *keys.values()], time, ["rate"], grain).drop("_ccy")


def convert_currency(prices: DataFrame, rates: DataFrame, source: str, value: str = "close",
                     time: str = "tradedatetimeutc", grain: str | None = "day") -> DataFrame:
    """Add ``rate`` and ``converted``: minor units become major, then the rate in force applies.

    ``rates`` gives, per (currency, source, ts), the value of one major unit in the target
    currency. A price without a rate converts to NULL, never to its own value. ``grain`` is the segment in which
    prices and rates meet; None for rates so dense that a segment holds very many.
    """
    joined = _with_rate(prices, rates.where(F.col("source") == source), {}, time, grain)
    return joined.withColumn("converted", major_value(F.col(value), F.col("currency")) * F.col("rate"))


def convert_prices(prices: DataFrame, rates: DataFrame, source: str, target: str,
                   values: Sequence[str], time: str = "tradedatetimeutc", grain: str | None = "day") -> DataFrame:
    """``prices`` with every column of ``values`` and ``currency`` in the target currency.

    ``rates`` names the target of each rate in ``to_currency``: a row is never called by a currency
    that its rate does not lead to.
    """
    if "to_currency" not in rates.columns:
        raise ValueError("rates need a to_currency column")
    led = rates.where((F.col("source") == source) & (F.col("to_currency") == target))
    joined = _with_rate(prices, led, {}, time, grain)
    changed = {v: major_value(F.col(v), F.col("currency")) * F.col("rate") for v in values}
    return joined.withColumns(changed).withColumn("currency", F.lit(target)).select(*prices.columns)


def convert_by_spec(prices: DataFrame, spec: DataFrame, rates: DataFrame, factors: DataFrame,
                    values: Sequence[str], time: str = "tradedatetimeutc", grain: str | None = "day") -> DataFrame:
    """Convert every row as its symbol's spec says: currency by ``to_currency`` and
    ``currency_source``, then unit by ``to_unit`` and ``unit_factor``.

    Rows of symbols without a wish for a currency, or a unit, keep theirs; a wish that no rate or
    factor meets gives NULL. A ``unit_factor`` wins over ``factors (unit, to_unit, factor)``.
    """
    wished = with_conversion_spec(prices, spec)
    rated = _with_rate(wished, rates, {"source": "currency_source", "to_currency": "to_currency"}, time, grain)
    asks = F.col("to_currency").isNotNull()
    rated = rated.withColumns(
        {v: F.when(asks, major_value(F.col(v), F.col("currency")) * F.col("rate")).otherwise(F.col(v)) for v in values}
    ).withColumn("currency", F.coalesce("to_currency", "currency"))
    known = factors.select(F.col("unit").alias("_from"), F.col("to_unit").alias("_to"), "factor")
    measured = rated.join(known, (F.col("unit") == F.col("_from")) & (F.col("to_unit") == F.col("_to")), "left")
    times = F.coalesce("unit_factor", "factor")
    asks = F.col("to_unit").isNotNull()
    return measured.withColumns(
        {v: F.when(asks, F.col(v) * times).otherwise(F.col(v)) for v in values}
    ).withColumn("unit", F.coalesce("to_unit", "unit")).select(*prices.columns)


def convert_units(prices: DataFrame, factors: DataFrame, value: str = "close") -> DataFrame:
    """Add ``factor`` and ``converted`` for the units a row has and wants.

    ``factors`` holds one row per (unit, to_unit). A ``unit_factor`` on the row wins, except 0 which
    counts as unset. Without any factor the result is NULL.
    """
    joined = prices.join(factors.select("unit", "to_unit", "factor"), ["unit", "to_unit"], "left")
    own = F.nullif(F.col("unit_factor"), F.lit(0.0)) if "unit_factor" in prices.columns else None
    factor = F.col("factor") if own is None else F.coalesce(own, F.col("factor"))
    return joined.withColumn("factor", factor).withColumn(
        "converted", F.col(value) * F.col("factor")
    ).select(*prices.columns, "factor", "converted")


def with_conversion_spec(prices: DataFrame, spec: DataFrame) -> DataFrame:
    """Attach each symbol's wanted currency, source, unit and factor; empty text and 0 are unset."""
    clean = spec.select(
        "symbol",
        *[F.nullif(F.col(c), F.lit("")).alias(c)
          for c in ("to_currency", "currency_source", "to_unit")],
        F.nullif(F.col("unit_factor"), F.lit(0.0)).alias("unit_factor"),
    )
    return prices.join(clean, "symbol", "left")
