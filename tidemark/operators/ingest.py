"""De-duplication, quarantine, anti-joins, totals (rows A-1 to A-7, A-12, I-17, I-18, J-1 to J-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import schemas

NEW_SYMBOL_DEPTH = 7200
KNOWN_SYMBOL_DEPTH = 30


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key under a stated total order.

    The rank-1 limit is also applied to each map task's rows before the shuffle, so a key that
    fills a third of the table sends one row per task, not its whole group.
    """
    if not order:
        raise ValueError("de-duplication needs an explicit order")
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _too_long(limits: dict[str, int | None], columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for name, limit in limits.items():
        if limit and name in columns:
            out = out | F.coalesce(F.length(name) > limit, F.lit(False))
    return out


def price_reject_reason(df: DataFrame) -> Column:
    """Why a price row cannot be stored, or NULL. With symbol and time set, the key always is."""
    return (
        F.when(F.col("symbol").isNull(), "symbol missing")
        .when(F.col("tradedatetimeutc").isNull(), "trade time missing")
        .when(_too_long(schemas.PRICE_TEXT_LENGTHS, df.columns), "text too long")
    )


def instrument_reject_reason(df: DataFrame) -> Column:
    return F.when(F.col("instrument_hash").isNull(), "key missing").when(
        _too_long(schemas.INSTRUMENT_LENGTHS, df.columns), "text too long"
    )


def quarantine_split(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason)."""
    marked = df.withColumn("reason", reason)
    return (
        marked.where(F.col("reason").isNull()).drop("reason"),
        marked.where(F.col("reason").isNotNull()),
    )


def unseen(new: DataFrame, stored: DataFrame, key: str, partition: str | None = None) -> DataFrame:
    """Rows of ``new`` whose key the stored table lacks; the planner picks the join by size.

    A key fixes its ``partition``: where one is named, both travel in the join. Hand over only the stored
    partitions that ``new`` has rows in (``Store.read(only=...)``): the others cannot hold its keys.
    """
    both = [key] if partition is None else [partition, key]
    return new.join(stored.where(F.col(key).isNotNull()).select(*both), both, "left_anti")


PACKED = "_packed"


def packed_key(key: str) -> Column:
    """A key in as few bytes as tell it from every other: 64 hex digits, as the business keys are, in 32; other
    texts as they are, with 33 bytes behind them, so that none is taken for a packed one."""
    binary = F.unhex(key)
    return F.when(F.lower(F.hex(binary)).eqNullSafe(F.col(key)) & (F.octet_length(binary) == 32), binary).otherwise(
        F.concat(F.encode(key, "UTF-8"), F.lit(bytes(33))))


def unpacked_key(packed: Column) -> Column:
    text = F.decode(F.substring(packed, F.lit(1), F.octet_length(packed) - 33), "UTF-8")
    return F.when(F.octet_length(packed) == 32, F.lower(F.hex(packed))).otherwise(text)


def first_unseen(rows: DataFrame, stored: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key that the stored table lacks: ``first_by_key``, then ``unseen``, in one shuffle.

    Keys travel packed, and the anti-join meets the rows where the de-duplication has put them.
    """
    by = [c for c in order if not (isinstance(c, str) and c == key)]
    once = first_by_key(rows.withColumn(PACKED, packed_key(key)).drop(key), [PACKED], by or [PACKED] if order else [])
    known = stored.where(F.col(key).isNotNull()).select(packed_key(key).alias(PACKED))
    new = once.join(known, PACKED, "left_anti").withColumn(key, unpacked_key(F.col(PACKED)))
    return new.select(*rows.columns)


def new_symbols(instruments: DataFrame, prices: DataFrame) -> DataFrame:
    return _listed(instruments).join(_priced(prices), "symbol", "left_anti")


def known_symbols(instruments: DataFrame, prices: DataFrame) -> DataFrame:
    return _listed(instruments).join(_priced(prices), "symbol", "left_semi")


def _listed(instruments: DataFrame) -> DataFrame:
    return instruments.where(F.col("symbol").isNotNull() & (F.col("symbol") != "")).select(
        "symbol"
    ).distinct()


def _priced(prices: DataFrame) -> DataFrame:
    return prices.where(F.col("symbol").isNotNull()).select("symbol").distinct()


def fetch_plan(instruments: DataFrame, prices: DataFrame, new_depth: int = NEW_SYMBOL_DEPTH,
               known_depth: int = KNOWN_SYMBOL_DEPTH) -> DataFrame:
    """How many records to request per symbol: deep for new symbols, shallow for known ones."""
    joined = _listed(instruments).join(
        _priced(prices).withColumn("known", F.lit(True)), "symbol", "left"
    )
    return joined.select(
        "symbol",
        F.when(F.col("known"), "existing").otherwise("new").alias("symbol_type"),
        F.when(F.col("known"), known_depth).otherwise(new_depth).alias("recordsback"),
    )


def symbol_type_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("symbol_type").agg(F.count("*").alias("symbols"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def failures_by_source(quarantine: DataFrame, top: int = 10) -> DataFrame:
    return (
        quarantine.groupBy("source").agg(F.count("*").alias("failures"))
        .orderBy(F.desc("failures"), "source").limit(top)
    )


def run_totals(status: DataFrame) -> DataFrame:
    """Inserted, skipped and failed rows, and how many sources did or did not deliver any row.

    ``status`` has a ``source`` and an ``outcome`` (inserted, skipped, failed). Rows are first
    summed per source, so the final sum is over sources, not rows.
    """
    def rows(outcome: str) -> Column:
        return F.count(F.when(F.col("outcome") == outcome, 1))

    per_source = status.groupBy("source").agg(
        rows("inserted").alias("inserted"), rows("skipped").alias("skipped"),
        rows("failed").alias("failed"),
    )
    delivered = (F.col("inserted") + F.col("skipped")) > 0
    return per_source.agg(
        F.sum("inserted").alias("inserted"),
        F.sum("skipped").alias("skipped"),
        F.sum("failed").alias("failed"),
        F.count(F.when(delivered, 1)).alias("processed_sources"),
        F.count(F.when(~delivered, 1)).alias("failed_sources"),
    )


def insert_rate(audit: DataFrame) -> DataFrame:
    """Records per second of each run; NULL when no time passed."""
    seconds = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1000000
    return audit.withColumn(
        "rate", F.when(seconds > 0, F.col("inserted") / F.nullif(seconds, F.lit(0.0)))
    )
