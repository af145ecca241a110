"""Exact places of rows in an order, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

_IN_TASK = (1 << 33) - 1


def in_order(rows: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """The rows dealt by sampled ranges of (group, keys) and sorted, with the task (``_run``) and the place
    in it (``_at``); to be written before anything is made of those."""
    return (rows.repartitionByRange(group, *keys).sortWithinPartitions(group, *keys)
            .withColumn("_run", F.spark_partition_id())
            .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(_IN_TASK)))


def starts(stored: DataFrame, group: str, total: str = "total") -> DataFrame:
    """``(group, _run, _shift, total)``: what to add to ``_at`` for a gapless place within the group. A row for
    each group that a task holds: at most as many as there are tasks and groups together."""
    runs = stored.groupBy(group, "_run").agg(F.count("*").alias(total), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)
    upto = whole.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select(group, "_run", (F.coalesce(F.sum(total).over(upto), F.lit(0)) - F.col("_first")).alias("_shift"),
                       F.sum(total).over(whole).alias(total))


def placed(rows: DataFrame, group: str, keys: list[str], place: str = "place", total: str = "total") -> DataFrame:
    """The rows with ``place``, gapless from 0 within their group by ``keys``, and ``total``, the group's
    rows; stored in the shared folder.

    One exchange: a hot group is spread over many tasks. Only the number of rows a group has in a task is
    summed further. ``group`` holds no nulls; null keys come first. Rows equal in all keys have places in any
    order, and meet in one task: end the keys with a column that tells copies apart where there may be very
    many.
    """
    stored = written(in_order(rows, group, keys), "placed")
    return (stored.join(starts(stored, group, total), [group, "_run"]).withColumn(place, F.col("_at") + F.col("_shift"))
            .select(*rows.columns, place, total))
