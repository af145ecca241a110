"""Row-to-row calculations over long histories without one task per symbol.

A plain ``lag`` or running sum partitioned by symbol puts a symbol's whole history into one task.
Here each symbol is cut into segments that follow each other in time. Windows run inside a segment;
what a segment must know of the past (its last row, its sum) is one aggregated row per segment,
carried forward by a window over those few rows and joined back. A hot symbol thus spreads over as
many tasks as it has segments, and the window and the join share the (symbol, segment) partitioning.

Segments are calendar units by default (``grain``), which costs nothing to find. Where one unit of
one symbol may still be too much for a task, ``balanced_segments`` cuts by row count instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.bars import moment
from tidemark.session import shared_dir

SEGMENT = "_segment"


def balanced_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      partitions: int) -> DataFrame:
    """Rows with a ``_segment`` number: contiguous runs of the total order, of about equal size.

    Range partitioning samples the order to find its cuts; the cuts only decide where a run ends,
    so no result depends on them. The numbered rows are written to the shared folder, which makes
    every later reading of them agree and cuts their lineage.
    """
    path = shared_dir(df.sparkSession, "segments")
    late = [F.col(c).asc_nulls_last() for c in order]
    (
        df.repartitionByRange(partitions, *keys, *late)
        .withColumn(SEGMENT, F.spark_partition_id())
        .write.parquet(path)
    )
    schema = T.StructType([*df.schema.fields, T.StructField(SEGMENT, T.IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def history_columns(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    lagged: dict[str, str] | None = None,
    running: dict[str, str] | None = None,
    latest: dict[str, Sequence[str]] | None = None,
    grain: str = "month",
) -> DataFrame:
    """Add previous-row, running-sum and last-known columns per key.

    ``lagged`` and ``running`` map an output name to an input column. ``latest`` maps an output
    name to the columns of a struct whose first column decides whether the row counts (not NULL).
    ``order`` must be a total order within a key and begin with ``time``. Every row stays: those of a NULL key
    are one history of their own, and rows of a NULL time come after all others of their key. A frame that comes from ``balanced_segments`` brings its segments, and ``grain`` is not used.
    """
    lagged, running, latest = lagged or {}, running or {}, latest or {}
    kinds = dict(df.dtypes)
    # Joins and windows share plain key columns that are never NULL, and with them one exchange.
    hidden = {f"_key_{i}": F.coalesce(F.concat(F.lit("="), k), F.lit("")) if kinds[k] == "string" else F.struct(k) for i, k in enumerate(keys)}
    own, keys = [c for c in df.columns if c != SEGMENT], list(hidden)
    last = F.lit("9999-12-31").cast(kinds[time])
    marked = df.withColumns(hidden | {"_time": F.coalesce(F.col(time), last)})
    order = ["_time", *order[1:]]
    if SEGMENT not in df.columns:
        marked = marked.withColumn(SEGMENT, F.date_trunc(grain, "_time"))
    marked = marked.withColumn("_at", moment(marked, order[0], order[1:]))

    def packed(columns: Sequence[str]) -> Column:
        return F.struct(*[F.col(c) for c in columns])

    # One max_by per column, not one over a struct: plain types keep the hash aggregation.
    previous = list(dict.fromkeys(lagged.values()))
    summary = [F.max_by(c, "_at").alias(f"_end_{c}") for c in previous]
    summary += [F.sum(column).alias(f"_sum_{name}") for name, column in running.items()]
    for name, columns in latest.items():
        at_known = F.when(F.col(columns[0]).isNotNull(), F.col("_at"))
        summary += [F.max_by(c, at_known).alias(f"_last_{name}_{c}") for c in columns]
    ends = marked.groupBy(*keys, SEGMENT).agg(*summary)

    by_key = W.partitionBy(*keys).orderBy(SEGMENT)
    before = by_key.rowsBetween(W.unboundedPreceding, -1)
    carried = [F.col(k) for k in [*keys, SEGMENT]]
    carried += [F.lag(f"_end_{c}").over(by_key).alias(f"_end_{c}") for c in previous]
    carried += [F.sum(f"_sum_{n}").over(before).alias(f"_sum_{n}") for n in running]
    for name, columns in latest.items():
        known = F.struct(*[F.col(f"_last_{name}_{c}").alias(c) for c in columns])
        at_known = F.when(F.col(f"_last_{name}_{columns[0]}").isNotNull(), known)
        carried.append(F.last(at_known, ignorenulls=True).over(before).alias(f"_last_{name}"))
    joined = marked.join(ends.select(*carried), [*keys, SEGMENT])

    inside = W.partitionBy(*keys, SEGMENT).orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    out = {}
    if previous:
        out["_prev"] = F.lag(packed(previous)).over(inside)
    for name, column in running.items():
        # Nothing summed yet is NULL, as for a plain running sum.
        here = F.sum(column).over(upto)
        out[name] = F.coalesce(F.col(f"_sum_{name}") + here, here, F.col(f"_sum_{name}"))
    for name, columns in latest.items():
        here = F.last(F.when(F.col(columns[0]).isNotNull(), packed(columns)), ignorenulls=True)
        out[name] = F.coalesce(here.over(upto), F.col(f"_last_{name}"))
    result = joined.withColumns(out).withColumns(
        {name: F.when(F.col("_prev").isNull(), F.col(f"_end_{column}"))
         .otherwise(F.col("_prev")[column]) for name, column in lagged.items()}
    )
    return result.select(*own, *lagged, *running, *latest)
