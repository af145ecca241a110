"""The two ingest jobs: landed rows to history tables (rows I-12 to I-17, A-4 to A-7, J-1, J-2).

One run reads the landing once: cleaning, keys and checks are one projection, written to a staging
table split by whether a row is storable. The staging table fixes the arrival order used by the
de-duplication, feeds both outputs without a second parse, and cuts the lineage: a lost executor
costs its tasks, not the landing scan. The good part is reduced to one row per key, anti-joined with
the stored keys of the same partitions, and appended.

A run's rows, what it set aside and its totals become visible by one commit of the store: a run that dies
anywhere leaves nothing behind, and running the same batch again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import keys
from tidemark.operators import conform, ingest
from tidemark.session import shared_dir
from tidemark.operators.mutate import remove_folder
from tidemark.sources import landing
from tidemark.sources.store import Store, partition_names

AUDIT_TABLE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("skipped", T.LongType()),
        T.StructField("failed", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)


LANDED = "_landed"  # the row's own text, kept for the quarantine


@dataclass(frozen=True)
class TableRules:
    """What differs between the two history tables."""

    table: str
    key: str
    schema: T.StructType
    partition: str | None
    time: str | None  # the time that a key fixes, to the second
    clean: Callable[[DataFrame], DataFrame]
    make_key: Callable[[DataFrame], Column]
    reject_reason: Callable[[DataFrame], Column]
    audit: Callable[[DataFrame, dt.datetime], DataFrame]


def _with_month(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("trade_month", T.DateType())])


PRICES = TableRules(
    table="prices",
    key="price_hash",
    schema=_with_month(schemas.PRICE_TABLE),
    partition="trade_month",
    time="tradedatetimeutc",
    clean=conform.clean_prices,
    make_key=lambda df: keys.price_hash(df, spare=False),
    reject_reason=ingest.price_reject_reason,
    audit=conform.with_price_audit,
)


def price_rules(data_source: str) -> TableRules:
    """The rules of the price table for rows of another data source."""
    return replace(PRICES, audit=lambda df, run_ts: conform.with_price_audit(df, run_ts, data_source))


INSTRUMENTS = TableRules(
    table="instruments",
    key="instrument_hash",
    schema=schemas.INSTRUMENT_TABLE,
    partition=None,
    time=None,
    clean=conform.clean_instruments,
    make_key=keys.instrument_hash,
    reject_reason=ingest.instrument_reject_reason,
    audit=conform.with_instrument_audit,
)


def keyed(landed: DataFrame, rules: TableRules) -> DataFrame:
    """Cleaned rows with their key and, when they cannot be stored, the reason and the row as landed."""
    cleaned = rules.clean(landed.withColumn(LANDED, F.struct(*landed.columns)))
    with_key = cleaned.withColumn(rules.key, rules.make_key(cleaned.drop(LANDED)))
    marked = with_key.withColumn("reason", rules.reject_reason(with_key.drop(LANDED)))
    raw = F.to_json(F.col(LANDED), {"ignoreNullFields": "false"})
    return marked.withColumn(LANDED, F.when(F.col("reason").isNotNull(), raw))


def with_partition(rows: DataFrame, rules: TableRules) -> DataFrame:
    """Keyed rows with the column their table is partitioned by, if it is."""
    if rules.partition == "trade_month":
        return rows.withColumn("trade_month", F.to_date(F.date_trunc("month", "tradedatetimeutc")))
    return rows


MOST_RANGES = 8


def near_in_time(stored: DataFrame, rows: DataFrame, rules: TableRules) -> DataFrame:
    """Stored rows that can hold a key of ``rows``: those within the times of each partition's rows.

    One row a partition reaches the driver, and the ranges become a filter on the time alone, which the
    Parquet scan meets with the statistics of files and row groups: of a month that was stored day by day, a
    day's rows read that day's files. At most ``MOST_RANGES`` reach the scan, which tests every row by them:
    beyond, the nearest ones are joined.
    """
    if rules.time is None or rules.partition is None:
        return stored
    spans = rows.groupBy(rules.partition).agg(F.min(rules.time).alias("low"), F.max(rules.time).alias("high")).collect()
    second = dt.timedelta(seconds=1)
    known = sorted((r.low - second, r.high + second) for r in spans if r.low is not None)
    gaps = sorted(range(1, len(known)), key=lambda i: known[i][0] - known[i - 1][1], reverse=True)
    starts = sorted([0, *gaps[:MOST_RANGES - 1]]) if known else []
    ends = [*starts[1:], len(known)]
    ranges = [F.col(rules.time).between(F.lit(known[a][0]), F.lit(max(high for _, high in known[a:b]))) for a, b in zip(starts, ends)]
    return stored.where(reduce(lambda a, b: a | b, ranges)) if ranges else stored


def storable(rows: DataFrame, stored: DataFrame, rules: TableRules, order: list[str],
             run_ts: dt.datetime) -> DataFrame:
    """From keyed good rows to the rows to append: first per key, unseen, audited, conformed."""
    return as_stored(new_rows(rows, stored, rules, order), rules, run_ts)


def new_rows(rows: DataFrame, stored: DataFrame, rules: TableRules, order: list[str]) -> DataFrame:
    """First per key, unseen: the columns that the table keeps, without those that ``as_stored`` makes."""
    new = with_partition(ingest.first_unseen(rows, stored, rules.key, order), rules)
    return new.select(*[c for c in new.columns if c in rules.schema.names and c != rules.key])


def as_stored(rows: DataFrame, rules: TableRules, run_ts: dt.datetime) -> DataFrame:
    """New rows with their key, audited and conformed; the key is made again, which is less than to move it."""
    return conform.conform(rules.audit(rows.withColumn(rules.key, rules.make_key(rows)), run_ts), rules.schema)


QUARANTINE, AUDIT = "quarantine", "audit"


def run_ingest(spark: SparkSession, landed: DataFrame, rules: TableRules, store: Store, run_id: str,
               run_ts: dt.datetime, order: list[str] | None = None, reason: str | None = None,
               refused: Sequence[DataFrame] = ()) -> dict[str, int]:
    """One batch run; returns the totals it also records in the audit table.

    ``order`` names the columns that say which duplicate arrived first; without it the position in
    the landing is used, fixed when the staging table is written. ``refused``, (reason, content) rows that
    never became landed rows, go to the quarantine with the others. A run id that was committed before is
    not run again: its recorded totals are returned.
    """
    change = store.begin(spark, run_id)
    before = change.read(AUDIT, AUDIT_TABLE).where(F.col("run_id") == run_id).first()
    if before is not None:
        return {n: before[n] for n in ("inserted", "skipped", "failed")}
    staged_path = shared_dir(spark, "staged")
    seen = Observation()
    staging = (
        keyed(landed, rules)
        .withColumn("arrival", F.monotonically_increasing_id())
        .withColumn("rejected", F.col("reason").isNotNull())
        .observe(seen, F.count("*").alias("rows"),
                 F.count(F.when(F.col("reason").isNotNull(), 1)).alias("failed"))
    )
    # The key, which nothing can press, is not stored: it is made again from what it was made of.
    staging = staging.drop(rules.key)
    staging.write.option("compression", "zstd").partitionBy("rejected").parquet(staged_path)
    counts = seen.get
    staged = spark.read.schema(staging.schema).parquet(staged_path)

    good = staged.where(~F.col("rejected")).drop("reason", "rejected", LANDED)
    good = good.withColumn(rules.key, rules.make_key(good.drop("arrival")))
    touched = partition_names(with_partition(good, rules), rules.partition) if rules.partition else [""]
    change.hold(rules.table, touched)
    added = Observation()
    stored = near_in_time(change.read(rules.table, rules.schema, touched), with_partition(good, rules), rules)
    new = new_rows(good, stored, rules, order or ["arrival"])
    change.append(rules.table, new, rules.partition, added, lambda rows: as_stored(rows, rules, run_ts))
    bad = [staged.where(F.col("rejected")).select("reason", F.col(LANDED).alias("content"))] if counts["failed"] else []
    for rows in [*bad, *refused]:
        change.append(QUARANTINE, rows.select(F.lit(run_id).alias("run_id"), "reason", "content"))
    inserted = added.get["inserted"]
    totals = {
        "inserted": inserted,
        "skipped": counts["rows"] - counts["failed"] - inserted,
        "failed": counts["failed"],
    }
    finished = dt.datetime.now(dt.timezone.utc)
    change.append(AUDIT, spark.createDataFrame(
        [(run_id, run_ts, finished, *totals.values(), reason)], AUDIT_TABLE).coalesce(1))
    change.commit()
    remove_folder(spark, staged_path)
    return totals


def run_landing(spark: SparkSession, path: str | list[str], columns: list[str], rules: TableRules,
                store: Store, run_id: str, run_ts: dt.datetime, key_column: str | None = None,
                key_pattern: str | None = None, order: list[str] | None = None) -> dict[str, int]:
    """Landed files to the table in one call.

    Files that hold an error answer, or have another header, are left out as a whole; they and the rows that
    do not parse go to the quarantine with the run's id. The driver sees no list of files. An absent or
    empty key column is taken from the file's path. Then the rows are ingested; without ``order`` the
    first duplicate is the one of the smallest file name, then of the smallest content.
    """
    refused = landing.refused_files(spark, path, columns)
    rows, malformed = landing.landed_rows(spark, path, columns, refused)
    aside = [refused.select("reason", F.col("source_file").alias("content")), malformed.select("reason", "content")]
    if key_column is not None and key_pattern is not None:
        rows = landing.default_key_column(rows, key_column, key_pattern)
    return run_ingest(spark, rows, rules, store, run_id, run_ts,
                      order or ["source_file", *[c for c in rows.columns if c != "source_file"]], refused=aside)


def already_ran(spark: SparkSession, store: Store, run_id: str) -> bool:
    return not store.read(spark, AUDIT, AUDIT_TABLE).where(F.col("run_id") == run_id).isEmpty()
