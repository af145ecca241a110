"""Incremental ingest with the batch job inside foreachBatch (rows T-1 to T-3, T-6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ingest import first_by_key, first_unseen
from tidemark.plans.jobs import LANDED, TableRules, keyed, run_ingest, run_landing, with_partition
from tidemark.sources.landing import CORRUPT, csv_options, split_corrupt
from tidemark.schemas import text_schema
from tidemark.sources.store import Store, partition_names


def _each(stream: DataFrame, checkpoint: str, one_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landed_stream(spark: SparkSession, path: str, columns: list[str],
                  files_per_trigger: int = 1000) -> DataFrame:
    """Landed CSV files as a stream of text rows with the file they came from and, where a row did not
    parse, its raw text; ``ingest_stream`` puts that into the quarantine."""
    return (
        spark.readStream.options(**csv_options())
        .option("maxFilesPerTrigger", files_per_trigger)
        .schema(text_schema(columns, CORRUPT))
        .csv(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def ingest_stream(stream: DataFrame, rules: TableRules, name: str, store: Store, checkpoint: str,
                  run_ts: dt.datetime, order: list[str] | None = None) -> StreamingQuery:
    """Run the batch ingest on every micro-batch of what has landed, then stop.

    A micro-batch is one run of the store: one that was committed before is skipped, one that failed
    halfway has left nothing behind and is run again.
    """
    def one_batch(batch: DataFrame, batch_id: int) -> None:
        rows, refused = batch, []
        if CORRUPT in batch.columns:
            rows, malformed = split_corrupt(batch)
            refused = [malformed.select("reason", "content")]
        run_ingest(batch.sparkSession, rows, rules, store, f"{name}-{batch_id}", run_ts, order, refused=refused)

    return _each(stream, checkpoint, one_batch)


#: What Spark's reader of whole files gives; the content is not read where it is not selected.
FILES = "path string, modificationTime timestamp, length long, content binary"


def landing_stream(spark: SparkSession, path: str, columns: list[str], rules: TableRules, name: str,
                   store: Store, checkpoint: str, run_ts: dt.datetime,
                   key_column: str | None = None, key_pattern: str | None = None,
                   order: list[str] | None = None, files_per_trigger: int = 1000) -> StreamingQuery:
    """Run the landing job on the files of every micro-batch.

    The stream only tells which files are new, at most ``files_per_trigger`` names at a time; they are
    then read as the batch job reads them, so error answers and malformed rows reach the quarantine.
    """
    files = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", files_per_trigger).load(path)
    named = files.select(F.col("_metadata.file_path").alias("source_file"))

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        new = sorted(r.source_file for r in batch.distinct().collect())
        run_landing(batch.sparkSession, new, columns, rules, store, f"{name}-{batch_id}", run_ts, key_column, key_pattern, order)

    return _each(named, checkpoint, one_batch)


def distinct_stream(stream: DataFrame, rules: TableRules, event_time: str | None = None,
                    delay: str | None = None) -> DataFrame:
    """Keyed good rows with repeats of a key dropped.

    Without a watermark the state holds every key ever seen. With one, a key is remembered for the
    delay only: right where repeats arrive within it. ``distinct_to_store`` needs neither.
    """
    good = keyed(stream, rules).where(F.col("reason").isNull()).drop("reason", LANDED)
    if event_time and delay:
        return good.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([rules.key])
    return good.dropDuplicates([rules.key])


def distinct_to_store(stream: DataFrame, rules: TableRules, store: Store, checkpoint: str,
                      order: Sequence[str] | None = None) -> StreamingQuery:
    """Keyed good rows into the store, each key once, however late a repeat arrives.

    The stream keeps no state: a micro-batch is reduced to one row a key and anti-joined with the stored
    keys of the partitions that it has rows in, since a key fixes its partition. Its rows are the newest
    version's, or none are: a batch that runs again adds nothing. Without ``order`` the smallest content of a
    key's rows in a micro-batch is taken.
    """
    good = keyed(stream, rules).where(F.col("reason").isNull()).drop("reason", LANDED)

    def one_batch(batch: DataFrame, _: int) -> None:
        rows = with_partition(batch, rules)
        change = store.begin(batch.sparkSession)
        names = partition_names(rows, rules.partition) if rules.partition else [""]
        change.hold(rules.table, names)
        stored = change.read(rules.table, rows.schema, names)
        new = first_unseen(rows, stored, rules.key, list(order or [c for c in rows.columns if c != rules.key]))
        change.append(rules.table, new, rules.partition)
        change.commit()

    return _each(good, checkpoint, one_batch)


def corrections_stream(stream: DataFrame, store: Store, table: str, keys: Sequence[str], order: Sequence[str],
                       partition: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest revision per key in a partitioned table, whatever order revisions come in.

    Each micro-batch reads and rewrites only the partitions it has rows in, and is one version of the store.
    ``order`` must be total within a key: then running a batch again changes nothing.
    """
    newest_first = [F.desc(c) for c in order]

    def one_batch(batch: DataFrame, _: int) -> None:
        change = store.begin(batch.sparkSession)
        names = partition_names(batch, partition)
        both = change.read(table, batch.schema, names).unionByName(batch)
        change.replace(table, first_by_key(both, keys, newest_first), partition, names)
        change.commit()

    return _each(stream, checkpoint, one_batch)
