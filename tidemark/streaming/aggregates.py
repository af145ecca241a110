"""Bars and latest quotes over a tick stream (rows T-4, T-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.bars import bars, latest_quote, moment, ohlcv
from tidemark.operators.ingest import first_by_key
from tidemark.sources.store import Store, partition_names


def stream_bars(ticks: DataFrame, minutes: int, delay: str, price: str = "last", time: str = "ts",
                volume: str = "volume", tie: Sequence[str] = ()) -> DataFrame:
    """Bars over a stream; append mode emits a bar once the watermark has passed its end.

    Watermarks need a zoned timestamp: cast TIMESTAMP_NTZ columns first.
    """
    window = F.window(time, f"{minutes} minutes")
    return (
        ticks.withColumn("_at", moment(ticks, time, tie))
        .withWatermark(time, delay)
        .groupBy("symbol", window.alias("window"))
        .agg(*ohlcv(price, volume))
        .withColumn("bar", F.col("window.start")).drop("window")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def keep_complete(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rewrite the whole result on every trigger; for small results such as closed reports."""
    def one_batch(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (
        stream.writeStream.outputMode("complete").foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


TICKS, BARS = "ticks", "bars"


def stream_corrected_bars(ticks: DataFrame, store: Store, checkpoint: str, minutes: int, order: Sequence[str],
                          price: str = "last", time: str = "ts", volume: str = "volume", tie: Sequence[str] = ()) -> StreamingQuery:
    """Bars that follow corrections however late they come: those of a closed bar replace it.

    A row is a revision of its symbol, time and ``tie``; the newest by ``order`` counts, whatever order revisions
    come in. Both tables of the store, the revisions that count and the bars, are cut by the day of the bar. A
    micro-batch rewrites the days it has rows in, ticks and bars in one version, and no other; the stream keeps
    no state. Rows without a time belong to no bar and are dropped.
    """
    if not isinstance(minutes, int) or minutes <= 0:
        raise ValueError("the bar interval is a positive number of minutes")
    span, newest = minutes * 60, [F.desc(c) for c in order]

    def one_batch(batch: DataFrame, _: int) -> None:
        start = F.timestamp_seconds(F.expr(f"(unix_seconds({time}) - pmod(unix_seconds({time}), {span}))"))
        rows = batch.where(F.col(time).isNotNull()).withColumn("day", F.to_date(start))
        change = store.begin(batch.sparkSession)
        names = partition_names(rows, "day")
        both = change.read(TICKS, rows.schema, names).unionByName(rows)
        kept = change.replace(TICKS, first_by_key(both, ["symbol", time, *tie], newest), "day", names)
        made = bars(kept, minutes, price, time, volume, tie).withColumn("day", F.to_date("bar"))
        change.replace(BARS, made, "day", names)
        change.commit()

    return (
        ticks.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


QUOTES, QUOTE_LOG = "quotes", "quote_log"


def stream_quotes(ticks: DataFrame, fields: Sequence[str], store: Store, checkpoint: str,
                  time: str = "ts", tie: Sequence[str] = ()) -> StreamingQuery:
    """Newest row per symbol, as a snapshot and a log of the symbols that changed since.

    Each trigger appends its changed symbols to the log. Once the log holds as many rows as the snapshot,
    both are merged into the next snapshot and the log starts anew, in the same version: a read scans at most
    twice the symbols and one trigger's, and a symbol is rewritten once for each row that was logged. A batch
    that runs again adds rows that tie with their own copies.
    """
    quotes = latest_quote(ticks, [*fields, *tie], time, tie)

    def one_batch(batch: DataFrame, _: int) -> None:
        change = store.begin(batch.sparkSession)
        old, log = (change.read(t, batch.schema) for t in (QUOTES, QUOTE_LOG))
        batch.persist()
        if log.count() + batch.count() >= old.count():
            both = old.unionByName(log).unionByName(batch)
            change.replace(QUOTES, latest_quote(both, [*fields, *tie], time, tie), None, [""])
            change.replace(QUOTE_LOG, batch.limit(0), None, [""])
        else:
            change.append(QUOTE_LOG, batch)
        change.commit()
        batch.unpersist()

    return (
        quotes.writeStream.outputMode("update").foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current_quotes(spark: SparkSession, store: Store, schema: T.StructType, fields: Sequence[str],
                   time: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    state = store.state(spark)
    shape = T.StructType([schema[c] for c in dict.fromkeys(["symbol", time, *fields, *tie])])
    both = [store.read_state(spark, state, t, shape) for t in (QUOTES, QUOTE_LOG)]
    return latest_quote(both[0].unionByName(both[1]), fields, time, tie)
