"""Streams fed in several micro-batches give what the batch operators give."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.raw import RAW_COLUMNS, raw_prices
from tidemark.operators import bars, filters
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import sinks, views
from tidemark.sources.store import Store
from tidemark.streaming import aggregates, ingest

RUN_TS = dt.datetime(2024, 6, 3, tzinfo=dt.timezone.utc)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_ingest_in_batches_equals_one_run(spark, sf_dir):
    root = shared_dir(spark, "t-ingest")
    sinks.write_csv(raw_prices(spark, sf_dir).repartition(3, "ord"), f"{root}/landing")
    stream = ingest.landed_stream(spark, f"{root}/landing", RAW_COLUMNS, files_per_trigger=1)
    stores = Store(f"{root}/t"), Store(f"{root}/t1")
    ingest.ingest_stream(stream, jobs.PRICES, "s", stores[0], f"{root}/c", RUN_TS).awaitTermination()
    jobs.run_ingest(spark, raw_prices(spark, sf_dir), jobs.PRICES, stores[1], "once", RUN_TS)
    audit = stores[0].read(spark, "audit")
    assert audit.count() == 3
    once = stores[1].read(spark, "audit").first()
    sums = audit.agg(*[F.sum(c).alias(c) for c in ("inserted", "skipped", "failed")]).first()
    assert (sums.inserted, sums.skipped, sums.failed) == (once.inserted, once.skipped, once.failed)

    def keys(store):
        return {r.price_hash for r in store.read(spark, "prices").select("price_hash").collect()}

    assert keys(stores[0]) == keys(stores[1])


def _tick_files(spark, sf_dir, root, parts):
    ticks = views.ticks(spark, sf_dir).select("symbol", "ts", "last", "volume", "seq")
    # Files in time order: a stream may rightly drop rows later than its watermark.
    for i in range(parts):
        low, high = F.lit(i * 31 / parts + 1), F.lit((i + 1) * 31 / parts + 1)
        ticks.where((F.dayofmonth("ts") >= low) & (F.dayofmonth("ts") < high)).coalesce(1) \
            .write.mode("append").parquet(f"{root}/ticks")
    stream = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/ticks")
    return ticks, stream


def test_bars_and_quotes_in_batches(spark, sf_dir):
    root = shared_dir(spark, "t-ticks")
    ticks, stream = _tick_files(spark, sf_dir, root, 3)
    complete = aggregates.stream_bars(stream, 60, "1 hour", tie=["seq"])
    aggregates.keep_complete(complete, f"{root}/all", f"{root}/c1").awaitTermination()
    batch = bars.bars(ticks, 60, tie=["seq"])
    assert rows(spark.read.parquet(f"{root}/all")) == rows(batch)

    aggregates.append_to(aggregates.stream_bars(stream, 60, "1 hour", tie=["seq"]), f"{root}/closed",
                         f"{root}/c2").awaitTermination()
    closed = rows(spark.read.parquet(f"{root}/closed"))
    assert set(closed) < set(rows(batch)) and len(closed) > 0.9 * len(rows(batch))

    store = Store(f"{root}/quotes")
    aggregates.stream_quotes(stream, ["last"], store, f"{root}/c3", "ts", ["seq"]).awaitTermination()
    quotes = aggregates.current_quotes(spark, store, ticks.schema, ["last"], "ts", ["seq"])
    assert rows(quotes) == rows(bars.latest_quote(ticks, ["last"], "ts", ["seq"]))


def test_corrections_in_any_order(spark, sf_dir):
    root = shared_dir(spark, "t-corrections")
    revised = views.corrections(spark, sf_dir).select(
        "symbol", "tradedatetimeutc", "lastupdatetime", "close", "ord",
        F.to_date(F.date_trunc("year", "tradedatetimeutc")).alias("trade_month"))
    revised.repartition(3, "ord").write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(revised.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
    ingest.corrections_stream(stream, Store(root), "t", ["symbol", "tradedatetimeutc"],
                              ["lastupdatetime", "ord"], "trade_month", f"{root}/c").awaitTermination()
    expected = filters.latest_revision(revised, ["symbol", "tradedatetimeutc"], ["lastupdatetime", "ord"])
    assert rows(Store(root).read(spark, "t")) == rows(expected)


def test_repeats_within_a_delay(spark):
    root = shared_dir(spark, "t-distinct")
    t = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([("A", t, 1.0), ("a ", t, 2.0), ("B", t, 3.0)],
                               "symbol string, tradedatetimeutc timestamp, close double")
    df.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
    once = ingest.distinct_stream(stream, jobs.PRICES, "tradedatetimeutc", "1 day")
    aggregates.append_to(once, f"{root}/out", f"{root}/c").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 2
