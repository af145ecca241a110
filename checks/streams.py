"""The ingest and aggregations as streams over the given tables, run until no input is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from checks.history import BAR_SQL
from checks.ingest import GOOD, RUN_TS
from checks.raw import CLEAN_SQL, RAW_COLUMNS, raw_prices
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import sinks, views
from tidemark.sources.store import Store
from tidemark.streaming import aggregates, ingest


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a file stream."""
    schema = views.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(
        sf_dir)


def _tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_stream(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", F.col("value").alias("last"),
        F.lit(1).alias("volume"), F.col("event_id").alias("seq"), "user_id")


def _files(rows: DataFrame, batches: int) -> int:
    """How many files of one task's size a micro-batch has, where the rows are landed for so many."""
    return -(-rows.rdd.getNumPartitions() // batches)


def _at_least(rows: DataFrame, files: int) -> DataFrame:
    """The rows as they are read, where that makes as many files; a larger table is not moved to be landed."""
    return rows if rows.rdd.getNumPartitions() >= files else rows.repartition(files)


def _run_ingest(spark: SparkSession, root: str, landing: str, name: str, files: int) -> None:
    stream = ingest.landed_stream(spark, landing, RAW_COLUMNS, files_per_trigger=files)
    ingest.ingest_stream(stream, jobs.PRICES, name, Store(root), f"{root}/checkpoint-{name}", RUN_TS).awaitTermination()


@check("stream_price_ingest", f"""
    WITH clean AS ({CLEAN_SQL}), {GOOD}
    SELECT upper(trim(symbol, ' ' || chr(9))) AS symbol, count(DISTINCT price_hash) AS stored,
           min(tradedatetimeutc) AS first_time, max(tradedatetimeutc) AS last_time FROM good GROUP BY 1""")
def stream_price_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items landed as CSV files and streamed into the table; stored rows per symbol."""
    root = shared_dir(spark, "stream-ingest")
    raw = raw_prices(spark, sf_dir)
    files = max(2, _files(raw, 2))
    sinks.write_csv(_at_least(raw, 4), f"{root}/landing")
    _run_ingest(spark, root, f"{root}/landing", "prices", files)
    return Store(root).read(spark, "prices").groupBy(
        F.upper(F.btrim("symbol", F.lit(" \t"))).alias("symbol")).agg(
        F.count("*").alias("stored"), F.min("tradedatetimeutc").alias("first_time"), F.max("tradedatetimeutc").alias("last_time"))


@check("stream_replay", f"""
    WITH clean AS ({CLEAN_SQL}), {GOOD},
    n AS (SELECT (SELECT count(*) FROM clean) AS total, (SELECT count(*) FROM good) AS good,
                 (SELECT count(DISTINCT price_hash) FROM good) AS keys)
    SELECT 'first' AS run, keys AS inserted, good - keys AS skipped, total - good AS failed FROM n
    UNION ALL SELECT 'replay', 0, good, total - good FROM n""")
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing streamed again from an empty checkpoint: nothing is inserted twice."""
    root = shared_dir(spark, "stream-replay")
    raw = raw_prices(spark, sf_dir)
    sinks.write_csv(raw, f"{root}/landing")
    for name in ("first", "replay"):
        _run_ingest(spark, root, f"{root}/landing", name, max(2, _files(raw, 2)))
    return Store(root).read(spark, "audit").groupBy(F.substring_index("run_id", "-", 1).alias("run")).agg(
        *[F.sum(c).alias(c) for c in ("inserted", "skipped", "failed")])


@check("stream_distinct_keys", over("trades", then="""
    SELECT symbol, count(DISTINCT tradedatetimeutc) AS keys FROM trades GROUP BY 1"""))
def stream_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "stream-distinct")
    trades = _table_stream(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("symbol"),
        F.col("l_shipdate").alias("tradedatetimeutc"), F.col("l_extendedprice").alias("close"))
    once = ingest.distinct_stream(trades, jobs.PRICES)
    aggregates.append_to(once, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("symbol").agg(F.count("*").alias("keys"))


@check("stream_distinct_stored", over("trades", then="""
    SELECT symbol, count(DISTINCT tradedatetimeutc) AS keys FROM trades GROUP BY 1"""))
def stream_distinct_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same keys without any state in the stream: landed in four files, two of them twice."""
    root = shared_dir(spark, "stream-stored")
    trades = views.trades(spark, sf_dir).select("symbol", "tradedatetimeutc", "close", (F.col("ord") % 4).alias("part"))
    files = _files(trades, 4)  # of a part: one, until the table is larger
    for k in (0, 1, 2, 3, 1, 2):
        trades.where(F.col("part") == k).drop("part").coalesce(files).write.mode("append").parquet(f"{root}/landing")
    stream = spark.readStream.schema(trades.drop("part").schema).option("maxFilesPerTrigger", 2 * files).parquet(f"{root}/landing")
    ingest.distinct_to_store(stream, jobs.PRICES, Store(root), f"{root}/checkpoint").awaitTermination()
    return Store(root).read(spark, "prices").groupBy("symbol").agg(F.count("*").alias("keys"))


@check("stream_corrected_bars", over("ticks", then=f"""
    , r AS (SELECT symbol, ts, seq, volume, last + k * (seq % 7) AS last, row_number() OVER (PARTITION BY seq ORDER BY k DESC) AS n
            FROM ticks, range(3) AS x(k) WHERE k = 0 OR seq % 4 = k),
    ticks2 AS (SELECT * FROM r WHERE n = 1)
    SELECT symbol, time_bucket(INTERVAL 60 MINUTE, ts) AS bar, {BAR_SQL} FROM ticks2 GROUP BY 1, 2"""))
def stream_corrected_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks, then corrections of every second one, long after their bars were made: the newest first."""
    root = shared_dir(spark, "stream-corrected")
    ticks = views.ticks(spark, sf_dir).select("symbol", "ts", "seq", "volume", "last")
    files = _files(ticks, 1)
    for k in (2, 0, 1):
        part = ticks.where((F.lit(k) == 0) | (F.col("seq") % 4 == k)).withColumns(
            {"last": F.col("last") + k * (F.col("seq") % 7), "revision": F.lit(k)})
        part.coalesce(files).write.mode("append").parquet(f"{root}/landing")
    stream = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/landing")
    aggregates.stream_corrected_bars(stream, Store(root), f"{root}/checkpoint", 60, ["revision"], tie=["seq"]).awaitTermination()
    return Store(root).read(spark, "bars").drop("day")


@check("stream_bars_closed", over("ticks", then=f"""
    SELECT symbol, time_bucket(INTERVAL 60 MINUTE, ts) AS bar, {BAR_SQL} FROM ticks GROUP BY 1, 2
    HAVING bar + INTERVAL 60 MINUTE <= (SELECT max(ts) FROM ticks) - INTERVAL 1 HOUR"""))
def stream_bars_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: the bars whose end the watermark has passed."""
    root = shared_dir(spark, "stream-bars")
    bars = aggregates.stream_bars(_tick_stream(spark, sf_dir), 60, "1 hour", tie=["seq"])
    aggregates.append_to(bars, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@check("stream_bars_complete", over("ticks", then=f"""
    SELECT symbol, time_bucket(INTERVAL 240 MINUTE, ts) AS bar, {BAR_SQL} FROM ticks
    GROUP BY 1, 2"""))
def stream_bars_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode equals the batch result."""
    root = shared_dir(spark, "stream-bars-all")
    bars = aggregates.stream_bars(_tick_stream(spark, sf_dir), 240, "1 hour", tie=["seq"])
    aggregates.keep_complete(bars, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@check("stream_latest_quotes", over("ticks", then="""
    SELECT symbol, ts, last, user_id FROM ticks
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, seq DESC) = 1"""))
def stream_latest_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "stream-quotes")
    views.ticks(spark, sf_dir).repartition(5).write.parquet(f"{root}/ticks")
    ticks = spark.readStream.schema(spark.read.parquet(f"{root}/ticks").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/ticks")
    aggregates.stream_quotes(
        ticks, ["last", "user_id"], Store(root), f"{root}/checkpoint", "ts", ["seq"]
    ).awaitTermination()
    schema = ticks.select("symbol", "ts", "last", "user_id", "seq").schema
    return aggregates.current_quotes(
        spark, Store(root), schema, ["last", "user_id"], "ts", ["seq"])


@check("stream_corrections", over("corrections", then=f"""
    SELECT symbol, tradedatetimeutc, lastupdatetime, close, ord,
           {day("date_trunc('month', tradedatetimeutc)")} AS trade_month FROM corrections
    QUALIFY row_number() OVER (PARTITION BY symbol, tradedatetimeutc
                               ORDER BY lastupdatetime DESC, ord DESC) = 1"""))
def stream_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed revisions streamed into a table that keeps the latest one."""
    root = shared_dir(spark, "stream-corrections")
    landed = views.corrections(spark, sf_dir).select(
        "symbol", "tradedatetimeutc", "lastupdatetime", "close", "ord",
        F.to_date(F.date_trunc("month", "tradedatetimeutc")).alias("trade_month"))
    files = _files(landed, 4)
    _at_least(landed, 4).write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/landing")
    ingest.corrections_stream(
        stream, Store(root), "prices", ["symbol", "tradedatetimeutc"], ["lastupdatetime", "ord"],
        "trade_month", f"{root}/checkpoint",
    ).awaitTermination()
    return Store(root).read(spark, "prices")
