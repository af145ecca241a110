"""The price and instrument jobs and their parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, over
from checks.raw import CLEAN_SQL, KEY_SQL, landed_prices, raw_prices
from tidemark import schemas
from tidemark.functions.keys import price_hash
from tidemark.operators import conform, ingest
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import views
from tidemark.sources.store import Store, partition_names

RUN_TS = dt.datetime(2024, 6, 3, 12, 0, tzinfo=dt.timezone.utc)
HISTORY_END = dt.datetime(1998, 7, 1, tzinfo=dt.timezone.utc)
GOOD = f"good AS (SELECT *, {KEY_SQL} AS price_hash FROM clean WHERE symbol IS NOT NULL " \
       "AND tradedatetimeutc IS NOT NULL)"
ONCE = "once AS (SELECT * FROM good QUALIFY row_number() OVER " \
       "(PARTITION BY price_hash ORDER BY ord, line) = 1)"
STORED = "stored AS (SELECT DISTINCT price_hash FROM good " \
         "WHERE tradedatetimeutc < TIMESTAMP '1998-07-01')"


def _good(landed: DataFrame) -> DataFrame:
    return jobs.keyed(landed, jobs.PRICES).where(F.col("reason").isNull()).drop("reason", jobs.LANDED)


def _stored(good: DataFrame) -> DataFrame:
    """The keys that an earlier run stored: the history up to mid 1998."""
    past = good.where(F.col("tradedatetimeutc") < F.lit(HISTORY_END))
    return past.select(
        "price_hash", F.to_date(F.date_trunc("month", "tradedatetimeutc")).alias("trade_month"))


@check("price_ingest", f"""
    WITH clean AS ({CLEAN_SQL}), {GOOD}, {ONCE}, {STORED}
    SELECT upper(trim(symbol, ' ' || chr(9))) AS symbol, count(*) AS new_rows,
           count(close) AS priced_rows, sum(volume) AS volume,
           min(tradedatetimeutc) AS first_time, max(tradedatetimeutc) AS last_time
    FROM once WHERE price_hash NOT IN (SELECT price_hash FROM stored) GROUP BY 1""")
def price_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price job's core on landed CSV: clean, key, check, first per key, drop stored keys; the
    new rows per symbol."""
    root = shared_dir(spark, "price-core")
    landed = _good(landed_prices(spark, sf_dir))
    # The landing is parsed once; the keys, which nothing can press, are made again.
    landed = landed.drop("price_hash")
    landed.write.option("compression", "zstd").parquet(f"{root}/good")
    good = spark.read.schema(landed.schema).parquet(f"{root}/good")
    good = good.withColumn("price_hash", price_hash(good, spare=False))
    store = Store(root)
    earlier = store.begin(spark)
    past = jobs.with_partition(good.drop("price_hash"), jobs.PRICES).select("symbol", "tradedatetimeutc", "trade_month")
    earlier.append("prices", past.where(F.col("tradedatetimeutc") < F.lit(HISTORY_END)), "trade_month",
                   finish=lambda rows: _stored(rows.withColumn("price_hash", price_hash(rows, spare=False))))
    earlier.commit()
    touched = partition_names(jobs.with_partition(good, jobs.PRICES), "trade_month")
    new = jobs.storable(good, store.read(spark, "prices", only=touched), jobs.PRICES, ["ord", "line"], RUN_TS)
    return new.groupBy(F.upper(F.btrim("symbol", F.lit(" \t"))).alias("symbol")).agg(
        F.count("*").alias("new_rows"), F.count("close").alias("priced_rows"),
        F.sum("volume").alias("volume"), F.min("tradedatetimeutc").alias("first_time"),
        F.max("tradedatetimeutc").alias("last_time"),
    )


@check("price_job_run", f"""
    WITH clean AS ({CLEAN_SQL}), {GOOD}, {ONCE}
    SELECT run, CASE WHEN run = 1 THEN n ELSE 0 END AS inserted,
           total - bad - CASE WHEN run = 1 THEN n ELSE 0 END AS skipped, bad AS failed, n AS stored
    FROM (SELECT (SELECT count(*) FROM once) AS n, (SELECT count(*) FROM clean) AS total,
                 (SELECT count(*) FROM clean) - (SELECT count(*) FROM good) AS bad),
         (VALUES (1), (2)) AS r(run)""")
def price_job_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole price job, written to a table, run twice: the second run must insert nothing."""
    store = Store(shared_dir(spark, "price-job"))
    for run in (1, 2):
        jobs.run_ingest(
            spark, raw_prices(spark, sf_dir), jobs.PRICES, store, f"run-{run}", RUN_TS, ["ord", "line"],
        )
    stored = store.read(spark, "prices").agg(F.count("*").alias("stored")).scalar()
    return store.read(spark, "audit").select(
        F.substring("run_id", 5, 1).cast("int").alias("run"), "inserted", "skipped", "failed",
        stored.alias("stored"),
    )


@check("instrument_job_run", over("instruments", then="""
    SELECT exchange_code, count(*) AS instruments, count(DISTINCT security_type) AS types,
           min(strftime(DATE '2024-06-03', '%Y-%m-%d')) AS last_seen_date, 0::BIGINT AS pulled
    FROM instruments GROUP BY 1"""))
def instrument_job_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole instrument job, run twice over all parts; the stored table per exchange."""
    store = Store(shared_dir(spark, "instrument-job"))
    for run in (1, 2):
        jobs.run_ingest(
            spark, views.instruments(spark, sf_dir), jobs.INSTRUMENTS, store, f"run-{run}", RUN_TS, ["seq"],
        )
    stored = store.read(spark, "instruments", schemas.INSTRUMENT_TABLE)
    return stored.groupBy("exchange_code").agg(
        F.count("*").alias("instruments"),
        F.count_distinct("security_type").alias("types"),
        F.min("last_seen_date").alias("last_seen_date"),
        F.count("last_price_pull_date").alias("pulled"),
    )


@check("clean_prices", f"{CLEAN_SQL}")
def clean_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.clean_prices(raw_prices(spark, sf_dir))


@check("clean_instruments", """
    SELECT 'P' || p_partkey AS symbol,
           CASE WHEN p_size % 6 >= 4 THEN CASE p_size % 6 WHEN 4 THEN '' ELSE p_brand END END
               AS exchange_code,
           CAST(p_size AS VARCHAR) AS rownum
    FROM part""")
def clean_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    words = F.element_at(
        F.array(*[F.lit(w) for w in (*schemas.INSTRUMENT_SENTINELS, "")]), (size % 6 + 1)
    )
    raw = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"),
        F.when(size % 6 == 5, F.col("p_brand")).otherwise(
            F.when(size % 6 < 5, words)).alias("exchange_code"),
        size.alias("rownum"),
    )
    return conform.clean_instruments(raw)


@check("conform_instruments", over("instruments", then="""
    SELECT symbol, exchange_code, CAST(NULL AS VARCHAR) AS gross_net, option_root, strike_price,
           CAST(NULL AS VARCHAR) AS source_symbol, 43::BIGINT AS columns FROM instruments"""))
def conform_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = conform.conform(views.instruments(spark, sf_dir), schemas.INSTRUMENT_TABLE)
    return out.select(
        "symbol", "exchange_code", "gross_net", "option_root", "strike_price", "source_symbol",
        F.lit(len(out.columns)).cast("bigint").alias("columns"),
    )


@check("price_audit_columns", over("daily", then="""
    SELECT data_source, created_at, updated_at, count(*) AS n
    FROM (SELECT 'MV_API' AS data_source, TIMESTAMP '2024-06-03 12:00:00' AS created_at,
                 TIMESTAMP '2024-06-03 12:00:00' AS updated_at FROM daily) GROUP BY 1, 2, 3"""))
def price_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        conform.with_price_audit(views.daily(spark, sf_dir), RUN_TS)
        .groupBy("data_source", "created_at", "updated_at").agg(F.count("*").alias("n"))
    )


@check("instrument_audit_columns", over("instruments", then="""
    SELECT symbol, TIMESTAMP '2024-06-03 12:00:00' AS created_at,
           TIMESTAMP '2024-06-03 12:00:00' AS updated_at, '2024-06-03' AS last_seen_date,
           CAST(NULL AS VARCHAR) AS last_price_pull_date
    FROM instruments"""))
def instrument_audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.with_instrument_audit(views.instruments(spark, sf_dir), RUN_TS).select(
        "symbol", *schemas.INSTRUMENT_AUDIT
    )


@check("nan_to_null", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS discount
    FROM lineitem""")
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_discount"))
        .alias("discount"),
    )
    return conform.nan_to_null(raw)


@check("first_by_key", over("daily", then="SELECT * FROM daily"))
def first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.daily(spark, sf_dir)


@check("quarantine", f"""
    WITH clean AS ({CLEAN_SQL})
    SELECT market, CASE WHEN symbol IS NULL THEN 'symbol missing' ELSE 'trade time missing' END
           AS reason, count(*) AS n
    FROM clean WHERE symbol IS NULL OR tradedatetimeutc IS NULL GROUP BY 1, 2""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = conform.clean_prices(raw_prices(spark, sf_dir))
    with_key = cleaned.withColumn("price_hash", price_hash(cleaned))
    _, bad = ingest.quarantine_split(with_key, ingest.price_reject_reason(with_key))
    return bad.groupBy("market", "reason").agg(F.count("*").alias("n"))


@check("run_totals", """
    SELECT count(*) FILTER (o_orderstatus = 'F') AS inserted,
           count(*) FILTER (o_orderstatus = 'O') AS skipped,
           count(*) FILTER (o_orderstatus = 'P') AS failed,
           (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus <> 'P')
               AS processed_sources,
           count(DISTINCT o_custkey)
               - (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus <> 'P')
               AS failed_sources
    FROM orders""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a status table: one source per customer, one outcome per order."""
    status = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("source"),
        F.when(F.col("o_orderstatus") == "F", "inserted")
        .when(F.col("o_orderstatus") == "O", "skipped").otherwise("failed").alias("outcome"),
    )
    return ingest.run_totals(status)


@check("failures_by_source", f"""
    WITH clean AS ({CLEAN_SQL})
    SELECT source, count(*) AS failures
    FROM (SELECT l_suppkey AS source, l_orderkey AS o FROM lineitem
          WHERE l_orderkey % 101 = 0 OR l_orderkey % 97 = 0)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def failures_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("source"), F.col("l_orderkey").alias("k")
    )
    _, bad = ingest.quarantine_split(
        raw, F.when((F.col("k") % 101 == 0) | (F.col("k") % 97 == 0), "bad key part")
    )
    return ingest.failures_by_source(bad)


@check("insert_rate", """
    SELECT run_id, inserted, CASE WHEN seconds > 0 THEN inserted / seconds::DOUBLE END AS rate
    FROM (SELECT l_returnflag || l_linestatus AS run_id, count(*) AS inserted,
                 date_diff('second', min(l_shipdate), max(l_shipdate)) AS seconds
          FROM lineitem GROUP BY 1)""")
def insert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = views.table(spark, sf_dir, "lineitem").groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("run_id")
    ).agg(F.count("*").alias("inserted"), F.min("l_shipdate").alias("started_at"),
          F.max("l_shipdate").alias("finished_at"))
    return ingest.insert_rate(runs).select("run_id", "inserted", "rate")


@check("unseen_instruments", """
    SELECT 'P' || p_partkey AS symbol FROM part
    WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem
                            WHERE l_shipdate < TIMESTAMP '1995-06-01')""")
def unseen_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = views.trades(spark, sf_dir).where(
        F.col("tradedatetimeutc") < F.lit(dt.datetime(1995, 6, 1, tzinfo=dt.timezone.utc))
    )
    new = views.instruments(spark, sf_dir).select("symbol")
    return ingest.unseen(new, stored, "symbol")


def _early(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dt.datetime(1995, 6, 1, tzinfo=dt.timezone.utc)
    return views.trades(spark, sf_dir).where(F.col("tradedatetimeutc") < F.lit(cut))


EARLY = "early AS (SELECT DISTINCT symbol FROM trades " \
        "WHERE tradedatetimeutc < TIMESTAMP '1995-06-01')"


@check("new_symbols", over("instruments", "trades", then=f""", {EARLY}
    SELECT DISTINCT symbol FROM instruments WHERE symbol NOT IN (SELECT symbol FROM early)"""))
def new_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.new_symbols(views.instruments(spark, sf_dir), _early(spark, sf_dir))


@check("known_symbols", over("instruments", "trades", then=f""", {EARLY}
    SELECT DISTINCT symbol FROM instruments WHERE symbol IN (SELECT symbol FROM early)"""))
def known_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.known_symbols(views.instruments(spark, sf_dir), _early(spark, sf_dir))


@check("fetch_plan", over("instruments", "trades", then=f""", {EARLY}
    SELECT symbol, CASE WHEN symbol IN (SELECT symbol FROM early) THEN 'existing' ELSE 'new' END
           AS symbol_type,
           CASE WHEN symbol IN (SELECT symbol FROM early) THEN 30 ELSE 7200 END AS recordsback
    FROM (SELECT DISTINCT symbol FROM instruments)"""))
def fetch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.fetch_plan(views.instruments(spark, sf_dir), _early(spark, sf_dir))


@check("symbol_type_counts", over("instruments", "trades", then=f""", {EARLY}
    SELECT CASE WHEN symbol IN (SELECT symbol FROM early) THEN 'existing' ELSE 'new' END
           AS symbol_type, count(DISTINCT symbol) AS symbols
    FROM instruments GROUP BY 1"""))
def symbol_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.symbol_type_counts(fetch_plan(spark, sf_dir))


@check("row_count", over("daily", then="SELECT count(*) AS n FROM daily"))
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.daily(spark, sf_dir).agg(F.count("*").alias("n"))


@check("exchange_codes", """
    SELECT DISTINCT p_brand AS exchange_code FROM part WHERE p_size > 10 AND p_brand IS NOT NULL""")
def exchange_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = views.table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("exchange_code")
    )
    return ingest.distinct_values(part, "exchange_code")


@check("symbols_ordered", """
    SELECT DISTINCT 'P' || l_partkey AS symbol FROM lineitem ORDER BY 1""")
def symbols_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.distinct_values(views.trades(spark, sf_dir), "symbol").orderBy("symbol")


@check("key_difference", over("instruments", "trades", then=f""", {EARLY}
    SELECT symbol FROM instruments EXCEPT SELECT symbol FROM early"""))
def key_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.instruments(spark, sf_dir).select("symbol").subtract(
        _early(spark, sf_dir).select("symbol"))


@check("key_intersection", over("instruments", "trades", then=f""", {EARLY}
    SELECT symbol FROM instruments INTERSECT SELECT symbol FROM early"""))
def key_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.instruments(spark, sf_dir).select("symbol").intersect(
        _early(spark, sf_dir).select("symbol"))
