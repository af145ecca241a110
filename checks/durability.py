"""Keyed writes and landings that must not lose rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from tidemark.operators import mutate
from tidemark.plans import jobs
from tidemark.plans.requests import MarketData
from tidemark.session import shared_dir
from tidemark.sources import views
from tidemark.sources.landing import file_list
from tidemark.sources.store import Store
from tidemark.streaming import ingest as streams

RUN = dt.datetime(2024, 6, 3, tzinfo=dt.timezone.utc)
KEYS = ["symbol", "tradedatetimeutc"]


def _stored(spark: SparkSession, sf_dir: str, partition) -> tuple[DataFrame, Store]:
    """Daily prices stored by a text partition; the rows and where they are."""
    store = Store(shared_dir(spark, "durable"))
    rows = views.daily(spark, sf_dir).select(*KEYS, "close", partition.alias("part"))
    first = store.begin(spark)
    first.append("prices", rows, "part")
    first.commit()
    return rows, store


@check("upsert_null_partition", over("daily", then="""
    SELECT symbol, tradedatetimeutc, CASE WHEN currency = 'EUR' THEN NULL ELSE currency END AS part,
           CASE WHEN currency = 'EUR' AND length(symbol) % 2 = 0 THEN close + 1 ELSE close END AS close
    FROM daily"""))
def upsert_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch for some keys of the NULL partition leaves that partition's other rows stored."""
    part = F.when(F.col("currency") != "EUR", F.col("currency"))
    rows, store = _stored(spark, sf_dir, part)
    batch = rows.where("part is null and length(symbol) % 2 = 0").withColumn("close", F.col("close") + 1)
    mutate.upsert_partitions(store, "prices", batch, KEYS, mutate.by_content(batch, KEYS))
    return store.read(spark, "prices")


@check("upsert_repeated_keys", over("trades", then="""
    SELECT symbol, tradedatetimeutc, max(close) AS close FROM trades GROUP BY 1, 2"""))
def upsert_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that comes several times in one batch is stored once: its greatest value here."""
    batch = views.trades(spark, sf_dir).select(*KEYS, "close")
    stored = views.daily(spark, sf_dir).select(*KEYS, F.lit(0.0).alias("close"))
    return mutate.upsert(stored, batch, KEYS, [F.desc("close")])


@check("delete_escaped_partition", over("daily", then="""
    SELECT symbol, tradedatetimeutc, 'x:' || currency || '/1' AS part, close FROM daily
    WHERE currency <> 'JPY' AND NOT (currency = 'USD' AND length(symbol) % 2 = 0)"""))
def delete_escaped_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values that storage escapes: one partition is emptied, one loses some rows."""
    rows, store = _stored(spark, sf_dir, F.concat(F.lit("x:"), "currency", F.lit("/1")))
    gone = rows.where("part = 'x:JPY/1' or (part = 'x:USD/1' and length(symbol) % 2 = 0)")
    mutate.delete_partitions(store, "prices", gone, KEYS)
    return store.read(spark, "prices")


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """Line items as landed CSV text, one folder with good, malformed and error files."""
    path = shared_dir(spark, "landing")
    rows = views.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("symbol"),
        F.when(F.col("l_linenumber") == 7, "not a date")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("tradedatetimeutc"),
        F.col("l_extendedprice").cast("string").alias("close"))
    text = F.concat_ws(",", "symbol", "tradedatetimeutc", "close")
    rows.select(F.when(F.col("symbol").endswith("3"), F.concat(text, F.lit(",1,2"))).otherwise(text)
                .alias("symbol,tradedatetimeutc,close")) \
        .write.option("header", "true").option("sep", "\u0001").csv(path)
    spark.range(1).select(F.lit('{"detail": "no access"}').alias("value")).coalesce(1).write.mode("append").text(path)
    return path


COLUMNS = ["symbol", "tradedatetimeutc", "close"]
LANDED_SQL = """landed AS (
    SELECT 'P' || l_partkey AS symbol, l_shipdate AS t, l_linenumber, l_extendedprice AS close,
           l_partkey % 10 = 3 AS malformed FROM lineitem)"""
QUARANTINE_SQL = f"""WITH {LANDED_SQL}
    SELECT reason, content, count(*) AS n FROM (
        SELECT 'malformed row' AS reason, symbol || ',' || CASE WHEN l_linenumber = 7 THEN 'not a date'
                   ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END || ',' || close || ',1,2' AS content
        FROM landed WHERE malformed
        UNION ALL SELECT 'trade time missing', 'not a date' FROM landed WHERE NOT malformed AND l_linenumber = 7
        UNION ALL SELECT 'error payload', '') GROUP BY 1, 2"""


def _quarantined(rows: DataFrame) -> DataFrame:
    """File names differ from run to run, and rejected rows are shown by the text that was at fault."""
    content = (F.when(F.col("reason") == "error payload", "")
               .when(F.col("reason") == "trade time missing", F.get_json_object("content", "$.tradedatetimeutc"))
               .otherwise(F.col("content")))
    return rows.groupBy("reason", content.alias("content")).agg(F.count("*").alias("n"))


@check("quarantine_content", QUARANTINE_SQL)
def quarantine_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing with an error file, malformed rows and times that cannot be read, in one call: what is
    set aside holds the text as it landed."""
    store = Store(shared_dir(spark, "store"))
    jobs.run_landing(spark, _landing(spark, sf_dir), COLUMNS, jobs.PRICES, store, "run", RUN)
    return _quarantined(store.read(spark, "quarantine"))


STORED_SQL = f"""WITH {LANDED_SQL}
    SELECT symbol, t AS tradedatetimeutc, count(*) AS n FROM (
        SELECT DISTINCT symbol, t FROM landed WHERE NOT malformed AND l_linenumber <> 7) GROUP BY 1, 2"""


@check("landing_job", STORED_SQL)
def landing_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(shared_dir(spark, "store"))
    jobs.run_landing(spark, _landing(spark, sf_dir), COLUMNS, jobs.PRICES, store, "run", RUN)
    return store.read(spark, "prices").groupBy(*KEYS).agg(F.count("*").alias("n"))


@check("landing_stream", STORED_SQL)
def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing as a stream of several micro-batches, one file each."""
    path = _landing(spark, sf_dir)
    store = Store(shared_dir(spark, "store"))
    streams.landing_stream(spark, path, COLUMNS, jobs.PRICES, "s", store, shared_dir(spark, "checkpoint"), RUN,
                           files_per_trigger=max(1, len(file_list(spark, path)) // 2)).awaitTermination()
    return store.read(spark, "prices").groupBy(*KEYS).agg(F.count("*").alias("n"))


@check("update_data_stored", f"""
    WITH rows AS (SELECT 'P' || l_partkey AS symbol, date_trunc('month', l_shipdate) AS index, l_returnflag AS version,
                         l_extendedprice AS close, l_quantity AS oi FROM lineitem),
    best AS (SELECT symbol, field, index, version, max(value) AS value FROM (
        SELECT symbol, 'CLOSE' AS field, index, version, close AS value FROM rows
        UNION ALL SELECT symbol, 'OPENINTEREST', index, version, oi FROM rows) GROUP BY 1, 2, 3, 4)
    SELECT symbol, field, {day('index')} AS index, version, value, 'load' AS reason FROM best
    UNION ALL SELECT 'OLD' || p_partkey, 'CLOSE', '2001-01-01', 'A', p_retailprice, NULL FROM part""")
def update_data_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide update with INDEX, FREQUENCY, VERSION and open interest, put into a stored series."""
    wide = views.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("SYMBOL"), F.lit("").alias("DATE"),
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("INDEX"), F.lit("1M").alias("FREQUENCY"),
        F.col("l_returnflag").alias("VERSION"), F.col("l_extendedprice").alias("CLOSE"),
        F.col("l_quantity").alias("OPENINTEREST"))
    stored = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("OLD"), "p_partkey").alias("symbol"), F.lit("CLOSE").alias("field"),
        F.lit(None).cast("date").alias("ondate"), F.lit(dt.datetime(2001, 1, 1, tzinfo=dt.timezone.utc)).alias("index"),
        F.lit("A").alias("version"), F.col("p_retailprice").cast("double").alias("value"))
    series = mutate.update_data({"series": stored}, wide, "load")["series"]
    return series.select("symbol", "field", F.to_date("index").alias("index"), "version", "value", "reason")


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored curve inputs of all parts, and a configuration body for every second one."""
    part = views.table(spark, sf_dir, "part")
    symbol = F.concat(F.lit("P"), "p_partkey").alias("symbol")
    stored = part.select(symbol, F.col("p_brand").alias("role"), F.lit("old").alias("product"))
    body = part.where("p_partkey % 2 = 0").select(symbol, F.array(
        F.struct(F.col("p_brand").alias("role"), F.col("p_type").alias("product")),
        F.struct(F.lit("extra").alias("role"), F.col("p_type").alias("product"))).alias("inputs"))
    return stored, body


INPUTS_SQL = """
    SELECT 'P' || p_partkey AS symbol, p_brand AS role, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'old' END AS product FROM part
    UNION ALL SELECT 'P' || p_partkey, 'extra', p_type FROM part WHERE p_partkey % 2 = 0"""


@check("update_curve_configuration", INPUTS_SQL)
def update_curve_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, body = _inputs(spark, sf_dir)
    return mutate.update_curve_configuration({"inputs": stored}, body)["inputs"]


@check("symbol_inputs", f"SELECT * FROM ({INPUTS_SQL}) WHERE symbol LIKE 'P1%'")
def symbol_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inputs of built curves, as a request names them."""
    stored, body = _inputs(spark, sf_dir)
    data = MarketData({"curve_inputs": stored}, {})
    return data.with_table("curve_inputs", data.update_curves(body)["inputs"]).get_symbol_information("P1<*>", info="inputs")


@check("table_versions", over("daily", then="""
    SELECT v.version, currency, count(*) AS n, sum((CASE WHEN v.version >= 2 AND currency = 'EUR' THEN close + 1 ELSE close END)::DECIMAL(18,2))::DOUBLE AS total
    FROM daily, (VALUES (1), (2), (3)) AS v(version) WHERE NOT (v.version = 3 AND currency = 'JPY') GROUP BY 1, 2"""))
def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a table held before an upsert, between that and a delete, and after both."""
    rows, store = _stored(spark, sf_dir, F.col("currency"))
    changed = rows.where("part = 'EUR'").withColumn("close", F.col("close") + 1)
    mutate.upsert_partitions(store, "prices", changed, KEYS, mutate.by_content(changed, KEYS))
    mutate.delete_partitions(store, "prices", rows.where("part = 'JPY'"), KEYS)
    held = [store.read(spark, "prices", version=v).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    return (held[0].unionByName(held[1]).unionByName(held[2]).groupBy("version", F.col("part").alias("currency"))
            .agg(F.count("*").alias("n"), F.sum(F.col("close").cast("decimal(18,2)")).cast("double").alias("total")))


@check("replayed_landing", f"""
    WITH {LANDED_SQL}
    SELECT (SELECT count(*) FROM (SELECT DISTINCT symbol, t FROM landed WHERE NOT malformed AND l_linenumber <> 7)) AS stored,
           (SELECT count(*) FROM landed WHERE malformed OR l_linenumber = 7) + 1 AS set_aside, 1::BIGINT AS runs""")
def replayed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is started three times, once committed and twice again: its rows, its quarantine and its
    totals are there once."""
    store, path = Store(shared_dir(spark, "store")), _landing(spark, sf_dir)
    for _ in range(3):
        jobs.run_landing(spark, path, COLUMNS, jobs.PRICES, store, "run", RUN)
    n = {t: store.read(spark, t).agg(F.count("*")).scalar() for t in ("prices", "quarantine", "audit")}
    return spark.range(1).select(n["prices"].alias("stored"), n["quarantine"].alias("set_aside"), n["audit"].alias("runs"))
