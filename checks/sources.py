"""Landed files, stored tables and sinks: written to the shared folder and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.base import check, day, over
from checks.raw import CLEAN_SQL, RAW_COLUMNS, raw_prices
from tidemark.operators import conform
from tidemark.session import shared_dir
from tidemark.sources import landing, sinks, tables, views


@check("csv_landing", f"""
    SELECT * REPLACE (CAST(line AS VARCHAR) AS line, CAST(ord AS VARCHAR) AS ord)
    FROM ({CLEAN_SQL})""")
def csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows written as landed CSV, read as text, cleaned."""
    path = shared_dir(spark, "landing")
    sinks.write_csv(raw_prices(spark, sf_dir), path)
    good, _ = landing.split_corrupt(landing.read_landed(spark, path, RAW_COLUMNS))
    return conform.clean_prices(good.drop("source_file"))


PARTS = 4


def _nation_files(spark: SparkSession, sf_dir: str) -> str:
    """Landed files per nation, several each, customers as lines; some begin with an error answer."""
    path = shared_dir(spark, "bodies")
    line = F.concat_ws(",", "c_name", F.col("c_acctbal").cast("string"))
    rows = views.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"),
        F.pmod(F.xxhash64("c_custkey"), F.lit(PARTS)).cast("int").alias("part"),
        F.lit(1).alias("rank"), line.alias("value"))
    heads = views.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation"),
        F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), F.lit(0).alias("rank"),
        F.when(F.col("n_nationkey") % 5 == 0, '  {"message": "none"}')
        .when(F.col("n_nationkey") % 5 == 1, "An Error happened")
        .otherwise("name,balance").alias("value"))
    (rows.unionByName(heads).repartition("nation", "part")
     .sortWithinPartitions("nation", "part", "rank").drop("rank")
     .write.partitionBy("nation", "part").text(path))
    return path


@check("error_payload_files", """
    SELECT c_nationkey AS nation, count(*) AS rows FROM customer
    WHERE c_nationkey % 5 > 1 GROUP BY 1""")
def error_payload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _nation_files(spark, sf_dir)
    rejected = landing.error_files(spark, path)
    lines = spark.read.text(path).withColumn("source_file", F.col("_metadata.file_path"))
    kept = landing.drop_files(lines, rejected)
    return kept.where(F.col("value") != "name,balance").groupBy("nation").agg(
        F.count("*").alias("rows"))


@check("malformed_rows", """
    SELECT l_linenumber > 5 AS malformed, count(*) AS n FROM lineitem GROUP BY 1""")
def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with too many cells are set aside, the others are kept."""
    path = shared_dir(spark, "malformed")
    line = F.concat_ws(",", "l_orderkey", "l_partkey", F.when(F.col("l_linenumber") > 5, "extra"))
    views.table(spark, sf_dir, "lineitem").select(line.alias("ord,part")).write.option(
        "header", True).option("quote", "\u0000").option("sep", "\u0001").csv(path)
    good, bad = landing.split_corrupt(landing.read_landed(spark, path, ["ord", "part"]))
    return good.agg(F.lit(False).alias("malformed"), F.count("*").alias("n")).unionByName(
        bad.agg(F.lit(True).alias("malformed"), F.count("*").alias("n"))
    )


@check("default_key_from_path", """
    SELECT 'NATION_' || c_nationkey AS symbol, count(*) AS n FROM customer GROUP BY 1""")
def default_key_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbol column is absent from the files: it is the name of the landed folder."""
    path = shared_dir(spark, "keyed-landing")
    customers = views.table(spark, sf_dir, "customer")
    customers.select(
        F.concat(F.lit("NATION_"), "c_nationkey").alias("symbol"), "c_name", "c_acctbal"
    ).write.partitionBy("symbol").option("header", True).csv(path)
    rows = landing.read_landed(spark, f"{path}/*", ["c_name", "c_acctbal"])
    return landing.default_key_column(rows, "symbol", r"symbol=([^/]+)/").groupBy("symbol").agg(
        F.count("*").alias("n"))


@check("typed_result", over("daily", then="""
    SELECT symbol, tradedatetimeutc, close, volume::BIGINT AS volume, ord::VARCHAR AS ord
    FROM daily"""))
def typed_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsers by name, some with a request prefix; columns without a parser stay text."""
    text = views.daily(spark, sf_dir).select(
        "symbol", F.date_format("tradedatetimeutc", "MM/dd/yyyy hh:mm:ss a").alias(
            "tradedatetimeutc"),
        F.col("close").cast("string").alias("close"),
        F.col("volume").cast("string").alias("volume"), F.col("ord").cast("string").alias("ord"),
    )
    return landing.typed(text, {
        "Get_Daily-tradedatetimeutc": "datetime", "Get_Daily-close": "float", "volume": "int",
        "Get_Daily-missing": "int", "symbol": lambda c: c,
    })


@check("sql_with_parameters", """
    SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS value FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_quantity < 25 GROUP BY 1""")
def sql_with_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_sql(
        spark,
        "SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS value "
        "FROM {lineitem} WHERE l_shipdate >= :since AND l_quantity < :most GROUP BY 1",
        {"since": dt.datetime(1997, 1, 1, tzinfo=dt.timezone.utc), "most": 25},
        lineitem=views.table(spark, sf_dir, "lineitem"),
    )


@check("create_table_once", over("daily", then="""
    SELECT symbol, count(*) AS n, true AS created, false AS created_again FROM daily
    GROUP BY 1"""))
def create_table_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "table")
    name = "prices_" + path.rsplit("-", 1)[1]
    schema = T.StructType([
        T.StructField("symbol", T.StringType()), T.StructField("close", T.DoubleType()),
        T.StructField("trade_month", T.DateType()),
    ])
    created = tables.create_table(spark, name, schema, path, ["trade_month"])
    rows = views.daily(spark, sf_dir).withColumn(
        "trade_month", F.to_date(F.date_trunc("month", "tradedatetimeutc")))
    conform.conform(rows, schema).hint("rebalance", "trade_month").write.insertInto(name)
    again = tables.create_table(spark, name, schema, path, ["trade_month"])
    out = spark.table(name).groupBy("symbol").agg(F.count("*").alias("n"))
    return out.withColumns({"created": F.lit(created), "created_again": F.lit(again)})


@check("append_sink", over("daily", then=f"""
    SELECT {day("date_trunc('month', tradedatetimeutc)")} AS trade_month, 2 * count(*) AS n
    FROM daily GROUP BY 1"""))
def append_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "append")
    rows = views.daily(spark, sf_dir).withColumn(
        "trade_month", F.to_date(F.date_trunc("month", "tradedatetimeutc")))
    for _ in range(2):
        sinks.append_parquet(rows, path, ["trade_month"])
    return spark.read.parquet(path).groupBy("trade_month").agg(F.count("*").alias("n"))


@check("csv_sink", """
    SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer""")
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "csv")
    rows = views.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    sinks.write_csv(rows, path)
    return spark.read.option("header", True).csv(path)


@check("csv_sink_quoted", """
    SELECT concat(chr(34), c_name, ' said ', chr(34), chr(34), c_mktsegment, chr(34), chr(34),
                  chr(34), ',', c_custkey, ',', chr(34), c_mktsegment, chr(34)) AS line
    FROM customer""")
def csv_sink_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as written: text quoted, numbers bare, header on top of each part file."""
    path = shared_dir(spark, "quoted")
    rows = views.table(spark, sf_dir, "customer").select(
        F.concat("c_name", F.lit(' said "'), "c_mktsegment", F.lit('"')).alias("NAME"),
        F.col("c_custkey").alias("KEY"), F.col("c_mktsegment").alias("SEGMENT"),
    )
    sinks.write_csv_quoted(rows, path)
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.where(F.col("line") != '"NAME","KEY","SEGMENT"')


@check("json_sink", f"""
    SELECT o_orderkey AS key, {day('o_orderdate')} AS on_date, o_orderpriority AS tenor,
           o_totalprice AS value FROM orders""")
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested bodies written as JSON lines and read back."""
    path = shared_dir(spark, "json")
    body = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.to_date("o_orderdate").alias("onDate"),
        F.array(F.struct(F.col("o_orderpriority").alias("tenor"),
                         F.col("o_totalprice").alias("value"))).alias("tenors"),
    )
    sinks.write_json(body, path)
    back = spark.read.schema(
        "key bigint, onDate string, tenors array<struct<tenor string, value double>>").json(path)
    return back.select("key", F.col("onDate").alias("on_date"), F.inline("tenors"))
