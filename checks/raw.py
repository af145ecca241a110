"""Untidy landed text made from the line items, and what cleaning must make of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.sources import landing, sinks
from tidemark.sources.views import table

RAW_COLUMNS = ["symbol", "tradedatetimeutc", "close", "volume", "tickcount", "currency", "market",
               "ord", "line"]


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as text: mixed case and blanks, three time formats, null words, junk."""
    k, ship = F.col("l_orderkey"), F.col("l_shipdate")
    partkey = F.col("l_partkey").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.when(k % 101 == 0, "nan").when(k % 7 == 0, F.concat(F.lit("  p"), partkey, F.lit("\t")))
        .otherwise(F.concat(F.lit("P"), partkey)).alias("symbol"),
        F.when(k % 97 == 0, "junk")
        .when(k % 3 == 0, F.date_format(ship, "M/d/yyyy h:mm:ss a"))
        .when(k % 3 == 1, F.date_format(ship, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(ship, "yyyy-MM-dd HH:mm:ss")).alias("tradedatetimeutc"),
        F.when(k % 13 == 0, "x").when(k % 17 == 0, "NaN")
        .otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("close"),
        F.col("l_quantity").cast("int").cast("string").alias("volume"),
        F.concat(F.when(k % 2 == 0, "-").otherwise(""), F.col("l_quantity").cast("int"),
                 F.lit(".9")).alias("tickcount"),
        F.when(k % 5 == 0, "nan").when(k % 5 == 1, "None").when(k % 5 == 2, "NaN")
        .when(k % 5 == 3, "").otherwise("USD").alias("currency"),
        F.col("l_returnflag").alias("market"),
        k.alias("ord"), F.col("l_linenumber").alias("line"),
    )


def landed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows written once as landed CSV and read back as text."""
    path = shared_dir(spark, "landing")
    sinks.write_csv(raw_prices(spark, sf_dir), path)
    good, _ = landing.split_corrupt(landing.read_landed(spark, path, RAW_COLUMNS))
    return good.drop("source_file").withColumns(
        {"ord": F.col("ord").cast("bigint"), "line": F.col("line").cast("int")})


# The cleaned rows, stated from the line items and not by parsing the text again.
CLEAN_SQL = """
    SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL
                WHEN l_orderkey % 7 = 0 THEN '  p' || l_partkey || chr(9)
                ELSE 'P' || l_partkey END AS symbol,
           CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_shipdate END AS tradedatetimeutc,
           CASE WHEN l_orderkey % 13 = 0 OR l_orderkey % 17 = 0 THEN NULL
                ELSE l_extendedprice END AS close,
           l_quantity AS volume,
           CASE WHEN l_orderkey % 2 = 0 THEN -1 ELSE 1 END * l_quantity::BIGINT AS tickcount,
           CASE WHEN l_orderkey % 5 = 4 THEN 'USD' END AS currency,
           l_returnflag AS market, l_orderkey AS ord, l_linenumber AS line
    FROM lineitem"""

KEY_SQL = """sha256('symbol:' || lower(trim(symbol, ' ' || chr(9))) || '|tradedatetimeutc:'
             || strftime(tradedatetimeutc, '%Y-%m-%d %H:%M:%S'))"""
