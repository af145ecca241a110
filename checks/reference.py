"""Metadata, folders and dimension lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, over
from checks.fills import FACTOR_SQL, factors, unit_of
from checks.keys import ZONE_SQL, zone_of
from tidemark.operators import reference as ref
from tidemark.sources import views


@check("metadata_wide", over("metadata", then="""
    SELECT symbol, max(value) FILTER (property = 'brand') AS brand,
           max(value) FILTER (property = 'type') AS type,
           max(value) FILTER (property = 'quality') AS quality
    FROM metadata WHERE property IN ('brand', 'type', 'quality') GROUP BY 1"""))
def metadata_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ref.get_metadata(views.metadata(spark, sf_dir), ["brand", "type", "quality"])


@check("metadata_search", """
    SELECT 'P' || p_partkey AS symbol FROM part
    WHERE p_type IN ('PROMO', 'SMALL') AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')""")
def metadata_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ref.search_metadata(
        views.metadata(spark, sf_dir),
        {"type": ["PROMO", "SMALL"], "brand": ["Brand#1", "Brand#2", "Brand#3"]})


@check("folder_members", over("folders", then="""
    SELECT path, symbol FROM folders WHERE path = 'therha.example.com'
        OR starts_with(path, 'therha.example.com/')
    UNION ALL SELECT path, symbol FROM folders WHERE path = 'therou.example.com'
        OR starts_with(path, 'therou.example.com/')"""))
def folder_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = views.folders(spark, sf_dir)
    return ref.get_folder(folders, "therha.example.com").unionByName(
        ref.get_folder(folders, "therou.example.com"))


@check("folder_sizes", over("folders", then="""
    SELECT path, count(*) AS members FROM folders GROUP BY 1"""))
def folder_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.folders(spark, sf_dir).groupBy("path").agg(F.count("*").alias("members"))


@check("unified_metadata", over("instruments", then="""
    SELECT symbol, description, supplier FROM instruments
    WHERE (contains(lower(symbol), 'bolt') OR contains(lower(description), 'bolt'))
      AND supplier = 'SUP' ORDER BY symbol LIMIT 10 OFFSET 10"""))
def unified_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is the feature here."""
    return ref.unified_metadata(
        views.instruments(spark, sf_dir), "BOLT", "SUP", 2, 10
    ).select("symbol", "description", "supplier")


@check("all_roots", over("instruments", then="""
    SELECT DISTINCT option_root FROM instruments WHERE contains(lower(option_root), 'm')"""))
def all_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ref.all_roots(views.instruments(spark, sf_dir), "M")


@check("permissioned_roots", over("instruments", then="""
    SELECT DISTINCT option_root, exchange_code FROM instruments
    WHERE option_root IN (SELECT '/' || p_type FROM part WHERE p_size = 50)"""))
def permissioned_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    grants = views.table(spark, sf_dir, "part").where(F.col("p_size") == 50).select(
        F.concat(F.lit("/"), "p_type").alias("option_root"))
    return ref.permissioned_roots(
        views.instruments(spark, sf_dir), grants, fields=["option_root", "exchange_code"])


@check("currency_list", over("trades", then="SELECT DISTINCT currency FROM trades"))
def currency_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ref.dimension(views.trades(spark, sf_dir), ["currency"])


@check("exchange_list", over("instruments", then="""
    SELECT DISTINCT exchange_code, security_type FROM instruments"""))
def exchange_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ref.dimension(views.instruments(spark, sf_dir), ["exchange_code", "security_type"])


@check("time_zone_list", f"""
    SELECT DISTINCT {ZONE_SQL} AS iana_code FROM events
    WHERE {ZONE_SQL} IN ('Asia/Tokyo', 'UTC', 'Europe/Berlin')""")
def time_zone_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = views.ticks(spark, sf_dir).select(zone_of(F.col("symbol")).alias("iana_code"))
    return ref.dimension(zones, ["iana_code"], iana_code=["Asia/Tokyo", "UTC", "Europe/Berlin"])


@check("unit_list", f"""
    SELECT 'P' || p_partkey AS symbol, f.unit, f.to_unit, f.factor
    FROM part JOIN {FACTOR_SQL} ON f.unit = (['BBL','MT','MMB','GJ'])[p_partkey % 4 + 1]
    WHERE p_partkey = 17""")
def unit_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"), unit_of(F.col("p_partkey")).alias("unit"))
    return ref.units_of(symbols, factors(spark), "P17")
