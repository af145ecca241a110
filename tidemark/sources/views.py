"""Market-data views of the driver's tables, so that every operator runs on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _symbol(partkey: str):
    return F.concat(F.lit("P"), F.col(partkey).cast("string"))


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _symbol("p_partkey").alias("symbol"),
        F.col("p_brand").alias("exchange_code"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("security_type"),
        F.concat(F.lit("/"), F.col("p_type")).alias("option_root"),
        F.col("p_retailprice").cast("string").alias("strike_price"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("SUP")).alias("supplier"),
        F.col("p_size").cast("string").alias("rownum"),
        F.col("p_partkey").alias("seq"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one price record; (symbol, tradedatetimeutc) repeats."""
    return table(spark, sf_dir, "lineitem").select(
        _symbol("l_partkey").alias("symbol"),
        F.col("l_shipdate").alias("tradedatetimeutc"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").alias("volume"),
        F.col("l_orderkey").alias("ord"),
        F.col("l_linenumber").alias("line"),
        F.element_at(
            F.array(*[F.lit(c) for c in ("USD", "USC", "EUR", "GBC", "JPY")]),
            (F.col("l_suppkey") % 5 + 1).cast("int"),
        ).alias("currency"),
        F.col("l_returnflag").alias("version"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price record per (symbol, day): the first by (ord, line)."""
    from tidemark.operators.ingest import first_by_key

    return first_by_key(trades(spark, sf_dir), ["symbol", "tradedatetimeutc"], ["ord", "line"])


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("ts"),
        F.col("value").alias("last"),
        F.lit(1).alias("volume"),
        F.col("event_id").alias("seq"),
        F.col("user_id"),
        F.col("props"),
    )


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward curve points: average line price per (part type, order month, contract month).

    The contract lies one month ahead, and as many more as order and ship month are apart, so that
    every line is a point.
    """
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice",
        F.trunc("l_shipdate", "month").alias("shipped"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.trunc("o_orderdate", "month").alias("curvedate"),
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("curveroot")
    )
    ahead = 1 + F.abs(F.months_between("shipped", "curvedate")).cast("int")
    return (
        items.join(orders, "l_orderkey")
        .withColumn("contract", F.add_months("curvedate", ahead))
        .join(parts, "l_partkey")
        .groupBy("curveroot", "curvedate", "contract")
        .agg((F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
              / F.count("*")).alias("value"))
    )


def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (symbol, day) records act as revisions, stamped by line number."""
    return trades(spark, sf_dir).withColumn(
        "lastupdatetime", F.col("tradedatetimeutc") + F.make_dt_interval(hours=F.col("line"))
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rate per (currency, source); at most 12 series, one value a day."""
    orders = table(spark, sf_dir, "orders")
    ccy = F.element_at(
        F.array(*[F.lit(c) for c in ("USD", "EUR", "GBP", "JPY")]),
        (F.col("o_custkey") % 4 + 1).cast("int"),
    )
    source = F.element_at(
        F.array(*[F.lit(c) for c in ("ECB", "BOE", "USF")]),
        (F.col("o_custkey") % 3 + 1).cast("int"),
    )
    return orders.groupBy(
        ccy.alias("currency"), source.alias("source"), F.col("o_orderdate").alias("ts")
    ).agg((F.min("o_totalprice") / 100000).alias("rate"))


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One holiday per (calendar, month): the first order day of an order priority."""
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.col("o_orderpriority").alias("calendar"), F.trunc("o_orderdate", "month").alias("month")
    ).agg(F.to_date(F.min("o_orderdate")).alias("holiday")).drop("month")


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-attribute-value rows from parts and labels."""
    part = table(spark, sf_dir, "part")
    labels = table(spark, sf_dir, "labels")
    return (
        part.select(
            _symbol("p_partkey").alias("symbol"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
            F.col("p_size").cast("string").alias("size"),
        )
        .unpivot("symbol", ["brand", "type", "size"], "property", "value")
        .unionByName(
            labels.select(
                F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("symbol"),
                F.col("quality").cast("string").alias("quality"),
                F.col("toxic").cast("string").alias("toxic"),
            ).unpivot("symbol", ["quality", "toxic"], "property", "value")
        )
    )


def folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder path from the page address without scheme, query and fragment; member = page."""
    path = F.regexp_replace(F.col("url"), r"^[a-z]+://|[?#].*$", "")
    return table(spark, sf_dir, "pages").select(
        F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("path"),
        F.concat(F.lit("G"), F.col("page_id").cast("string")).alias("symbol"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitemporal long series: ondate = order date, index = first ship time of the order's lines."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("ondate"),
    )
    return (
        items.join(orders, "l_orderkey")
        .groupBy(_symbol("l_partkey").alias("symbol"), F.lit("CLOSE").alias("field"), "ondate",
                 F.col("l_shipdate").alias("index"))
        .agg(F.max("l_extendedprice").alias("value"))
    )


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option contracts: strike = list price, underlier = brand, spot set around the strike."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return part.select(
        _symbol("p_partkey").alias("symbol"),
        F.col("p_brand").alias("underlier"),
        F.add_months(F.lit("2024-01-15").cast("date"), (k % 4 * 3 + 3).cast("int")).alias("expiry"),
        F.when(k % 2 == 0, "C").otherwise("P").alias("callput"),
        F.col("p_retailprice").alias("strike"),
        (F.col("p_retailprice") * (0.9 + 0.05 * (k % 5))).alias("underprice"),
        (0.15 + 0.01 * (F.col("p_size") % 20)).alias("vol"),
    )
