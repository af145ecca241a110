"""Upserts, deletes and corrections, table to table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from tidemark.functions import keys
from tidemark.operators import conform, mutate
from tidemark.session import shared_dir
from tidemark.sources.store import Store
from tidemark.sources import views

MIDYEAR = dt.date(1998, 1, 1)


@check("refresh_instruments", over("instruments", then="""
    SELECT symbol, exchange_code, CASE WHEN seq % 2 = 0 AND supplier IS NULL THEN 'old' ELSE 'new'
           END AS description,
           CASE WHEN supplier IS NULL THEN TIMESTAMP '2024-01-01' ELSE
                CASE WHEN seq % 2 = 0 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-06-03' END END
           AS created_at,
           CASE WHEN seq % 2 = 0 AND supplier IS NULL THEN TIMESTAMP '2024-01-01'
                ELSE TIMESTAMP '2024-06-03' END AS updated_at
    FROM instruments WHERE supplier IS NOT NULL OR seq % 2 = 0
    UNION ALL SELECT symbol, exchange_code, 'new', TIMESTAMP '2024-06-03', TIMESTAMP '2024-06-03'
    FROM instruments WHERE supplier IS NULL AND seq % 2 = 1 AND rownum::INT > 25"""))
def refresh_instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: even parts. Incoming: supplied parts and large odd ones. Known keys keep created_at."""
    base = views.instruments(spark, sf_dir)
    base = base.withColumn("instrument_hash", keys.instrument_hash(base.drop("seq")))

    def at(df: DataFrame, text: str, when: dt.datetime) -> DataFrame:
        return conform.with_instrument_audit(df.withColumn("description", F.lit(text)), when)

    stored = at(base.where(F.col("seq") % 2 == 0), "old",
                dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    large_odd = (F.col("seq") % 2 == 1) & (F.col("rownum").cast("int") > 25)
    incoming = at(base.where(F.col("supplier").isNotNull() | large_odd), "new",
                  dt.datetime(2024, 6, 3, tzinfo=dt.timezone.utc))
    return mutate.refresh_instruments(stored, incoming).select(
        "symbol", "exchange_code", "description", "created_at", "updated_at")


@check("update_timeseries", over("series", then=f""", stored AS (
        SELECT * FROM series WHERE ondate < DATE '1998-01-01'),
    incoming AS (SELECT symbol, field, ondate, index, value + 1 AS value FROM series
                 WHERE ondate >= DATE '1997-07-01')
    SELECT symbol, field, {day('ondate')} AS ondate, index, value FROM incoming
    UNION ALL SELECT symbol, field, {day('ondate')}, index, value FROM stored s
    WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.symbol = s.symbol AND i.field = s.field
                      AND i.ondate = s.ondate AND i.index = s.index)"""))
def update_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: curve dates before 1998. Incoming: those from July 1997 on, with other values."""
    series = views.series(spark, sf_dir)
    stored = series.where(F.col("ondate") < F.lit(MIDYEAR))
    incoming = series.where(F.col("ondate") >= F.lit(dt.date(1997, 7, 1))).select(
        "symbol", "field", "ondate", "index", (F.col("value") + 1).alias("value"))
    return mutate.update_timeseries(stored, incoming)


@check("update_timeseries_monthly", """
    SELECT 'P' || l_partkey AS symbol, 'CLOSE' AS field, CAST(NULL AS VARCHAR) AS ondate,
           date_trunc('month', l_shipdate)::TIMESTAMP AS index,
           arg_max(l_extendedprice, (l_orderkey, l_linenumber)) AS value
    FROM lineitem GROUP BY 1, 4""")
def update_timeseries_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undated text rows with a monthly frequency; the last line of a month wins."""
    body = views.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("SYMBOL"), F.lit("CLOSE").alias("FIELD"),
        F.lit("").alias("ONDATE"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("INDEX"),
        F.col("l_extendedprice").alias("VALUE"), "l_orderkey", "l_linenumber",
    )
    rows = mutate.series_rows(body, "1M", keep=["l_orderkey", "l_linenumber"])
    empty = rows.select("symbol", "field", "ondate", "index", "value").limit(0)
    return mutate.update_timeseries(
        empty, rows, [F.desc("l_orderkey"), F.desc("l_linenumber")])


@check("delete_timeseries", over("series", then=f"""
    SELECT symbol, field, {day('ondate')} AS ondate, index, value FROM series s
    WHERE NOT EXISTS (SELECT 1 FROM series d WHERE d.symbol = s.symbol AND d.ondate = s.ondate
                      AND d.index = s.index AND d.index < TIMESTAMP '1998-01-01')"""))
def delete_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items name every point before 1998."""
    series = views.series(spark, sf_dir)
    items = series.where(
        F.col("index") < F.lit(dt.datetime(1998, 1, 1, tzinfo=dt.timezone.utc))
    ).select("symbol", "field", F.col("ondate").alias("curvedate"),
             F.array("index").alias("indexes"))
    return mutate.delete_timeseries(series, items)


@check("delete_undated_points", over("daily", then="""
    SELECT symbol, 'CLOSE' AS field, CAST(NULL AS VARCHAR) AS ondate, tradedatetimeutc AS index,
           close AS value FROM daily WHERE currency <> 'USD'"""))
def delete_undated_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL curve date names the undated series: the comparison is NULL-safe."""
    daily = views.daily(spark, sf_dir)
    stored = daily.select(
        "symbol", F.lit("CLOSE").alias("field"), F.lit(None).cast("date").alias("ondate"),
        F.col("tradedatetimeutc").alias("index"), F.col("close").alias("value"))
    items = daily.where(F.col("currency") == "USD").select(
        "symbol", F.lit("CLOSE").alias("field"), F.lit(None).cast("date").alias("curvedate"),
        F.array("tradedatetimeutc").alias("indexes"))
    return mutate.delete_timeseries(stored, items)


@check("update_prices_wide", """
    SELECT 'P' || l_partkey AS symbol, f.field, CAST(NULL AS VARCHAR) AS ondate,
           l_shipdate AS index, l_orderkey, l_linenumber,
           CASE f.field WHEN 'CLOSE' THEN l_extendedprice ELSE l_quantity END AS value
    FROM lineitem CROSS JOIN (VALUES ('CLOSE'), ('HIGH')) f(field)
    WHERE f.field = 'CLOSE' OR l_linenumber <= 3""")
def update_prices_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows with day-first dates to long rows; empty cells give no row."""
    wide = views.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("SYMBOL"),
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("DATE"),
        F.col("l_extendedprice").alias("CLOSE"),
        F.when(F.col("l_linenumber") <= 3, F.col("l_quantity")).alias("HIGH"),
        "l_orderkey", "l_linenumber")
    return mutate.update_prices_long(wide, keep=["l_orderkey", "l_linenumber"])


@check("update_metadata_wide", """
    SELECT DISTINCT 'P' || p_partkey AS symbol, m.property,
           CASE m.property WHEN 'CURRENCY' THEN 'USD' WHEN 'UNIT' THEN p_type
                ELSE CAST(p_size AS VARCHAR) END AS value
    FROM part CROSS JOIN (VALUES ('CURRENCY'), ('UNIT'), ('DENSITY')) m(property)
    WHERE m.property <> 'UNIT' OR p_size > 10""")
def update_metadata_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptive and star-marked columns to metadata rows; empty cells are skipped."""
    wide = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("SYMBOL"), F.lit("01-04-2023").alias("DATE"),
        F.col("p_retailprice").alias("CLOSE"), F.lit("USD").alias("CURRENCY"),
        F.when(F.col("p_size") > 10, F.col("p_type")).otherwise("").alias("UNIT"),
        F.col("p_size").alias("*DENSITY"))
    return mutate.update_metadata_long(wide)


@check("update_folder_paths", """
    SELECT DISTINCT 'DOC/' || p_type AS path, 'P' || p_partkey AS symbol FROM part
    WHERE p_size > 20""")
def update_folder_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("SYMBOL"),
        F.when(F.col("p_size") > 20, F.concat(F.lit("\\DOC\\"), "p_type")).otherwise("")
        .alias("FOLDER_PATH"))
    return mutate.update_folders(wide)


@check("update_curve_points", over("curve", then=f""", stored AS (
        SELECT curveroot AS symbol, curvedate AS "onDate", strftime(contract, '%YM%m') AS tenor, value
        FROM curve WHERE curvedate < DATE '1998-01-01'),
    incoming AS (SELECT curveroot AS symbol, curvedate AS "onDate",
                        strftime(contract, '%YM%m') AS tenor, value / 2 AS value
                 FROM curve WHERE curvedate >= DATE '1997-06-01')
    SELECT symbol, {day('"onDate"')} AS "onDate", tenor, value, 'Update' AS reason
    FROM incoming
    UNION ALL SELECT symbol, {day('"onDate"')}, tenor, value, 'Load' FROM stored s
    WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.symbol = s.symbol
                      AND i."onDate" = s."onDate" AND i.tenor = s.tenor)"""), digits=None)
def update_curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One body per curve and date, its tenors as an array."""
    points = views.curve(spark, sf_dir).select(
        F.col("curveroot").alias("symbol"), F.col("curvedate").alias("onDate"),
        F.lit("CLOSE").alias("field"), F.date_format("contract", "yyyy'M'MM").alias("tenor"),
        "value")
    stored = mutate.with_reason(points.where(F.col("onDate") < F.lit(MIDYEAR)), "Load")
    body = (
        points.where(F.col("onDate") >= F.lit(dt.date(1997, 6, 1)))
        .groupBy("symbol", "onDate", "field", F.lit("Update").alias("reason"))
        .agg(F.collect_list(F.struct("tenor", (F.col("value") / 2).alias("value")))
             .alias("tenors"))
    )
    return mutate.update_curves(stored, body).drop("field")


@check("curve_configuration", """
    SELECT 'input' AS part, 'P' || p_partkey AS symbol, p_brand AS name, p_type AS value FROM part
    UNION ALL SELECT 'setting', 'P' || p_partkey, s.name, CAST(p_size AS VARCHAR)
    FROM part CROSS JOIN (VALUES ('A'), ('B')) s(name)
    UNION ALL SELECT 'curve', 'P' || p_partkey, p_name, 'Formula' FROM part""")
def curve_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string").alias("value")
    body = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"), F.col("p_name").alias("name"),
        F.array(F.struct(F.col("p_brand").alias("role"), F.col("p_type").alias("product")))
        .alias("inputs"),
        F.array(F.struct(F.lit("A").alias("name"), size), F.struct(F.lit("B").alias("name"), size))
        .alias("settings"),
        F.struct(F.lit("Formula").alias("buildType")).alias("build"),
    )
    parts = mutate.curve_configuration(body)
    return (
        parts["inputs"].select(F.lit("input").alias("part"), "symbol", F.col("role").alias("name"),
                               F.col("product").alias("value"))
        .unionByName(parts["settings"].select(F.lit("setting").alias("part"), "symbol", "name",
                                              "value"))
        .unionByName(parts["curve"].select(F.lit("curve").alias("part"), "symbol", "name",
                                           F.col("buildType").alias("value")))
    )


@check("delete_symbols", over("daily", then="""
    SELECT symbol, count(*) AS n FROM daily
    WHERE symbol NOT IN (SELECT 'P' || p_partkey FROM part WHERE p_type = 'ECONOMY')
      AND symbol NOT IN ('P1', 'P2') GROUP BY 1"""))
def delete_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = views.instruments(spark, sf_dir).where(F.col("security_type") == "ECONOMY")
    kept = mutate.delete_symbol(views.daily(spark, sf_dir), gone)
    return mutate.delete_symbol(kept, ["P1", "P2"]).groupBy("symbol").agg(F.count("*").alias("n"))


@check("update_metadata", over("metadata", then="""
    SELECT symbol, property, value FROM metadata
    WHERE NOT (starts_with(symbol, 'P') AND property = 'brand')
    UNION ALL SELECT 'P' || p_partkey, 'brand', upper(p_brand) FROM part
    UNION ALL SELECT 'P' || p_partkey, 'colour', p_name FROM part WHERE p_size > 30"""))
def update_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("SYMBOL"), F.upper("p_brand").alias("brand"),
        F.when(F.col("p_size") > 30, F.col("p_name")).alias("colour"))
    return mutate.update_metadata(views.metadata(spark, sf_dir), items)


@check("delete_metadata", over("metadata", then="""
    SELECT symbol, property, value FROM metadata
    WHERE NOT (property IN ('brand', 'size') AND symbol IN
               (SELECT 'P' || p_partkey FROM part WHERE p_type = 'PROMO'))"""))
def delete_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.table(spark, sf_dir, "part").where(F.col("p_type") == "PROMO").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"),
        F.array(F.lit("brand"), F.lit("size")).alias("properties"))
    return mutate.delete_metadata(views.metadata(spark, sf_dir), items)


@check("update_folders", over("folders", then="""
    , incoming AS (SELECT DISTINCT path || '/SUB' AS path, CAST(NULL AS VARCHAR) AS symbol FROM folders
                   UNION SELECT DISTINCT path, 'NEW' FROM folders)
    SELECT path, symbol, 'Load' AS reason FROM (SELECT DISTINCT path, symbol FROM folders)
    UNION ALL SELECT path, symbol, 'doc update' FROM incoming"""))
def update_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every folder gets a sub-folder and a member."""
    folders = views.folders(spark, sf_dir).distinct()
    stored = mutate.with_reason(folders, "Load")
    body = folders.select(F.col("path").alias("folderId")).distinct().select(
        "folderId", F.array(F.struct(F.lit("SUB").alias("name"))).alias("folders"),
        F.array(F.struct(F.lit("NEW").alias("symbol"))).alias("content"),
        F.lit("doc update").alias("reason"))
    return mutate.update_folder(stored, body)


@check("delete_folders", over("folders", then="""
    SELECT path, symbol FROM folders
    WHERE NOT (path = 'therha.example.com' OR starts_with(path, 'therha.example.com/'))"""))
def delete_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutate.delete_folder(views.folders(spark, sf_dir), ["therha.example.com"])


@check("load_status", """
    SELECT l_returnflag || l_linestatus AS run_id, count(*) AS inserted FROM lineitem
    GROUP BY 1 HAVING run_id = 'RF'""")
def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = views.table(spark, sf_dir, "lineitem").groupBy(
        F.concat("l_returnflag", "l_linestatus").alias("run_id")).agg(
        F.count("*").alias("inserted"))
    return mutate.load_status(audit, "RF")


@check("upsert_partitions", over("daily", then=f"""
    SELECT symbol, tradedatetimeutc, {day("date_trunc('month', tradedatetimeutc)")} AS trade_month,
           CASE WHEN tradedatetimeutc >= TIMESTAMP '1998-06-15' THEN close + 1 ELSE close END
           AS close FROM daily"""))
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table rewritten only in the months the batch touches."""
    store = Store(shared_dir(spark, "upsert"))
    rows = views.daily(spark, sf_dir).select(
        "symbol", "tradedatetimeutc", "close",
        F.to_date(F.date_trunc("month", "tradedatetimeutc")).alias("trade_month"))
    first = store.begin(spark)
    first.append("prices", rows, "trade_month")
    first.commit()
    cut = dt.datetime(1998, 6, 15, tzinfo=dt.timezone.utc)
    batch = rows.where(F.col("tradedatetimeutc") >= F.lit(cut)).withColumn(
        "close", F.col("close") + 1)
    keys = ["symbol", "tradedatetimeutc"]
    mutate.upsert_partitions(store, "prices", batch, keys, mutate.by_content(batch, keys))
    return store.read(spark, "prices")


@check("delete_partitions", over("daily", then=f"""
    SELECT symbol, tradedatetimeutc, {day("date_trunc('month', tradedatetimeutc)")} AS trade_month,
           close FROM daily
    WHERE tradedatetimeutc < TIMESTAMP '1998-06-01' OR (currency <> 'USD'
          AND tradedatetimeutc < TIMESTAMP '2000-01-01')"""))
def delete_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dollar row since June 1998 and all rows since 2000 are deleted from a stored table;
    months without any row left disappear."""
    store = Store(shared_dir(spark, "delete"))
    rows = views.daily(spark, sf_dir).select(
        "symbol", "tradedatetimeutc", "close", "currency",
        F.to_date(F.date_trunc("month", "tradedatetimeutc")).alias("trade_month"))
    first = store.begin(spark)
    first.append("prices", rows.drop("currency"), "trade_month")
    first.commit()
    since, last = (dt.datetime(y, m, 1, tzinfo=dt.timezone.utc) for y, m in ((1998, 6), (2000, 1)))
    t = F.col("tradedatetimeutc")
    gone = rows.where((t >= F.lit(since)) & ((F.col("currency") == "USD") | (t >= F.lit(last))))
    mutate.delete_partitions(store, "prices", gone, ["symbol", "tradedatetimeutc"])
    return store.read(spark, "prices")
