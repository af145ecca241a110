"""Casting, keys and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from tidemark import schemas
from tidemark.functions import casting, keys, money, tenors
from tidemark.operators import conform, ingest
from tidemark.plans import jobs
from tidemark.sources import views


@check("instrument_hash", over("instruments", then="""
    SELECT symbol, sha256('exchange_code:' || lower(exchange_code) || '|option_root:'
           || lower(option_root) || '|security_type:' || lower(security_type)
           || '|symbol:' || lower(symbol)) AS instrument_hash
    FROM instruments"""))
def instrument_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.instruments(spark, sf_dir)
    return df.select("symbol", keys.instrument_hash(df).alias("instrument_hash"))


@check("instrument_hash_spare", """
    SELECT p_partkey, sha256('description:' || p_name || CASE WHEN p_size > 25
           THEN '' ELSE '|display_date2:b|display_date:a' END || '|rownum:' || p_size)
           AS instrument_hash
    FROM part""")
def instrument_hash_spare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No key column is set: every other column makes the key."""
    small = F.col("p_size") <= 25
    df = views.table(spark, sf_dir, "part").select(
        "p_partkey", F.lit(None).cast("string").alias("symbol"),
        F.concat(F.lit(" "), F.upper("p_name"), F.lit("\n")).alias("description"),
        F.when(small, "A").alias("display_date"), F.when(small, "b").alias("display_date2"),
        F.col("p_size").cast("string").alias("rownum"),
    )
    return df.select("p_partkey", keys.instrument_hash(df).alias("instrument_hash"))


@check("instrument_without_any_value", """
    SELECT p_brand, 'key missing' AS reason, count(*) AS n FROM part WHERE p_size <= 10
    GROUP BY 1""")
def instrument_without_any_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with no value at all have no reproducible key and go to the quarantine."""
    df = views.table(spark, sf_dir, "part").select(
        "p_brand", F.when(F.col("p_size") > 10, F.col("p_name")).alias("description"),
        F.lit("nan").alias("symbol"),
    )
    marked = jobs.keyed(df, jobs.INSTRUMENTS)
    return marked.where(F.col("reason").isNotNull()).groupBy("p_brand", "reason").agg(
        F.count("*").alias("n"))


@check("price_hash", """
    SELECT l_orderkey, l_partkey, l_linenumber,
           sha256('pricesymbol:' || lower(l_returnflag) || '|symbol:p' || l_partkey
                  || '|tradedatetimeutc:' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))
           AS price_hash
    FROM lineitem""")
def price_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks, case and fractions of a second do not change a key."""
    df = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.concat(F.lit("\t P"), "l_partkey", F.lit(" ")).alias("symbol"),
        (F.col("l_shipdate") + F.make_dt_interval(
            secs=F.col("l_linenumber").cast("decimal(18,6)") / 10)).alias("tradedatetimeutc"),
        F.col("l_returnflag").alias("pricesymbol"),
    )
    return df.select("l_orderkey", "l_partkey", "l_linenumber",
                     keys.price_hash(df).alias("price_hash"))


@check("price_hash_spare", """
    SELECT l_orderkey, l_partkey, l_linenumber,
           sha256('market:' || l_returnflag || '|tickcount:' || l_linenumber) AS price_hash
    FROM lineitem""")
def price_hash_spare(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.lit(None).cast("string").alias("symbol"),
        F.lit(None).cast("timestamp").alias("tradedatetimeutc"),
        F.col("l_returnflag").alias("market"),
        F.col("l_linenumber").cast("bigint").alias("tickcount"),
    )
    return df.select("l_orderkey", "l_partkey", "l_linenumber",
                     keys.price_hash(df).alias("price_hash"))


@check("parse_numbers", """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CASE l_linenumber WHEN 1 THEN l_quantity WHEN 2 THEN -l_quantity
                WHEN 6 THEN 1000::DOUBLE END AS as_int,
           CASE l_linenumber WHEN 1 THEN l_quantity + 0.5::DOUBLE
                WHEN 2 THEN -(l_quantity + 0.5::DOUBLE) WHEN 6 THEN 1000::DOUBLE END AS as_float,
           CASE l_linenumber WHEN 1 THEN l_quantity + 0.5::DOUBLE
                WHEN 2 THEN -(l_quantity + 0.5::DOUBLE) END AS as_numeric
    FROM lineitem""", digits=None)
def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, line = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")
    text = (
        F.when(line == 1, F.concat(F.lit(" "), n, F.lit(".5")))
        .when(line == 2, F.concat(F.lit("-"), n, F.lit(".5e0")))
        .when(line == 3, "x").when(line == 4, "nan").when(line == 5, "1.0d")
        .when(line == 6, "1_000").otherwise("")
    )
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        casting.parse_int(text).cast("double").alias("as_int"),
        casting.nan_to_null(casting.parse_float(text)).alias("as_float"),
        casting.to_numeric(text).alias("as_numeric"),
    )


@check("parse_datetimes", """
    SELECT event_id, CASE event_id % 6
           WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
           WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('minute', ts)
           WHEN 4 THEN date_trunc('day', ts) END AS parsed
    FROM events""")
def parse_datetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, ts = F.col("event_id") % 6, F.col("ts")
    text = (
        F.when(kind == 0, F.date_format(ts, "M/d/yyyy h:mm:ss a"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == 3, F.date_format(ts, "M/d/yyyy H:mm"))
        .when(kind == 4, F.date_format(ts, "dd-MM-yyyy")).otherwise("junk")
    )
    return views.table(spark, sf_dir, "events").select(
        "event_id", casting.parse_datetime(text, casting.DAY_FIRST).alias("parsed"))


@check("sentinels_and_normal_text", """
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS kept,
           lower(source) AS plain, sha256(lower(source)) AS digest
    FROM documents""")
def sentinels_and_normal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(F.col("doc_id") % 3 == 0, "NaN").otherwise(F.col("lang"))
    text = F.concat(F.lit("　 \t"), F.upper("source"), F.lit("\n"))
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", casting.null_if_in(word, schemas.PRICE_SENTINELS).alias("kept"),
        casting.normalise(text).alias("plain"),
        F.sha2(casting.normalise(text), 256).alias("digest"),
    )


@check("second_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events")
def second_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", casting.second_text(F.col("ts")).alias("text"))


ZONES = {"click": "America/New_York", "view": "Europe/Berlin", "purchase": "Asia/Tokyo",
         "signup": "Asia/Kolkata", "error": "UTC"}


def zone_of(symbol):
    out = F.lit("UTC")
    for name, zone in ZONES.items():
        out = F.when(symbol == name, zone).otherwise(out)
    return out


ZONE_SQL = "CASE event_type " + " ".join(
    f"WHEN '{n}' THEN '{z}'" for n, z in ZONES.items()) + " END"


@check("time_zones", f"""
    SELECT event_id, (ts::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS chicago,
           (ts::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE ({ZONE_SQL}) AS publisher
    FROM events""")
def time_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", money.local_time(F.col("ts"), "America/Chicago").alias("chicago"),
        money.local_time(F.col("ts"), zone_of(F.col("event_type"))).alias("publisher"),
    )


@check("minor_currencies", over("daily", then="""
    SELECT symbol, tradedatetimeutc,
           CASE currency WHEN 'USC' THEN 'USD' WHEN 'GBC' THEN 'GBP' ELSE currency END AS major,
           CASE WHEN currency IN ('USC', 'GBC') THEN close / 100 ELSE close END AS value
    FROM daily"""), digits=None)
def minor_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.daily(spark, sf_dir).select(
        "symbol", "tradedatetimeutc", money.major_currency(F.col("currency")).alias("major"),
        money.major_value(F.col("close"), F.col("currency")).alias("value"),
    )


@check("conversion_formula", """
    SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'P' || p_partkey
        ELSE '=""P' || p_partkey || '"";[' || CASE p_size % 4 WHEN 1 THEN '@EUR:ECB'
             WHEN 2 THEN '@BBL:7.5' ELSE '@EUR,@BBL' END || ']' END AS formula
    FROM part""")
def conversion_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_size") % 4
    return views.table(spark, sf_dir, "part").select(
        "p_partkey",
        money.conversion_formula(
            F.concat(F.lit("P"), "p_partkey"),
            F.when(kind % 2 == 1, "EUR").otherwise(""), F.when(kind == 1, "ECB").otherwise(""),
            F.when(kind >= 2, "BBL"), F.when(kind == 2, 7.5).otherwise(0.0),
        ).alias("formula"),
    )


@check("tenor_starts", f"""
    SELECT o_orderkey, {day('''CASE o_orderkey % 6
        WHEN 0 THEN date_trunc('month', o_orderdate) + INTERVAL 2 MONTH
        WHEN 1 THEN date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH
        WHEN 2 THEN date_trunc('year', o_orderdate) + INTERVAL 1 YEAR
        WHEN 3 THEN TIMESTAMP '2025-06-01' WHEN 4 THEN TIMESTAMP '2025-07-01'
        ELSE date_trunc('month', o_orderdate)
             + to_months(CASE WHEN month(o_orderdate) IN (6, 8) THEN 1 ELSE 0 END) END''')} AS start,
        CASE o_orderkey % 6 WHEN 1 THEN 3 WHEN 2 THEN 12 WHEN 4 THEN 3 ELSE 1 END AS months
    FROM orders""")
def tenor_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, on = F.col("o_orderkey") % 6, F.to_date("o_orderdate")
    # Month codes name years from 2000 on: the order years are moved there and back. The codes of
    # June and August (M24, Q24) read as relative months and quarters, so those use the next month.
    moved = F.add_months(on, F.when(F.month(on).isin(6, 8), 241).otherwise(240))
    tenor = (
        F.when(kind == 0, "M02").when(kind == 1, "Q01").when(kind == 2, "Y01")
        .when(kind == 3, "2025M06").when(kind == 4, "2025Q03")
        .otherwise(tenors.month_code(moved))
    )
    start = tenors.tenor_start(tenor, on)
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(kind == 5, F.add_months(start, -240)).otherwise(start).alias("start"),
        tenors.tenor_months(tenor).alias("months"),
    )


@check("contract_starts", f"""
    SELECT o_orderkey, {day("date_trunc('month', o_orderdate) + INTERVAL 240 MONTH")} AS start FROM orders""")
def contract_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract part of a symbol is a month code, whatever the letter: all twelve months."""
    code = tenors.month_code(F.add_months(F.to_date("o_orderdate"), 240))
    symbol = F.concat(F.lit("#CH.CAT.S"), "o_custkey", F.lit("/"), code)
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", tenors.contract_start(symbol).alias("start"))


@check("double_texts", """
    SELECT l_orderkey, l_linenumber, CAST(l_extendedprice::DOUBLE * pow(10::DOUBLE, l_linenumber % 4 * 3) AS VARCHAR) AS text
    FROM lineitem""")
def double_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles on both sides of 1e7 keep plain digits in a key."""
    value = F.col("l_extendedprice").cast("double") * F.pow(F.lit(10.0), F.col("l_linenumber") % 4 * 3)
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", keys.double_text(value).alias("text"))


@check("tenor_texts", over("curve", then=f"""
    SELECT curveroot, {day('curvedate')} AS curvedate, {day('contract')} AS contract,
           'M' || lpad(date_diff('month', curvedate, contract)::VARCHAR, 2, '0') AS relative,
           strftime(contract, '%YM%m') AS absolute
    FROM curve"""))
def tenor_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.curve(spark, sf_dir).select(
        "curveroot", "curvedate", "contract",
        tenors.relative_tenor(F.col("contract"), F.col("curvedate")).alias("relative"),
        tenors.absolute_tenor(F.col("contract")).alias("absolute"),
    )


@check("contract_symbols", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '#CH.CAT.S' || o_custkey ELSE '/GCL' END
           AS root, CASE WHEN o_orderkey % 2 = 0 THEN 'F24' END AS contract
    FROM orders""")
def contract_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbol = F.when(
        F.col("o_orderkey") % 2 == 0, F.concat(F.lit("#CH.CAT.S"), "o_custkey", F.lit("/F24"))
    ).otherwise("/GCL")
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", tenors.root_part(symbol).alias("root"),
        tenors.contract_part(symbol).alias("contract"),
    )


@check("json_attributes", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CAST(json_extract(props, '$.k') AS VARCHAR) AS k_text
    FROM events""")
def json_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", casting.json_attribute("props", "k", "bigint").alias("k"),
        casting.json_attribute("props", "k").alias("k_text"),
    )


@check("year_fraction", """
    SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') / 360.0::DOUBLE
           AS years FROM orders""", digits=None)
def year_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.lit(dt.date(2002, 1, 1))
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", money.year_fraction(F.to_date("o_orderdate"), end, 360.0).alias("years"))


@check("field_pairs", over("daily", then="""
    SELECT symbol, close * 2 AS close, volume::BIGINT AS volume FROM daily"""))
def field_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.select_fields(
        views.daily(spark, sf_dir),
        ['"symbol"', ["close", lambda c: c * 2], ["volume", lambda c: c.cast("bigint")]],
    )


@check("field_preset", over("daily", then="""
    SELECT CAST(NULL AS VARCHAR) AS pricesymbol, tradedatetimeutc, CAST(NULL AS DOUBLE) AS open,
           CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS low, close, volume
    FROM daily"""))
def field_preset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.select_fields(views.daily(spark, sf_dir), "INTRADAY")


@check("columnar_body_to_rows", """
    SELECT 'P' || l_partkey AS "SYMBOL", l_shipdate AS "DATE", l_extendedprice AS "CLOSE",
           l_orderkey AS body FROM lineitem""")
def columnar_body_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One body per order: an order's lines as equal-length arrays, and back to rows."""
    bodies = views.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("body")
    ).agg(
        F.collect_list(F.struct(
            F.concat(F.lit("P"), "l_partkey").alias("s"), F.col("l_shipdate").alias("d"),
            F.col("l_extendedprice").alias("c"))).alias("x")
    ).select("body", F.col("x.s").alias("SYMBOL"), F.col("x.d").alias("DATE"),
             F.col("x.c").alias("CLOSE"))
    return conform.columnar_to_rows(bodies, ["SYMBOL", "DATE", "CLOSE"], ["body"])


@check("known_keys", over("daily", then="""
    SELECT upper(symbol) AS symbol, count(*) AS n FROM daily GROUP BY 1"""))
def known_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key scan of a history: only the key column is read."""
    from tidemark.sources.tables import existing_keys

    return existing_keys(views.daily(spark, sf_dir), "symbol").groupBy("symbol").agg(
        F.count("*").alias("n"))
