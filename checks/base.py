"""Registry of queries, output normalisation, and the SQL text of the market-data views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def emit(df: DataFrame, digits: int | None) -> DataFrame:
    """Comparable output: doubles rounded, dates as text, times without a zone.

    Where both sides do the same few operations the doubles are equal to the last bit, and are left
    alone (``digits=None``): rounding would only add ties that the two engines break differently.
    """
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("double", "float"):
            c = c.cast("double") if digits is None else F.round(c.cast("double"), digits)
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def check(name: str, sql: str | None = None, digits: int | None = 6) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return emit(query(spark, sf_dir), digits)

        REGISTRY[name] = (run, sql)
        return query

    return add


# --- SQL twins of tidemark.sources.views ---------------------------------------------------------

VIEWS: dict[str, str] = {
    "instruments": """
        SELECT 'P' || p_partkey AS symbol, p_brand AS exchange_code, p_name AS description,
               p_type AS security_type, '/' || p_type AS option_root,
               CAST(p_retailprice AS VARCHAR) AS strike_price,
               CASE WHEN p_partkey % 3 = 0 THEN 'SUP' END AS supplier,
               CAST(p_size AS VARCHAR) AS rownum, p_partkey AS seq
        FROM part""",
    "trades": """
        SELECT 'P' || l_partkey AS symbol, l_shipdate AS tradedatetimeutc,
               l_extendedprice AS close, l_quantity AS volume, l_orderkey AS ord,
               l_linenumber AS line,
               (['USD','USC','EUR','GBC','JPY'])[l_suppkey % 5 + 1] AS currency,
               l_returnflag AS version
        FROM lineitem""",
    "daily": """
        SELECT * FROM trades
        QUALIFY row_number() OVER (PARTITION BY symbol, tradedatetimeutc ORDER BY ord, line) = 1""",
    "ticks": """
        SELECT event_type AS symbol, ts, value AS last, 1 AS volume, event_id AS seq, user_id, props
        FROM events""",
    "curve": """
        SELECT p_type AS curveroot, date_trunc('month', o_orderdate)::DATE AS curvedate,
               (date_trunc('month', o_orderdate)
                + to_months(1 + abs(date_diff('month', o_orderdate, l_shipdate))::INT))::DATE AS contract,
               sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(*) AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY 1, 2, 3""",
    "corrections": """
        SELECT *, tradedatetimeutc + to_hours(line) AS lastupdatetime FROM trades""",
    "rates": """
        SELECT (['USD','EUR','GBP','JPY'])[o_custkey % 4 + 1] AS currency,
               (['ECB','BOE','USF'])[o_custkey % 3 + 1] AS source, o_orderdate AS ts,
               min(o_totalprice) / 100000 AS rate
        FROM orders GROUP BY 1, 2, 3""",
    "holidays": """
        SELECT o_orderpriority AS calendar, min(o_orderdate)::DATE AS holiday
        FROM orders GROUP BY o_orderpriority, date_trunc('month', o_orderdate)""",
    "calendars": "SELECT DISTINCT calendar FROM holidays",
    "metadata": """
        SELECT 'P' || p_partkey AS symbol, 'brand' AS property, p_brand AS value FROM part
        UNION ALL SELECT 'P' || p_partkey, 'type', p_type FROM part
        UNION ALL SELECT 'P' || p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part
        UNION ALL SELECT 'D' || doc_id, 'quality', CAST(quality AS VARCHAR) FROM labels
        UNION ALL SELECT 'D' || doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM labels""",
    "folders": """
        SELECT regexp_extract(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''),
                              '^(.*)/[^/]*$', 1) AS path,
               'G' || page_id AS symbol
        FROM pages""",
    "series": """
        SELECT 'P' || l_partkey AS symbol, 'CLOSE' AS field, o_orderdate::DATE AS ondate,
               l_shipdate AS index, max(l_extendedprice) AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""",
    "chain": """
        SELECT 'P' || p_partkey AS symbol, p_brand AS underlier,
               (DATE '2024-01-15' + to_months((p_partkey % 4 * 3 + 3)::INT))::DATE AS expiry,
               CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS callput,
               p_retailprice AS strike,
               p_retailprice * (0.9::DOUBLE + 0.05::DOUBLE * (p_partkey % 5)) AS underprice,
               0.15::DOUBLE + 0.01::DOUBLE * (p_size % 20) AS vol
        FROM part""",
}
NEEDS = {"daily": ["trades"], "corrections": ["trades"], "calendars": ["holidays"]}


def over(*names: str, then: str) -> str:
    """``WITH`` the named views, ``then`` the statement (which may add more after a comma)."""
    wanted: list[str] = []
    for name in names:
        for view in [*NEEDS.get(name, []), name]:
            if view not in wanted:
                wanted.append(view)
    ctes = ",".join(f" {v} AS ({VIEWS[v]})" for v in wanted)
    return f"WITH{ctes} {then}"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"
