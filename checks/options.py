"""Option chains: strike windows, model values, Greeks, implied volatility."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base import check, day, over
from tidemark.functions.black import CDF_BOTTOM, CDF_TOP
from tidemark.operators import options
from tidemark.sources import views

VALUATION = dt.date(2024, 1, 2)


@check("strike_window", over("chain", then=f""", near AS (
        SELECT *, row_number() OVER (PARTITION BY underlier, expiry, callput
               ORDER BY abs(strike - underprice), strike, symbol) AS near FROM chain),
    placed AS (SELECT *, row_number() OVER (PARTITION BY underlier, expiry, callput
               ORDER BY strike, symbol) AS place FROM near WHERE near <= 6)
    SELECT symbol, underlier, {day('expiry')} AS expiry, callput, strike,
           (place - min(CASE WHEN near = 1 THEN place END)
               OVER (PARTITION BY underlier, expiry, callput))::DOUBLE AS atmindex
    FROM placed"""))
def strike_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return options.strike_window(views.chain(spark, sf_dir), 6).select(
        "symbol", "underlier", "expiry", "callput", "strike",
        F.col("atmindex").cast("double").alias("atmindex"))


@check("price_selection", over("chain", then="""
    SELECT symbol, CASE WHEN vol > 0.25 THEN strike ELSE underprice END AS price FROM chain"""),
       digits=None)
def price_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = views.chain(spark, sf_dir).withColumn(
        "settle", F.when(F.col("vol") > 0.25, F.col("strike")))
    return chain.select("symbol", options.chosen_price(["settle", "underprice"]).alias("price"))


def _cdf(x: str) -> str:
    def polynomial(coefficients: list[float]) -> str:
        out = f"{coefficients[0]!r}::DOUBLE"
        for c in coefficients[1:]:
            out = f"({out} * abs({x}) + {c!r}::DOUBLE)"
        return out

    # Every contract here lies within the range of the rational part.
    tail = f"(exp(-{x} * {x} / 2) * {polynomial(CDF_TOP)} / {polynomial(CDF_BOTTOM)})"
    return f"(CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END)"


def _greeks_sql(carry: str, rho: str, price: str = "underprice") -> str:
    return over("chain", then=f""", a AS (
        SELECT *, {price} AS s, date_diff('day', DATE '2024-01-02', expiry) / 365::DOUBLE AS t,
               0.03::DOUBLE AS r, {carry} AS b, CASE WHEN callput = 'C' THEN 1 ELSE -1 END AS phi
        FROM chain),
    d AS (SELECT *, (ln(s / strike) + (b + vol * vol / 2) * t) / (vol * sqrt(t)) AS d1,
                 exp((b - r) * t) AS g, exp(-r * t) AS df FROM a),
    n AS (SELECT *, d1 - vol * sqrt(t) AS d2, exp(-d1 * d1 / 2) / sqrt(2 * pi()) AS pdf FROM d),
    m AS (SELECT *, phi * d1 AS x1, phi * d2 AS x2 FROM n),
    c AS (SELECT *, {_cdf('x1')} AS n1, {_cdf('x2')} AS n2 FROM m)
    SELECT symbol, round(phi * (s * g * n1 - strike * df * n2), 6) AS value,
           round(phi * g * n1, 6) AS delta, round(g * pdf / (s * vol * sqrt(t)), 6) AS gamma,
           round(s * g * pdf * sqrt(t), 6) AS vega, round({rho}, 6) AS rho,
           round((-s * g * pdf * vol / (2 * sqrt(t)) - phi * (b - r) * s * g * n1
                  - phi * r * strike * df * n2) / 365, 6) AS theta
    FROM c""")


GREEKS = ["symbol", "value", "delta", "gamma", "vega", "rho", "theta"]


@check("option_greeks", _greeks_sql("(0.03 - 0.01)::DOUBLE", "phi * strike * t * df * n2"))
def option_greeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return options.analytics(
        views.chain(spark, sf_dir), VALUATION, rate=0.03, dividend=0.01).select(*GREEKS)


@check("futures_option_greeks", _greeks_sql(
    "0::DOUBLE", "-t * phi * (s * g * n1 - strike * df * n2)"))
def futures_option_greeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return options.analytics(
        views.chain(spark, sf_dir), VALUATION, rate=0.03, futures=True).select(*GREEKS)


@check("implied_volatility", over("chain", then="""
    SELECT symbol, round(vol, 4) AS impvol FROM chain"""), digits=4)
def implied_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model value of each contract must imply the volatility it was computed with."""
    priced = options.analytics(views.chain(spark, sf_dir), VALUATION, rate=0.03, dividend=0.01)
    chain = priced.select("symbol", "callput", "strike", "expiry", "underprice", "vol",
                          F.col("value").alias("settle"))
    return options.analytics(
        chain, VALUATION, rate=0.03, dividend=0.01, contract_price=["settle"]
    ).select("symbol", "impvol")
