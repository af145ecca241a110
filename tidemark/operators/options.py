"""Option chains (rows G-1 to G-4)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import black
from tidemark.functions.money import year_fraction


def strike_window(chain: DataFrame, strikecount: int, callput: str | None = None,
                  underlier: str | None = None, tie: Sequence[str] = ("symbol",)) -> DataFrame:
    """The N strikes nearest the money per underlier, expiry and side, with a signed index.

    Index 0 is the nearest strike, negative ones lie below it. The N nearest are picked by a rank
    limit that also runs before the shuffle; the index is then counted over those N rows only.
    """
    if not isinstance(strikecount, int) or strikecount <= 0:
        raise ValueError("the strike count is a positive whole number")
    if callput is not None:
        chain = chain.where(F.col("callput") == callput)
    if underlier is not None:
        chain = chain.where(F.col("underlier") == underlier)
    group = ["underlier", "expiry", "callput"]
    nearest = F.row_number().over(
        W.partitionBy(*group).orderBy(
            F.abs(F.col("strike") - F.col("underprice")), "strike", *tie
        )
    )
    picked = chain.withColumn("_near", nearest).where(F.col("_near") <= strikecount)
    place = F.row_number().over(W.partitionBy(*group).orderBy("strike", *tie))
    placed = picked.withColumn("_place", place)
    atm = F.min(F.when(F.col("_near") == 1, F.col("_place"))).over(W.partitionBy(*group))
    return placed.withColumn("atmindex", F.col("_place") - atm).drop("_near", "_place")


def chosen_price(choices: Sequence[str]) -> Column:
    """First of the named price columns that has a value."""
    return F.coalesce(*choices)


def analytics(
    chain: DataFrame,
    valuation: Column | dt.date,
    volatility: Column | str = "vol",
    rate: float = 0.0,
    dividend: float = 0.0,
    foreign_rate: float | None = None,
    day_count: float = 365,
    futures: bool = False,
    underlier_price: Sequence[str] = ("underprice",),
    contract_price: Sequence[str] | None = None,
    model: str = "bs",
    volatility_bounds: tuple[float, float] = (1e-4, 5.0),
    steps: int = 30,
) -> DataFrame:
    """Model value, Greeks and, when a contract price is named, implied volatility per contract.

    The carry is 0 for a futures underlier, the rate difference when a foreign rate is given, else
    the rate less the dividend yield. Implied volatility is sought within ``volatility_bounds``; it
    is NULL where it lies outside or is not found in ``steps``.
    """
    if model != "bs":
        raise ValueError(f"unknown option model: {model}")
    vol = F.col(volatility) if isinstance(volatility, str) else volatility
    r = F.lit(float(rate))
    if futures:
        carry = F.lit(0.0)
    else:
        carry = F.lit(float(rate) - float(dividend if foreign_rate is None else foreign_rate))
    today = F.lit(valuation) if isinstance(valuation, dt.date) else valuation
    priced = chain.withColumns(
        {"_s": chosen_price(underlier_price),
         "_t": year_fraction(today, F.col("expiry"), float(day_count))}
    )
    s, k, t, side = F.col("_s"), F.col("strike"), F.col("_t"), F.col("callput")
    modelled = priced.withColumns(black.model_terms(side, s, k, t, vol, r, carry)).withColumns(
        black.model_probabilities())
    out = black.model_results(s, t, vol, r, carry, F.lit(float(day_count)), futures)
    if contract_price is not None:
        out["impvol"] = black.implied_volatility(
            chosen_price(contract_price), side, s, k, t, r, carry, *volatility_bounds, steps
        )
    names = [c for c in chain.columns if c not in out]
    return modelled.select(*names, *[c.alias(n) for n, c in out.items()])
