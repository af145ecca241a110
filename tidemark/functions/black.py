"""Black-Scholes-Merton value, Greeks and implied volatility as column expressions (G-3, G-4).

Spark has no error function: the normal distribution is Hart's rational approximation in the form
published by G. West, "Better approximations to cumulative normal functions" (2005).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the published approximation, highest power first.
CDF_TOP = [0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
           112.079291497871, 221.213596169931, 220.206867912376]
CDF_BOTTOM = [0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
              296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
CDF_NEAR = 7.07106781186547
TOLERANCE = 1e-12


def normal_pdf(x: Column) -> Column:
    return F.exp(-x * x / 2) / math.sqrt(2 * math.pi)


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def normal_cdf(x: Column) -> Column:
    a = F.abs(x)
    near = _polynomial(a, CDF_TOP) / _polynomial(a, CDF_BOTTOM)
    # Continued fraction for the far tail.
    far = a + 0.65
    for k in (4, 3, 2, 1):
        far = a + k / far
    tail = F.exp(-a * a / 2) * F.when(a < CDF_NEAR, near).otherwise(
        1 / (far * math.sqrt(2 * math.pi)))
    return F.when(x > 0, 1 - tail).otherwise(tail)


def _sign(callput: Column) -> Column:
    return F.when(callput == "C", 1.0).when(callput == "P", -1.0)


def model_terms(callput: Column, spot: Column, strike: Column, years: Column, vol: Column,
                rate: Column, carry: Column) -> dict[str, Column]:
    """First step of the model; ``carry`` is r-q for a dividend yield q, 0 for a futures underlier.

    Without time, volatility, price or strike there is nothing to divide by: ``_root`` and ``_d1`` are
    NULL then.
    """
    live = (years > 0) & (vol > 0) & (spot > 0) & (strike > 0)
    years = F.when(years < 0, 0.0).otherwise(years)  # what has expired is not discounted
    root = F.when(live, vol * F.sqrt(F.abs(years)))
    return {
        "_phi": _sign(callput),
        "_root": root,
        "_d1": F.when(live, (F.log(F.try_divide(spot, strike)) + (carry + vol * vol / 2) * years)) / root,
        "_spot": spot * F.exp((carry - rate) * years),
        "_strike": strike * F.exp(-rate * years),
    }


def model_probabilities() -> dict[str, Column]:
    """Second step, over the columns of the first."""
    phi, d1 = F.col("_phi"), F.col("_d1")
    return {
        "_n1": normal_cdf(phi * d1),
        "_n2": normal_cdf(phi * (d1 - F.col("_root"))),
        "_pdf": normal_pdf(d1),
    }


def model_results(spot: Column, years: Column, vol: Column, rate: Column, carry: Column,
                  day_count: Column, futures: bool = False) -> dict[str, Column]:
    """Model value and sensitivities; theta is per calendar day, vega and rho per unit change.

    Where the model has no terms (expired, or no volatility, price or strike) the value is what
    exercise at the forward price would give, and the sensitivities are NULL.
    """
    phi, s, k = F.col("_phi"), F.col("_spot"), F.col("_strike")
    n1, n2, pdf = F.col("_n1"), F.col("_n2"), F.col("_pdf")
    live = F.col("_root").isNotNull()
    value = F.when(live, phi * (s * n1 - k * n2)).otherwise(F.greatest(phi * (s - k), F.lit(0.0)))
    years = F.when(live, years)
    spot = F.when(live, spot)
    decay = (-s * pdf * vol / (2 * F.sqrt(years)) - phi * (carry - rate) * s * n1
             - phi * rate * k * n2)
    return {
        "value": value,
        "delta": phi * s / spot * n1,
        "gamma": s * pdf / (spot * spot * F.col("_root")),
        "vega": s * pdf * F.sqrt(years),
        "theta": decay / day_count,
        "rho": -years * value if futures else phi * years * k * n2,
    }


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` with ``value`` evaluated once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def implied_volatility(price: Column, callput: Column, spot: Column, strike: Column,
                       years: Column, rate: Column, carry: Column, low: float = 1e-4,
                       high: float = 5.0, steps: int = 30) -> Column:
    """Volatility whose model value is ``price``: Newton steps kept inside a shrinking bracket.

    A step that leaves the bracket is replaced by its middle, so the search always ends. It starts
    where the value bends as a function of volatility, from where Newton steps do not overshoot.
    NULL when the price lies outside the values the bracket can reach, when the search is not done
    after ``steps``, and where time, price or strike leave nothing to search for.
    """
    live = (years > 0) & (spot > 0) & (strike > 0)
    years, spot, strike = F.when(live, years), F.when(live, spot), F.when(live, strike)
    row = F.struct(
        price.alias("price"), _sign(callput).alias("phi"), F.sqrt(years).alias("sq"),
        years.alias("t"), (F.log(spot / strike) + carry * years).alias("drift"),
        (spot * F.exp((carry - rate) * years)).alias("sg"),
        (strike * F.exp(-rate * years)).alias("kd"),
    )

    def solve(o: Column) -> Column:
        def at(vol: Column, use: Callable[[Column], Column]) -> Column:
            """``use`` with d1, the miss of the model value and vega at one volatility."""
            root = vol * o["sq"]
            d1 = (o["drift"] + vol * vol / 2 * o["t"]) / root

            def with_d1(d: Column) -> Column:
                def with_cdf(n: Column) -> Column:
                    value = o["phi"] * (o["sg"] * n["n1"] - o["kd"] * n["n2"])
                    return _let(F.struct(
                        (value - o["price"]).alias("miss"),
                        (o["sg"] * normal_pdf(d["d1"]) * o["sq"]).alias("vega"),
                    ), use)

                return _let(F.struct(
                    _let(o["phi"] * d["d1"], normal_cdf).alias("n1"),
                    _let(o["phi"] * d["d2"], normal_cdf).alias("n2"),
                ), with_cdf)

            return _let(F.struct(d1.alias("d1"), (d1 - root).alias("d2")), with_d1)

        def step(acc: Column, _: Column) -> Column:
            def move(m: Column) -> Column:
                below = m["miss"] < 0
                bracket = F.struct(
                    F.when(below, acc["x"]).otherwise(acc["lo"]).alias("lo"),
                    F.when(below, acc["hi"]).otherwise(acc["x"]).alias("hi"),
                    (acc["x"] - m["miss"] / F.nullif(m["vega"], F.lit(0.0))).alias("x"),
                )
                return _let(bracket, lambda b: F.struct(
                    b["lo"].alias("lo"), b["hi"].alias("hi"),
                    F.when(b["x"].between(b["lo"], b["hi"]), b["x"])
                    .otherwise((b["lo"] + b["hi"]) / 2).alias("x"),
                    (F.abs(b["x"] - acc["x"]) < TOLERANCE).alias("done"),
                ))

            # Most rows settle after a few steps; the others of the fold then cost nothing.
            return F.when(acc["done"], acc).otherwise(at(acc["x"], move))

        bend = F.sqrt(2 * F.abs(o["drift"]) / o["t"])
        start = F.struct(F.lit(low).alias("lo"), F.lit(high).alias("hi"),
                         F.least(F.greatest(bend, F.lit(0.1)), F.lit(high)).alias("x"),
                         F.lit(False).alias("done"))
        found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step,
                            lambda acc: F.when(acc["done"], acc["x"]))
        ends = F.transform(F.array(F.lit(low), F.lit(high)), lambda v: at(v, lambda m: m["miss"]))
        return F.when(_let(ends, lambda e: (e[0] <= 0) & (e[1] >= 0)), found)

    return _let(row, solve)
