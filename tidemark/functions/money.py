"""Currency and unit text, minor units, zones, year fractions (rows S-10 to S-12, S-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import MINOR_CURRENCIES


def major_currency(currency: Column) -> Column:
    out = currency
    for minor, major in MINOR_CURRENCIES.items():
        out = F.when(currency == minor, F.lit(major)).otherwise(out)
    return out


def major_value(value: Column, currency: Column) -> Column:
    """Cents and pence are hundredths of their currency."""
    return F.when(currency.isin(*MINOR_CURRENCIES), value / 100).otherwise(value)


def local_time(ts: Column, zone: Column | str) -> Column:
    return F.from_utc_timestamp(ts, zone)


def year_fraction(start: Column, end: Column, day_count: Column | float = 365) -> Column:
    return F.datediff(end, start) / (F.lit(day_count) if not isinstance(day_count, Column)
                                     else day_count)


def conversion_formula(symbol: Column, currency: Column, source: Column, unit: Column,
                       factor: Column) -> Column:
    """Text form of a conversion request; empty text and a zero factor count as unset."""
    def filled(c: Column) -> Column:
        return F.when(c != "", c)

    def part(first: Column, second: Column) -> Column:
        return F.when(first.isNotNull(), F.concat(F.lit("@"), F.concat_ws(":", first, second)))

    money = part(filled(currency), filled(source))
    measure = part(filled(unit), F.when(factor != 0, factor).cast("string"))
    wanted = F.concat_ws(",", money, measure)
    return F.when(wanted == "", symbol).otherwise(
        F.concat(F.lit('=""'), symbol, F.lit('"";['), wanted, F.lit("]"))
    )
