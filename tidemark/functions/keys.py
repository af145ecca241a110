"""Business keys as pure column expressions (rows K-1 to K-5, S-7).

A key is the SHA-256 of ``column:value`` parts in sorted order. Each part starts with its column
name and a colon, so the sorted order is that of the names with their colon: it is fixed when the
expression is built, and ``concat_ws`` then skips NULL parts. No array is sorted per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.casting import normalise, second_text


def _digest(parts: dict[str, Column]) -> Column:
    ordered = sorted(parts, key=lambda name: name + ":")
    return F.sha2(
        F.concat_ws("|", *[F.concat(F.lit(name + ":"), parts[name]) for name in ordered]), 256
    )


def _any_set(names: list[str]) -> Column:
    present = F.lit(False)
    for name in names:
        present = present | F.col(name).isNotNull()
    return present


def _key(core: dict[str, Column], rest: dict[str, Column]) -> Column:
    key = F.when(_any_set(list(core)), _digest(core)) if core else F.lit(None).cast("string")
    # The spare key is only reached when every core column is NULL.
    return F.coalesce(key, F.when(_any_set(list(rest)), _digest(rest))) if rest else key


def instrument_hash(df: DataFrame) -> Column:
    """Key over the five identifying columns, else over every source column, else NULL."""
    core = {c: normalise(F.col(c)) for c in schemas.INSTRUMENT_KEY if c in df.columns}
    rest = {c: normalise(F.col(c)) for c in df.columns
            if c in schemas.INSTRUMENT_COLUMNS and c not in core}
    return _key(core, rest)


def double_text(value: Column) -> Column:
    """A double as the shortest text that reads back: plain from 1e-4 up to 1e16, ``1e-05`` or
    ``1.5e+16`` beyond."""
    text = value.cast("string")
    size = F.abs(value)
    plain = F.regexp_replace(value.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.lpad(F.abs(power).cast("string"), 2, "0")
    digits = F.when(F.abs(power) > 99, F.abs(power).cast("string")).otherwise(digits)
    exponent = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), digits)
    return (
        F.when(~F.contains(text, F.lit("E")), text)
        .when((size >= 1e-4) & (size < 1e16), plain).otherwise(exponent)
    )


def price_hash(df: DataFrame, spare: bool = True) -> Column:
    """Key over symbol, trade time to the second and price symbol, else over every source column.

    A row that needs the spare key lacks its symbol and time and cannot be stored, so the ingest job
    leaves it out.
    """
    core = {
        c: second_text(F.col(c)) if c in schemas.PRICE_TIMES else normalise(F.col(c))
        for c in schemas.PRICE_KEY if c in df.columns
    }
    kinds = dict(df.dtypes)

    def text(c: str) -> Column:
        if c in schemas.PRICE_TIMES:
            return second_text(F.col(c))
        return double_text(F.col(c)) if kinds[c] == "double" else F.col(c).cast("string")

    rest = {c: text(c) for c in df.columns if c in schemas.PRICE_COLUMNS and c not in core}
    return _key(core, rest if spare else {})
