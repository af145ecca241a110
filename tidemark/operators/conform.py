"""Cleaning and shaping (rows I-12 to I-15b, F-1, F-2, U-1)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import casting


def clean_instruments(df: DataFrame) -> DataFrame:
    """Instrument columns as text; the four null words become NULL, empty text stays."""
    return df.select(
        *[casting.null_if_in(F.col(c).cast("string"), schemas.INSTRUMENT_SENTINELS).alias(c)
          if c in schemas.INSTRUMENT_COLUMNS else F.col(c) for c in df.columns]
    )


def clean_prices(df: DataFrame) -> DataFrame:
    """Times, numbers and texts of a price frame coerced in one projection; others pass through."""
    kinds = dict(df.dtypes)

    def clean(c: str) -> Column:
        if c in schemas.PRICE_TIMES:
            text = kinds[c] == "string"
            return casting.parse_datetime(F.col(c)) if text else F.col(c).cast("timestamp")
        if c in schemas.PRICE_COUNTS:
            text = kinds[c] == "string"
            return casting.parse_int(F.col(c)) if text else F.col(c).cast("bigint")
        if c in schemas.PRICE_NUMBERS:
            if kinds[c] == "string":
                return casting.to_numeric(F.col(c))
            return casting.nan_to_null(F.col(c).cast("double"))
        if c in schemas.PRICE_TEXT:
            return casting.null_if_in(F.col(c).cast("string"), schemas.PRICE_SENTINELS)
        return F.col(c)

    return df.select(*[clean(c).alias(c) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order; missing ones are NULL, extras are dropped."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_instrument_audit(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return df.withColumns(
        {
            "created_at": F.lit(run_ts),
            "updated_at": F.lit(run_ts),
            "last_seen_date": F.lit(run_ts.date()),
            "last_price_pull_date": F.lit(None).cast("date"),
        }
    )


def with_price_audit(df: DataFrame, run_ts: dt.datetime,
                     data_source: str = schemas.DATA_SOURCE) -> DataFrame:
    return df.withColumns(
        {
            "created_at": F.lit(run_ts),
            "updated_at": F.lit(run_ts),
            "data_source": F.lit(data_source),
        }
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType)
              and not isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: casting.nan_to_null(F.col(c)) for c in floats}) if floats else df


Field = str | list | tuple


def select_fields(df: DataFrame, fields: str | Sequence[Field]) -> DataFrame:
    """Projection by name, ``[name, parser]`` pair, or the name of a preset.

    A parser is a function of a Column; a pandas_udf may be passed where no expression will do.
    Preset columns a frame lacks come back as NULL; other unknown names are an error.
    """
    if isinstance(fields, str):
        if fields.upper() not in schemas.FIELD_PRESETS:
            raise ValueError(f"unknown field preset: {fields}")
        names = schemas.FIELD_PRESETS[fields.upper()]
        return df.select(
            *[F.col(c) if c in df.columns else F.lit(None).cast(schemas.price_type(c)).alias(c)
              for c in names]
        )
    picked = []
    for item in fields:
        parser: Callable[[Column], Column] | None = None
        if isinstance(item, (list, tuple)):
            if len(item) != 2 or not callable(item[1]):
                raise ValueError("a field pair is [name, parser]")
            item, parser = item
        if not isinstance(item, str):
            raise ValueError("a field is a name or a [name, parser] pair")
        name = item.strip('"')
        if name not in df.columns:
            raise ValueError(f"unknown field: {name}")
        picked.append((parser(F.col(name)) if parser else F.col(name)).alias(name))
    return df.select(*picked)


def columnar_to_rows(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Equal-length arrays, one per field, to one row per position; unequal lengths are an error."""
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"missing array for: {missing}")
    first = F.size(fields[0])
    same = F.lit(True)
    for name in fields[1:]:
        same = same & (F.size(name) == first)
    zipped = F.when(same, F.arrays_zip(*[F.col(f) for f in fields])).otherwise(
        F.raise_error(F.lit("field arrays differ in length"))
    )
    return df.select(*keep, F.explode(zipped).alias("_row")).select(
        *keep, *[F.col("_row")[f].alias(f) for f in fields]
    )
