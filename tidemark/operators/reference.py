"""Metadata, folders and dimension lists (rows D-4, D-5, M-1 to M-5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.filters import page


def get_metadata(metadata: DataFrame, fields: Sequence[str],
                 symbols: Sequence[str] | None = None) -> DataFrame:
    """One row per symbol with the named properties as columns.

    Naming the properties keeps the pivot to one aggregation that combines before the shuffle.
    """
    if symbols is not None:
        metadata = metadata.where(F.col("symbol").isin(*symbols))
    return (
        metadata.where(F.col("property").isin(*fields))
        .groupBy("symbol").pivot("property", list(fields)).agg(F.max("value"))
    )


def search_metadata(metadata: DataFrame, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Symbols that have, for every named property, one of its wanted values."""
    if not wanted:
        raise ValueError("name at least one property")
    hits = {f"_hit{i}": (F.col("property") == p) & F.col("value").isin(*v)
            for i, (p, v) in enumerate(wanted.items())}
    some = F.lit(False)
    every = F.lit(True)
    for name, hit in hits.items():
        some, every = some | hit, every & F.col(name)
    return (
        metadata.where(some).groupBy("symbol")
        .agg(*[F.bool_or(hit).alias(name) for name, hit in hits.items()])
        .where(every).select("symbol")
    )


def get_folder(folders: DataFrame, folder: str) -> DataFrame:
    """Members at or below a path."""
    if not folder:
        raise ValueError("folder is required")
    return folders.where((F.col("path") == folder) | F.col("path").startswith(folder + "/"))


def unified_metadata(instruments: DataFrame, search: str, supplier: str | None = None,
                     number: int = 1, size: int = 100) -> DataFrame:
    """Text search in symbol and description, optional supplier, one page by symbol."""
    text = F.lit(search.lower())
    found = instruments.where(
        F.coalesce(F.contains(F.lower("symbol"), text), F.lit(False))
        | F.coalesce(F.contains(F.lower("description"), text), F.lit(False))
    )
    if supplier is not None:
        found = found.where(F.col("supplier") == supplier)
    return page(found, ["symbol"], number, size)


def all_roots(instruments: DataFrame, search: str) -> DataFrame:
    """Distinct option roots containing a text, in any case."""
    return (
        instruments.where(F.contains(F.lower("option_root"), F.lit(search.lower())))
        .select("option_root").distinct()
    )


def permissioned_roots(instruments: DataFrame, grants: DataFrame, key: str = "option_root",
                       fields: Sequence[str] = ("option_root",)) -> DataFrame:
    """Distinct root rows the caller may see."""
    return instruments.join(grants.select(key).distinct(), key, "left_semi").select(
        *fields
    ).distinct()


def dimension(df: DataFrame, fields: Sequence[str], **any_of: Sequence[str] | None) -> DataFrame:
    """Distinct rows of a dimension, with optional value lists per column."""
    for name, values in any_of.items():
        if values is not None:
            df = df.where(F.col(name).isin(*values))
    return df.select(*fields).distinct()


def units_of(symbols: DataFrame, factors: DataFrame, symbol: str) -> DataFrame:
    """Units a symbol's own unit can be converted to."""
    if not isinstance(symbol, str):
        raise ValueError("symbol is required and must be text")
    return (
        symbols.where(F.col("symbol") == symbol).join(factors, "unit")
        .select("symbol", "unit", "to_unit", "factor")
    )
