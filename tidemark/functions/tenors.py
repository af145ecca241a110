"""Contract symbols and tenors (rows S-13, S-14, P-5)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import MONTH_CODES


def contract_part(symbol: Column) -> Column:
    """``F24`` of ``#A.B/F24``; NULL when the slash is the leading mark of a root."""
    return F.when(F.instr(symbol, "/") > 1, F.split_part(symbol, F.lit("/"), F.lit(2)))


def root_part(symbol: Column) -> Column:
    return F.when(F.instr(symbol, "/") > 1, F.split_part(symbol, F.lit("/"), F.lit(1))).otherwise(
        symbol
    )


def _group(tenor: Column, pattern: str, i: int) -> Column:
    """Captured group as an integer, NULL when the pattern does not match."""
    text = F.regexp_extract(tenor, pattern, i)
    return F.when(text != "", text).try_cast("int")


def tenor_start(tenor: Column, as_of: Column) -> Column:
    """First day of the period a tenor names, seen from ``as_of``.

    ``Mnn``/``Qnn``/``Ynn``, of two digits or more, count whole months, quarters and years after the
    current one; ``2025M06``, ``2025Q03`` and month codes such as ``F24`` are absolute. In a tenor the
    codes of June and August look like relative months and quarters (``M24``, ``Q24``) and are read as
    those; the contract part of a symbol is a code, see ``contract_start``. Unknown text is NULL.
    """
    code = F.regexp_extract(tenor, f"^([{MONTH_CODES}])[0-9]{{2}}$", 1)
    absolute_quarter = _group(tenor, r"^\d{4}Q0?([1-4])$", 1)
    return F.coalesce(
        F.add_months(F.trunc(as_of, "month"), _group(tenor, r"^M(\d{2,})$", 1)),
        F.add_months(F.trunc(as_of, "quarter"), 3 * _group(tenor, r"^Q(\d{2,})$", 1)),
        F.add_months(F.trunc(as_of, "year"), 12 * _group(tenor, r"^Y(\d{2,})$", 1)),
        F.make_date(
            _group(tenor, r"^(\d{4})M(?:0[1-9]|1[0-2])$", 1),
            _group(tenor, r"^\d{4}M(0[1-9]|1[0-2])$", 1), F.lit(1),
        ),
        F.make_date(
            _group(tenor, r"^(\d{4})Q0?[1-4]$", 1), 3 * absolute_quarter - 2, F.lit(1)
        ),
        F.make_date(
            2000 + _group(tenor, f"^[{MONTH_CODES}]([0-9]{{2}})$", 1),
            F.when(code != "", F.instr(F.lit(MONTH_CODES), code)), F.lit(1),
        ),
    )


def contract_start(symbol: Column) -> Column:
    """First day of the month named by the contract part of a symbol: all twelve letters are codes."""
    part = contract_part(symbol)
    code = F.regexp_extract(part, f"^([{MONTH_CODES}])[0-9]{{2}}$", 1)
    return F.make_date(2000 + _group(part, f"^[{MONTH_CODES}]([0-9]{{2}})$", 1),
                       F.when(code != "", F.instr(F.lit(MONTH_CODES), code)), F.lit(1))


def tenor_months(tenor: Column) -> Column:
    """Length of the named period in months."""
    return (
        F.when(tenor.rlike(r"^(\d{4}Q\d{2}|Q\d{2,})$"), 3)
        .when(tenor.rlike(r"^Y\d{2,}$"), 12)
        .when(tenor.rlike(f"^(\\d{{4}}M\\d{{2}}|M\\d{{2,}}|[{MONTH_CODES}]\\d{{2}})$"), 1)
    )


def relative_tenor(contract: Column, as_of: Column) -> Column:
    """``Mnn`` of a contract month seen from ``as_of``."""
    months = F.months_between(F.trunc(contract, "month"), F.trunc(as_of, "month")).cast("int")
    text = months.cast("string")
    return F.concat(F.lit("M"), F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text))


def absolute_tenor(contract: Column) -> Column:
    return F.concat(F.date_format(contract, "yyyy"), F.lit("M"), F.date_format(contract, "MM"))


def month_code(contract: Column) -> Column:
    return F.concat(
        F.substring(F.lit(MONTH_CODES), F.month(contract), F.lit(1)),
        F.date_format(contract, "yy"),
    )


def like_pattern(wildcard: str) -> str:
    """``/GCL<*>`` as a LIKE pattern with every other special character escaped."""
    return "%".join(re.sub(r"([\\%_])", r"\\\1", part) for part in wildcard.split("<*>"))


def last_business_day(day: Column) -> Column:
    """Last Monday-to-Friday day of the month of ``day``."""
    end = F.last_day(day)
    return F.date_sub(end, F.greatest(F.weekday(end) - 4, F.lit(0)))


def prompt_contract(day: Column) -> Column:
    """First day of the contract month trading on ``day``: the earliest month not yet expired.

    A contract expires on the last business day before its month starts.
    """
    ahead = F.when(day <= last_business_day(day), 1).otherwise(2)
    return F.add_months(F.trunc(day, "month"), ahead)
