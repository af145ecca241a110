"""Text to typed values; every failure becomes NULL (rows S-1 to S-6, S-8, S-9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# One cheap test before the cast: it keeps out Java-only forms such as ``1.0d``, and words, whose
# failing cast would be slow.
NUMBER = r"^\s*[+-]?[0-9.][0-9.eE+-]*\s*$|(?i)^\s*[+-]?inf(inity)?\s*$"
NUMBER_OR_NAN = NUMBER + r"|(?i)^\s*[+-]?nan\s*$"
# Text shape -> format. The shape keeps the formatter from failing, which is slow, on other text.
# ISO forms, with a blank or a T before the time, need no format.
DATETIME_FORMATS = {
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2} [AaPp][Mm]$": "M/d/yyyy h:m:s a",
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$": "M/d/yyyy H:m:s",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$": "M/d/yyyy H:m",
    r"^\d{8}$": "yyyyMMdd",
}
DAY_FIRST = {r"^\d{2}-\d{2}-\d{4}$": "dd-MM-yyyy"}
# Characters Python's str.strip() removes: ASCII ones, and all.
ASCII_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
BLANKS = (
    ASCII_BLANKS + "\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Text without blanks at its edges; the long list of blanks is only used on non-ASCII text."""
    ascii_only = F.octet_length(c) == F.length(c)
    return F.when(ascii_only, F.btrim(c, F.lit(ASCII_BLANKS))).otherwise(
        F.btrim(c, F.lit(BLANKS)))


def normalise(c: Column) -> Column:
    """Case- and edge-blank-insensitive text, as used in keys."""
    return F.lower(strip(c))


def parse_float(c: Column) -> Column:
    """Double, or NULL; NaN and infinities are values here. Digit groups may carry underscores."""
    grouped = F.regexp_replace(c, r"(?<=\d)_(?=\d)", "")
    return F.when(c.rlike(NUMBER_OR_NAN), c.try_cast("double")).when(
        F.contains(c, F.lit("_")) & grouped.rlike(NUMBER), grouped.try_cast("double")
    )


def parse_int(c: Column) -> Column:
    """Integer part toward zero, or NULL; NaN and infinities are NULL."""
    return parse_float(c).try_cast("bigint")


def to_numeric(c: Column) -> Column:
    """Double, or NULL; the word NaN is NULL too."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def parse_datetime(c: Column, more: Mapping[str, str] | None = None) -> Column:
    """Timestamp by the first format whose shape fits the text, row by row; else NULL."""
    plain = c.try_cast("timestamp")
    formatted = None
    for shape, pattern in {**DATETIME_FORMATS, **(more or {})}.items():
        value = F.try_to_timestamp(c, F.lit(pattern))
        formatted = F.when(c.rlike(shape), value) if formatted is None else formatted.when(
            c.rlike(shape), value)
    # One cheap test sends the ISO forms past all shapes.
    return F.when(c.rlike(r"^\d{4}-\d"), plain).otherwise(formatted.otherwise(plain))


def null_if_in(c: Column, sentinels: Sequence[str]) -> Column:
    return F.when(~c.isin(*sentinels), c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def second_text(c: Column) -> Column:
    """Timestamp as text, without fractions of a second."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


FIELD_PARSERS = {
    "int": parse_int,
    "float": parse_float,
    "string": lambda c: c,
    "datetime": parse_datetime,
}


def json_attribute(body: Column | str, path: str, kind: str = "string") -> Column:
    """An attribute of a JSON body by its path (``build.buildType``); NULL where it is absent, or does not
    read as ``kind``."""
    found = F.get_json_object(F.col(body) if isinstance(body, str) else body, f"$.{path}")
    return found if kind == "string" else found.try_cast(kind)
