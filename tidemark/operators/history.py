"""Previous-session and running quote fields (rows W-2 to W-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.segments import history_columns

# Output field -> column it repeats from the previous session.
SESSION_FIELDS = {"prevlast": "last", "lastopen": "open", "lasthigh": "high", "lastlow": "low",
                  "lastclose": "close", "lastvolume": "volume"}


def session_fields(prices: DataFrame, time: str = "tradedatetimeutc", tie: Sequence[str] = (),
                   grain: str = "month") -> DataFrame:
    """Add previous-session values, changes, last known value, direction and running volume.

    Columns the frame lacks are skipped. ``grain`` sizes the segments a symbol's history is cut
    into; give rows from ``balanced_segments`` where one such unit of one symbol is too large.
    """
    have = set(prices.columns)
    lagged = {out: c for out, c in SESSION_FIELDS.items() if c in have}
    out = history_columns(
        prices, ["symbol"], time, [time, *tie],
        lagged=lagged,
        running={"historicvolume": "volume"} if "volume" in have else {},
        latest={"_known": ["close", time]} if "close" in have else {},
        grain=grain,
    )
    added = {}
    if "close" in have:
        change = F.col("close") - F.col("lastclose")
        added["netchange"] = change
        added["percentchange"] = 100 * (
            F.col("close") / F.nullif(F.col("lastclose"), F.lit(0.0)) - 1
        )
        added["mostrecentvalue"] = F.col("_known")["close"]
        added["mostrecentvaluedate"] = F.col("_known")[time]
    if "last" in have:
        added["lasttradedirection"] = F.signum(F.col("last") - F.col("prevlast"))
    return out.withColumns(added).drop("_known")


def tick_counts(ticks: DataFrame, time: str = "ts") -> DataFrame:
    """Ticks per symbol and day."""
    return ticks.groupBy("symbol", F.to_date(time).alias("day")).agg(
        F.count("*").alias("tickcount")
    )
