"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Each query is run whole, with every
output column computed and thrown away (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_prices", "price_hash", "first_by_key", "price_ingest", "fetch_plan", "records_back",
    "session_fields", "corrections_all", "latest_quotes", "tick_session_fields", "intraday_bars",
    "daily_peak_hours", "resample_months", "fill_forward", "fill_interpolate", "fill_projected",
    "lag_weeks", "convert_currency", "convert_units", "curve_range_front", "curve_spreadwave",
    "curve_table_latest", "series_latest", "prompt_contracts", "metadata_wide",
    "update_timeseries", "delete_timeseries", "strike_window", "option_greeks",
    "implied_volatility",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from checks import REGISTRY
    from tidemark.session import build_session

    spark = build_session(cpus, "tidemark-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    run("row_count")  # starts the JVM side before the clock matters
    times = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
