"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local threads. If a smaller data
folder (sf0.01) lies beside it, everything runs once on that first, untimed, so that the
numbers are those of a warm JVM; BENCH_WARM=0 leaves this out.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larder.plans.registry import BUILDERS  # noqa: E402
from larder.plans.workspace import Workspace  # noqa: E402
from larder.session import build_session  # noqa: E402

# Building the layers, in order; later queries read what these store.
LAYERS = (
    "order_keys", "production_logs", "waste_logs", "menu_data", "location_data", "supplier_data", "silver",
    "dim_date", "dim_category", "dim_location", "dim_menu", "dim_supplier", "fact_production",
    "fact_waste", "fact_consumption", "fact_waste_summary",
)
HEADLINES = (
    "waste_to_grain", "silver", "dq_silver_report", "fact_production", "fact_waste",
    "fact_consumption", "fact_waste_summary", "scd1_menu", "scd2_supplier", "mom_by_location",
    "top_menu_items", "demand_gap", "supplier_quality_vs_waste", "reason_by_meal", "root_cause",
    "kpi_monthly", "location_trend", "top_items_by_category", "trend_mom", "root_cause_counts",
)


def measure(spark, sf_dir: str) -> dict[str, float]:
    layers = Workspace(spark, sf_dir)
    timings: dict[str, float] = {}

    def timed(name, action) -> None:
        start = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - start, 3)

    def build(name: str):
        if name in ("order_keys", "silver"):
            return getattr(layers, name)()
        return layers[name] if name.startswith(("dim_", "fact_")) else layers.bronze(name)

    for name in LAYERS:
        timed(f"build_{name}", lambda name=name: build(name))
    for name in HEADLINES:
        timed(
            name,
            lambda name=name: BUILDERS[name](layers)
            .write.format("noop").mode("overwrite").save(),
        )
    return timings


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "larder-bench", f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    smaller = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    warm = os.environ.get("BENCH_WARM", "1") != "0" and os.path.isdir(smaller)
    if warm:
        measure(spark, smaller)
    timings = measure(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds: build all layers, then the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "warm": warm,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
