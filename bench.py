"""Time the headline queries on $BENCH_SF_DIR and print one JSON line.

Every query runs to completion into the ``noop`` sink in a warm session: one
warm-up, then the median of the timed runs. ``etl_and_gold`` is the whole way
from events to written laps, engineered laps and the four gold tables, timed
cold in a fresh workspace.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stintwise.registry import workspace  # noqa: E402
from stintwise.registry.queries import REGISTRY  # noqa: E402
from stintwise.session import build_session  # noqa: E402
from stintwise.sources.catalog import GOLD_SCHEMAS  # noqa: E402

HEADLINE = [
    "driver_analytics", "tire_analytics", "pitstop_analytics", "race_analytics",
    "sql_consistency_rank", "sql_positions_gained", "sql_compound_performance", "sql_pit_efficiency",
    "sql_pace_vs_result", "sql_sector_benchmarks",
    "sector_deltas", "rolling_pace", "performance_score", "transform_laps", "engineer_laps", "degradation_rate",
    "clean_laps", "column_medians", "dq_report", "asof_weather", "lap_assembly", "per_group_split",
    "race_overview", "ols_trendline", "heuristic_lap_time",
    "star_price_above_best", "star_usage_share", "star_customer_rank", "star_asof_orders",
    "gold_from_raw_driver", "gold_from_raw_tire", "gold_from_raw_pitstop", "gold_from_raw_race", "ml_first_split", "ml_fixed_forest",
]
RUNS = 3


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def build_tables() -> None:
        workspace._written.clear()
        ws = workspace.Workspace(spark, sf_dir)
        for table in GOLD_SCHEMAS:
            ws.gold(table)

    build_tables()
    seconds = {"etl_and_gold": round(timed(build_tables), 3)}
    for name in HEADLINE:
        def run(name=name) -> None:
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
