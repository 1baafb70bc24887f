"""Wall times of the headline operators, as one JSON line.

Raw prices, staged bars and indicators are stored first (not timed); each operator then
reads stored tables and writes its whole result to the no-op sink. One warm-up, median of
three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from barloom.operators import (  # noqa: E402
    analytics,
    features,
    incremental,
    indicators,
    mart,
    quality,
    signals,
    staging,
)
from barloom.plans import settings  # noqa: E402
from barloom.scratch import durable  # noqa: E402
from barloom.session import configured  # noqa: E402
from barloom.sources.star_bars import raw_prices  # noqa: E402

RUNS = 3


def seconds(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("barloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configured(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    raw = durable(raw_prices(spark, sf_dir).repartition(int(cpus)))
    staged = durable(staging.stage_prices(raw))
    base = durable(
        indicators.technical_indicators(staged.filter(F.col("price_date") <= F.lit(settings.CUT)))
    )

    def build_mart():
        fresh = staging.stage_prices(raw)
        ti = indicators.technical_indicators(fresh, keep=["sector"])
        return mart.training_mart(features.ml_features(ti), settings.MART)

    cases = {
        "stage_prices": lambda: staging.stage_prices(raw),
        "sma": lambda: indicators.moving_averages(staged),
        "technical_indicators": lambda: indicators.technical_indicators(staged),
        "ml_features": lambda: features.ml_features(
            indicators.technical_indicators(staged, keep=["sector"])
        ),
        "staging_to_mart": build_mart,
        "incremental_indicators": lambda: incremental.incremental_indicators(
            base, staged, settings.CUT
        ),
        "sector_momentum": lambda: features.sector_momentum(staged),
        "macd_ema": lambda: analytics.macd_ema(staged),
        "signal_overview": lambda: signals.signal_overview(staged),
        "quality_report": lambda: quality.quality_report(
            [(staged, quality.staged_checks(["africa", "america", "asia"]))]
        ),
    }
    times = {}
    for name, build in cases.items():
        seconds(build)
        times[name] = round(statistics.median(seconds(build) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "bars": staged.count(),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
