"""Load test: constant-valued sources, one batch day run, one stream refresh, and their invariants.

    python tools/load_test.py [orders]      (default 2,000,000; three lines each)

Prints the seconds of every step as one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from orderloom.plans import medallion as m
from orderloom.plans.checks import check_load_test
from orderloom.session import scratch_path, tune
from orderloom.sources.tables import Lake
from orderloom.streaming import freeze


def main() -> None:
    orders = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    run_dir = tempfile.mkdtemp(prefix="run-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", f"{run_dir}/warehouse")
        .config("spark.checkpoint.dir", f"{run_dir}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lake = Lake(tune(spark), "load_").create()
    offsets = scratch_path(spark, "offsets")
    sizes = m.SeedSizes(orders=orders)
    seconds: dict[str, float] = {}

    def step(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 1)

    step("seed", lambda: m.seed_load_test(lake, sizes))
    step("bronze_dimensions", lambda: m.load_bronze_dimensions(lake))
    step("bronze_orders", lambda: m.load_bronze_orders(lake))
    step("silver", lambda: m.load_silver(lake, "2024-01-01"))
    step("gold", lambda: m.load_gold(lake, "2024-01-01"))
    step("stream_refresh", lambda: freeze.refresh(lake, offsets))
    check_load_test(lake, sizes)
    step("next_day_seed", lambda: m.seed_day(lake, "2024-01-02", sizes))
    step("next_day_batch", lambda: m.run_day(lake, "2024-01-02"))
    step("next_day_stream", lambda: freeze.refresh(lake, offsets))
    step("day_after_seed", lambda: m.seed_day(lake, "2024-01-03", sizes))
    step("items_to_incremental", lambda: m.load_bronze_items(lake, offsets))
    step("day_after_batch_incremental", lambda: m.run_day(lake, "2024-01-03", checkpoints=offsets))
    print(json.dumps({"orders": orders, "items": orders * 3, "seconds": seconds}))


if __name__ == "__main__":
    main()
