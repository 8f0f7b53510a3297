"""Times the headline queries and prints one JSON line.

The mart is loaded first and timed on its own, as a mart is loaded once and queried often.
Each query is then run once to warm up and three times for a median. ``BENCH_SF_DIR`` and
``BENCH_CPUS`` choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from riskmart.plans.load import refresh
from riskmart.session import tuned
from riskmart.sources.files import write_table
from riskmart.sources.schemas import RAW_FILES
from riskmart.sources.workspace import work_path
from suite import mapping
from suite.catalog import QUERIES
from suite.mart import STAR, Mart

HEADLINE = [
    "sr_08_supplier_risk",
    "sd_10_supplier_dependency",
    "ir_10_inventory_risk",
    "lp_06_logistics_performance",
    "db_01_supplier_dashboard",
    "db_02_inventory_dashboard",
    "db_03_logistics_dashboard",
    "db_04_dependency_dashboard",
    "db_05_executive_summary",
    "rp_01_supplier_report_high",
    "rp_02_inventory_report_critical",
    "ah_09_reorder_candidates",
    "ah_11_warehouse_risk",
    "kpi_02_dependency_share",
    "fct_01_orders",
    "stg_05_orders",
    "dq_05_shipments_rejects",
    "dq_08_orders_duplicates",
    "dq_23_mapping_coverage",
    "rnk_01_rank",
    "tr_19_utilization",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        tuned(SparkSession.builder.master(f"local[{cpus}]"))
        .appName("riskmart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    mart = Mart.open(spark, sf_dir)
    load = timed(lambda: [mart[name] for name in STAR])
    staged = timed(mart.staged_all)
    landing, target = work_path(spark, "bench-landing"), work_path(spark, "bench-mart")
    for table, file in RAW_FILES.items():
        write_table(mart.raw(table), f"{landing}/{file}", fmt="csv")
    from_csv = timed(lambda: refresh(spark, landing, target, mapping.CALENDAR))

    def run(name: str) -> None:
        # All rows and columns are computed, none are brought to the driver.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(statistics.median(timed(lambda: run(name)) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, sum of medians of three",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "load": {
                    "star": round(load, 3),
                    "staged": round(staged, 3),
                    "refresh_from_csv": round(from_csv, 3),
                },
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
