"""Times the star build, the marts on the stored star, and queries straight from the raw tables.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores,
``BENCH_RUNS`` the timed runs per query, of which the best counts, ``BENCH_TARGET`` the folder to
build in (a new one in the shared folder of the session by default).
"""

from __future__ import annotations

import json
import os
import time
import uuid

from retailmart.plans.adhoc import ADHOC
from retailmart.plans.jobs import build_marts, build_star, read_star, stored_staging
from retailmart.plans.marts import BREAKDOWNS, MART_PLANS
from retailmart.session import local_session
from retailmart.sources.scratch import shared_folder
from retailmart.trial.queries import QUERIES, reader

# straight from the raw tables, all joins and deduplication included
HEADLINE = (
    "report_products_sales", "report_customers_sales", "report_time_sales", "report_stores_sales",
    "report_suppliers_sales", "report_product_quality", "q_overview", "q_by_breed", "q_age_by_category", "dq_reconcile",
)


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    target = os.environ.get("BENCH_TARGET") or f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"

    def best(action) -> float:
        return round(min(seconds(action) for _ in range(runs)), 3)

    times = {}
    times["write_staging"] = best(lambda: reader(spark, sf_dir)().write.mode("overwrite").parquet(f"{target}/staging"))
    read = stored_staging(spark, f"{target}/staging")
    times["build_star"] = best(lambda: build_star(spark, read, target))
    times["build_marts"] = best(lambda: build_marts(spark, target, anew=True))
    star = read_star(spark, target)
    for name, plan in {**MART_PLANS, **BREAKDOWNS, **ADHOC}.items():
        times[f"stored.{name}"] = best(lambda plan=plan: run(plan(star)))
    for name in HEADLINE:
        times[f"raw.{name}"] = best(lambda name=name: run(QUERIES[name](spark, sf_dir)))
    spark.stop()

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_time", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
