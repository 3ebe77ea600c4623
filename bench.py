"""Times the headline queries and a full build with all checks; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallywright.catalog.queries import Sample, run  # noqa: E402
from tallywright.plans.contracts import run_report  # noqa: E402
from tallywright.plans.warehouse import build  # noqa: E402
from tallywright.session import local_session, run_folder  # noqa: E402

HEADLINE = (
    "fct_order_items fct_orders dim_customers dim_products fct_daily_revenue mart_product_performance "
    "mart_customer_cohorts mart_acquisition_channels revenue_concentration topk_products met_net_revenue "
    "met_average_order_value mq_entity_join mq_two_hop mq_offset chk_revenue_reconciles chk_relationships"
).split()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def full_build(spark, folder) -> None:
    """Every mart written in its layout, then all declared checks on the stored tables."""
    sample = Sample(spark, folder)
    with run_folder(spark) as scratch:
        built = build(sample.sources, sample.cfg, f"{scratch}/marts")
        report = run_report(lambda name: sample.events if name == "events" else built.frame(name), sample.cfg)
        report.write.format("noop").mode("overwrite").save()


def one_query(name, spark, folder) -> None:
    with run_folder(spark):
        run(name, spark, folder).write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed run, so that the first timed query does not pay for the JVM's start
    one_query("fct_daily_revenue", spark, folder)

    seconds = {name: timed(lambda: one_query(name, spark, folder)) for name in HEADLINE}
    seconds["full_build_and_checks"] = timed(lambda: full_build(spark, folder))
    print(
        json.dumps(
            {
                "metric": "headline_queries_and_full_build",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
