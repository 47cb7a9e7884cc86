"""Benchmark the headline queries on local Spark.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 3).

Every timed run builds the query anew and executes it into the ``noop`` sink, so
work that a query does while it is built (streams, MERGEs, checkpoints, key
checks) counts. One warm-up run is not timed; the median is reported. Two more
rows apply one prepared batch to a stored table (the maintained history, the
MERGE dimension). Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from dimsmith.operators import merge  # noqa: E402
from dimsmith.plans import catalog, inspect  # noqa: E402
from dimsmith.session import build_session, scale_conf, scratch_path  # noqa: E402
from dimsmith.sources.model import CUSTOMER_PAYLOAD  # noqa: E402
from dimsmith.streaming.incremental import read_table, refresh_batch  # noqa: E402

HEADLINE = [
    "ship_mode_report", "ship_mode_report_norely",
    "reporting_by_customer_region", "reporting_by_customer_region_columns",
    "region_report_eager", "region_report_eager_verified",
    "region_report_verified_columns", "reporting_by_customer_region_norely", "ship_mode_function",
    "main_reporting", "main_reporting_trusted", "loyalty_customer", "loyalty_maintained",
    # dimensions: full rebuilds, MERGE, incremental
    "scd2_customer", "scd2n1_customer", "scd2n1_events", "scd2_point_in_time_join",
    "scd2_merge_upsert", "scd2_merge_replay", "scd2_merge_table", "scd2_incremental",
    # audits
    "constraint_report", "constraint_report_maintained", "audit_foreign_key_bitmaps",
]


# Queries that run many jobs while they are built: timed once after the warm-up run.
LONG = {"constraint_report_maintained", "loyalty_maintained", "audit_foreign_key_bitmaps", "scd2_merge_replay", "scd2_merge_table", "scd2_incremental", "constraint_report"}


def run(df):
    df.write.format("noop").mode("overwrite").save()


def _loads(spark, sf_dir):
    feed = catalog._feed(spark, sf_dir).checkpoint(eager=True)
    times = [r[0] for r in feed.select("__ldts").distinct().orderBy("__ldts").collect()]
    return feed, [feed.where(F.col("__ldts") == F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")) for t in times]


def incremental_refresh(spark, sf_dir, runs):
    """Type-2+1 table maintained over the loads but the last (prepared, not timed),
    then one refresh with the last: only the keys of that batch are recomputed."""
    _, batches = _loads(spark, sf_dir)
    samples = []
    for _ in range(runs + 1):
        base = scratch_path(spark, "bench-refresh")
        for i, b in enumerate(batches[:-1]):
            refresh_batch(spark, base, b, i, "customer_id", catalog._customer_t2n1)
        t0 = time.perf_counter()
        refresh_batch(spark, base, batches[-1], len(batches) - 1, "customer_id", catalog._customer_t2n1)
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples[1:]), 3), read_table(spark, base, "customer_id").count()


def stored_merge(spark, sf_dir, runs):
    """Stored dimension after the loads but the last (prepared, not timed), then
    one MERGE of the newest load."""
    feed, batches = _loads(spark, sf_dir)
    samples = []
    for _ in range(runs + 1):
        path = scratch_path(spark, "bench-dim")
        for b in batches[:-1]:
            merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=b)
        t0 = time.perf_counter()
        merge.merge_into_table(feed, path, "customer_id", CUSTOMER_PAYLOAD, batch=batches[-1])
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples[1:]), 3), merge.read_dimension(spark, path, "customer_id").count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    input_bytes = sum(os.path.getsize(os.path.join(sf_dir, f)) for f in os.listdir(sf_dir)
                      if f.endswith(".parquet"))
    extra = dict(scale_conf(input_bytes, cpus), **{"spark.driver.memory": "16g"})
    spark = build_session(f"local[{cpus}]", app="dimsmith-bench", extra=extra)
    cat = catalog.catalog()
    names = sys.argv[1:] or HEADLINE
    # Process warm-up (JIT, class loading, file listing), not timed.
    for warm in ("scd2n1_customer", "ship_mode_report_norely"):
        run(cat[warm].run(spark, sf_dir))
    times, rows, plans, spread = {}, {}, {}, {}
    for name in names:
        fn = cat[name].run
        df = fn(spark, sf_dir)
        rows[name] = df.count()
        plans[name] = inspect.summary(df)
        samples = []
        for _ in range(1 if name in LONG else runs):
            t0 = time.perf_counter()
            run(fn(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        spread[name] = [round(min(samples), 3), round(max(samples), 3)]
    if not sys.argv[1:]:
        for name, one in (("scd2n1_incremental_one_batch", incremental_refresh),
                          ("scd2_merge_table_one_batch", stored_merge)):
            times[name], rows[name] = one(spark, sf_dir, 1)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "rows_out": rows, "plans": plans, "min_max_sec": spread, "cpus": cpus, "runs": runs,
    }))


if __name__ == "__main__":
    main()
