"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR chooses the data, BENCH_CPUS the local threads, BENCH_RUNS the repeats;
each query runs once to warm up and the median of the repeats counts. ``duckdb`` has the
times of the queries' SQL counterparts in DuckDB on the same files and as many threads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import PLANS  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "scan_ranges", "scan_ranges_join", "scan_batches", "q_agg_tagged", "q_sum_col", "a_per_table", "a_ohlc_bar",
    "j_cdc_range", "w_dedup_drop", "w_dedup_upsert", "w_truncate_range_rows", "w_rows_to_columns", "x_symbol_encode",
    "a_stats_by_uid", "j_span_pair", "a_flamegraph", "kv_update", "kv_add", "find", "w_metric_delta",
]


def duckdb_times(sf_dir: str, cpus: str, names: list[str], runs: int) -> dict[str, float]:
    """Median seconds of the SQL counterparts, with all rows fetched."""
    import duckdb

    times = {}
    with duckdb.connect() as con:
        con.execute(f"SET threads = {int(cpus)}")
        for table in ("events", "orders", "customer", "part", "documents", "pages", "lineitem"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        for name in names:
            taken = []
            for _ in range(runs):
                start = time.perf_counter()
                con.execute(PLANS[name].sql).fetchall()
                taken.append(time.perf_counter() - start)
            times[name] = round(statistics.median(taken), 4)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, rows = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for run in range(runs + 1):
            start = time.perf_counter()
            # A sink that takes every row and column, so that nothing is optimised away.
            PLANS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 4)
        rows[name] = PLANS[name](spark, sf_dir).count()
    total = round(sum(times.values()), 4)
    duck = duckdb_times(sf_dir, cpus, [n for n in times if PLANS[n].sql is not None], runs)
    print(json.dumps({
        "metric": "headline_total", "value": total, "unit": "sec", "queries": times, "rows": rows, "duckdb": duck,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
