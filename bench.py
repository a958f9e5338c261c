"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` (comma separated)
a subset, ``BENCH_RUNS`` the timed runs of which the best counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidegrid import session  # noqa: E402
from tidegrid.catalog import QUERIES  # noqa: E402
from tidegrid.catalog.model_queries import forget_fits  # noqa: E402

HEADLINE = (
    "entity_hour_grid",
    "entity_hour_measures",
    "rule_waterfall",
    "rules_applied",
    "clock_keys",
    "scheduled_realised",
    "dim_rollup",
    "checked_join",
    "share_where",
    "resolved_with_source",
    "lags",
    "trailing_mean",
    "null_families",
    "distribution",
    "tukey_fences",
    "extremes",
    "value_spectrum",
    "rank_gap",
    "matched_compare",
    "zone_table",
    "comparison",
    "bias_by_bin",
    "expected_revenue",
    "glm_cell_means",
    "permuted_columns",
    "spearman",
    "attributed_bias",
    "glm_poisson",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(runs):
            forget_fits()
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name} {best:.3f}", file=sys.stderr, flush=True)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
