"""Headline-query timings: ``python bench.py`` prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8), ``BENCH_QUERIES``
(comma-separated subset). Each query is run to completion with the ``noop`` sink (every row is computed, nothing is
collected to the driver); the reported value is the sum of the per-query wall times, including ``prepare`` (building
the stored, bucketed adapter tables from the source tables).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contestlab.registry import QUERIES  # noqa: E402
from contestlab.session import local_session  # noqa: E402
from contestlab.sources import prepared  # noqa: E402

HEADLINE = [
    "team_record",
    "offense_stats",
    "defense_stats",
    "season_to_date_mean",
    "trailing_mean_p",
    "elo",
    "pregame_features",
    "roc_auc",
    "corr_long",
    "five_number",
    "standings_rank",
    "html_rows",
    "json_stats",
    "stratified_split",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="contestlab-bench")
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    # build the stored adapter tables from scratch for this run and time it as its own entry, so no query
    # benefits from tables left by an earlier run
    spark.conf.set(prepared.NAMESPACE_CONF, f"bench_{uuid.uuid4().hex[:10]}")
    t0 = time.perf_counter()
    prepared.contests(spark, sf_dir)
    prepared.plays(spark, sf_dir)
    times["prepare"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
