"""Benchmark: headline work of the engine at one scale factor.

Prints ONE JSON line:
  {"metric": "total_query_time", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Timed steps (each forces its result with a full collect or write):
  load            derive raw region / sub-region relations from lineitem ⋈ orders ⋈
                  customer ⋈ nation and full-refresh them as tables
  marts           staging + both marts (histogram rank, broadcast enrichment), written, and
                  the underserved mart's summary by region that Q4 and Q7 read
  q1..q8          the eight analytical queries over the written marts
  checks          post-load check suite + null profile over the raw tables
  county_rank     global rank of every staged sub-region
  batch_job       end-to-end batch job: land responses (+ the optional open-data
                  CSV) → parse → profile → CSV snapshots → manifest → load latest →
                  staging → marts → exports

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_WARMUP_DIR (default /root/testdata/sf0.001; skipped if absent).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gapscope.operators.quality import check_suite, null_profile  # noqa: E402
from gapscope.operators.rank import global_rank  # noqa: E402
from gapscope.plans import analytics as A  # noqa: E402
from gapscope.plans.batch import open_data_stand_in, run_batch_job  # noqa: E402
from gapscope.plans.warehouse import Warehouse  # noqa: E402
from gapscope.session import apply_scale_settings, build_session, fresh_dir  # noqa: E402


def _timed(fn):
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="gapscope-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    apply_scale_settings(spark, sf_dir, total_cores=cpus)   # partitions sized from input bytes
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    # warm-up on the smallest data: JVM, codegen caches, readers and writers
    small = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(small):
        warm = Warehouse(spark, small).load().build_marts()
        A.q1_scorecard(warm.mart_state()).collect()
        warm_root = fresh_dir(spark, "bench-warm")
        run_batch_job(spark, small, warm_root,
                      open_data_path=open_data_stand_in(spark, small, warm_root))

    times: dict[str, float] = {}
    wh = Warehouse(spark, sf_dir)
    times["load"] = _timed(wh.load)
    times["marts"] = _timed(wh.build_marts)
    ms, mu = wh.mart_state(), wh.mart_underserved()
    queries = {
        "q1": lambda: A.q1_scorecard(ms), "q2": lambda: A.q2_ranking(ms),
        "q3": lambda: A.q3_fiber(ms, state_bound=wh.state_bound),
        "q4": lambda: A.q4_of(wh.region_summary()),
        "q5": lambda: A.q5_critical(mu), "q6": lambda: A.q6_gap_index(mu),
        "q7": lambda: A.q7_of(wh.region_summary()), "q8": lambda: A.q8_tiers(ms),
    }
    for name, q in queries.items():
        times[name] = _timed(lambda q=q: q().collect())
    times["checks"] = _timed(lambda: (check_suite(wh.raw_state(), wh.raw_county()).collect(),
                                      null_profile(wh.raw_county()).collect()))
    times["county_rank"] = _timed(lambda: global_rank(
        wh.stg_county().select("county_fips", "state_fips", "broadband_penetration_pct"),
        "broadband_penetration_pct", rank_col="broadband_rank")
        .write.mode("overwrite").format("noop").save())
    root = fresh_dir(spark, "bench-batch")
    download = open_data_stand_in(spark, sf_dir, root)   # replaces a network fetch: untimed
    times["batch_job"] = _timed(lambda: run_batch_job(spark, sf_dir, root,
                                                      open_data_path=download))

    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
