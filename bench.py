"""Time every registered query at one scale factor and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_ONLY (comma-separated name substrings, optional),
BENCH_SKIP_HEAVY=1 to skip model-fitting queries,
BENCH_REFERENCE=1 to time, instead of the queries, fits at the published hyper-parameters.
Each query is fully materialised with a no-op write (``format("noop")``),
which runs the whole plan without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def reference_fits(spark, sf_dir: str) -> dict[str, float]:
    """Seconds to fit and score ALS (rank 20, 20 iterations, reg 0.1) and each
    model at its published settings, on all training rows of the split."""
    from ratings_engine.plans import queries  # noqa: F401  (registers on import)
    from ratings_engine.operators import models as md
    from ratings_engine.operators import recsys as rs
    from ratings_engine.plans.q_eval import split
    from ratings_engine.plans.q_models import supervised

    def timed(work) -> float:
        t0 = time.time()
        work()
        return round(time.time() - t0, 3)

    train, test = (x.cache() for x in split(spark, sf_dir))
    rows = train.count() + test.count()
    out = {"rows": rows, "ALS_r20_i20": timed(lambda: rs.als_regression_metrics(rs.fit_als(train, 20, 20, 0.1), test).first())}
    train, test, _ = supervised(spark, sf_dir, None)
    train, test = train.cache(), test.cache()
    train.count(), test.count()
    for label, models in (("label_cls", md.classifiers()), ("rating", md.regressors())):
        for name, m in models.items():
            out[name] = timed(lambda: m.setLabelCol(label).fit(train).transform(test)
                              .write.format("noop").mode("overwrite").save())
            print(name, out[name], file=sys.stderr, flush=True)
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [s for s in os.environ.get("BENCH_ONLY", "").split(",") if s]
    skip_heavy = os.environ.get("BENCH_SKIP_HEAVY", "") == "1"

    from ratings_engine.config import build_session
    from ratings_engine.plans.registry import all_queries

    try:
        mem_gb = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2 ** 30
    except (ValueError, OSError):
        mem_gb = 8.0
    driver_mem = f"{max(1, min(16, int(mem_gb * 0.6)))}g"   # local mode: the driver JVM is the executor
    spark = build_session(f"local[{cpus}]", app="ratings_engine-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": driver_mem})
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up (not timed): JVM start-up, code generation paths and file listing.
    from ratings_engine.sources.views import ratings_view
    ratings_view(spark, sf_dir).groupBy("rating").count().write.format("noop").mode("overwrite").save()
    if os.environ.get("BENCH_REFERENCE", "") == "1":
        print(json.dumps({"metric": "reference_fits", "unit": "sec", "sf": sf_dir, "cpus": cpus, "queries": reference_fits(spark, sf_dir)}))
        spark.stop()
        return
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    t_all = time.time()
    for name, q in all_queries().items():
        if only and not any(s in name for s in only):
            continue
        if skip_heavy and q.heavy:
            continue
        t0 = time.time()
        try:
            q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(time.time() - t_all, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_seconds_all_queries", "value": total, "unit": "sec", "queries": times,
           "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
