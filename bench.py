"""Benchmark: every registered query on one scale factor, warm.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full into Spark's ``noop`` sink (all rows are
computed, nothing is collected to the driver).  One warm-up pass, then
``BENCH_REPEAT`` (default 3) timed passes; a query's time is its median.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tidemark.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.ui.showConsoleProgress": "false",
                               "spark.driver.memory": "16g"})
    from tidemark.plans.queries import QUERIES

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    errors: dict[str, str] = {}
    for name in QUERIES:      # warm-up: JIT, file listing, Python workers
        try:
            run(name)
        except Exception as e:  # a failing query is reported, the others still run
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    samples = {name: [] for name in QUERIES if name not in errors}
    for _ in range(repeat):
        for name in samples:
            samples[name].append(run(name))
    times = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    streams = bench_streams(spark, sf_dir) if os.environ.get("BENCH_STREAMS", "1") == "1" else {}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
        **({"errors": errors} if errors else {}),
        **({"streams": streams} if streams else {}),
    }))
    spark.stop()


def bench_streams(spark, sf_dir: str) -> dict:
    """Streaming jobs over file topics built from the scale factor, each run
    once to completion (``availableNow``): seconds and input rows per second.
    Inputs and job state go below ``spark.checkpoint.dir``."""
    import tempfile

    from pyspark.sql import functions as F

    from tidemark import schemas as S
    from tidemark.plans import config as C
    from tidemark.plans import queries as Q
    from tidemark.session import ensure_checkpoint_dir
    from tidemark.sinks.topics import write_topic
    from tidemark.sources import projections as P
    from tidemark.sources.tables import table
    from tidemark.sources.topics import TopicConfig
    from tidemark.streaming import jobs

    base = tempfile.mkdtemp(prefix="bench-streams-", dir=ensure_checkpoint_dir(spark))
    cfg = TopicConfig(base_path=os.path.join(base, "topics"))
    once = {"availableNow": True}
    state = os.path.join(base, "state")
    log = P.app_log(table(spark, sf_dir, "events"))
    closing = (log.limit(1).withColumn("event_id", F.lit(-1).cast("long"))
               .withColumn("ts", F.lit(4 * 10 ** 12).cast("long"))
               .withColumn("common", F.col("common").withField("mid", F.lit("~close"))))
    n_events = log.count()
    write_topic(log.unionByName(closing), cfg, S.TOPIC_ODS_LOG, 0)
    page = P.page_log(table(spark, sf_dir, "events"))
    page_close = (page.limit(1).withColumn("event_id", F.lit(-1).cast("long"))
                  .withColumn("ts", F.lit(4 * 10 ** 12).cast("long"))
                  .withColumn("common", F.col("common").withField("mid", F.lit("~close"))))
    write_topic(page.unionByName(page_close), cfg, S.TOPIC_DWD_PAGE, 0)
    info = P.order_info(table(spark, sf_dir, "orders"))
    detail = P.order_detail(table(spark, sf_dir, "lineitem"))
    n_orders = info.count() + detail.count()
    write_topic(info, cfg, S.TOPIC_DWD_ORDER_INFO, 0)
    write_topic(detail, cfg, S.TOPIC_DWD_ORDER_DETAIL, 0)
    hour = 3_600_000
    runs = {
        "log_detail": (lambda: jobs.log_detail_job(spark, cfg, 6 * hour, trigger=once,
                                                   state_root=state), n_events),
        "unique_visitor": (lambda: jobs.unique_visitor_job(spark, cfg, 6 * hour, trigger=once,
                                                           state_root=state), n_events),
        "bounce": (lambda: jobs.bounce_job(spark, cfg, C.BOUNCE_WITHIN_MS, trigger=once,
                                           state_root=state), n_events),
        "order_wide": (lambda: jobs.order_wide_job(spark, cfg, Q._dims(spark, sf_dir), C.AS_OF,
                                                   C.ORDER_BAND_MS, C.ORDER_BAND_MS,
                                                   trigger=once, state_root=state), n_orders),
    }
    out = {}
    for name, (start, rows) in runs.items():
        try:
            t0 = time.perf_counter()
            for q in start():
                q.awaitTermination()
                if q.exception() is not None:
                    raise RuntimeError(str(q.exception())[:200])
            sec = time.perf_counter() - t0
            out[name] = {"sec": round(sec, 3), "rows_per_sec": round(rows / sec)}
        except Exception as e:  # reported, never fatal to the bench
            out[name] = {"error": f"{type(e).__name__}: {str(e)[:200]}"}
    return out


if __name__ == "__main__":
    main()
