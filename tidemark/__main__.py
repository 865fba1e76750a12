"""Command line: start one of the warehouse's streaming jobs, or run a
registered query into a table.

    spark-submit -m tidemark log-detail --topics /shared/topics
    python -m tidemark db-detail --kafka broker:9092 --rules /shared/rules --dims /shared/dims
    python -m tidemark query order_wide --sf /root/testdata/sf0.1 --out /shared/out/order_wide

Job progress lives under ``spark.checkpoint.dir``; a restarted job resumes.
"""

from __future__ import annotations

import argparse

from tidemark.plans import config as C


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="cmd", required=True)

    def job(name, **extra):
        s = sub.add_parser(name)
        s.add_argument("--kafka", help="broker list; without it topics are folders")
        s.add_argument("--topics", help="base folder of file topics")
        s.add_argument("--trigger-ms", type=int, default=C.WINDOW_MS)
        s.add_argument("--once", action="store_true", help="process what is there, then stop")
        s.add_argument("--allowance-ms", type=int, default=C.OUT_OF_ORDER_MS)
        for flag, kw in extra.items():
            s.add_argument(flag, **kw)
        return s

    job("log-detail", **{"--window-ms": dict(type=int, default=C.WINDOW_MS)})
    job("unique-visitor", **{"--window-ms": dict(type=int, default=C.WINDOW_MS)})
    job("bounce", **{"--within-ms": dict(type=int, default=C.PATTERN_WITHIN_MS),
                     "--next-rule": dict(default="entry", choices=["entry", "non_entry"]),
                     "--emit": dict(default="both", choices=["both", "timeout"])})
    job("db-detail", **{"--rules": dict(required=True), "--dims": dict(required=True)})
    job("order-wide", **{"--dims": dict(required=True, help="dimension store folder"),
                         "--as-of": dict(required=True),
                         "--band-ms": dict(type=int, default=C.JOIN_BAND_MS)})
    job("raw-log-landing", **{"--incoming": dict(required=True),
                              "--landing": dict(required=True)})
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf", required=True)
    q.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    from tidemark.session import get_session
    spark = get_session()
    if args.cmd == "query":
        from tidemark.plans.queries import QUERIES
        QUERIES[args.name](spark, args.sf).write.mode("overwrite").parquet(args.out)
        return

    from tidemark.sinks.dimensions import DimensionStore
    from tidemark.sources.topics import TopicConfig
    from tidemark.streaming import jobs

    cfg = TopicConfig(kafka_servers=args.kafka, base_path=args.topics)
    trig = {"availableNow": True} if args.once else {"processingTime": f"{args.trigger_ms} milliseconds"}
    if args.cmd == "log-detail":
        qs = jobs.log_detail_job(spark, cfg, args.window_ms, args.allowance_ms, trig)
    elif args.cmd == "unique-visitor":
        qs = jobs.unique_visitor_job(spark, cfg, args.window_ms, args.allowance_ms, trig)
    elif args.cmd == "bounce":
        qs = jobs.bounce_job(spark, cfg, args.within_ms, args.next_rule, args.emit,
                             args.allowance_ms, trig)
    elif args.cmd == "db-detail":
        qs = jobs.db_detail_job(spark, cfg, args.rules, args.dims, trigger=trig)
    elif args.cmd == "order-wide":
        reader = jobs.dimension_reader(DimensionStore(spark, args.dims))
        qs = jobs.order_wide_job(spark, cfg, reader, args.as_of, args.band_ms, args.band_ms,
                                 args.allowance_ms, trig)
    else:
        qs = jobs.raw_log_landing_job(spark, cfg, args.incoming, args.landing, trig)
    for q in qs:
        q.awaitTermination()


if __name__ == "__main__":
    main()
