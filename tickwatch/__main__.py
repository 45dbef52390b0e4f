"""Command line for the batch jobs: ``python -m tickwatch <job> ...``.

Jobs: ``ingest`` (landed API answers -> envelopes), ``process`` (envelopes ->
metrics, anomalies, alerts, run log), ``alert`` (one day's anomalies ->
delivery tally), ``monitor`` (dashboard tables), ``expire`` (raw retention).
The session comes from ``SparkSession.builder.getOrCreate()`` with the
package defaults, so ``spark-submit`` settings (master, checkpoint
directory, shuffle partitions) apply.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tickwatch")
    sub = p.add_subparsers(dest="job", required=True)

    i = sub.add_parser("ingest", help="decode landed answers and land envelopes")
    i.add_argument("--answers", required=True, help="JSON lines: collection_timestamp, body, optional error")
    i.add_argument("--raw", required=True, help="landing root (year=/month=/day=/hour=)")
    i.add_argument("--keys", default=None, help="comma-separated expected keys")
    i.add_argument("--lenient", action="store_true", help="keep complete keys of a partly broken answer")

    pr = sub.add_parser("process", help="envelopes -> metrics, anomalies, alerts, run log")
    pr.add_argument("--raw", required=True)
    pr.add_argument("--metrics", required=True)
    pr.add_argument("--anomalies", required=True)
    pr.add_argument("--runs", default=None, help="run-log table")
    pr.add_argument("--no-alerts", action="store_true")

    a = sub.add_parser("alert", help="deliver one day's anomalies")
    a.add_argument("--anomalies", required=True)
    a.add_argument("--date", default=None, help="YYYY-MM-DD (default: today, UTC)")

    m = sub.add_parser("monitor", help="print the dashboard tables")
    m.add_argument("--metrics", default=None)
    m.add_argument("--anomalies", default=None)
    m.add_argument("--runs", default=None)

    e = sub.add_parser("expire", help="empty raw hours older than the retention")
    e.add_argument("--raw", required=True)
    e.add_argument("--as-of", default=None, help="YYYY-MM-DD (default: today, UTC)")
    e.add_argument("--days", type=int, default=30)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from tickwatch.operators import alerts, flatten
    from tickwatch.plans import jobs
    from tickwatch.session import build_session

    spark = build_session()
    if args.job == "ingest":
        answers = spark.read.schema("collection_timestamp long, body string, error string").json(args.answers)
        keys = tuple(k.strip() for k in args.keys.split(",")) if args.keys else flatten.DEFAULT_KEYS
        summary = jobs.ingestion_job(answers, args.raw, expected_keys=keys, strict=not args.lenient, error_col="error")
        summary.orderBy("collection_timestamp").show(truncate=False)
    elif args.job == "process":
        res = jobs.processing_job(
            spark, args.raw, args.metrics, args.anomalies, args.runs, alert=not args.no_alerts
        )
        print(json.dumps(res.__dict__))
    elif args.job == "alert":
        tally = jobs.alerting_job(spark, args.anomalies, args.date).first()
        print(json.dumps({"succeeded": tally["succeeded"], "failed": tally["failed"]}))
    elif args.job == "monitor":
        for name, df in jobs.monitoring_report(spark, args.metrics, args.anomalies, args.runs).items():
            print(f"--- {name}")
            df.show(truncate=False)
    elif args.job == "expire":
        from tickwatch.sources import envelopes

        as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc).date()
        print(json.dumps({"expired_days": envelopes.expire_raw(spark, args.raw, as_of, args.days)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
