"""Command line: ``spark-submit -m eventstar`` or ``python -m eventstar``.

  run        land page files as one batch (catalog window with lookback),
             then transform; prints the run statistics as JSON
  ingest     land page files as one batch, no window
  transform  raw -> staging -> star schema; prints the layer counts
  stream     drain new page files from a landing folder (availableNow)
  query      print one analytical report (q1 .. q7)
  counts     print the layer counts
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os

from eventstar.config import PipelineConfig
from eventstar.plans import analytics
from eventstar.plans.pipeline import Pipeline
from eventstar.session import build_session
from eventstar.sources.pages import read_page_files


REPORTS = ["q1", "q1b", "q2", "q3", "q4", "q5", "q6", "q7"]


def _pipeline(args) -> Pipeline:
    spark = build_session(args.master, args.shuffle_partitions)
    cfg = PipelineConfig(max_errors=args.max_errors, on_violation=args.on_violation,
                         lookback_days=args.lookback_days)
    return Pipeline(spark, args.warehouse, cfg)


def _report(pipe: Pipeline, name: str, as_of: dt.date | None):
    s = pipe.star()
    f, t, l, e = s["fact"], s["dim_time"], s["dim_location"], s["dim_event_type"]
    return {
        "q1": lambda: analytics.q1_region(f, l),
        "q1b": lambda: analytics.q1b_region_short(f, l),
        "q2": lambda: analytics.q2_weekday(f, t),
        "q3": lambda: analytics.q3_depth(f, l),
        "q4": lambda: analytics.q4_month(f, t),
        "q5": lambda: analytics.q5_magtype(f, e),
        "q6": lambda: analytics.q6_high_impact(f, t, l, e, as_of=as_of),
        "q7": lambda: analytics.q7_recent_errors(s["errors"]),
    }[name]()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="eventstar", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("command", choices=["run", "ingest", "transform", "stream", "query", "counts"])
    ap.add_argument("--warehouse", required=True, help="folder of the layer tables")
    ap.add_argument("--landing", help="page files (run, ingest, stream)")
    ap.add_argument("--wholetext", action="store_true", help="one page per file")
    ap.add_argument("--files-per-batch", type=int, default=None,
                    help="stream: landed files per micro-batch (one ingestion batch each)")
    ap.add_argument("--report", default="q1", help="q1, q1b, q2 .. q7, or all (query)")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, help="Q6 reference date")
    ap.add_argument("--end-time", type=dt.datetime.fromisoformat, help="window end (run)")
    ap.add_argument("--lookback-days", type=int, default=PipelineConfig.lookback_days)
    ap.add_argument("--max-errors", type=int, default=PipelineConfig.max_errors)
    ap.add_argument("--on-violation", default="quarantine", choices=["quarantine", "fail"])
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=200)
    ap.add_argument("--limit", type=int, help="most rows to print (query; default: all)")
    args = ap.parse_args(argv)

    pipe = _pipeline(args)
    out: object
    if args.command in ("run", "ingest"):
        pages = read_page_files(pipe.spark, args.landing) if args.wholetext else \
            pipe.spark.read.text(args.landing).selectExpr("_metadata.file_path AS page_id", "value")
        if args.command == "run":
            out = pipe.run_full_pipeline(pages=pages, end_time=args.end_time)
        else:
            out = pipe.ingest_pages(pages)
    elif args.command == "transform":
        out = pipe.run_transformations()
    elif args.command == "stream":
        from eventstar.streaming.incremental import start_ingest_stream
        ck = os.path.join(args.warehouse, "_stream_checkpoint")  # lives with the tables
        start_ingest_stream(pipe.spark, args.landing, pipe, ck, wholetext=args.wholetext,
                            files_per_batch=args.files_per_batch).awaitTermination()
        out = pipe.layer_counts()
    elif args.command == "query":
        names = REPORTS if args.report == "all" else [args.report]
        out = {}
        for name in names:
            report = _report(pipe, name, args.as_of)
            rows = report.collect() if args.limit is None else report.limit(args.limit).collect()
            out[name] = [r.asDict() for r in rows]
        out = out if args.report == "all" else out[args.report]
    else:
        out = pipe.layer_counts()
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
