"""Run-log job: any number of Spark event logs -> appended run-metrics rows.

    event-log lines (plain, gzip, zstd; rolling or single file)
      --from_json--> per-run conditional aggregates --units--> metrics rows
      --append--> CSV folder (header per part file)

One scan and one grouped aggregate, whatever the number of runs. The
optional stage table (last submission merged with its completion per
stage) is written as parquet by a second scan of the logs rather than from
a cache, so a lost executor costs recomputation of its own partitions only.
"""

from __future__ import annotations

import os
import sys

if not __package__:  # run by path, e.g. by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession

from jobtally.operators.runlog import environment_table, replace_run_metrics, run_metrics, stage_table, write_run_metrics
from jobtally.sources.eventlog import read_event_logs


def analyse_logs(spark: SparkSession, logs: str | list[str], label: str | None = None,
                 label_from: str = "file") -> DataFrame:
    """Metrics rows for the given logs (see :func:`run_metrics`)."""
    return run_metrics(read_event_logs(spark, logs, label=label, label_from=label_from))


def main(argv: list[str] | None = None) -> None:
    """Entry point for ``spark-submit jobtally/plans/runlog_job.py``."""
    import argparse

    from jobtally.session import build_session

    ap = argparse.ArgumentParser(description="Spark event logs -> run metrics")
    ap.add_argument("logs", nargs="+", help="event-log files, folders or globs")
    ap.add_argument("--label", help="one run label for everything read")
    ap.add_argument("--label-from", default="file", choices=("file", "folder"))
    ap.add_argument("--out", required=True, help="metrics CSV folder (appended)")
    ap.add_argument("--replace", action="store_true", help="replace the rows of the runs that are read instead")
    ap.add_argument("--all-columns", action="store_true")
    ap.add_argument("--stages-out", help="also write the stage table (parquet)")
    ap.add_argument("--environment-out", help="also write the runs' settings (parquet)")
    ap.add_argument("--master")
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    lines = read_event_logs(spark, args.logs, label=args.label, label_from=args.label_from)
    write = replace_run_metrics if args.replace else write_run_metrics
    write(run_metrics(lines), args.out, all_columns=args.all_columns)
    if args.stages_out:
        stage_table(lines).write.mode("overwrite").parquet(args.stages_out)
    if args.environment_out:
        environment_table(lines).write.mode("overwrite").parquet(args.environment_out)
    spark.stop()


if __name__ == "__main__":
    main()
