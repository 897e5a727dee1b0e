"""Monthly job-accounting report, end to end.

    raw job rows --derive--> typed rows --(Period in window months)-->
    per-(Period, cluster) partial sums --broadcast (Period, tag)-->
    per-(tag, cluster) measures --fill/unpivot--> 70-row long report

Only the months of the Year window are read (file or partition pruning on a
file source). The heavy part is one scan with a map-side partial aggregate:
the first shuffle carries at most 36 rows per scan task, the second at most
36 rows in all.
"""

from __future__ import annotations

import os
import sys

if not __package__:  # run by path, e.g. by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from jobtally.functions.calendar import (period_calendar, period_dimension,
                                         resolve_month, window_months)
from jobtally.operators import metrics as M
from jobtally.operators.derive import derive_jobs
from jobtally.operators.periods import keep_months, tag_jobs
from jobtally.operators.report import report_long
from jobtally.sources.jobfiles import read_job_files, read_landed_jobs

FORMS = ("fused", "tagged", "grouped")


def window_measures(spark: SparkSession, jobs: DataFrame, m: int,
                    form: str = "fused", persist: bool = False,
                    repartition: int | None = None) -> DataFrame:
    """(tag, cluster, 6 measures) for report month ``m``.

    ``form``: ``fused`` (aggregate per month, then tag; flagship),
    ``tagged`` (tag every row, then aggregate) or ``grouped`` (aggregate by
    all grouping columns, then derive). ``persist`` caches the tagged rows,
    computes the measures (at most 9 rows) and releases the cache before it
    returns; the fused form has no tagged rows to cache and rejects it.
    ``repartition`` round-robins rows first (off by default: a full shuffle
    before a tiny aggregate only costs).
    """
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}")
    if persist and form == "fused":
        raise ValueError("the fused form keeps no rows that could be cached")
    months = window_months(m)["Year"]
    dim = period_dimension(spark, m)
    if repartition:
        jobs = jobs.repartition(repartition)
    if form == "fused":
        return M.window_metrics(jobs, dim, months)
    tagged = tag_jobs(keep_months(jobs, months), dim)
    measure = M.fused_metrics if form == "tagged" else M.grouped_metrics
    if not persist:
        return measure(tagged)
    cached = tagged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        result = measure(cached)
        return spark.createDataFrame(result.collect(), result.schema)
    finally:
        cached.unpersist()


def monthly_report(spark: SparkSession, raw_jobs: DataFrame, month: str | None = None,
                   year: int | None = None, start: str | None = None,
                   form: str = "fused", persist: bool = False,
                   repartition: int | None = None) -> DataFrame:
    """The 70-row long report (ord, name, value, value_num) for raw job rows.

    ``persist`` and ``repartition`` as in :func:`window_measures`.
    """
    m, y = resolve_month(month, year)
    jobs = derive_jobs(raw_jobs)
    calendar = period_calendar(spark, m, y, start)
    if form == "fused" and not persist:
        # zero rows for empty groups ride along in the rollup: no fill join
        if repartition:
            jobs = jobs.repartition(repartition)
        measures = M.window_metrics(jobs, period_dimension(spark, m), window_months(m)["Year"],
                                    all_groups=True)
        return report_long(spark, measures, calendar, complete=True)
    return report_long(spark, window_measures(spark, jobs, m, form, persist, repartition), calendar)


def report_from_files(spark: SparkSession, data_dir: str, month: str | None = None,
                      year: int | None = None, start: str | None = None,
                      period_aliases: dict[str, str] | None = None,
                      form: str = "fused") -> DataFrame:
    """Report straight from a folder of ``jobs_<Mon>.txt`` exports.

    The month filter is applied on the file-name token, so files outside the
    Year window are never opened.
    """
    m, _ = resolve_month(month, year)
    raw = read_job_files(spark, data_dir, months=window_months(m)["Year"],
                         period_aliases=period_aliases)
    return monthly_report(spark, raw, month, year, start, form)


def report_from_landing(spark: SparkSession, landing_path: str, month: str | None = None,
                        year: int | None = None, start: str | None = None,
                        period_aliases: dict[str, str] | None = None,
                        form: str = "fused") -> DataFrame:
    """Report from the parquet landing (:func:`jobtally.sources.jobfiles.land_jobs`).

    Only the Year-window ``Period=`` partitions are listed and read
    (partition pruning), with vectorised reads of the seven used columns.
    """
    m, _ = resolve_month(month, year)
    raw = read_landed_jobs(spark, landing_path, window_months(m)["Year"], period_aliases)
    return monthly_report(spark, raw, month, year, start, form)


def main(argv: list[str] | None = None) -> None:
    """Entry point for ``spark-submit jobtally/plans/report_job.py``.

    Writes the report as a parquet table (``<out>/table``) and, from that
    table, as ordered text (``<out>/text``). Settings such as event logging, executor sizing
    or shuffle width come from the submit command / session config.
    """
    import argparse

    from jobtally.operators.report import report_lines, write_report_table, write_report_text
    from jobtally.session import build_session

    ap = argparse.ArgumentParser(description="monthly job-accounting report")
    ap.add_argument("--files", required=True, help="folder of job exports")
    ap.add_argument("--layout", default="flat", choices=("flat", "partitioned"))
    ap.add_argument("--month", help="month token, e.g. Jan (default: previous month)")
    ap.add_argument("--year", type=int)
    ap.add_argument("--start", help="first day of the year window, YYYY-MM-DD")
    ap.add_argument("--alias", action="append", default=[], metavar="RAW=MONTH",
                    help="map a file token onto a month, e.g. Ago=Aug")
    ap.add_argument("--form", default="fused", choices=FORMS)
    ap.add_argument("--persist", action="store_true", help="cache tagged rows (not with --form fused)")
    ap.add_argument("--repartition", type=int, help="round-robin the job rows over this many tasks first")
    ap.add_argument("--out", required=True)
    ap.add_argument("--params-file", help="also write the 70 lines to this one local file")
    ap.add_argument("--master")
    ap.add_argument("--event-log-dir")
    args = ap.parse_args(argv)

    spark = build_session(args.master, event_log_dir=args.event_log_dir)
    aliases = dict(a.split("=", 1) for a in args.alias) or None
    m, _ = resolve_month(args.month, args.year)
    raw = read_job_files(spark, args.files, months=window_months(m)["Year"],
                         period_aliases=aliases, layout=args.layout)
    report = monthly_report(spark, raw, args.month, args.year, args.start, args.form,
                            args.persist, args.repartition)
    # The table is written first and the text rendered from it: the second
    # sink reads 70 stored rows instead of a cached block whose loss (with
    # its executor) would mean rescanning every export.
    table = f"{args.out.rstrip('/')}/table"
    write_report_table(report, table)
    stored = spark.read.parquet(table)
    write_report_text(stored, f"{args.out.rstrip('/')}/text")
    if args.params_file:  # the 70 rows, collected at the edge, as one file
        with open(args.params_file, "w") as fh:
            fh.writelines(r["line"] + "\n" for r in report_lines(stored).orderBy("ord").collect())
    spark.stop()


if __name__ == "__main__":
    main()
