"""Print the formatted physical plans of the headline jobs.

Usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobtally.functions.calendar import window_months  # noqa: E402
from jobtally.operators.runlog import run_metrics, stage_table  # noqa: E402
from jobtally.plans.catalog import SPARK_QUERIES  # noqa: E402
from jobtally.plans.report_job import monthly_report, window_measures  # noqa: E402
from jobtally.operators.derive import derive_jobs  # noqa: E402
from jobtally.session import build_session  # noqa: E402
from jobtally.sources.eventlog import events_as_listener_lines  # noqa: E402
from jobtally.sources.jobfiles import read_job_files, write_job_files  # noqa: E402
from jobtally.sources.jobview import read_job_view  # noqa: E402


def show(title, df):
    print(f"\n===== {title} =====")
    df.explain("formatted")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    files = os.path.join(tempfile.mkdtemp(prefix="jobtally-plans-"), "jobs")
    write_job_files(read_job_view(spark, sf_dir), files)
    raw = read_job_files(spark, files, months=window_months(5)["Year"], layout="partitioned")
    show("window measures from export files (flagship)",
         window_measures(spark, derive_jobs(raw), 5))
    show("70-row report", monthly_report(spark, raw, "May", 2025))
    lines = events_as_listener_lines(spark.read.parquet(f"{sf_dir}/events.parquet"))
    show("run metrics", run_metrics(lines))
    show("stage table", stage_table(lines))
    show("tagged form (join, then aggregate)", SPARK_QUERIES["fused_report_tagged"](spark, sf_dir))
    spark.stop()


if __name__ == "__main__":
    main()
