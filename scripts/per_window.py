"""The report as separate small queries per window: the historical shape.

A slow reference point for the benchmark and an equivalence check for the
tests; every step scans the jobs again. Production code uses
``jobtally.operators.metrics.window_metrics``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from jobtally.functions import jobcols as J
from jobtally.functions.calendar import window_months
from jobtally.operators import metrics as M


def _hours(seconds: int | None) -> float:
    return (seconds or 0) / J.SECONDS_PER_HOUR


#: query of (jobs, months), measure name of a row, its value
STEPS = [
    (M.jobs_by_outcome_cluster,
     lambda r: "CompletedJobs" if r["COMPLETED"] == J.COMPLETED else "FailedJobs", lambda r: r["count"]),
    *[(partial(M.having_cluster, cluster=c), lambda r: "usedhours",
       lambda r: _hours(r["sum(totalJobSeconds)"])) for c in J.CLUSTERS],
    (M.nonlocal_jobs, lambda r: "Jobs", lambda r: r["count"]),
    (M.having_agency_sorted, lambda r: "JobsEuroHPC", lambda r: r["count"]),
    (M.agency_cluster_sums, lambda r: "usedhoursEuroHPC", lambda r: _hours(r["sum(totalJobSeconds)"])),
]


def per_window_values(jobs: DataFrame, m: int) -> dict[str, object]:
    """Report name -> value; 7 queries for each of the 3 windows, a few rows each."""
    values = {}
    for tag, months in window_months(m).items():
        for query, measure, value in STEPS:
            for row in query(jobs, months).collect():
                suffix = tag.replace("Month", "")
                values[row["cluster"].lower() + measure(row) + suffix] = value(row)
    return values
