"""Attach report windows (tags) to job rows.

A month can belong to up to three windows (Month, Trimester, Year), so the
join is many-to-many by design and multiplies rows. The dimension has at
most 16 rows (see :func:`jobtally.functions.calendar.period_dimension`),
which is the proven size bound that makes the broadcast safe at any data
size: the job side is never shuffled for the join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_months(jobs: DataFrame, months: Iterable[str]) -> DataFrame:
    """Filter on the wanted month tokens before anything else.

    On a file scan whose ``Period`` comes from ``_metadata.file_name`` (or a
    ``Period=`` partition folder) this prunes whole files; on the parquet
    view it is a cheap in-stage predicate.
    """
    return jobs.filter(F.col("Period").isin(sorted(set(months))))


def tag_jobs(jobs: DataFrame, dimension: DataFrame) -> DataFrame:
    """Inner equi-join on ``Period`` with the broadcast (Period, tag) table."""
    return jobs.join(F.broadcast(dimension), on="Period", how="inner")
