"""Monthly partial measures, kept beside the exports and refreshed by month.

The report's measures are counts and sums, so all that a report needs of a
month is its partial per cluster. :func:`refresh_partials` keeps those in a
small store (``Period=<Mon>/``) with a stamp of the month's export files and
reads again only the months whose files changed; any number of reports then
read at most a few rows per month and no export at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtally.functions.calendar import period_calendar, period_dimension, resolve_month, window_months
from jobtally.operators import metrics as M
from jobtally.operators.derive import derive_jobs
from jobtally.operators.report import report_long
from jobtally.session import listed_in_few_tasks
from jobtally.sources.jobfiles import DEFAULT_GLOB, PERIOD_PATTERN, apply_aliases, keep_periods, read_job_files

STORE_DDL = ("cluster string, " + ", ".join(f"{m} bigint" for m in M.MEASURES) + ", stamp string, Period string")


def month_stamps(spark: SparkSession, data_dir: str, glob: str = DEFAULT_GLOB) -> DataFrame:
    """(Period, stamp): what identifies the state of a month's export files (names, sizes, times).

    A listing; no file is opened.
    """
    with listed_in_few_tasks(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(data_dir)
    name = F.element_at(F.split("path", "/"), -1)
    one = F.xxhash64(name, "length", "modificationTime").cast("decimal(38,0)")
    token = F.regexp_extract(name, PERIOD_PATTERN, 1)
    return (files.groupBy(token.alias("Period")).agg(F.concat_ws("/", F.count(F.lit(1)), F.sum(one)).alias("stamp"))
            .where("Period <> ''"))


def read_partials(spark: SparkSession, store: str) -> DataFrame:
    """The store's rows; none where nothing was stored yet."""
    try:
        return spark.read.schema(STORE_DDL).parquet(store)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORE_DDL)


def refresh_partials(spark: SparkSession, data_dir: str, store: str, glob: str = DEFAULT_GLOB) -> list[str]:
    """Bring the store up to date with the exports; the months whose partials were computed anew.

    Each changed month is replaced as a whole when the write commits, so a run
    that failed or was repeated leaves no half or double month. The stamps are
    taken before the files are read: a file that changes meanwhile has another
    stamp at the next refresh. A month whose files are gone keeps one row
    without a cluster, which no report counts.
    """
    stamps = month_stamps(spark, data_dir, glob)
    now = {r["Period"]: r["stamp"] for r in stamps.collect()}  # a row per month token
    kept = {r["Period"]: r["stamp"] for r in read_partials(spark, store).select("Period", "stamp").distinct().collect()}
    changed = sorted(p for p in now if kept.get(p) != now[p])
    gone = sorted(p for p in kept if p not in now and kept[p] != "gone")
    if not changed and not gone:
        return []
    state = spark.createDataFrame([(p, now[p]) for p in changed] + [(p, "gone") for p in gone], "Period string, stamp string")
    raw = read_job_files(spark, data_dir, months=changed, glob=glob)
    rows = state.join(M.month_partials(derive_jobs(raw)), "Period", "left").select("cluster", *M.MEASURES, "stamp", "Period")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Period").parquet(store))
    return changed


def stored_measures(spark: SparkSession, store: str, month: int, months: Iterable[str] | None = None,
                    period_aliases: Mapping[str, str] | None = None, all_groups: bool = False) -> DataFrame:
    """Six measures per (tag, cluster) for a report month, from the store alone."""
    months = window_months(month)["Year"] if months is None else months
    rows = keep_periods(read_partials(spark, store), months, period_aliases).where("cluster IS NOT NULL")
    rows = apply_aliases(rows, period_aliases).select("Period", "cluster", *M.MEASURES)
    return M.window_rollup(rows, period_dimension(spark, month), all_groups)


def report_from_partials(spark: SparkSession, store: str, month: str | None = None, year: int | None = None,
                         start: str | None = None, period_aliases: Mapping[str, str] | None = None) -> DataFrame:
    """The 70-row long report from the store."""
    m, y = resolve_month(month, year)
    measures = stored_measures(spark, store, m, period_aliases=period_aliases, all_groups=True)
    return report_long(spark, measures, period_calendar(spark, m, y, start), complete=True)
