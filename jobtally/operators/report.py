"""Report shaping and sinks.

The report is a long table of 70 ``name -> value`` pairs: 16 header values
(period labels, month, year, capacity constants, day counts, wall-hour
macros) and 3 clusters x 6 measures x 3 windows. A (window, cluster) group
without any job reports the integer 0 everywhere; a group whose jobs have no
known seconds reports 0.0 hours. Numbers are rendered the way the report file has always
shown them: integers plainly, doubles in shortest round-trip form with at
least one decimal ("116148.0675", "5.0").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtally.functions import jobcols as J
from jobtally.functions.calendar import text_array
from jobtally.operators.metrics import group_catalogue

# Capacity constants printed in the report header.
CAPACITY = (
    ("armnodes", 1632),
    ("amdnodes", 500),
    ("gpunodes", 132),
    ("percentaviail", 0.8),
    ("eurohpcavail", 0.35),
)

# Wall-hour entries, left as macros for the typesetter
# (value_num carries the computed number).
HOUR_MACROS = (
    ("monthhours", "ndays", "{\\inteval{\\ndays * 24}}"),
    ("hoursTrimester", "ndaysTrimester", "{\\inteval{\\ndaysTrimester * 24}}"),
    ("hoursYear", "ndaysYear", "{\\inteval{\\ndaysYear * 24}}"),
)

# Report measures (name stem, source column, kind).
REPORT_MEASURES = (
    ("CompletedJobs", "completedJobs", "count"),
    ("FailedJobs", "failedJobs", "count"),
    ("usedhours", "totalSecs", "hours"),
    ("Jobs", "jobCount", "count"),
    ("JobsEuroHPC", "ehpcJobCount", "count"),
    ("usedhoursEuroHPC", "ehpcSecs", "hours"),
)

# Line order of the report file.
REPORT_ORDER = (
    "reportPeriod", "reportPeriodTrimester", "reportPeriodYear", "reportMonth",
    "reportYear", "armnodes", "amdnodes", "gpunodes", "percentaviail",
    "eurohpcavail", "ndays", "armusedhours", "amdusedhours", "gpuusedhours",
    "gpuusedhoursEuroHPC", "amdusedhoursEuroHPC", "armusedhoursEuroHPC",
    "armJobs", "amdJobs", "gpuJobs", "gpuCompletedJobs", "gpuFailedJobs",
    "armCompletedJobs", "amdCompletedJobs", "amdFailedJobs", "armFailedJobs",
    "gpuJobsEuroHPC", "amdJobsEuroHPC", "armJobsEuroHPC", "ndaysTrimester",
    "gpuCompletedJobsTrimester", "gpuFailedJobsTrimester",
    "armCompletedJobsTrimester", "amdCompletedJobsTrimester",
    "amdFailedJobsTrimester", "armFailedJobsTrimester", "armusedhoursTrimester",
    "amdusedhoursTrimester", "gpuusedhoursTrimester", "armJobsTrimester",
    "amdJobsTrimester", "gpuJobsTrimester", "gpuusedhoursEuroHPCTrimester",
    "amdusedhoursEuroHPCTrimester", "armusedhoursEuroHPCTrimester",
    "gpuJobsEuroHPCTrimester", "amdJobsEuroHPCTrimester",
    "armJobsEuroHPCTrimester", "ndaysYear", "gpuCompletedJobsYear",
    "gpuFailedJobsYear", "armCompletedJobsYear", "amdCompletedJobsYear",
    "amdFailedJobsYear", "armFailedJobsYear", "armusedhoursYear",
    "amdusedhoursYear", "gpuusedhoursYear", "armJobsYear", "amdJobsYear",
    "gpuJobsYear", "gpuJobsEuroHPCYear", "amdJobsEuroHPCYear",
    "armJobsEuroHPCYear", "gpuusedhoursEuroHPCYear", "amdusedhoursEuroHPCYear",
    "armusedhoursEuroHPCYear", "monthhours", "hoursTrimester", "hoursYear",
)


def float_text_sql(x: str) -> str:
    """SQL text of :func:`float_text` for the expression ``x``."""
    t = f"regexp_replace(CAST(CAST({x} AS DECIMAL(38,20)) AS STRING), '0+$', '')"
    return (f"CASE WHEN {x} IS NULL THEN CAST(NULL AS STRING) "
            f"WHEN endswith({t}, '.') THEN concat({t}, '0') ELSE {t} END")


def float_text(x: Column) -> Column:
    """Double -> shortest round-trip decimal text, never exponent form.

    Goes through ``decimal(38,20)`` (built from the double's shortest
    digits), then trims trailing zeros and keeps one decimal: 1e7 ->
    '10000000.0', 1/3600 -> '0.0002777777777777778'. Exact for magnitudes
    in [1e-3, 1e18), which covers hours, shares and ratios of the report.
    """
    trimmed = F.regexp_replace(x.cast("decimal(38,20)").cast("string"), "0+$", "")
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed))


def _sql_text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _entry(name: str, value_sql: str, num_sql: str) -> str:
    return (f"named_struct('name', {name}, 'value', {value_sql}, "
            f"'value_num', CAST({num_sql} AS DOUBLE))")


def fill_groups(spark: SparkSession, metrics: DataFrame) -> DataFrame:
    """One row per (window, cluster), zeros where no job fell in a group.

    Both sides have at most 9 rows (3 windows x 3 clusters).
    """
    joined = group_catalogue(spark).join(F.broadcast(metrics), ["tag", "cluster"], "left")
    out = [F.col("tag"), F.col("cluster")]
    for _, src, kind in REPORT_MEASURES:
        if kind == "count":
            out.append(F.coalesce(F.col(src), F.lit(0).cast("bigint")).alias(src))
        else:
            out.append(J.hours(F.col(src)).alias(src.replace("Secs", "Hours")))
    return joined.select(*out)


def measures_long(filled: DataFrame) -> DataFrame:
    """Wide -> long: (name, value, value_num) for every measure of a group.

    Each measure is rendered to text before stacking, so counts stay
    integers ('5', not '5.0'). One SQL projection (``inline`` of an array of
    structs), so the plan is built in a single call.
    """
    sfx = "CASE WHEN tag = 'Month' THEN '' ELSE tag END"
    entries = []
    for stem, src, kind in REPORT_MEASURES:
        col = f"`{src}`" if kind == "count" else f"`{src.replace('Secs', 'Hours')}`"
        text = f"CAST({col} AS STRING)"
        if kind == "hours":  # every job is completed or failed
            text = f"CASE WHEN completedJobs + failedJobs = 0 THEN '0' ELSE {float_text_sql(col)} END"
        entries.append(_entry(f"concat(lower(cluster), '{stem}', {sfx})", text, col))
    return filled.selectExpr(f"inline(array({', '.join(entries)}))")


def header_long(calendar: DataFrame) -> DataFrame:
    """Header values from the one-row calendar plus the capacity constants."""
    entries = []
    for name in ("reportPeriod", "reportPeriodTrimester", "reportPeriodYear", "reportMonth"):
        entries.append(_entry(f"'{name}'", name, "NULL"))
    for name in ("reportYear", "ndays", "ndaysTrimester", "ndaysYear"):
        entries.append(_entry(f"'{name}'", f"CAST({name} AS STRING)", name))
    for name, value in CAPACITY:
        text = f"'{value}'" if isinstance(value, int) else float_text_sql(f"CAST({value!r} AS DOUBLE)")
        entries.append(_entry(f"'{name}'", text, repr(value)))
    for name, days, macro in HOUR_MACROS:
        entries.append(_entry(f"'{name}'", _sql_text(macro), f"{days} * 24"))
    return calendar.selectExpr(f"inline(array({', '.join(entries)}))")


def hours_columns(metrics: DataFrame) -> DataFrame:
    """Counts as they are, seconds -> hours (NULL sums count as 0)."""
    out = [F.col("tag"), F.col("cluster")]
    for _, src, kind in REPORT_MEASURES:
        out.append(F.col(src) if kind == "count"
                   else J.hours(F.col(src)).alias(src.replace("Secs", "Hours")))
    return metrics.select(*out)


def report_long(spark: SparkSession, metrics: DataFrame, calendar: DataFrame,
                complete: bool = False) -> DataFrame:
    """The 70-row report: (ord, name, value, value_num).

    ``complete``: ``metrics`` already holds all 9 (window, cluster) groups
    (``window_metrics(..., all_groups=True)``), so no zero-fill join is
    needed; otherwise missing groups are filled with zeros here.
    """
    filled = hours_columns(metrics) if complete else fill_groups(spark, metrics)
    rows = header_long(calendar).unionByName(measures_long(filled))
    order = text_array(REPORT_ORDER)
    return rows.select(F.array_position(order, F.col("name")).cast("int").alias("ord"),
                       "name", "value", "value_num")


def report_lines(report: DataFrame) -> DataFrame:
    """(ord, line) with line = '\\def\\<name>{<value>}'."""
    return report.select("ord", F.concat(F.lit("\\def\\"), F.col("name"), F.lit("{"),
                                         F.col("value"), F.lit("}")).alias("line"))


def write_report_text(report: DataFrame, path: str) -> None:
    """Write the report as one ordered text file (70 lines, one task)."""
    (report_lines(report).repartition(1).sortWithinPartitions("ord")
     .select("line").write.mode("overwrite").text(path))


def write_report_table(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the long report table (parquet or csv with header)."""
    writer = report.repartition(1).sortWithinPartitions("ord").write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def report_params(report: DataFrame) -> dict[str, str]:
    """Collect the (bounded, 70-row) report as an ordered name -> text dict."""
    return {r["name"]: r["value"] for r in report.orderBy("ord").collect()}
