"""Scans of raw job-accounting records.

The records arrive as ``|``-delimited text with a header line, one file per
month (``jobs_<Mon>.txt``). All columns are read as text with an explicit
schema (no header sniffing, no type inference job); numbers are parsed later
with ``try_cast``. The month token of each row comes from its file name via
``_metadata.file_name``, so a filter on ``Period`` prunes whole files before
they are opened.

For repeated reports, :func:`land_jobs` writes the same rows as parquet
partitioned by ``Period``; :func:`read_landed_jobs` then reads only the
wanted months (partition pruning) with vectorised column pruning.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtally.session import listed_in_few_tasks, side_by_side

# Column order of the accounting export (positional, all text).
JOB_COLUMNS = (
    "JobID", "JobIDRaw", "ElapsedRaw", "Account", "AllocCPUS", "CPUTimeRAW",
    "NNodes", "AllocNodes", "NCPUS", "Partition", "TotalCPU", "User",
    "ExitCode", "State", "Reservation", "ReservationId", "AllocTRES",
)
JOB_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in JOB_COLUMNS])

# File naming of the monthly exports.
DEFAULT_GLOB = "jobs_*.txt"
PERIOD_PATTERN = r"jobs_(\w+)(?:\.\d+)?\.txt"
# Older naming rule: the text after the first '_' up to the first '.'.
LEGACY_PERIOD_PATTERN = r"^[^_]*_([^.]*)"
DELIMITER = "|"

#: a month with more rows is written in several files
ROWS_PER_FILE = 1_000_000
#: row groups of the landing: a task has as many open as there are months
LANDED_GROUP_BYTES = 16 << 20


def keep_periods(df: DataFrame, months: Iterable[str] | None,
                   aliases: Mapping[str, str] | None) -> DataFrame:
    """Keep wanted months; filter on the raw file token so pruning holds."""
    if months is None:
        return df
    wanted = set(months)
    raw_tokens = {raw for raw, std in (aliases or {}).items() if std in wanted}
    return df.filter(F.col("Period").isin(sorted(wanted | raw_tokens)))


def apply_aliases(df: DataFrame, aliases: Mapping[str, str] | None) -> DataFrame:
    if not aliases:
        return df
    period = F.col("Period")
    mapped = None
    for raw, std in aliases.items():
        mapped = (F.when(period == raw, F.lit(std)) if mapped is None
                  else mapped.when(period == raw, F.lit(std)))
    return df.withColumn("Period", mapped.otherwise(period))


def read_job_files(
    spark: SparkSession,
    data_dir: str,
    months: Iterable[str] | None = None,
    glob: str = DEFAULT_GLOB,
    period_aliases: Mapping[str, str] | None = None,
    infer_types: bool = False,
    legacy_naming: bool = False,
    layout: str = "flat",
) -> DataFrame:
    """One scan over every monthly file of ``data_dir``.

    ``months``: keep only these period tokens (prunes files).
    ``period_aliases``: e.g. ``{"Ago": "Aug"}`` maps file tokens onto the
    report's month names; off by default, as in the original report, where
    an ``Ago`` file never matches ``Aug`` and drops out.
    ``infer_types``: sniff column types instead of reading text (slower; a
    malformed number then breaks the later cast instead of becoming NULL).
    ``legacy_naming``: period = text after the first '_' up to the first '.'
    of any ``jobs*`` file, instead of the ``jobs_(\\w+).txt`` rule (which takes
    the parts ``jobs_<Mon>.<n>.txt`` of a month as well).
    ``layout="partitioned"``: files live in ``Period=<Mon>/`` folders (as
    written by :func:`write_job_files`); the period is the folder value and a
    months filter prunes folders.
    """
    reader = (spark.read.option("sep", DELIMITER).option("header", True)
              .option("mode", "PERMISSIVE"))
    if infer_types:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(JOB_SCHEMA)
    if layout == "partitioned":
        with listed_in_few_tasks(spark):
            df = reader.csv(data_dir)
        df = keep_periods(df, months, period_aliases)
        return apply_aliases(df, period_aliases)
    if legacy_naming:
        with listed_in_few_tasks(spark):
            df = reader.option("pathGlobFilter", "jobs*").csv(data_dir)
        pattern = LEGACY_PERIOD_PATTERN
    else:
        with listed_in_few_tasks(spark):
            df = reader.csv(f"{data_dir.rstrip('/')}/{glob}")
        pattern = PERIOD_PATTERN
    df = df.withColumn("Period", F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))
    df = keep_periods(df, months, period_aliases)
    return apply_aliases(df, period_aliases)


def write_job_files(raw: DataFrame, path: str) -> None:
    """Write raw job rows as ``|``-delimited text with header, one folder per
    month (``Period=<Mon>/part-*.csv``), readable with
    ``read_job_files(..., layout="partitioned")``. Months that ``raw`` does
    not hold keep what was written before.

    Each task writes one file per month present in its input, the months side
    by side and without a sort, so input that is already split by month (the
    monthly exports) yields one file per task.
    """
    with side_by_side(raw.sparkSession):
        (raw.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("Period")
         .option("sep", DELIMITER).option("header", True).csv(path))


def write_flat_job_files(raw: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write raw job rows the way the exports arrive, directly in ``path``: ``jobs_<Mon>.txt``, and for a
    month of more than ``rows_per_file`` rows parts ``jobs_<Mon>.<n>.txt`` beside it.

    Rows are counted by month first (a dozen numbers). A longer month is written
    where its rows are read: no row is moved or sorted, each task begins a new
    file after ``rows_per_file`` rows, and there are no more tasks than cores or
    than fill their files. Only the rows of shorter months are brought together.
    """
    spark = raw.sparkSession
    jvm = spark._jvm
    folder = f"{path.rstrip('/')}/_months"
    sizes = {r["Period"]: r["n"] for r in raw.groupBy("Period").agg(F.count(F.lit(1)).alias("n")).collect()}
    long = [m for m, n in sizes.items() if n > rows_per_file]
    is_long = F.coalesce(F.col("Period").isin([m for m in long if m is not None]), F.lit(None in long))
    tasks = max(spark.sparkContext.defaultParallelism, -(-sum(sizes.values()) // (rows_per_file * max(len(sizes), 1))))
    short = raw.where(~is_long).repartition("Period")
    with side_by_side(spark):
        for mode, rows in (("overwrite", raw.where(is_long).coalesce(tasks) if long else None),
                           ("append", short if len(long) < len(sizes) or not sizes else None)):
            if rows is not None:
                (rows.write.mode(mode).partitionBy("Period").option("maxRecordsPerFile", rows_per_file)
                 .option("sep", DELIMITER).option("header", True).csv(folder))
    # the parts are renamed, not copied
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for month in fs.listStatus(root):
        token = month.getPath().getName().partition("=")[2]
        parts = [p.getPath() for p in fs.listStatus(month.getPath())] if token else []
        for number, part in enumerate(sorted(parts, key=lambda p: p.getName())):
            name = f"jobs_{token}.{number}.txt" if number else f"jobs_{token}.txt"
            fs.rename(part, jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}"))
    fs.delete(root, True)


def period_tokens(spark: SparkSession, data_dir: str, glob: str = "jobs*",
                  layout: str = "flat", legacy_naming: bool = False) -> list[str]:
    """The distinct period tokens of the exports under ``data_dir``, sorted.

    A metadata listing (``binaryFile`` without its content column opens no
    file); the tokens are made distinct in Spark, so only the few tokens
    reach the driver, never the paths.
    """
    path = F.col("path")
    reader = spark.read.format("binaryFile")
    if layout == "partitioned":
        token = F.regexp_extract(path, r"/Period=([^/]*)/", 1)
        reader = reader.option("recursiveFileLookup", True)
    else:
        token = F.regexp_extract(F.element_at(F.split(path, "/"), -1),
                                 LEGACY_PERIOD_PATTERN if legacy_naming else PERIOD_PATTERN, 1)
        reader = reader.option("pathGlobFilter", glob)
    with listed_in_few_tasks(spark):
        files = reader.load(data_dir)
    rows = files.select(token.alias("token")).where("token <> ''").distinct()
    return sorted(r["token"] for r in rows.collect())


def read_job_files_per_month(spark: SparkSession, data_dir: str,
                             tokens: Iterable[str] | None = None, layout: str = "flat",
                             legacy_naming: bool = False) -> DataFrame:
    """The per-month form: each month is read on its own, tagged with the
    period as a literal, and appended by name.

    One branch per token (about a dozen), so the plan does not grow with the
    number of files; a month filter drops the branches whose literal does not
    match. ``tokens`` default to those found by :func:`period_tokens`; none
    gives an empty frame.
    """
    if tokens is None:
        tokens = period_tokens(spark, data_dir, layout=layout, legacy_naming=legacy_naming)
    tokens = list(tokens)
    if not tokens:
        return spark.createDataFrame([], T.StructType([*JOB_SCHEMA, T.StructField("Period", T.StringType())]))
    whole = read_job_files(spark, data_dir, legacy_naming=legacy_naming, layout=layout)
    columns = [*JOB_COLUMNS, "Period"]
    return union_months(
        whole.filter(F.col("Period") == t).withColumn("Period", F.lit(t)).select(*columns) for t in tokens)


def union_months(frames: Iterable[DataFrame]) -> DataFrame:
    """Append per-month frames (by column name, not position)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def land_jobs(raw: DataFrame, path: str) -> None:
    """Write raw job rows as parquet partitioned by ``Period``.

    Replaces the months that ``raw`` holds and no others, so landing a month
    again after its export was rewritten, or a late month, loses nothing.

    No shuffle and no sort: there are at most a dozen period values, so each scan
    task writes at most that many files, side by side. Hashing rows by ``Period`` instead would
    funnel a whole month (a twelfth of the data, or more when one month is
    hot) through a single task.
    """
    with side_by_side(raw.sparkSession):
        (raw.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", LANDED_GROUP_BYTES)
         .partitionBy("Period").parquet(path))


def read_landed_jobs(spark: SparkSession, path: str, months: Iterable[str] | None = None,
                     period_aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Read the parquet landing; a months filter becomes partition pruning.

    ``period_aliases`` as in :func:`read_job_files`; the filter is on the
    landed tokens, so pruning holds with aliases too.
    """
    df = keep_periods(spark.read.parquet(path), months, period_aliases)
    return apply_aliases(df, period_aliases)
