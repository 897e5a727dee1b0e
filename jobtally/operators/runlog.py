"""Run metrics from Spark event logs: one grouped aggregate per run.

Input: (run_label, file, seq, block, ord, line) rows, e.g. from
:func:`jobtally.sources.eventlog.read_event_logs`. A line is parsed once and
strictly. Blank lines are skipped, lines
that are not one JSON object are counted as parse errors. A decimal where a
whole number is usual keeps its line (its fraction is dropped). Every measure is a
conditional count/sum/min/max/max_by over the run's lines, so any number of
runs costs one scan plus shuffles of small partial aggregates (per block of a
file, then per run).

Output columns (first ten as in the metrics file): run_label, parsed_at,
app_duration_s, driver_time_s, stages_submitted, total_tasks,
input_read_mb, shuffle_write_mb, shuffle_read_mb, executor_gc_s, then
stages_completed, stages_failed, completed_tasks, failed_tasks,
task_span_s, executor_run_s, executors, lines, parse_errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtally.functions.numbers import round2_sql

S = T.StringType()


# Listener event names and the fields read from each line.
APP_START = "SparkListenerApplicationStart"
APP_END = "SparkListenerApplicationEnd"
EXECUTOR_ADDED = "SparkListenerExecutorAdded"
STAGE_SUBMITTED = "SparkListenerStageSubmitted"
STAGE_COMPLETED = "SparkListenerStageCompleted"
TASK_END = "SparkListenerTaskEnd"
ENVIRONMENT_UPDATE = "SparkListenerEnvironmentUpdate"
ENVIRONMENT_SECTIONS = ("Spark Properties", "JVM Information", "System Properties", "Hadoop Properties", "Classpath Entries")


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(f, S) if isinstance(f, str) else T.StructField(f[0], _struct(*f[1])) for f in fields])


# numbers are read as text, see number()
EVENT_SCHEMA = _struct(
    "Event", "Timestamp", "Executor ID",
    ("Stage Info", ("Stage ID", "Stage Name", "Number of Tasks", "Submission Time", "Completion Time", "Failure Reason")),
    ("Task Info", ("Launch Time", "Finish Time")),
    ("Task End Reason", ("Reason",)),
    ("Task Metrics", ("Executor Run Time", "JVM GC Time", ("Shuffle Read Metrics", ("Remote Bytes Read", "Local Bytes Read")),
                      ("Shuffle Write Metrics", ("Shuffle Bytes Written",)), ("Input Metrics", ("Bytes Read",)))),
)

METRICS_FILE_COLUMNS = (
    "run_label", "parsed_at", "app_duration_s", "driver_time_s", "stages_submitted",
    "total_tasks", "input_read_mb", "shuffle_write_mb", "shuffle_read_mb", "executor_gc_s",
)

METRICS_COLUMNS = METRICS_FILE_COLUMNS + (
    "stages_completed", "stages_failed", "completed_tasks", "failed_tasks", "task_span_s",
    "executor_run_s", "executors", "lines", "parse_errors",
)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``ev`` (parsed struct), ``etype``, ``blank`` and ``bad`` flags.

    A line is read as the only element of an array: text after the object, a
    second object or single quotes then fail as they do for a strict parser.
    The parser walks over all fields but those of ``EVENT_SCHEMA``.
    """
    wrapped = F.from_json(F.concat(F.lit("["), F.col("line"), F.lit("]")), T.ArrayType(EVENT_SCHEMA),
                          {"allowSingleQuotes": "false"})
    # generated, not projected: what is filtered or selected later cannot
    # pull a second parse of the line into its own expressions
    ev = F.explode(F.transform(F.array(wrapped), lambda a: F.when(F.size(a) == 1, F.get(a, 0))))
    return (lines.select("*", ev.alias("ev"))
            .withColumn("blank", F.col("line").rlike(r"^\s*$"))
            .withColumn("bad", ~F.col("blank") & F.col("ev").isNull())
            .withColumn("etype", F.when(~F.col("blank") & F.col("ev").isNotNull(), F.coalesce(F.col("ev.Event"), F.lit("")))))


def text(path: str) -> Column:
    """A field of the parsed line as text."""
    field = F.col("ev")
    for part in path.split("/"):
        field = field[part]
    return field


def number(path: str) -> Column:
    """A JSON number of the parsed line as long; a fraction is dropped."""
    return F.coalesce(text(path).try_cast("bigint"), text(path).try_cast("double").try_cast("bigint"))


def _is(event: str) -> Column:
    return F.col("etype") == event


def _truthy_num(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def ms_to_s_sql(ms: str) -> str:
    """ms -> s rounded to 2 like Python's round; zero or missing -> NULL."""
    return (f"CASE WHEN {ms} IS NOT NULL AND {ms} <> 0 THEN "
            f"{round2_sql(f'CAST({ms} AS DOUBLE) / CAST(1000 AS DOUBLE)')} END")


def bytes_to_mb_sql(b: str) -> str:
    """bytes -> MB rounded to 2 like Python's round."""
    return round2_sql(f"CAST({b} AS DOUBLE) / CAST(1048576 AS DOUBLE)")


def run_totals(lines: DataFrame) -> DataFrame:
    """Raw per-run totals (integers, ms and bytes), before unit conversion.

    Lines are aggregated per block of a file first (and per executor added, for
    the distinct count), blocks per run then. Of repeated application starts or
    ends the last one holds: by row within a block, by file number and block
    after that. All buffers are fixed-width, so Spark plans hash aggregates with
    map-side partial results: a run spread over many files or holding most of
    the lines still costs a few small rows per block.
    """
    p = parse_lines(lines)
    task, completed = _is(TASK_END), _is(STAGE_COMPLETED)
    summed = lambda event, path: F.sum(F.when(event, number(path)))
    last = lambda event: F.max_by(F.when(event, number("Timestamp")), F.when(event, F.col("ord")))
    failed = F.coalesce(text("Stage Info/Failure Reason"), F.lit("")) != ""
    success = F.coalesce(text("Task End Reason/Reason"), F.lit("")) == "Success"
    truthy = lambda path: F.nullif(number(path), F.lit(0).cast("long"))
    place = F.least(F.col("seq"), F.lit((1 << 16) - 1)) * F.lit(1 << 47) + F.col("block")
    counts = {
        "lines": F.count(F.lit(1)), "parse_errors": F.count_if("bad"), "stages_submitted": F.count_if(_is(STAGE_SUBMITTED)),
        "total_tasks": summed(_is(STAGE_SUBMITTED), "Stage Info/Number of Tasks"),
        "stages_failed": F.count_if(completed & failed), "stages_completed": F.count_if(completed & ~failed),
        "completed_tasks": F.count_if(task & success), "failed_tasks": F.count_if(task & ~success),
        "remote_read": summed(task, "Task Metrics/Shuffle Read Metrics/Remote Bytes Read"),
        "local_read": summed(task, "Task Metrics/Shuffle Read Metrics/Local Bytes Read"),
        "shuffle_write_bytes": summed(task, "Task Metrics/Shuffle Write Metrics/Shuffle Bytes Written"),
        "executor_run_ms": summed(task, "Task Metrics/Executor Run Time"),
        "executor_gc_ms": summed(task, "Task Metrics/JVM GC Time"),
        "input_bytes": summed(task, "Task Metrics/Input Metrics/Bytes Read"),
    }
    executor = F.when(_is(EXECUTOR_ADDED), text("Executor ID"))
    blocks = p.groupBy("run_label", place.alias("place"), executor.alias("executor_id")).agg(
        *(c.alias(name) for name, c in counts.items()),
        last(_is(APP_START)).alias("start_ms"), F.max(F.when(_is(APP_START), place)).alias("start_at"),
        last(_is(APP_END)).alias("end_ms"), F.max(F.when(_is(APP_END), place)).alias("end_at"),
        F.min(F.when(task, truthy("Task Info/Launch Time"))).alias("first_launch_ms"),
        F.max(F.when(task, truthy("Task Info/Finish Time"))).alias("last_finish_ms"))
    agg = blocks.groupBy("run_label").agg(
        *(F.coalesce(F.sum(name), F.lit(0).cast("long")).alias(name) for name in counts),
        F.size(F.collect_set("executor_id")).cast("long").alias("executors"),
        F.max_by("start_ms", "start_at").alias("app_start_ms"), F.max_by("end_ms", "end_at").alias("app_end_ms"),
        F.min("first_launch_ms").alias("first_launch_ms"), F.max("last_finish_ms").alias("last_finish_ms"))
    agg = agg.withColumn("shuffle_read_bytes", F.col("remote_read") + F.col("local_read")).drop("remote_read", "local_read")
    start, end = F.col("app_start_ms"), F.col("app_end_ms")
    app_ms = F.when(_truthy_num(start) & _truthy_num(end), end - start)
    span_ms = F.when(F.col("first_launch_ms").isNotNull() & F.col("last_finish_ms").isNotNull()
                     & app_ms.isNotNull(), F.col("last_finish_ms") - F.col("first_launch_ms"))
    return (agg.withColumn("app_duration_ms", app_ms)
            .withColumn("task_span_ms", span_ms)
            .withColumn("driver_time_ms", app_ms - span_ms))


def run_metrics(lines: DataFrame) -> DataFrame:
    """One metrics row per run (seconds and MB, rounded to 2)."""
    t = run_totals(lines)
    return t.select(
        "run_label",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("parsed_at"),
        F.expr(ms_to_s_sql("app_duration_ms")).alias("app_duration_s"),
        F.expr(ms_to_s_sql("driver_time_ms")).alias("driver_time_s"),
        "stages_submitted", "total_tasks",
        F.expr(bytes_to_mb_sql("input_bytes")).alias("input_read_mb"),
        F.expr(bytes_to_mb_sql("shuffle_write_bytes")).alias("shuffle_write_mb"),
        F.expr(bytes_to_mb_sql("shuffle_read_bytes")).alias("shuffle_read_mb"),
        F.expr(ms_to_s_sql("executor_gc_ms")).alias("executor_gc_s"),
        "stages_completed", "stages_failed", "completed_tasks", "failed_tasks",
        F.expr(ms_to_s_sql("task_span_ms")).alias("task_span_s"),
        F.expr(ms_to_s_sql("executor_run_ms")).alias("executor_run_s"),
        "executors", "lines", "parse_errors",
    )


def stage_table(lines: DataFrame) -> DataFrame:
    """One row per (run, stage): last submission merged with its completion.

    A resubmitted stage keeps its last submission (in log order: file
    number, block, row) and forgets earlier completions; a completion counts only
    when it comes after that submission (the latest such one wins); completions
    of never-submitted stages are dropped. ``attempts`` counts every submission.

    Stages are told apart by log (``file``) as well as by run label, so runs
    read under one fixed label keep their own.

    Plan: only lines that name a stage event are parsed, once. The last
    submission and the last completion of a stage are maxima by position, a
    state that tasks build from their own lines and that merges like any
    aggregate: one small row per stage and task is shuffled, whatever the
    number of events, and there is no window and no join.
    """
    stage_lines = lines.filter(F.col("line").contains("SparkListenerStage"))
    submitted, completed = _is(STAGE_SUBMITTED), _is(STAGE_COMPLETED)
    of = lambda name: f"Stage Info/{name}"
    events = parse_lines(stage_lines).select(
        "run_label", "file", number(of("Stage ID")).alias("stage_id"),
        F.when(submitted, F.struct(
            F.struct("seq", "block", "ord").alias("at"), text(of("Stage Name")).alias("stage_name"), number(of("Number of Tasks")).alias("num_tasks"),
            number(of("Submission Time")).alias("submission_time"))).alias("submission"),
        F.when(completed, F.struct(
            F.struct("seq", "block", "ord").alias("at"), number(of("Completion Time")).alias("completion_time"),
            text(of("Failure Reason")).alias("failure_reason"))).alias("completion"))
    state = events.groupBy("run_label", "file", "stage_id").agg(
        F.max("submission").alias("last"), F.max("completion").alias("done"), F.count("submission").alias("attempts"))
    after = F.col("done.at") > F.col("last.at")
    return state.filter(F.col("last").isNotNull()).select(
        "run_label", "stage_id", "last.stage_name", "last.num_tasks", "last.submission_time",
        F.when(after, F.col("done.completion_time")).alias("completion_time"),
        F.when(after, F.col("done.failure_reason")).alias("failure_reason"), "attempts")


def environment_table(lines: DataFrame) -> DataFrame:
    """(run_label, section, key, value): what a run's environment event says its settings were.

    A run repeats the event when files are added; its last one holds. Lines that
    do not name the event are not parsed.
    """
    sections = [*ENVIRONMENT_SECTIONS]
    schema = T.StructType([T.StructField("Event", S)] + [T.StructField(c, T.MapType(S, S)) for c in sections])
    found = lines.filter(F.col("line").contains(ENVIRONMENT_UPDATE)).select(
        "run_label", F.struct("seq", "block", "ord").alias("at"), F.from_json("line", schema).alias("ev"))
    found = found.filter(F.col("ev.Event") == ENVIRONMENT_UPDATE)
    last = found.groupBy("run_label").agg(F.max_by("ev", "at").alias("ev"))

    def entries(section: str) -> Column:
        pairs = F.map_entries(F.coalesce(F.col("ev")[section], F.create_map().cast("map<string,string>")))
        return F.transform(pairs, lambda e: F.struct(F.lit(section).alias("section"), e["key"].alias("key"), e["value"].alias("value")))

    return last.select("run_label", F.inline(F.concat(*(entries(c) for c in sections))))


def directives(lines: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """(run_label, key, wanted, effective, holds): whether each run had the settings it was meant to have.

    ``effective`` is null where the run knew no such key: a directive that was
    misspelt or came too late, and that Spark ignored. Every run with an
    environment event has a row per wanted key.
    """
    table = environment_table(lines).filter(F.col("section") == "Spark Properties")
    asked = F.explode(F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).alias("wanted")) for k, v in wanted.items())))
    runs = table.select("run_label").distinct().select("run_label", asked.alias("d")).select("run_label", "d.key", "d.wanted")
    known = table.filter(F.col("key").isin(*wanted)).select("run_label", "key", F.col("value").alias("effective"))
    return runs.join(known, ["run_label", "key"], "left").withColumn("holds", F.coalesce(F.col("effective") == F.col("wanted"), F.lit(False)))


def write_run_metrics(metrics: DataFrame, path: str, all_columns: bool = False) -> None:
    """Append run rows to a CSV metrics folder (each part file has a header)."""
    out = metrics.select(*(METRICS_COLUMNS if all_columns else METRICS_FILE_COLUMNS))
    out.write.mode("append").option("header", True).csv(path)


#: folders of a replacing metrics folder; no more than Spark lists without a job
RUN_BUCKETS = 32


def replace_run_metrics(metrics: DataFrame, path: str, all_columns: bool = False) -> None:
    """Put run rows into a metrics folder in place of what it holds of the same runs.

    Runs are dealt to subfolders (``bucket=<n>``) by a hash of their label. The
    rows of other runs in the buckets concerned are written again beside the new
    ones, and each bucket is replaced as a whole when the write commits: a job
    that is tried again, or a log that is analysed again, leaves one row per
    run. Other buckets, and the rows that :func:`write_run_metrics` appended,
    stay as they are. A bucket holds either the ten columns or all.

    The files are as many as the buckets touched, whatever the number of runs;
    ``metrics`` is computed once.
    """
    spark = metrics.sparkSession
    columns = METRICS_COLUMNS if all_columns else METRICS_FILE_COLUMNS
    if _found(spark, f"{path}/run=*"):
        raise ValueError(f"{path} holds a folder per run, as an earlier version wrote them: put those runs into a new folder")
    rows = metrics.select(*columns, F.lit(1).alias("new"))
    if _found(spark, f"{path}/bucket=*"):
        # as text, so that what stays is written as it was
        stored = (spark.read.option("header", True).option("enforceSchema", False).option("multiLine", True)
                  .schema(T.StructType([T.StructField(c, S) for c in columns])).csv(f"{path}/bucket=*"))
        text_rows = rows.select(*(F.col(c).cast("string").alias(c) for c in columns), "new")
        rows = text_rows.unionByName(stored.select("*", F.lit(0).alias("new")))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("run_label"), F.lit(RUN_BUCKETS))).repartition(RUN_BUCKETS, "bucket")
    of_run, of_bucket = Window.partitionBy("bucket", "run_label"), Window.partitionBy("bucket")
    kept = rows.withColumns({"newest": F.max("new").over(of_run), "touched": F.max("new").over(of_bucket)})
    (kept.where("touched = 1 AND new = newest").select(*columns, "bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").option("header", True).csv(path))


def _found(spark: SparkSession, pattern: str) -> bool:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(at)
    return found is not None and len(found) > 0


# Types of the metrics columns.
_TEXT_COLUMNS = ("run_label", "parsed_at")
_COUNT_COLUMNS = ("stages_submitted", "total_tasks", "stages_completed", "stages_failed",
                  "completed_tasks", "failed_tasks", "executors", "lines", "parse_errors")


def metrics_schema(columns) -> T.StructType:
    kind = lambda c: S if c in _TEXT_COLUMNS else T.LongType() if c in _COUNT_COLUMNS else T.DoubleType()
    return T.StructType([T.StructField(c, kind(c)) for c in columns])


def read_run_metrics(spark, path: str, all_columns: bool = False) -> DataFrame:
    """The metrics folder with an explicit schema, the ten standard columns or
    all; a part file with another header is an error, not a silent mix."""
    columns = METRICS_COLUMNS if all_columns else METRICS_FILE_COLUMNS
    return (spark.read.option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
            .schema(metrics_schema(columns)).csv(path))
