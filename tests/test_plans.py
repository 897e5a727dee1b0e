"""Physical plan shape of the flagship report."""

from helpers import SMALL
from jobtally.functions.calendar import period_dimension, window_months
from jobtally.operators import metrics as M
from jobtally.operators.derive import derive_jobs
from jobtally.sources.jobview import read_job_view


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    jobs = derive_jobs(read_job_view(spark, SMALL))
    df = M.window_metrics(jobs, period_dimension(spark, 5), window_months(5)["Year"])
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    # one parquet scan, pruned to the seven columns the report reads
    assert formatted.count("ReadSchema") == 1
    read_schema = [ln for ln in formatted.splitlines() if ln.startswith("ReadSchema")][0]
    assert read_schema.split("struct<")[1].count(",") + 1 == 7 and "l_orderkey" not in read_schema
    # partial aggregation before the first shuffle
    assert "partial_count" in formatted and "partial_sum" in formatted


def test_tagged_form_broadcasts_dimension(spark):
    jobs = derive_jobs(read_job_view(spark, SMALL))
    df = M.tagged_window_metrics(jobs, period_dimension(spark, 5), window_months(5)["Year"])
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan


def test_runlog_plans_stay_hash_based(spark):
    from jobtally.operators.runlog import run_totals, stage_table
    from jobtally.sources.eventlog import events_as_listener_lines

    lines = events_as_listener_lines(spark.read.parquet(f"{SMALL}/events.parquet"))
    totals = _plan(run_totals(lines))
    assert "SortAggregate" not in totals and "HashAggregate" in totals
    stages = _plan(stage_table(lines))
    assert stages.count("Exchange") == 1 and "Join" not in stages and "Window" not in stages
    # only stage lines are parsed, once
    assert stages.count("from_json") == 1 and "SparkListenerStage" in stages
    assert totals.count("from_json") == 1


def test_report_path_has_no_fill_join(spark):
    from jobtally.plans.report_job import monthly_report

    rep = monthly_report(spark, read_job_view(spark, SMALL), "May", 2025)
    plan = _plan(rep)
    assert "LeftOuter" not in plan and "SortMergeJoin" not in plan
    assert rep.count() == 70


def test_grouped_form_reads_once(spark):
    from jobtally.operators.periods import keep_months, tag_jobs

    jobs = derive_jobs(read_job_view(spark, SMALL))
    tagged = tag_jobs(keep_months(jobs, window_months(5)["Year"]), period_dimension(spark, 5))
    plan = _plan(M.grouped_metrics(tagged))
    assert plan.count("FileScan") == 1 and "SortMergeJoin" not in plan


def test_session_keeps_what_is_configured(spark):
    from jobtally.session import build_session

    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "123")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        again = build_session("local[2]", shuffle_partitions=8)
        assert again.conf.get("spark.sql.shuffle.partitions") == "123"
        assert again.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
