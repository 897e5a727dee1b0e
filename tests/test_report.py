"""Report forms agree; report shape, ordering, number text and sinks."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import SMALL, spark_submit, submit_env
from jobtally.functions.calendar import period_calendar, period_dimension, window_months
from jobtally.operators import metrics as M
from jobtally.operators import report as R
from jobtally.operators.derive import derive_jobs
from jobtally.plans.report_job import monthly_report, window_measures
from jobtally.sources.jobview import read_job_view
from scripts.per_window import per_window_values


def _jobs(spark):
    return derive_jobs(read_job_view(spark, SMALL))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_three_forms_agree(spark):
    jobs = _jobs(spark)
    fused = _rows(window_measures(spark, jobs, 5, form="fused"))
    assert fused == _rows(window_measures(spark, jobs, 5, form="tagged"))
    assert fused == _rows(window_measures(spark, jobs, 5, form="grouped", persist=True))
    assert fused == _rows(window_measures(spark, jobs, 5, form="tagged", repartition=8))
    assert len(fused) == 9


def test_per_window_queries_agree_with_fused(spark):
    jobs = _jobs(spark)
    params = per_window_values(jobs, 5)
    report = R.report_params(monthly_report(spark, read_job_view(spark, SMALL), "May", 2025))
    for name, value in params.items():
        want = report[name]
        assert (repr(value) if isinstance(value, float) else str(value)) == want, name


def test_window_invariants(spark):
    rows = {(r["tag"], r["cluster"]): r for r in
            M.window_metrics(_jobs(spark), period_dimension(spark, 5), window_months(5)["Year"]).collect()}
    for c in ("ARM", "AMD", "GPU"):
        m, t, y = rows[("Month", c)], rows[("Trimester", c)], rows[("Year", c)]
        for k in M.MEASURES:
            assert (m[k] or 0) <= (t[k] or 0) <= (y[k] or 0)
        assert m["completedJobs"] + m["failedJobs"] >= m["jobCount"] >= m["ehpcJobCount"]


def test_january_windows_coincide(spark):
    rows = window_measures(spark, _jobs(spark), 1).collect()
    by_tag = {}
    for r in rows:
        by_tag.setdefault(r["tag"], set()).add(tuple(r)[1:])
    assert by_tag["Month"] == by_tag["Trimester"] == by_tag["Year"]


def test_report_shape_and_order(spark):
    rep = monthly_report(spark, read_job_view(spark, SMALL), "May", 2025)
    rows = rep.orderBy("ord").collect()
    assert [r["name"] for r in rows] == list(R.REPORT_ORDER)
    assert [r["ord"] for r in rows] == list(range(1, 71))
    params = {r["name"]: r["value"] for r in rows}
    assert params["reportMonth"] == "May" and params["armnodes"] == "1632"
    assert params["percentaviail"] == "0.8" and params["eurohpcavail"] == "0.35"
    assert params["monthhours"] == "{\\inteval{\\ndays * 24}}"
    assert params["ndaysYear"] == "151"


def test_missing_groups_report_zero(spark):
    # only ARM jobs in May: every AMD/GPU entry is the integer 0
    raw = read_job_view(spark, SMALL).filter(F.col("Partition").contains("arm"))
    for form in ("fused", "tagged", "grouped"):
        params = R.report_params(monthly_report(spark, raw, "May", 2025, form=form))
        assert {v for n, v in params.items() if n[:3] in ("gpu", "amd") and not n.endswith("nodes")} == {"0"}
        assert params["armJobs"] != "0"
    # jobs without readable run time: hours are 0.0, the jobs are counted
    lost = raw.withColumn("ElapsedRaw", F.lit("n/a"))
    params = R.report_params(monthly_report(spark, lost, "May", 2025))
    assert params["armusedhours"] == "0.0" and params["armJobs"] != "0" and params["gpuusedhours"] == "0"


def test_hours_text_matches_python(spark):
    rng = random.Random(7)
    values = [rng.randrange(0, 10 ** rng.randint(1, 15)) for _ in range(400)]
    values += [0, 1, 418133043, 137871996, 82241196, 10**13, 3600 * 10**7, 12345]
    df = spark.createDataFrame([(v,) for v in values], "s bigint")
    got = df.select("s", R.float_text(F.col("s") / 3600).alias("t")).collect()
    for r in got:
        assert r["t"] == repr(r["s"] / 3600), r["s"]
    assert repr(418133043 / 3600) == "116148.0675"


def test_text_sink_round_trip(spark, tmp_path):
    rep = R.report_long(spark, window_measures(spark, _jobs(spark), 1),
                        period_calendar(spark, 1, 2026))
    out = str(tmp_path / "report")
    R.write_report_text(rep, out)
    parts = glob.glob(os.path.join(out, "part-*"))
    assert len(parts) == 1
    lines = open(parts[0]).read().splitlines()
    assert len(lines) == 70
    assert lines[0] == "\\def\\reportPeriod{01/01/2026 - 31/01/2026}"
    assert lines[-1] == "\\def\\hoursYear{{\\inteval{\\ndaysYear * 24}}}"
    R.write_report_table(rep, str(tmp_path / "table"), fmt="csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "table"))
    assert back.count() == 70


# Published January report: hour values and the integer seconds behind them.
GOLDEN_HOURS = {
    418133043: "116148.0675",
    137871747: "38297.7075",
    82241196: "22844.77666666667",
    143552: "39.87555555555556",
    5589280: "1552.5777777777778",
    11438940: "3177.483333333333",
}


def test_golden_hour_text(spark):
    df = spark.createDataFrame([(s,) for s in GOLDEN_HOURS], "s bigint")
    got = {r["s"]: r["t"] for r in
           df.select("s", R.float_text(R.J.hours(F.col("s"))).alias("t")).collect()}
    assert got == GOLDEN_HOURS


def test_report_values_from_known_sums(spark):
    """Counts and sums of the published January report flow into the right names."""
    metrics = spark.createDataFrame(
        [("Month", "ARM", 6242, 4051, 418133043, 9135, 11438940, 4209),
         ("Month", "GPU", 754, 1421, 82241196, 1492, 143552, 52)],
        "tag string, cluster string, completedJobs long, failedJobs long, totalSecs long, "
        "jobCount long, ehpcSecs long, ehpcJobCount long")
    p = R.report_params(R.report_long(spark, metrics, period_calendar(spark, 1, 2026)))
    assert p["armusedhours"] == "116148.0675" and p["armJobs"] == "9135"
    assert p["armCompletedJobs"] == "6242" and p["armFailedJobs"] == "4051"
    assert p["gpuusedhoursEuroHPC"] == "39.87555555555556" and p["gpuJobsEuroHPC"] == "52"
    assert p["armusedhoursEuroHPC"] == "3177.483333333333"
    assert p["amdJobs"] == "0" and p["amdusedhours"] == "0"   # group absent -> 0
    assert p["armJobsYear"] == "0"                               # other windows absent


# The published January report, every line; # marks a window suffix.
GOLDEN_HEADER = """
reportPeriod 01/01/2026 - 31/01/2026
reportPeriodTrimester 01/01/2026 - 31/01/2026
reportPeriodYear 01/01/2026 - 31/01/2026
reportMonth January
reportYear 2026
armnodes 1632
amdnodes 500
gpunodes 132
percentaviail 0.8
eurohpcavail 0.35
ndays 31
ndaysTrimester 31
ndaysYear 31
monthhours {\\inteval{\\ndays * 24}}
hoursTrimester {\\inteval{\\ndaysTrimester * 24}}
hoursYear {\\inteval{\\ndaysYear * 24}}
"""
GOLDEN_MEASURES = """
armusedhours# 116148.0675
amdusedhours# 38297.7075
gpuusedhours# 22844.77666666667
gpuusedhoursEuroHPC# 39.87555555555556
amdusedhoursEuroHPC# 1552.5777777777778
armusedhoursEuroHPC# 3177.483333333333
armJobs# 9135
amdJobs# 17578
gpuJobs# 1492
gpuCompletedJobs# 754
gpuFailedJobs# 1421
armCompletedJobs# 6242
amdCompletedJobs# 12345
amdFailedJobs# 5446
armFailedJobs# 4051
gpuJobsEuroHPC# 52
amdJobsEuroHPC# 13932
armJobsEuroHPC# 4209
"""


def test_golden_report(spark):
    """All 70 lines of the published report from its integer sums."""
    sums = [("ARM", 6242, 4051, 418133043, 9135, 11438940, 4209),
            ("AMD", 12345, 5446, 137871747, 17578, 5589280, 13932),
            ("GPU", 754, 1421, 82241196, 1492, 143552, 52)]
    metrics = spark.createDataFrame(
        [(tag, *row) for tag in ("Month", "Trimester", "Year") for row in sums],
        "tag string, cluster string, completedJobs long, failedJobs long, totalSecs long, "
        "jobCount long, ehpcSecs long, ehpcJobCount long")
    got = R.report_params(R.report_long(spark, metrics, period_calendar(spark, 1, 2026)))
    want = dict(x.split(" ", 1) for x in GOLDEN_HEADER.strip().split("\n"))
    for line in GOLDEN_MEASURES.strip().split("\n"):
        name, value = line.split(" ")
        want.update({name.replace("#", suffix): value for suffix in ("", "Trimester", "Year")})
    assert len(want) == 70 and got == want
    assert list(got) == list(R.REPORT_ORDER)


def test_directives_leave_nothing_cached(spark):
    raw = read_job_view(spark, SMALL)
    want = R.report_params(monthly_report(spark, raw, "May", 2025))
    for form in ("tagged", "grouped"):
        got = R.report_params(monthly_report(spark, raw, "May", 2025, form=form, persist=True, repartition=6))
        assert got == want
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    assert R.report_params(monthly_report(spark, raw, "May", 2025, repartition=6)) == want
    with pytest.raises(ValueError):
        monthly_report(spark, raw, "May", 2025, persist=True)


def test_submit_entry_point(spark, tmp_path):
    """The README's spark-submit command, from another folder."""
    import subprocess

    from jobtally.sources.jobfiles import write_job_files

    files = str(tmp_path / "exports")
    write_job_files(read_job_view(spark, SMALL), files)
    out = str(tmp_path / "out")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([spark_submit(), "--master", "local[2]", f"{repo}/jobtally/plans/report_job.py",
                    "--files", files, "--layout", "partitioned", "--month", "May", "--year", "2025",
                    "--out", out, "--params-file", str(tmp_path / "params.tex")],
                   cwd=tmp_path, env=submit_env(), check=True, timeout=600, capture_output=True)
    lines = open(glob.glob(os.path.join(out, "text", "part-*"))[0]).read().splitlines()
    want = R.report_params(monthly_report(spark, read_job_view(spark, SMALL), "May", 2025))
    assert lines == [f"\\def\\{k}{{{v}}}" for k, v in want.items()]
    assert open(tmp_path / "params.tex").read().splitlines() == lines
    assert spark.read.parquet(os.path.join(out, "table")).count() == 70
