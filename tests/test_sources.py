"""Job-file scans: naming rules, month pruning, aliases, layouts."""

import os

from pyspark.sql import functions as F

from helpers import SMALL
from jobtally.sources.jobfiles import (JOB_COLUMNS, land_jobs, read_job_files, read_landed_jobs,
                                       write_job_files)
from jobtally.sources.jobview import read_job_view

HEADER = "|".join(JOB_COLUMNS)


def _line(job_id, state="COMPLETED", partition="dev-arm", elapsed="10"):
    vals = {c: "" for c in JOB_COLUMNS}
    vals.update(JobID=str(job_id), ElapsedRaw=elapsed, Account="f1", AllocCPUS="4",
                NNodes="1", Partition=partition, State=state)
    return "|".join(vals[c] for c in JOB_COLUMNS)


def _write(folder, name, n, start):
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + "\n")
        for i in range(n):
            f.write(_line(start + i) + "\n")


def _files(tmp_path):
    d = str(tmp_path)
    _write(d, "jobs_Jan.txt", 3, 0)
    _write(d, "jobs_Feb.txt", 4, 100)
    _write(d, "jobs_Ago.txt", 5, 200)
    _write(d, "notes.txt", 6, 300)
    return d


def _counts(df):
    return {r["Period"]: r["n"] for r in df.groupBy("Period").agg(F.count("*").alias("n")).collect()}


def test_glob_scan_tags_period_from_file_name(spark, tmp_path):
    d = _files(tmp_path)
    assert _counts(read_job_files(spark, d)) == {"Jan": 3, "Feb": 4, "Ago": 5}
    assert _counts(read_job_files(spark, d, months=["Jan", "Aug"])) == {"Jan": 3}
    aliased = read_job_files(spark, d, months=["Jan", "Aug"], period_aliases={"Ago": "Aug"})
    assert _counts(aliased) == {"Jan": 3, "Aug": 5}


def test_empty_field_is_null_and_header_skipped(spark, tmp_path):
    d = _files(tmp_path)
    r = read_job_files(spark, d, months=["Jan"]).orderBy("JobID").first()
    assert r["JobID"] == "0" and r["AllocTRES"] is None and r["State"] == "COMPLETED"


def test_legacy_naming_and_inference(spark, tmp_path):
    d = _files(tmp_path)
    legacy = read_job_files(spark, d, legacy_naming=True)
    assert _counts(legacy) == {"Jan": 3, "Feb": 4, "Ago": 5}
    inferred = read_job_files(spark, d, months=["Feb"], infer_types=True)
    assert dict(inferred.dtypes)["ElapsedRaw"] in ("int", "bigint")


def _files_scanned(df) -> int:
    """numFiles metric of the (single) file scan after running ``df``."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())
             if leaves.apply(i).getClass().getSimpleName() == "FileSourceScanExec"]
    assert len(scans) == 1
    return scans[0].metrics().apply("numFiles").value()


def test_month_filter_prunes_files(spark, tmp_path):
    d = _files(tmp_path)
    assert _files_scanned(read_job_files(spark, d, months=["Jan"]).select("JobID")) == 1
    assert _files_scanned(read_job_files(spark, d, months=["Jan", "Feb"]).select("JobID")) == 2
    aliased = read_job_files(spark, d, months=["Aug"], period_aliases={"Ago": "Aug"})
    assert _files_scanned(aliased.select("JobID", "Period")) == 1
    assert _files_scanned(read_job_files(spark, d).select("JobID")) == 3


def test_partitioned_layouts(spark, tmp_path):
    raw = read_job_view(spark, SMALL)
    total = raw.count()
    text_dir = str(tmp_path / "text")
    write_job_files(raw, text_dir)
    back = read_job_files(spark, text_dir, layout="partitioned")
    assert back.count() == total
    may = read_job_files(spark, text_dir, months=["May"], layout="partitioned")
    assert may.count() == raw.filter(F.col("Period") == "May").count()
    plan = may._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "May" in plan
    pq = str(tmp_path / "landing")
    land_jobs(raw, pq)
    assert read_landed_jobs(spark, pq, ["Jan", "Feb"]).count() == \
        raw.filter(F.col("Period").isin("Jan", "Feb")).count()


def test_per_month_form_matches_glob_scan(spark, tmp_path):
    from jobtally.sources.jobfiles import period_tokens, read_job_files_per_month

    d = _files(tmp_path)
    assert period_tokens(spark, d) == ["Ago", "Feb", "Jan"]   # jobs* only: notes.txt excluded
    per_month = read_job_files_per_month(spark, d)
    assert _counts(per_month) == _counts(read_job_files(spark, d))
    legacy = read_job_files_per_month(spark, d, legacy_naming=True)
    assert _counts(legacy) == {"Jan": 3, "Feb": 4, "Ago": 5}
    # a month filter removes whole branches before any file is read
    jan = per_month.filter(F.col("Period") == "Jan").select("JobID")
    assert _files_scanned(jan) == 1
    empty = tmp_path / "none"
    empty.mkdir()
    assert read_job_files_per_month(spark, str(empty)).count() == 0


def test_gzip_exports(spark, tmp_path):
    import gzip

    d = tmp_path / "gz"
    d.mkdir()
    lines = [HEADER] + [_line(i) for i in range(4)]
    with gzip.open(d / "jobs_Jan.txt.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    _write(str(d), "jobs_Feb.txt", 2, 10)
    df = read_job_files(spark, str(d), glob="jobs_*.txt*")
    assert _counts(df) == {"Jan": 4, "Feb": 2}
    assert _files_scanned(read_job_files(spark, str(d), months=["Jan"],
                                         glob="jobs_*.txt*").select("JobID")) == 1


def test_ago_file_drops_out_unless_aliased(spark, tmp_path):
    from jobtally.operators.report import report_params
    from jobtally.plans.report_job import report_from_files

    d = str(tmp_path)
    _write(d, "jobs_Jul.txt", 2, 0)
    _write(d, "jobs_Ago.txt", 3, 100)
    _write(d, "jobs_Sep.txt", 5, 200)
    plain = report_params(report_from_files(spark, d, "Sep", 2025))
    assert plain["armJobs"] == "5" and plain["armJobsTrimester"] == "7"   # Jul + Sep only
    aliased = report_params(report_from_files(spark, d, "Sep", 2025,
                                              period_aliases={"Ago": "Aug"}))
    assert aliased["armJobsTrimester"] == "10" and aliased["armJobsYear"] == "10"
    assert aliased["armCompletedJobsTrimester"] == "10"


def test_landing_month_split_input_writes_one_file_per_month(spark, tmp_path):
    d = str(tmp_path / "src")
    os.makedirs(d)
    for i, m in enumerate(["Jan", "Feb", "Mar"]):
        _write(d, f"jobs_{m}.txt", 4, 10 * i)
    out = str(tmp_path / "landing")
    land_jobs(read_job_files(spark, d), out)
    for m in ("Jan", "Feb", "Mar"):
        parts = [f for f in os.listdir(os.path.join(out, f"Period={m}")) if f.startswith("part-")]
        assert len(parts) == 1, (m, parts)
    assert read_landed_jobs(spark, out, ["Feb"]).count() == 4


def test_inferred_types_with_malformed_numbers(spark, tmp_path):
    from jobtally.operators.derive import derive_jobs

    d = str(tmp_path)
    with open(os.path.join(d, "jobs_Jan.txt"), "w") as f:
        f.write(HEADER + "\n" + _line(1) + "\n")
        vals = _line(2).split("|")
        vals[JOB_COLUMNS.index("NNodes")] = "1K"
        f.write("|".join(vals) + "\n")
    raw = read_job_files(spark, d, infer_types=True)
    assert dict(raw.dtypes)["NNodes"] == "string"       # '1K' keeps the column text
    got = {r["JobID"]: r["NNodes"] for r in derive_jobs(raw, keep=("JobID",)).collect()}
    assert got == {1: 1, 2: None} or got == {"1": 1, "2": None}


def test_landing_replaces_only_the_months_given(spark, tmp_path):
    """Months landed in turn, a late old file, a month exported again."""
    src, land = str(tmp_path / "src"), str(tmp_path / "land")
    os.makedirs(src)
    _write(src, "jobs_Apr.txt", 3, 0)
    land_jobs(read_job_files(spark, src), land)
    _write(src, "jobs_Mar.txt", 2, 100)
    os.utime(os.path.join(src, "jobs_Mar.txt"), (1_600_000_000, 1_600_000_000))
    land_jobs(read_job_files(spark, src, months=["Mar"]), land)
    assert _counts(read_landed_jobs(spark, land)) == {"Apr": 3, "Mar": 2}
    _write(src, "jobs_Apr.txt", 9, 0)
    land_jobs(read_job_files(spark, src, months=["Apr"]), land)
    assert _counts(read_landed_jobs(spark, land)) == {"Apr": 9, "Mar": 2}
    other = str(tmp_path / "second")
    land_jobs(read_job_files(spark, src), other)
    assert _counts(read_landed_jobs(spark, other)) == {"Apr": 9, "Mar": 2}


def test_text_exports_keep_other_months(spark, tmp_path):
    raw = read_job_view(spark, SMALL)
    out = str(tmp_path / "text")
    write_job_files(raw.filter(F.col("Period") == "Jan"), out)
    write_job_files(raw.filter(F.col("Period") == "Feb"), out)
    counts = _counts(read_job_files(spark, out, layout="partitioned"))
    assert set(counts) == {"Jan", "Feb"}


def test_landed_alias_month(spark, tmp_path):
    from jobtally.operators.report import report_params
    from jobtally.plans.report_job import report_from_files, report_from_landing

    src, land = str(tmp_path / "src"), str(tmp_path / "land")
    os.makedirs(src)
    for name, n in (("Jul", 2), ("Ago", 3), ("Sep", 5)):
        _write(src, f"jobs_{name}.txt", n, 100 * n)
    land_jobs(read_job_files(spark, src), land)
    for aliases, year in ((None, "7"), ({"Ago": "Aug"}, "10")):
        got = report_params(report_from_landing(spark, land, "Sep", 2025, period_aliases=aliases))
        assert got["armJobsYear"] == year
        assert got == report_params(report_from_files(spark, src, "Sep", 2025, period_aliases=aliases))
    assert read_landed_jobs(spark, land, ["Aug"], {"Ago": "Aug"}).select("Period").distinct().collect()[0][0] == "Aug"


def test_flat_exports(spark, tmp_path):
    from jobtally.sources.jobfiles import write_flat_job_files

    raw = read_job_view(spark, SMALL)
    out = str(tmp_path / "flat")
    write_flat_job_files(raw, out)
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == sorted(
        f"jobs_{m}.txt" for m in ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"))
    assert _counts(read_job_files(spark, out)) == _counts(raw)


def test_flat_exports_in_parts(spark, tmp_path):
    """A month with half of all rows is written by several tasks, into parts that the readers take."""
    from jobtally.sources.jobfiles import period_tokens, read_job_files_per_month, write_flat_job_files

    raw = read_job_view(spark, SMALL)
    raw = raw.withColumn("Period", F.when(F.crc32(F.col("JobID").cast("binary")) % 2 == 0, "May").otherwise(F.col("Period")))
    out = str(tmp_path / "flat")
    write_flat_job_files(raw, out, rows_per_file=500)
    files = [f for f in os.listdir(out) if not f.startswith(".")]
    assert "jobs_May.txt" in files and "jobs_May.1.txt" in files and len([f for f in files if f.startswith("jobs_May")]) > 4
    assert _counts(read_job_files(spark, out)) == _counts(raw)
    assert _counts(read_job_files(spark, out, months=["May"])) == {"May": _counts(raw)["May"]}
    assert period_tokens(spark, out) == sorted(_counts(raw))
    assert _counts(read_job_files_per_month(spark, out, legacy_naming=True)) == _counts(raw)


def test_exports_are_written_without_moving_or_sorting_rows(spark, tmp_path, monkeypatch):
    """Long months are written where their rows are read: no shuffle, sort or spill that grows with them."""
    from pyspark.sql import DataFrameWriter

    from jobtally.sources.jobfiles import write_flat_job_files

    plans = []

    def noting(name):
        write = getattr(DataFrameWriter, name)

        def noted(self, path, *args, **kwargs):
            write(self, path, *args, **kwargs)
            assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 13
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())

        monkeypatch.setattr(DataFrameWriter, name, noted)

    noting("csv")
    noting("parquet")
    raw = read_job_view(spark, SMALL).repartition(2).localCheckpoint()
    flat, folders, land = (str(tmp_path / n) for n in ("flat", "folders", "land"))
    write_flat_job_files(raw, flat, rows_per_file=100)
    write_job_files(raw, folders)
    land_jobs(read_job_files(spark, flat), land)
    assert len(plans) == 3 and not [p for p in plans if "Exchange" in p or "Sort" in p]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
    for back in (read_job_files(spark, flat), read_job_files(spark, folders, layout="partitioned"), read_landed_jobs(spark, land)):
        assert _rows_of(back) == _rows_of(raw)


def test_flat_exports_with_short_long_and_missing_months(spark, tmp_path):
    from jobtally.sources.jobfiles import write_flat_job_files

    raw = read_job_view(spark, SMALL).limit(300).withColumn(
        "Period", F.when(F.col("JobID").endswith("1"), "May").when(F.col("JobID").endswith("2"), "Jun").when(F.col("JobID").endswith("3"), None).otherwise("Jul"))
    raw = raw.repartition(5).localCheckpoint()
    counts = {r["Period"]: r["count"] for r in raw.groupBy("Period").count().collect()}
    out = str(tmp_path / "flat")
    write_flat_job_files(raw, out, rows_per_file=counts["Jun"])
    files = [f for f in os.listdir(out) if not f.startswith(".")]
    assert [f for f in files if "Jun" in f] == ["jobs_Jun.txt"] and len([f for f in files if "Jul" in f]) > 1
    back = {r["Period"]: r["count"] for r in read_job_files(spark, out).groupBy("Period").count().collect()}
    assert back == {m or "__HIVE_DEFAULT_PARTITION__": n for m, n in counts.items()}


def _rows_of(df):
    from jobtally.sources.jobfiles import JOB_COLUMNS

    return sorted((tuple(r) for r in df.select(*JOB_COLUMNS, "Period").collect()), key=repr)
