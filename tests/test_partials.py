"""The store of monthly partials: only changed months are read again."""

import os

from helpers import SMALL
from jobtally.functions.calendar import period_dimension
from jobtally.operators import metrics as M
from jobtally.operators.derive import derive_jobs
from jobtally.operators.report import report_params
from jobtally.plans.partials import month_stamps, read_partials, refresh_partials, report_from_partials, stored_measures
from jobtally.plans.report_job import report_from_files
from jobtally.sources.jobfiles import read_job_files, write_flat_job_files
from jobtally.sources.jobview import read_job_view

MONTHS = ["Apr", "Aug", "Dec", "Feb", "Jan", "Jul", "Jun", "Mar", "May", "Nov", "Oct", "Sep"]


def _files(store):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(store) for f in names if f.endswith(".parquet")}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_store_follows_the_exports(spark, tmp_path):
    data, store = str(tmp_path / "flat"), str(tmp_path / "store")
    write_flat_job_files(read_job_view(spark, SMALL), data, rows_per_file=300)
    assert read_partials(spark, store).count() == 0
    assert refresh_partials(spark, data, store) == MONTHS
    assert report_params(report_from_partials(spark, store, "May", 2025)) == report_params(report_from_files(spark, data, "May", 2025))
    assert _rows(stored_measures(spark, store, 5)) == _rows(
        M.window_metrics(derive_jobs(read_job_files(spark, data)), period_dimension(spark, 5), ["Jan", "Feb", "Mar", "Apr", "May"]))

    # nothing changed: nothing is written
    before = _files(store)
    assert refresh_partials(spark, data, store) == [] and _files(store) == before

    # one part of March is rewritten: March alone is computed anew
    part = os.path.join(data, "jobs_Mar.1.txt")
    with open(part) as f:
        lines = f.readlines()
    with open(part, "w") as f:
        f.writelines(lines + lines[1:50])
    for crc in os.listdir(data):
        if crc.endswith(".crc"):
            os.rename(os.path.join(data, crc), os.path.join(tmp_path, crc))
    assert refresh_partials(spark, data, store) == ["Mar"]
    after = _files(store)
    changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert changed and all("Period=Mar" in f for f in changed)
    assert report_params(report_from_partials(spark, store, "May", 2025)) == report_params(report_from_files(spark, data, "May", 2025))

    # an export without rows, a late one and a withdrawn one
    header = lines[0]
    for name in os.listdir(data):
        if name.startswith("jobs_Feb"):
            with open(os.path.join(data, name), "w") as f:
                f.write(header)
        if name.startswith("jobs_Apr"):
            os.rename(os.path.join(data, name), os.path.join(tmp_path, name))
    assert refresh_partials(spark, data, store) == ["Feb"]
    assert read_partials(spark, store).where("Period IN ('Apr', 'Feb') AND cluster IS NOT NULL").count() == 0
    assert report_params(report_from_partials(spark, store, "May", 2025)) == report_params(report_from_files(spark, data, "May", 2025))
    assert refresh_partials(spark, data, store) == []
    for name in os.listdir(tmp_path):
        if name.startswith("jobs_Apr"):
            os.rename(os.path.join(tmp_path, name), os.path.join(data, name))
    assert refresh_partials(spark, data, store) == ["Apr"]
    assert report_params(report_from_partials(spark, store, "May", 2025)) == report_params(report_from_files(spark, data, "May", 2025))


def test_report_reads_no_export(spark, tmp_path):
    data, store = str(tmp_path / "flat"), str(tmp_path / "store")
    write_flat_job_files(read_job_view(spark, SMALL), data)
    refresh_partials(spark, data, store)
    plan = stored_measures(spark, store, 5)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and "PartitionFilters: [Period" in plan
    assert read_partials(spark, store).count() <= 36


def test_aliased_export(spark, tmp_path):
    data, store = str(tmp_path / "flat"), str(tmp_path / "store")
    write_flat_job_files(read_job_view(spark, SMALL), data)
    os.rename(os.path.join(data, "jobs_Aug.txt"), os.path.join(data, "jobs_Ago.txt"))
    assert "Ago" in refresh_partials(spark, data, store)
    for aliases in (None, {"Ago": "Aug"}):
        assert report_params(report_from_partials(spark, store, "Sep", 2025, period_aliases=aliases)) == report_params(
            report_from_files(spark, data, "Sep", 2025, period_aliases=aliases))


def test_no_exports(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert month_stamps(spark, str(tmp_path / "none")).count() == 0
    assert refresh_partials(spark, str(tmp_path / "none"), str(tmp_path / "store")) == []
