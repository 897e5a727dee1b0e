import datetime as dt

import pytest

from jobtally.functions.calendar import (period_calendar, period_dimension, resolve_month,
                                         window_months)


@pytest.mark.parametrize("m,tri,year", [
    (1, ["Jan"], ["Jan"]),
    (2, ["Jan", "Feb"], ["Jan", "Feb"]),
    (3, ["Jan", "Feb", "Mar"], ["Jan", "Feb", "Mar"]),
    (5, ["Mar", "Apr", "May"], ["Jan", "Feb", "Mar", "Apr", "May"]),
    (12, ["Oct", "Nov", "Dec"], None),
])
def test_dimension_matches_windows(spark, m, tri, year):
    rows = period_dimension(spark, m).collect()
    got = {}
    for r in rows:
        got.setdefault(r["tag"], []).append(r["Period"])
    assert got["Trimester"] == tri
    assert got["Month"] == [window_months(m)["Month"][0]]
    assert got["Year"] == (year or window_months(12)["Year"])
    assert len(rows) <= 16
    assert window_months(m)["Trimester"] == tri


def test_january_header_matches_report(spark):
    r = period_calendar(spark, 1, 2026).first().asDict()
    assert r == {
        "reportPeriod": "01/01/2026 - 31/01/2026",
        "reportPeriodTrimester": "01/01/2026 - 31/01/2026",
        "reportPeriodYear": "01/01/2026 - 31/01/2026",
        "reportMonth": "January", "reportYear": 2026,
        "ndays": 31, "ndaysTrimester": 31, "ndaysYear": 31,
    }


def test_may_and_start_override(spark):
    r = period_calendar(spark, 5, 2025).first()
    assert r["reportPeriodTrimester"] == "01/03/2025 - 31/05/2025"
    assert (r["ndays"], r["ndaysTrimester"], r["ndaysYear"]) == (31, 92, 151)
    s = period_calendar(spark, 2, 2024, start="2024-01-15").first()
    # start moves the Year label and count, and the Trimester label early in the year
    assert s["reportPeriodYear"] == "15/01/2024 - 29/02/2024"
    assert s["reportPeriodTrimester"] == "15/01/2024 - 29/02/2024"
    assert s["ndaysYear"] == 46 and s["ndaysTrimester"] == 60 and s["ndays"] == 29


def test_default_month_is_previous_month():
    assert resolve_month(None, None, dt.date(2026, 3, 10)) == (2, 2026)
    assert resolve_month(None, None, dt.date(2026, 1, 10)) == (12, 2025)
    assert resolve_month("Jan", 2026) == (1, 2026)
    with pytest.raises(ValueError):
        resolve_month("Ago", 2026)


def test_start_override_after_march(spark):
    r = period_calendar(spark, 5, 2025, start="2025-02-10").first()
    assert r["reportPeriodTrimester"] == "01/03/2025 - 31/05/2025"   # unchanged
    assert r["reportPeriodYear"] == "10/02/2025 - 31/05/2025"
    assert (r["ndaysTrimester"], r["ndaysYear"]) == (92, 111)
    dec = period_calendar(spark, 12, 2024).first()
    assert dec["reportPeriod"] == "01/12/2024 - 31/12/2024" and dec["ndaysYear"] == 366


def test_dimension_mirrors_window_months_for_every_month(spark):
    from pyspark.sql import functions as F

    dims = [period_dimension(spark, m).withColumn("m", F.lit(m)) for m in range(1, 13)]
    allrows = dims[0]
    for d in dims[1:]:
        allrows = allrows.unionByName(d)
    got = {}
    for r in allrows.collect():
        got.setdefault(r["m"], {}).setdefault(r["tag"], []).append(r["Period"])
    for m in range(1, 13):
        assert got[m] == window_months(m)
        assert sum(len(v) for v in got[m].values()) <= 16
