"""Report calendar: month tokens, period windows, header values.

A report for month *m* of year *y* covers three overlapping windows:

* ``Month``     - month m only
* ``Trimester`` - the trailing three months m-2..m, clipped at January
  (not a calendar quarter)
* ``Year``      - January..m

Month tokens are English abbreviations taken from a fixed list (not the
JVM locale), so the result does not depend on where the job runs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month tokens of the export file names and report header.
MONTH_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
              "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December")
TAGS = ("Month", "Trimester", "Year")
DATE_TEXT = "dd/MM/yyyy"


def _sql_array(values) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def text_array(values) -> Column:
    """A literal array of strings as one SQL expression (one JVM call)."""
    return F.expr(_sql_array(values))


def month_abbr(month_number: Column) -> Column:
    """1..12 -> 'Jan'..'Dec' (NULL outside)."""
    return F.element_at(text_array(MONTH_ABBR), month_number)


def month_index(month: str) -> int:
    """'Jan' -> 1 ... 'Dec' -> 12."""
    if month not in MONTH_ABBR:
        raise ValueError(f"unknown month token {month!r}; expected one of {MONTH_ABBR}")
    return MONTH_ABBR.index(month) + 1


def resolve_month(month: str | None, year: int | None,
                  today: _dt.date | None = None) -> tuple[int, int]:
    """(month number, year) of the report; default is the previous month.

    In January the default is December of the previous year (a plain
    index step back would point at month 0).
    """
    today = today or _dt.date.today()
    if month is None:
        prev = today.replace(day=1) - _dt.timedelta(days=1)
        m = prev.month
        y = year if year is not None else prev.year
    else:
        m = month_index(month)
        y = year if year is not None else today.year
    return m, y


def window_months(m: int) -> dict[str, list[str]]:
    """Tag -> month tokens (driver-side mirror of :func:`period_dimension`)."""
    return {
        "Month": [MONTH_ABBR[m - 1]],
        "Trimester": list(MONTH_ABBR[max(m - 3, 0):m]),
        "Year": list(MONTH_ABBR[:m]),
    }


def period_dimension(spark: SparkSession, m: int) -> DataFrame:
    """(Period, tag) rows for report month ``m``: 1 + up to 3 + up to 12.

    At most 16 rows whatever the data size, so it is always safe to
    broadcast. Built from ``sequence``/``explode`` on a one-row relation
    (JVM only, no Python worker).
    """
    if not 1 <= m <= 12:
        raise ValueError(f"month number out of range: {m}")
    windows = (f"inline(array("
               f"named_struct('tag', 'Month', 'ms', sequence({m}, {m})), "
               f"named_struct('tag', 'Trimester', 'ms', sequence(greatest({m} - 2, 1), {m})), "
               f"named_struct('tag', 'Year', 'ms', sequence(1, {m}))))")
    return (spark.range(0, 1, 1, 1)
            .selectExpr(windows)
            .selectExpr("tag", "explode(ms) AS mi")
            .select(month_abbr(F.col("mi")).alias("Period"), "tag"))


def period_calendar(spark: SparkSession, m: int, year: int,
                    start: str | None = None) -> DataFrame:
    """One row of report header values for month ``m`` of ``year``.

    ``start`` ('YYYY-MM-DD') moves the year window's first day, and with it
    the Year label, the Trimester label in January-March and the Year day
    count; it never changes which months are counted.
    """
    if start:
        _dt.date.fromisoformat(start)  # reject malformed text early
    # one rule for the three windows: from the first day of their first month
    # to the last day of the report month
    windows = spark.range(0, 1, 1, 1).selectExpr(
        "inline(array(" + ", ".join(
            f"named_struct('tag', '{tag}', 'first', make_date({year}, {month_index(months[0])}, 1))"
            for tag, months in window_months(m).items()) + "))")
    last = F.last_day(F.make_date(F.lit(year), F.lit(m), F.lit(1)))
    counted = F.col("first")
    labelled = F.col("first")
    if start:
        moved = F.lit(_dt.date.fromisoformat(start))
        at_january = F.month("first") == 1
        counted = F.when(F.col("tag") == "Year", moved).otherwise(counted)
        # a window that opens in January is labelled from the moved day
        labelled = F.when((F.col("tag") == "Year") | ((F.col("tag") == "Trimester") & at_january & F.lit(m <= 3)),
                          moved).otherwise(labelled)
    text = F.concat(F.date_format(labelled, DATE_TEXT), F.lit(" - "), F.date_format(last, DATE_TEXT))
    days = (F.datediff(last, counted) + 1).cast("long")
    rows = windows.select("tag", text.alias("label"), days.alias("days"))

    def of(tag: str, column: str) -> Column:
        return F.max(F.when(F.col("tag") == tag, F.col(column)))

    suffix = {tag: "" if tag == "Month" else tag for tag in TAGS}
    return rows.agg(
        *[of(tag, "label").alias(f"reportPeriod{suffix[tag]}") for tag in TAGS],
        F.lit(MONTH_NAMES[m - 1]).alias("reportMonth"),
        F.lit(year).cast("long").alias("reportYear"),
        *[of(tag, "days").alias(f"ndays{suffix[tag]}") for tag in TAGS],
    )
