"""A job-shaped view over the supplied ``lineitem`` table.

The test tables hold no accounting exports, so every ``lineitem`` row is
read as one job record in the export's raw text layout (the same 17 text
columns a ``jobs_<Mon>.txt`` file yields) plus its file token ``Period``,
the month of ``l_shipdate``. Like the monthly exports, only the month
token is kept: rows of every year fall into their month's "file".

The mapping (kept identical in the SQL twin used by the oracle check):

* JobID = l_orderkey*10 + l_linenumber
* ElapsedRaw = floor(l_extendedprice)
* Account = f / ee / loc prefix by l_returnflag (A / R / other) + l_suppkey
* Partition by l_partkey % 3: normal-arm, normal-a100-40, normal-x86
* State by l_suppkey % 4: COMPLETED, FAILED, 'CANCELLED by <l_suppkey>', TIMEOUT
* NNodes = '1K' (malformed) when l_quantity = 50, else floor(l_quantity)
* AllocTRES NULL on line 1, 'cpu=4,gres/gpu=<line>,node=1' on even lines,
  'cpu=4,mem=1G' otherwise
* AllocCPUS = floor(l_quantity) * 8
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtally.functions.calendar import month_abbr

LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_returnflag", "l_shipdate",
)


def _text(c: Column) -> Column:
    return c.cast("string")


def lineitem_as_jobs(lineitem: DataFrame) -> DataFrame:
    """Project ``lineitem`` rows onto the raw job-record layout."""
    li = lineitem.select(*LINEITEM_COLUMNS)
    qty = F.floor(F.col("l_quantity"))
    job_id = _text(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    elapsed = _text(F.floor(F.col("l_extendedprice")))
    cpus = _text(qty * 8)
    nnodes = F.when(F.col("l_quantity") == 50, F.lit("1K")).otherwise(_text(qty))
    account = F.concat(
        F.when(F.col("l_returnflag") == "A", F.lit("f"))
        .when(F.col("l_returnflag") == "R", F.lit("ee"))
        .otherwise(F.lit("loc")),
        _text(F.col("l_suppkey")),
    )
    part_kind = F.col("l_partkey") % 3
    partition = (F.when(part_kind == 0, F.lit("normal-arm"))
                 .when(part_kind == 1, F.lit("normal-a100-40"))
                 .otherwise(F.lit("normal-x86")))
    state_kind = F.col("l_suppkey") % 4
    state = (F.when(state_kind == 0, F.lit("COMPLETED"))
             .when(state_kind == 1, F.lit("FAILED"))
             .when(state_kind == 2, F.concat(F.lit("CANCELLED by "), _text(F.col("l_suppkey"))))
             .otherwise(F.lit("TIMEOUT")))
    line = F.col("l_linenumber")
    tres = (F.when(line == 1, F.lit(None).cast("string"))
            .when(line % 2 == 0, F.concat(F.lit("cpu=4,gres/gpu="), _text(line), F.lit(",node=1")))
            .otherwise(F.lit("cpu=4,mem=1G")))
    none = F.lit(None).cast("string")
    return li.select(
        job_id.alias("JobID"),
        job_id.alias("JobIDRaw"),
        elapsed.alias("ElapsedRaw"),
        account.alias("Account"),
        cpus.alias("AllocCPUS"),
        none.alias("CPUTimeRAW"),
        nnodes.alias("NNodes"),
        nnodes.alias("AllocNodes"),
        cpus.alias("NCPUS"),
        partition.alias("Partition"),
        none.alias("TotalCPU"),
        F.concat(F.lit("u"), _text(F.col("l_suppkey"))).alias("User"),
        F.lit("0:0").alias("ExitCode"),
        state.alias("State"),
        none.alias("Reservation"),
        none.alias("ReservationId"),
        tres.alias("AllocTRES"),
        month_abbr(F.month(F.col("l_shipdate"))).alias("Period"),
    )


def read_job_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw job records for a test-data folder (whole ``lineitem`` table)."""
    return lineitem_as_jobs(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"))


# DuckDB twin of :func:`lineitem_as_jobs` (only the columns the report uses).
RAW_JOBS_SQL = """
SELECT
  CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS "JobID",
  CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS "ElapsedRaw",
  concat(CASE l_returnflag WHEN 'A' THEN 'f' WHEN 'R' THEN 'ee' ELSE 'loc' END,
         CAST(l_suppkey AS VARCHAR)) AS "Account",
  CAST(CAST(floor(l_quantity) AS BIGINT) * 8 AS VARCHAR) AS "AllocCPUS",
  CASE WHEN l_quantity = 50 THEN '1K'
       ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END AS "NNodes",
  CASE l_partkey % 3 WHEN 0 THEN 'normal-arm' WHEN 1 THEN 'normal-a100-40'
       ELSE 'normal-x86' END AS "Partition",
  CASE l_suppkey % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'FAILED'
       WHEN 2 THEN concat('CANCELLED by ', CAST(l_suppkey AS VARCHAR))
       ELSE 'TIMEOUT' END AS "State",
  CASE WHEN l_linenumber = 1 THEN NULL
       WHEN l_linenumber % 2 = 0 THEN concat('cpu=4,gres/gpu=', CAST(l_linenumber AS VARCHAR), ',node=1')
       ELSE 'cpu=4,mem=1G' END AS "AllocTRES",
  strftime(l_shipdate, '%b') AS "Period"
FROM lineitem
"""
