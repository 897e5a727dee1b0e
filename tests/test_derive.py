"""Edge rows of the derivation rules (values fixed by the report's rules)."""

from pyspark.sql import functions as F

from jobtally.operators.derive import derive_jobs
from jobtally.sources.jobfiles import JOB_COLUMNS

# (Partition, Account, State, ElapsedRaw, AllocCPUS, NNodes, AllocTRES) ->
# (COMPLETED, EState, cluster, Agency, VNodes, totalJobSeconds, OldVNodes)
CASES = [
    (("dev-arm", "f20", "COMPLETED", "3600", "64", "2", "cpu=1"),
     ("COMPLETED", "COMPLETED", "ARM", "FCT", 2, 7200, 2.0)),
    (("normal-a100-40", "ee1", "CANCELLED by 30910", "100", "33", "1", "billing=3,gres/gpu=2,node=1"),
     ("FAILED", "CANCELLED", "GPU", "EHPC", 2, 200, 2.03125)),
    (("normal-a100-40", "ee1", "TIMEOUT", "100", "32", "1", None),
     ("FAILED", "TIMEOUT", "GPU", "EHPC", 1, 100, 1.0)),
    (("normal-a100-40", "local", None, "100", "32", "1", "gres/gpu:a100=4,cpu=3"),
     ("FAILED", None, "GPU", "LOCAL", 4, 400, 1.0)),
    ((None, None, "COMPLETED", "10", "1", "1K", None),
     ("COMPLETED", "COMPLETED", "AMD", "LOCAL", None, None, None)),
    (("large-x86", "F9", "FAILED", "x", "1", "1", "cpu=1"),
     ("FAILED", "FAILED", "AMD", "LOCAL", 1, None, 1.0)),
    # a name with both marks: ARM cluster, but GPU-billed
    (("xarm-a100", "ee7", "COMPLETED", "10", "64", "2", "cpu=8,gres/gpu=3,node=2"),
     ("COMPLETED", "COMPLETED", "ARM", "EHPC", 3, 30, 2.0)),
    # two gres/gpu entries: the first wins
    (("normal-a100-80", "fx", "COMPLETED", "10", "64", "1", "gres/gpu=5,gres/gpu=7"),
     ("COMPLETED", "COMPLETED", "GPU", "FCT", 5, 50, 2.0)),
    # GPU partition, resource string without a gpu count -> NNodes * 4
    (("normal-a100-40", "ee2", "RUNNING", "10", "8", "3", "cpu=8"),
     ("FAILED", "RUNNING", "GPU", "EHPC", 12, 120, 1.25)),
]


def _raw(spark, rows):
    cols = ["Partition", "Account", "State", "ElapsedRaw", "AllocCPUS", "NNodes", "AllocTRES"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    others = [c for c in JOB_COLUMNS if c not in cols]
    return df.select(*cols, *[F.lit(None).cast("string").alias(c) for c in others],
                     F.lit("Jan").alias("Period"))


def test_edge_rows(spark):
    raw = _raw(spark, [c[0] for c in CASES]).withColumn("JobID", F.monotonically_increasing_id())
    got = derive_jobs(raw, legacy_nodes=True, keep=("JobID",)).orderBy("JobID").select(
        "COMPLETED", "EState", "cluster", "Agency",
        "VNodes", "totalJobSeconds", "OldVNodes").collect()
    for (inp, want), r in zip(CASES, got):
        assert tuple(r) == want, inp


def test_tolerant_cast_and_intended_legacy(spark):
    raw = _raw(spark, [("normal-a100-40", "f", "COMPLETED", "12", "33", "1K", None)])
    r = derive_jobs(raw, legacy_nodes="intended").first()
    assert r["ElapsedRaw"] == 12 and r["NNodes"] is None and r["AllocCPUS"] == 33
    assert r["OldVNodes"] == 2 and r["VNodes"] is None and r["totalJobSeconds"] is None


def test_derivation_stays_in_codegen(spark):
    raw = _raw(spark, [c[0] for c in CASES])
    plan = derive_jobs(raw)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
