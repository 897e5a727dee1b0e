"""Column expressions for job records.

Every function takes and returns a ``Column`` built from
``pyspark.sql.functions`` only, so all of it runs inside whole-stage
codegen next to the scan. Names follow the report's vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and match patterns the report's numbers depend on.
COMPLETED = "COMPLETED"
FAILED = "FAILED"
CANCELLED = "CANCELLED"
CLUSTERS = ("ARM", "AMD", "GPU")
ARM_MARK = "arm"
GPU_MARK = "a100"
AGENCY_FCT = "FCT"
AGENCY_EHPC = "EHPC"
AGENCY_LOCAL = "LOCAL"
FCT_PREFIX = "f"
EHPC_PREFIX = "ee"
GPU_GRES_PATTERN = r"gres/gpu=(\d+)"
GPU_NODE_SHARE = 4  # a GPU job without a gres count bills four units per node
CPUS_PER_GPU_UNIT = 32  # legacy rule: one billed unit per 32 CPUs
SECONDS_PER_HOUR = 3600


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def outcome(state: Column | str = "State") -> Column:
    """COMPLETED only for exactly 'COMPLETED'; anything else (NULL too) FAILED."""
    return F.when(_c(state) == COMPLETED, F.lit(COMPLETED)).otherwise(F.lit(FAILED))


def normalised_state(state: Column | str = "State") -> Column:
    """'CANCELLED by <uid>' -> 'CANCELLED'; other states unchanged."""
    return F.regexp_replace(_c(state), "CANCELLED(.*)", CANCELLED)


def tolerant_bigint(col: Column | str) -> Column:
    """Text -> bigint, NULL for malformed values such as '1K'."""
    return _c(col).try_cast("bigint")


def cluster_class(partition: Column | str = "Partition") -> Column:
    """'arm' anywhere -> ARM, else 'a100' -> GPU, else (NULL too) AMD."""
    p = _c(partition)
    return (
        F.when(p.contains(ARM_MARK), F.lit("ARM"))
        .when(p.contains(GPU_MARK), F.lit("GPU"))
        .otherwise(F.lit("AMD"))
    )


def agency_class(account: Column | str = "Account") -> Column:
    """Prefix 'f' -> FCT, else 'ee' -> EHPC, else (NULL too) LOCAL."""
    a = _c(account)
    return (
        F.when(a.startswith(FCT_PREFIX), F.lit(AGENCY_FCT))
        .when(a.startswith(EHPC_PREFIX), F.lit(AGENCY_EHPC))
        .otherwise(F.lit(AGENCY_LOCAL))
    )


def billed_nodes(
    partition: Column | str = "Partition",
    alloc_tres: Column | str = "AllocTRES",
    nnodes: Column | str = "NNodes",
) -> Column:
    """Billing units of a job.

    Only partitions whose name holds 'a100' are GPU-billed (the partition is
    tested, not the cluster class): no resource string -> NNodes; a
    ``gres/gpu=<n>`` entry -> n (first one wins); otherwise NNodes * 4.
    Every other partition bills NNodes.
    """
    p, tres, n = _c(partition), _c(alloc_tres), _c(nnodes)
    # One regex pass: the group is \d+, so it is non-empty exactly when the
    # pattern matches (no match -> '').
    gres = F.regexp_extract(tres, GPU_GRES_PATTERN, 1)
    gpu_units = (
        F.when(tres.isNull(), n)
        .when(gres != "", gres.try_cast("bigint"))
        .otherwise(n * F.lit(GPU_NODE_SHARE))
    )
    return F.when(p.contains(GPU_MARK), gpu_units).otherwise(n)


def legacy_billed_nodes(
    partition: Column | str = "Partition",
    alloc_cpus: Column | str = "AllocCPUS",
    nnodes: Column | str = "NNodes",
    as_written: bool = True,
) -> Column:
    """Older CPU-share rule for GPU partitions.

    ``as_written`` keeps the historical fractional value (AllocCPUS/32, plus
    one when not a multiple of 32, as a double: 33 CPUs -> 2.03125).
    ``as_written=False`` gives the intended whole count ceil(AllocCPUS/32).
    """
    p, cpus, n = _c(partition), _c(alloc_cpus), _c(nnodes)
    if as_written:
        share = cpus / F.lit(CPUS_PER_GPU_UNIT)
        gpu = F.when(cpus % CPUS_PER_GPU_UNIT == 0, share).otherwise(share + F.lit(1))
        return F.when(p.contains(GPU_MARK), gpu).otherwise(n.cast("double"))
    gpu = F.ceil(cpus / F.lit(CPUS_PER_GPU_UNIT)).cast("bigint")
    return F.when(p.contains(GPU_MARK), gpu).otherwise(n)


def weighted_seconds(
    elapsed: Column | str = "ElapsedRaw", vnodes: Column | str = "VNodes"
) -> Column:
    """ElapsedRaw x billing units; NULL when either is NULL."""
    return _c(elapsed) * _c(vnodes)


def hours(seconds: Column | str) -> Column:
    """Seconds -> hours as double, a missing sum counts as 0."""
    return F.coalesce(_c(seconds), F.lit(0)) / F.lit(SECONDS_PER_HOUR)
