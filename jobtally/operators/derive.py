"""Raw job rows -> typed, classified job rows (one narrow projection).

All columns are built from built-in expressions, so Catalyst collapses the
whole derivation into the scan's codegen stage and prunes the scan to the
seven raw columns actually read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtally.functions import jobcols as J

def derive_jobs(raw: DataFrame, legacy_nodes: bool | str = False,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Add outcome, cluster, agency, billing units and weighted seconds.

    ``legacy_nodes``: also add ``OldVNodes`` (the older CPU-share rule);
    ``True``/``"as_written"`` keeps its historical fractional value,
    ``"intended"`` the whole-number count.
    ``keep``: further raw columns to carry along (e.g. ``JobID``).
    """
    typed = raw.select(
        *keep,
        "State",
        J.normalised_state("State").alias("EState"),
        J.outcome("State").alias("COMPLETED"),
        "Period", "Account", "Partition",
        J.tolerant_bigint("ElapsedRaw").alias("ElapsedRaw"),
        J.tolerant_bigint("NNodes").alias("NNodes"),
        J.tolerant_bigint("AllocCPUS").alias("AllocCPUS"),
        "AllocTRES",
    )
    vnodes = J.billed_nodes("Partition", "AllocTRES", "NNodes")
    cols = [
        F.col(c) for c in typed.columns
    ] + [
        J.cluster_class("Partition").alias("cluster"),
        J.agency_class("Account").alias("Agency"),
        vnodes.alias("VNodes"),
        J.weighted_seconds("ElapsedRaw", vnodes).alias("totalJobSeconds"),
    ]
    if legacy_nodes:
        as_written = legacy_nodes in (True, "as_written")
        cols.append(J.legacy_billed_nodes("Partition", "AllocCPUS", "NNodes",
                                          as_written=as_written).alias("OldVNodes"))
    return typed.select(*cols)
