"""jobtally: compute-cluster job accounting on Spark DataFrames.

Layout
------
sources/    job-record scans (delimited files, parquet landing, a job-shaped
            view over the test tables) and event-log text scans
functions/  column expressions: outcome, cluster, agency, billed nodes,
            weighted seconds, hours, report calendar
operators/  DataFrame -> DataFrame steps: derivation, period tagging,
            aggregates, report shaping and sinks, run-log metrics
plans/      end-to-end jobs wiring the steps together
llm/        operators of a training-data pipeline (optional; nothing else imports it)
"""

from jobtally.session import build_session  # noqa: F401
