"""Derivation rules against a plain-Python statement, on generated rows."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtally.operators.derive import derive_jobs
from jobtally.sources.jobfiles import JOB_COLUMNS

COLS = ["Partition", "Account", "State", "ElapsedRaw", "AllocCPUS", "NNodes", "AllocTRES"]


def _joined(parts, sep=""):
    return st.lists(st.sampled_from(parts), min_size=1, max_size=4).map(sep.join)


partition = st.none() | _joined(["dev-", "normal-", "large-", "arm", "a100", "x86", "-40",
                                 "xarm", "A100", "ARM", "a10", "-"])
account = st.none() | _joined(["f", "ee", "e", "F", "loc", "x", "12", "fee"])
state = st.none() | st.sampled_from(["COMPLETED", "FAILED", "TIMEOUT", "CANCELLED",
                                     "CANCELLED by 30910", "completed", "RUNNING", ""])
number = st.none() | st.integers(0, 10**6).map(str) | st.sampled_from(["1K", "x", "", "007"])
tres = st.none() | _joined(["cpu=4", "gres/gpu=2", "gres/gpu=17", "gres/gpu=", "gres/gpu:a100=4",
                            "node=1", "billing=3", "mem=1G"], ",")
row = st.tuples(partition, account, state, number, number, number, tres)


def _int(s):
    return int(s) if s is not None and re.fullmatch(r"[0-9]+", s) else None


def expected(p, a, s, e, c, n, t):
    nn, ee = _int(n), _int(e)
    cluster = "ARM" if p and "arm" in p else "GPU" if p and "a100" in p else "AMD"
    agency = ("FCT" if a and a.startswith("f") else
              "EHPC" if a and a.startswith("ee") else "LOCAL")
    if p and "a100" in p:
        if t is None:
            v = nn
        else:
            m = re.search(r"gres/gpu=([0-9]+)", t)
            v = int(m.group(1)) if m else (None if nn is None else nn * 4)
    else:
        v = nn
    return ("COMPLETED" if s == "COMPLETED" else "FAILED",
            None if s is None else re.sub("CANCELLED(.*)", "CANCELLED", s),
            cluster, agency, v, None if ee is None or v is None else ee * v)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=150, max_size=150))
def test_rules_match_plain_statement(spark, rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i long, " + ", ".join(f"{c} string" for c in COLS))
    others = [c for c in JOB_COLUMNS if c not in COLS]
    raw = df.select("i", *COLS, *[F.lit(None).cast("string").alias(c) for c in others],
                    F.lit("Jan").alias("Period"))
    got = {r["i"]: tuple(r)[1:] for r in derive_jobs(raw, keep=("i",)).select(
        "i", "COMPLETED", "EState", "cluster", "Agency", "VNodes", "totalJobSeconds").collect()}
    for i, r in enumerate(rows):
        assert got[i] == expected(*r), r
