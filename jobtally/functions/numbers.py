"""Exact decimal rounding of doubles in plain SQL arithmetic.

``round2_sql(x)`` gives the same double as Python's ``round(x, 2)``: the
exact binary value of ``x`` rounded to two decimals, ties to even. Spark's
``round``/``bround`` round the shortest decimal text of ``x`` instead, which
differs whenever that text ends in 5 but the binary value lies just below
or above it (0.355 is 0.35499999999999998...).

Method: p = x*100 rounded, and the exact rounding error of that product
(Dekker's two-product, splitting x with 2^27+1; 100 needs no split). The
integer part of p and the sign of the error decide the result exactly; only
+-, *, floor and comparisons are used, so the same text runs as a Spark
expression (whole-stage codegen, no Python) and in other SQL engines with
IEEE doubles. Valid for |x| < 2^45.
"""

from __future__ import annotations

def _d(v) -> str:
    return f"CAST({v} AS DOUBLE)"


def round2_sql(x: str) -> str:
    """SQL text of Python's ``round(x, 2)`` for the double expression ``x``."""
    x = f"({x})"
    hundred = _d(100)
    p = f"({x} * {hundred})"
    c = f"({_d(134217729)} * {x})"
    hi = f"({c} - ({c} - {x}))"
    lo = f"({x} - {hi})"
    err = f"(({hi} * {hundred} - {p}) + {lo} * {hundred})"
    fl = f"{_d(f'floor({p})')}"
    frac = f"({p} - {fl})"
    half = _d(0.5)
    k = (f"CASE WHEN {frac} > {half} THEN {fl} + 1 WHEN {frac} < {half} THEN {fl} "
         f"WHEN {err} > 0 THEN {fl} + 1 WHEN {err} < 0 THEN {fl} "
         f"WHEN {fl} - 2 * floor({fl} / 2) = 0 THEN {fl} ELSE {fl} + 1 END")
    return f"({_d(k)} / {hundred})"
