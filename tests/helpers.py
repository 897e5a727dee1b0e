"""Paths and commands shared by the tests."""

import os
import sys

SMALL = "/root/testdata/sf0.001"


def spark_submit() -> str:
    import pyspark

    return os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")


def submit_env() -> dict[str, str]:
    """An environment in which neither driver nor workers find the package by themselves."""
    gone = ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")
    env = {k: v for k, v in os.environ.items() if k not in gone}
    return env | {"PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}
