"""Names that several test files of the library use."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def one_col(spark, values, name="v"):
    """A one-column text frame (for value-level cases)."""
    return spark.createDataFrame([(v,) for v in values], f"{name} string")
