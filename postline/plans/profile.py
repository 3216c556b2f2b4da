"""Column profiles by mergeable sketches.

A landing segment (a load, a file, a day) gets one row per column with a HyperLogLog
sketch of its distinct values and a KLL sketch of its numbers.  A sketch has a size that does
not grow with the rows, so the profile of all segments is merged from a few kilobytes a
segment and column, whatever the segments hold; a new load adds rows to the sketch table
and nothing is read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_DISTINCT = 14   # 2 ** 14 registers: a relative standard error of about 0.8 %
KLL_K = 800        # a rank error of about 0.5 %
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _numbers(df: DataFrame, column: str) -> Column:
    """Numbers as whole hundredths, null where the column is none."""
    kind = dict(df.dtypes)[column]
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.round(F.col(column).cast("decimal(30,4)") * 100).cast("long")
    return F.lit(None).cast("long")


def segment_sketches(rows: DataFrame, segment: str, columns: Sequence[str]) -> DataFrame:
    """(segment, column, n_rows, n_nulls, distinct_sketch, number_sketch): one pass, partial sketches before the shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), _numbers(rows, c).alias("number"))
                      for c in columns])
    return (rows.select(F.col(segment).alias("segment"), F.inline(cells)).groupBy("segment", "column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_nulls"),
        F.hll_sketch_agg("value", F.lit(LG_DISTINCT)).alias("distinct_sketch"),
        F.expr(f"kll_sketch_agg_bigint(number, {KLL_K})").alias("number_sketch")))


def merged(sketches: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """The sketches of several segments as one."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.expr(f"kll_merge_agg_bigint(number_sketch, {KLL_K})").alias("number_sketch"))


def estimates(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``sketches`` with the estimates in place: distinct values, and quantiles of the numbers (null without numbers)."""
    sketch = F.col("number_sketch")
    some = F.call_function("kll_sketch_get_n_bigint", sketch) > 0
    named = [F.when(some, F.call_function("kll_sketch_get_quantile_bigint", sketch, F.lit(float(q))) / 100.0).alias(
        f"q{round(q * 100):02d}") for q in quantiles]
    keys = [c for c in sketches.columns if not c.endswith("_sketch")]
    return sketches.select(*keys, F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"), *named)


def measured(rows: DataFrame, segment: str, columns: Sequence[str]) -> DataFrame:
    """(column, n_rows, n_nulls, exact_distinct, distinct_error, rank_error): merged sketches against exact figures.

    ``rank_error`` is the largest distance, as a share of the numbers, of a quantile estimate from the ranks that its value
    really has.  The exact figures read all rows; they are there to check the sketches, not to profile with.
    """
    found = estimates(merged(segment_sketches(rows, segment, columns)))
    exact = []
    for c in columns:
        number = _numbers(rows, c) / 100.0
        own = found.where(F.col("column") == c)  # one row
        both = rows.select(F.col(c).cast("string").alias("value"), number.alias("x")).crossJoin(F.broadcast(own.drop("column")))
        shares = []
        for q in QUANTILES:
            name = f"q{round(q * 100):02d}"
            below = F.avg((F.col("x") < F.col(name)).cast("double"))
            upto = F.avg((F.col("x") <= F.col(name)).cast("double"))
            shares.append(F.greatest(F.lit(0.0), below - q, q - upto))
        exact.append(both.agg(
            F.lit(c).alias("column"), F.first("n_rows").alias("n_rows"), F.first("n_nulls").alias("n_nulls"),
            F.countDistinct("value").alias("exact_distinct"), F.first("distinct_values").alias("_estimate"),
            F.when(F.count("x") > 0, F.greatest(*shares)).alias("rank_error")))
    rows_ = reduce(DataFrame.unionByName, exact)
    error = F.abs(F.col("_estimate") - F.col("exact_distinct")) / F.greatest("exact_distinct", F.lit(1))
    return rows_.withColumn("distinct_error", error).drop("_estimate")
