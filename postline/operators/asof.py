"""As-of join: each row with the interval that is open at its time.

Intervals are cut into buckets of time and each bucket's intervals are one sorted array, so a
row meets one array by an equality of buckets and no pair of a row and an interval is
formed that the row does not need; the right one is found inside the row.  Buckets that hold
many rows are dealt over ``salts`` keys, for which the arrays, small as they are, are
repeated.  The array of a bucket holds the intervals that touch it (of those without an
end, the ones that begin in it and the last one before): choose buckets so short that
these are few.

Of several open intervals the one that began last counts, of those the greatest ``name``.
Intervals are half-open; one without an end is open from its start on, one without a start or
that ends before it starts is never open.  A row without a time, or outside all
intervals, has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(time) / seconds)


def with_open_interval(rows: DataFrame, time: str, intervals: DataFrame, start: str, end: str, name: str,
                       alias: str = "open_name", seconds: int = 3600, salts: int = 16) -> DataFrame:
    """``rows`` with ``alias``: the ``name`` of the interval that is open at ``time``, or null."""
    named = intervals.select(F.col(name).cast("string").alias("_name"), F.col(start).alias("_start"), F.col(end).alias("_end"))
    begins = _bucket(F.col("_start"), seconds)
    closed = named.where("_end > _start").withColumn("_bucket", F.explode(F.sequence(begins, _bucket(F.col("_end"), seconds))))
    # of those without an end the last one counts: each in its own bucket, later buckets take over one
    endless = named.where("_start is not null and _end is null").withColumn("_bucket", begins)
    last = endless.groupBy("_bucket").agg(F.max(F.struct("_start", "_name")).alias("_last"))
    until = rows.agg(F.max(_bucket(F.col(time), seconds)).alias("_until"))  # one row
    every = (last.agg(F.min("_bucket").alias("_from")).crossJoin(until).where("_from <= _until")
             .select(F.explode(F.sequence("_from", "_until")).alias("_bucket")))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket of time
    carried = (every.join(last, "_bucket", "left").select("_bucket", F.last("_last", ignorenulls=True).over(before).alias("_last"))
               .where("_last is not null").select("_last._name", "_last._start", F.lit(None).cast("timestamp").alias("_end"), "_bucket"))
    pieces = closed.unionByName(endless).unionByName(carried)
    # the last to begin first, so the first that is open is the one
    arrays = pieces.groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct("_start", "_name", "_end")), asc=False).alias("_runs"))
    arrays = arrays.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    at = F.col(time)
    placed = rows.withColumn("_bucket", _bucket(at, seconds)).withColumn(
        "_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    hit = F.filter("_runs", lambda r: (r["_start"] <= at) & (r["_end"].isNull() | (at < r["_end"])))
    return placed.join(arrays, ["_bucket", "_salt"], "left").withColumn(alias, F.get(hit, F.lit(0))["_name"]).select(*rows.columns, alias)
