"""A filter of fixed size in front of a join, built and asked with Spark's own functions.

The keys set bits of one bitmap (``bitmap_construct_agg``), cut into pieces of 32,768
bits; a row asks the piece of its own bit in a broadcast semi join.  The bitmap has
``BITS`` bits however many keys there are, so its broadcast is bounded.  A row
without a partner passes where another key has its bit: an exact join has to
follow.  A row with a partner always passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
PIECE = 1 << 15  # bits of a bitmap of Spark's bitmap functions


def _bit(keys: list[Column], bits: int) -> Column:
    """The bit of a key (null where a part is null: it equals nothing)."""
    some_null = keys[0].isNull()
    for k in keys[1:]:
        some_null = some_null | k.isNull()
    return F.when(~some_null, F.pmod(F.xxhash64(F.lit(31), *keys), F.lit(bits)))


class KeyFilter:
    """The keys of some rows: ``split`` sorts other rows by whether they may meet one."""

    def __init__(self, keys: DataFrame, columns: list[Column], bits: int = BITS):
        self.bits = bits
        places = keys.select(_bit(columns, bits).alias("bit")).where("bit is not null").distinct()
        # one task sees all bits of a piece, so no task holds partial bitmaps of others
        self.pieces = (places.select(F.floor(F.col("bit") / PIECE).alias("_piece"), F.pmod("bit", F.lit(PIECE)).alias("at"))
                       .repartition("_piece").groupBy("_piece").agg(F.expr("bitmap_construct_agg(at)").alias("_bitmap")))

    def _asked(self, columns: list[Column]) -> Column:
        bit = _bit(columns, self.bits)
        at = F.pmod(bit, F.lit(PIECE))
        byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        set_ = F.call_function("getbit", byte, F.pmod(at, F.lit(8)).cast("int")) == 1
        return (F.floor(bit / PIECE) == F.col("_piece")) & set_

    def may_meet(self, rows: DataFrame, columns: list[Column]) -> DataFrame:
        return rows.join(F.broadcast(self.pieces), self._asked(columns), "left_semi")

    def meets_none(self, rows: DataFrame, columns: list[Column]) -> DataFrame:
        return rows.join(F.broadcast(self.pieces), self._asked(columns), "left_anti")
