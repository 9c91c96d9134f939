"""Which record numbers occur: one bit each, in words of 64 neighbouring numbers.

Rows are reduced to words where they are read, by a hash aggregate over longs. What crosses the network is at most
one word for 64 neighbouring record numbers and task, whatever the number of rows, and for sparse numbers
never more than the distinct numbers themselves. Numbers may be negative; a NULL number never occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word's number is the record number without its last bits.
_SHIFT = 6
_WORD, _BITS = "_word", "_bits"


def _word(key: str) -> Column:
    return F.shiftright(F.col(key).cast("bigint"), _SHIFT).alias(_WORD)


def _bit(key: str) -> Column:
    place = F.col(key).cast("bigint").bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def bitmaps(rows: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, _word, _bits)``: all numbers in column ``key``."""
    placed = rows.where(F.col(key).isNotNull()).select(*by, _word(key), _bit(key).alias("_bit"))
    return placed.groupBy(*by, _WORD).agg(F.bit_or("_bit").alias(_BITS))


def occurs(rows: DataFrame, seen: DataFrame, key: str, by: Sequence[str] = (), name: str = "_seen") -> DataFrame:
    """``rows`` with ``name``: whether ``key`` (of the same ``by``) is among the numbers ``seen``."""
    found = rows.withColumn(_WORD, _word(key)).join(seen, [*by, _WORD], "left")
    bit = F.col(_BITS).bitwiseAND(_bit(key)) != 0
    return found.withColumn(name, F.coalesce(bit, F.lit(False))).drop(_WORD, _BITS)


def lacking(whole: DataFrame, seen: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """``(columns of whole, key)``: numbers of the words ``whole`` that ``seen`` lacks, per ``by``."""
    own = [c for c in whole.columns if c not in (_WORD, _BITS)]
    both = whole.withColumnRenamed(_BITS, "_whole").join(seen, [*by, _WORD], "left")
    left = F.col("_whole").bitwiseAND(F.bitwise_not(F.coalesce(_BITS, F.lit(0).cast("bigint"))))
    words = both.select(*own, _WORD, left.alias("_left")).where("_left <> 0")
    places = F.explode(F.expr(f"filter(sequence(0, {(1 << _SHIFT) - 1}), b -> (shiftright(_left, b) & 1) = 1)"))
    return words.select(*own, _WORD, places.alias("_place")).select(
        *own, (F.shiftleft(F.col(_WORD), _SHIFT) + F.col("_place")).alias(key)
    )
