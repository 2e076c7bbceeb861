"""Unions of frames whose columns or types drifted apart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers, from the narrowest to the widest.
_NUMBERS = [T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType]
_WHOLE_DIGITS = {T.BooleanType: 1, T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_DATES = [T.DateType, T.TimestampNTZType, T.TimestampType]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Same columns, matched by name; all rows are kept."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def supertype(kinds: Sequence[T.DataType]) -> T.DataType:
    """Narrowest type that holds all values; text wins over numbers."""
    distinct = [k for i, k in enumerate(kinds) if k not in kinds[:i]]
    real = [k for k in distinct if not isinstance(k, T.NullType)]
    if not real:
        return T.StringType()
    if len(real) == 1:
        return real[0]
    if any(isinstance(k, T.StringType) for k in real):
        return T.StringType()
    if all(isinstance(k, T.DecimalType) or type(k) in _WHOLE_DIGITS for k in real):
        if any(isinstance(k, T.DecimalType) for k in real):
            return _decimal(real)
    if all(type(k) in _NUMBERS for k in real):
        widest = max(real, key=lambda k: _NUMBERS.index(type(k)))
        # A float holds whole numbers only up to 16 bits.
        wide_whole = any(type(k) in (T.IntegerType, T.LongType) for k in real)
        return T.DoubleType() if isinstance(widest, T.FloatType) and wide_whole else widest
    if all(isinstance(k, (T.DecimalType, *_NUMBERS)) for k in real):
        return T.DoubleType()
    if all(type(k) in _DATES for k in real):
        return max(real, key=lambda k: _DATES.index(type(k)))
    if all(isinstance(k, T.ArrayType) for k in real):
        return T.ArrayType(supertype([k.elementType for k in real]))
    if all(isinstance(k, T.StructType) for k in real):
        names = list(dict.fromkeys(n for k in real for n in k.names))
        return T.StructType([
            T.StructField(n, supertype([k[n].dataType for k in real if n in k.names])) for n in names])
    raise TypeError(f"no common type for {[k.simpleString() for k in real]}")


def _decimal(kinds: Sequence[T.DataType]) -> T.DataType:
    """A decimal with room for the whole digits and the fraction of each."""
    scale = max(k.scale for k in kinds if isinstance(k, T.DecimalType))
    whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else _WHOLE_DIGITS[type(k)]
                for k in kinds)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; missing columns become null, types widen to a common one.

    Types are settled from the schemas before the union, because Spark itself would
    turn a mix of text and numbers into numbers.
    """
    names: list[str] = []
    for frame in frames:
        names += [n for n in frame.columns if n not in names]
    target = {
        n: supertype([f.schema[n].dataType for f in frames if n in f.columns]) for n in names
    }
    aligned = [
        frame.select(
            *[
                (F.col(f"`{n}`") if n in frame.columns else F.lit(None))
                .cast(target[n])
                .alias(n)
                for n in names
            ]
        )
        for frame in frames
    ]
    return reduce(lambda left, right: left.union(right), aligned)
