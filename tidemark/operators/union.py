"""Union by name across inputs whose inferred types may disagree.

``unionByName`` resolves a type clash by implicit casting; under ANSI a
string/bigint clash becomes bigint and fails on the first non-numeric text.
Here conflicting columns are widened first: numeric with numeric to the
wider numeric type (double when integral and fractional meet), anything
else to string. Missing columns become null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
)

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_RANK = {ByteType: 0, ShortType: 1, IntegerType: 2, LongType: 3}


def _common(a: DataType, b: DataType) -> DataType:
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return a if _RANK[type(a)] >= _RANK[type(b)] else b
    numeric = (*_INTEGRAL, FloatType, DoubleType, DecimalType)
    if isinstance(a, numeric) and isinstance(b, numeric):
        return DoubleType()
    return StringType()


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL BY NAME with missing columns as null and safe type widening."""
    target: dict[str, DataType] = {}
    order: list[str] = []
    for df in frames:
        for f in df.schema.fields:
            if f.name not in target:
                target[f.name] = f.dataType
                order.append(f.name)
            else:
                target[f.name] = _common(target[f.name], f.dataType)
    out = None
    for df in frames:
        have = set(df.columns)
        cols = [(F.col(f"`{c}`").cast(target[c]) if df.schema[c].dataType != target[c] else F.col(f"`{c}`")).alias(c)
                if c in have else F.lit(None).cast(target[c]).alias(c) for c in order]
        cur = df.select(*cols)
        out = cur if out is None else out.unionByName(cur)
    return out
