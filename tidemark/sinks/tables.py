"""Append-only Bronze writes and reads (Parquet folders)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NumericType, ShortType, StructType)

_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
#: beside the data: the schema of everything appended so far
SCHEMA_FILE = "_tidemark_schema.json"


class SchemaDriftError(ValueError):
    """An append whose types cannot be stored in the table's types without loss."""


def _stored_schema(spark: SparkSession, path: str) -> StructType | None:
    from tidemark.sinks.upsert import _fs, _read_text
    text = _read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    if text is not None:
        return StructType.fromJson(json.loads(text))
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except Exception as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _holds(stored: DataType, new: DataType) -> bool:
    """Whether every value of ``new`` can be stored as ``stored``."""
    if stored == new:
        return True
    if isinstance(stored, DoubleType):
        return isinstance(new, NumericType) and not isinstance(new, DecimalType)
    if stored in _WHOLE and new in _WHOLE:
        return _WHOLE.index(new) <= _WHOLE.index(stored)
    return False


def conform(df: DataFrame, stored: StructType | None, numbers_as_double: Sequence[str] = ()) -> DataFrame:
    """``df`` in the table's types, so that old and new files stay readable together.

    Columns named in ``numbers_as_double`` are stored as double from the first append on
    if they are numeric, because a later run may infer a wider type for them. A stored
    double takes any number; a column that is null throughout takes the stored type;
    anything else raises :class:`SchemaDriftError` before a file is written.
    """
    known = {f.name: f.dataType for f in stored.fields} if stored else {}
    out, odd = {}, []
    for f in df.schema.fields:
        want = known.get(f.name)
        if want is None:
            if f.name in numbers_as_double and isinstance(f.dataType, NumericType):
                out[f.name] = F.col(f"`{f.name}`").cast("double")
        elif want != f.dataType:
            if _holds(want, f.dataType):
                out[f.name] = F.col(f"`{f.name}`").cast(want)
            else:
                odd.append(f.name)
    if odd:
        filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in odd]).first()
        for c in odd:
            if filled[c]:
                raise SchemaDriftError(f"column {c} is {df.schema[c].dataType.simpleString()}, "
                                       f"the table has {known[c].simpleString()}")
            out[c] = F.lit(None).cast(known[c])
    return df.withColumns(out) if out else df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), numbers_as_double: Sequence[str] = ()) -> None:
    """Append-only landing write; each write commits atomically as one job.

    The table's schema is kept beside the data; the rows are first brought to it
    (:func:`conform`).

    Partition Bronze by retrieval day so incremental Silver runs prune to
    the days they need.
    """
    from tidemark.sinks.upsert import _write_text
    spark = df.sparkSession
    stored = _stored_schema(spark, path)
    df = conform(df, stored, numbers_as_double)
    known = {f.name for f in stored.fields} if stored else set()
    schema = StructType([*(stored.fields if stored else []), *[f for f in df.schema.fields if f.name not in known]])
    if partition_by:
        # REBALANCE: AQE sizes the output files and splits a hot partition (one
        # retrieval day holding most rows) across tasks instead of one writer
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if stored is None or len(schema) != len(stored):
        _write_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}", schema.json())


def read_appended(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Read an appended table; ``mergeSchema`` unions the columns of all
    appends (a column added later reads as null in older rows). The stored schema answers
    that without opening every file's footer."""
    from tidemark.sinks.upsert import _read_text
    text = _read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}") if merge_schema else None
    if text is not None:
        return spark.read.schema(StructType.fromJson(json.loads(text))).parquet(path)
    return spark.read.option("mergeSchema", merge_schema).parquet(path)
