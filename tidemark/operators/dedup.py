"""Keep-latest deduplication (one generic operator for every Bronze table).

``row_number() = 1`` over (natural key, order) is planned by Catalyst as a
*partial* ``WindowGroupLimit`` before the shuffle and a final one after it,
so every map task forwards at most one row per key: a key that holds a third
of the input costs one row per map task in the shuffle, not a third of the
data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, MapType, VariantType

from tidemark.schemas import DEDUP_KEYS

_RN = "__tm_rn"


def _orderable(df: DataFrame, name: str) -> bool:
    dt = df.schema[name].dataType
    return not isinstance(dt, (MapType, VariantType, BinaryType))


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ("retrieved_at",),
                tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (each descending), latest wins.

    Ties on ``order`` are broken by ``tie_break`` (default: every other
    orderable column, descending) so the result is deterministic — two
    retrievals in one run share a ``retrieved_at``. Null keys form one group
    like any other value. Columns and their order are unchanged.
    """
    order_cols = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)}
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in named and _orderable(df, c)]
    order_cols += [F.col(c).desc_nulls_last() for c in tie_break]
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def dedup_prices(df: DataFrame) -> DataFrame:
    """Latest retrieval per (ticker, date)."""
    return keep_latest(df, DEDUP_KEYS["prices"])


def dedup_fx_rates(df: DataFrame) -> DataFrame:
    """Latest retrieval per (currency_code, effective_date)."""
    return keep_latest(df, DEDUP_KEYS["fx_rates"])


def dedup_fundamentals(df: DataFrame) -> DataFrame:
    """Latest retrieval per (ticker, date, period, statement_type)."""
    return keep_latest(df, DEDUP_KEYS["fundamentals"])


def dedup_macro(df: DataFrame) -> DataFrame:
    """Latest retrieval per (indicator_name, year)."""
    return keep_latest(df, DEDUP_KEYS["macro"])


def merge_with_precedence(frames: Sequence[tuple[DataFrame, int]], keys: Sequence[str],
                          order: Sequence[str] = ("retrieved_at",)) -> DataFrame:
    """Union inputs (e.g. batch and stream) and keep one row per key.

    Each input carries a priority; the higher priority wins, then the
    latest ``order``. Missing columns become null (union by name).
    """
    tagged = None
    for df, prio in frames:
        t = df.withColumn("source_priority", F.lit(prio))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    return keep_latest(tagged, keys, order=["source_priority", *order])
