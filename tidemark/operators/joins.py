"""Joins: size-checked broadcast, lookup left join, as-of join.

A side is broadcast only after a bounded check of its row count; beyond the
bound the plain join is returned and the planner (with AQE) picks a shuffle
join. The check costs one ``limit(n + 1).count()`` job over the small side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# What we accept to ship to every executor (reference data, calendars, rate grids):
# at most this many rows, and at most this many bytes by a schema-based estimate.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024


def estimated_row_bytes(df: DataFrame) -> int:
    """A conservative per-row size from the schema (strings counted at 64 B)."""
    from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DateType, MapType, ShortType,
                                   StringType, StructType)
    def size(t):
        if isinstance(t, (BooleanType, ByteType)):
            return 1
        if isinstance(t, (ShortType, DateType)):
            return 4
        if isinstance(t, StringType):
            return 64
        if isinstance(t, StructType):
            return sum(size(f.dataType) for f in t.fields)
        if isinstance(t, (ArrayType, MapType)):
            return 256
        return 8
    return max(16, 16 + sum(size(f.dataType) for f in df.schema.fields))


class DuplicateKeyError(ValueError):
    """A lookup or an upsert source holds one key more than once."""


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and at most ``max_bytes``
    by the schema estimate (reads at most bound + 1 rows)."""
    bound = max(1, min(max_rows, max_bytes // estimated_row_bytes(df)))
    return df.limit(bound + 1).count() <= bound


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df`` unchanged
    (the planner, with AQE, then picks a shuffle join). The proof reads ``df``, so
    it is for tables that are cheap to read; for derived sides leave the choice to
    AQE, which knows their size when they have run."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "lookup") -> None:
    """Raise :class:`DuplicateKeyError` when a key occurs twice (one aggregate job, never remembered:
    a table rewritten in place is checked again)."""
    rows = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if rows:
        raise DuplicateKeyError(f"duplicate {what} key {rows[0].asDict()}")


def lookup_left_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str] | str,
                     check_unique: bool = True, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
                     ) -> DataFrame:
    """Left join facts to a small lookup; an unknown key keeps its row with nulls.

    Duplicate lookup keys would fan facts out, so they raise.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if check_unique:
        assert_unique(lookup, keys)
    return facts.join(checked_broadcast(lookup, max_broadcast_rows), on=keys, how="left")


def add_currency_column(prices: DataFrame, tickers: DataFrame) -> DataFrame:
    """Label each price row with its ticker's trading currency (no conversion)."""
    return lookup_left_join(prices, tickers.select("ticker", "currency"), "ticker")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str,
              values: Sequence[str]) -> DataFrame:
    """Left as-of join on dates: each left row gets the latest right row with
    ``right_on <= left_on`` inside the same ``by`` group (null if none).

    Spark has no as-of join, and a window over ``by`` would put a hot group
    (one currency behind a third of all prices) into one task. Instead each
    right row is expanded to the days it is valid for — from its date up to
    the day before the next one — which turns the as-of match into an
    equi-join on (``by``, day) that partitions evenly. Left dates past the
    last right date take the last value through a second join on ``by``
    (one row per group).
    """
    by = list(by)
    bcol = {b: f"__by{i}" for i, b in enumerate(by)}
    vcol = {v: f"__val{i}" for i, v in enumerate(values)}
    r = right.select(*[F.col(b).alias(bcol[b]) for b in by], F.col(right_on).alias("__d"),
                     *[F.col(v).alias(vcol[v]) for v in values])
    # order by the values too, so duplicate dates resolve deterministically
    # (the last one covers the interval, the others get an empty one)
    w = Window.partitionBy(*bcol.values()).orderBy("__d", *vcol.values())
    r = r.withColumn("__next", F.lead("__d").over(w))
    daily = (r.where(F.col("__next").isNotNull() & (F.col("__next") > F.col("__d")))
             .select(*bcol.values(), F.explode(F.sequence("__d", F.date_sub("__next", 1))).alias("__day"),
                     *vcol.values()))
    last = r.where(F.col("__next").isNull()).select(
        *bcol.values(), F.col("__d").alias("__last_day"),
        *[F.col(vcol[v]).alias("__last" + vcol[v]) for v in values])
    on_day = [F.col(b) == F.col(bcol[b]) for b in by] + [F.col(left_on) == F.col("__day")]
    # AQE picks broadcast or shuffle from the sizes these sides have when they have run
    out = left.join(daily, on=on_day, how="left") \
        .drop(*bcol.values(), "__day")
    on_by = [F.col(b) == F.col(bcol[b]) for b in by]
    out = out.join(last, on=on_by, how="left")
    picked = {v: F.coalesce(F.col(vcol[v]), F.when(F.col(left_on) >= F.col("__last_day"),
                                                   F.col("__last" + vcol[v]))) for v in values}
    return out.withColumns(picked).drop(*bcol.values(), "__last_day", *vcol.values(),
                                        *["__last" + c for c in vcol.values()])


def convert_currency(prices: DataFrame, rates: DataFrame, base_currency: str = "PLN",
                     price_col: str = "close", out_col: str = "close_pln") -> DataFrame:
    """``close_pln`` = close x the latest mid rate on or before the price date.

    ``prices`` needs (currency, date, close); ``rates`` (currency_code,
    effective_date, mid_rate). The base currency converts at 1.0; a date with
    no earlier rate gives null.
    """
    r = rates.select(F.col("currency_code").alias("currency"), "effective_date", "mid_rate")
    joined = asof_join(prices, r, ["currency"], "date", "effective_date", ["mid_rate"])
    rate = F.when(F.col("currency") == F.lit(base_currency), F.lit(1.0)).otherwise(F.col("mid_rate"))
    return joined.withColumn("fx_rate", rate).withColumn(out_col, F.col(price_col) * F.col("fx_rate")) \
        .drop("mid_rate")
