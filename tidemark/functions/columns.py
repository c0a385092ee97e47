"""Column expressions shared by the operators.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; literal inputs are constant-folded.
"""

from __future__ import annotations

import re

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import (
    ANNUAL_PERIOD,
    CAMEL_PASS_1,
    CAMEL_PASS_2,
    PAYLOAD_DATE_FORMAT,
    PERIOD_TYPE_ANNUAL,
    PERIOD_TYPE_QUARTER,
)

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_date_or_null(c: ColumnOrName, fmt: str = PAYLOAD_DATE_FORMAT) -> Column:
    """Text to ``DateType``; anything that does not parse becomes null.

    ``try_to_date`` keeps ANSI mode on (``to_date`` raises there). The
    pattern is strict: ``2024-1-3`` is rejected.
    """
    return F.try_to_date(_c(c), fmt)


def period_type(period: ColumnOrName) -> Column:
    """``FY`` is an annual statement; anything else (null included) a quarter."""
    return F.when(_c(period) == F.lit(ANNUAL_PERIOD), F.lit(PERIOD_TYPE_ANNUAL)).otherwise(F.lit(PERIOD_TYPE_QUARTER))


def year_end_date(year: ColumnOrName) -> Column:
    """December 31 of ``year`` (the macro reference date)."""
    return F.make_date(_c(year), F.lit(12), F.lit(31))


def camel_to_snake(name: ColumnOrName) -> Column:
    """camelCase to snake_case: ``totalAssets`` -> ``total_assets``.

    Two regex passes then lower case; ``EBITDARatio`` -> ``ebitda_ratio``,
    ``epsdiluted`` is unchanged. Given a literal, Catalyst folds it.
    """
    c = _c(name)
    first = F.regexp_replace(c, *CAMEL_PASS_1)
    snake = F.lower(F.regexp_replace(first, *CAMEL_PASS_2))
    # both patterns need an upper-case letter: all-lower names skip the regex work
    return F.when(c == F.lower(c), c).otherwise(snake)


def _ts_literal(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        # a UTC wall-clock literal, independent of the JVM default zone
        return F.to_timestamp(F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")))
    return F.to_timestamp(F.lit(str(value)))


def provenance(df: DataFrame, source: str | Column, retrieved_at, **entity) -> DataFrame:
    """Stamp ``source``, ``retrieved_at`` (UTC) and entity keys on every row."""
    cols = {k: (v if isinstance(v, Column) else F.lit(v)) for k, v in entity.items()}
    cols["source"] = source if isinstance(source, Column) else F.lit(source)
    cols["retrieved_at"] = _ts_literal(retrieved_at)
    return df.withColumns(cols)


def snake_name(name: str) -> str:
    """:func:`camel_to_snake` of a name known when the plan is built."""
    for pattern, replacement in (CAMEL_PASS_1, CAMEL_PASS_2):
        name = re.sub(pattern, re.sub(r"\$(\d)", r"\\\1", replacement), name)
    return name.lower()
