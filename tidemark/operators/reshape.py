"""Reshape: schema-generic unpivot to long metrics, the VARIANT path, pivot back.

Unpivot is a per-row generator (``Expand``/``Generate``) with no shuffle; the
metric-name conversion is applied to literals and constant-folded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import camel_to_snake, snake_name
from tidemark.schemas import (
    SILVER_FUNDAMENTALS_COLUMNS,
    STATEMENT_DERIVED_COLUMNS,
    STATEMENT_ENVELOPE_COLUMNS,
)


class NoMetricColumnsError(ValueError):
    """Nothing left to unpivot after removing the envelope columns."""


def unpivot_numeric(df: DataFrame, ids: Sequence[str], metrics: Sequence[str],
                    name_col: str = "metric_name", value_col: str = "metric_value",
                    snake_case: bool = True) -> DataFrame:
    """Melt ``metrics`` into (name, double value) rows next to ``ids``.

    Each metric is ``try_cast`` to double *before* the unpivot (mixed types
    cannot share one value column), then rows whose value is null or not
    numeric are dropped. ``'NaN'`` text stays as NaN.
    """
    if not metrics:
        raise NoMetricColumnsError("unpivot: No metric columns besides the identifying ones")
    final = [snake_name(m) if snake_case else m for m in metrics]
    if len({*final, *ids}) == len(final) + len(ids):
        # the unpivot's own name literal is the final name
        staged = df.select(*ids, *[F.col(f"`{m}`").try_cast("double").alias(n) for m, n in zip(metrics, final, strict=True)])
        long = staged.unpivot(list(ids), [F.col(f"`{n}`") for n in final], name_col, value_col)
    else:  # two fields share a final name
        pairs = F.array(*[F.struct(F.lit(n).alias(name_col), F.col(f"`{m}`").try_cast("double").alias(value_col))
                          for m, n in zip(metrics, final, strict=True)])
        long = df.select(*ids, F.inline(pairs))
    return long.where(F.col(value_col).isNotNull()).select(*ids, value_col, name_col)


def unpivot_statement_metrics(df: DataFrame, envelope: Sequence[str] = STATEMENT_ENVELOPE_COLUMNS,
                              only: Sequence[str] | None = None) -> DataFrame:
    """Standardized wide statements -> Silver long rows.

    Every column outside the envelope (and the derived ``statement_type`` /
    ``period_type``) is a metric. Renames ``date`` -> ``period_end_date``,
    ``fiscalYear`` -> ``fiscal_year`` (int), ``reportedCurrency`` ->
    ``reported_currency``. ``only`` limits the unpivot to these (snake-cased)
    metrics, so a query about one metric does not multiply rows by all of them.
    """
    skip = set(envelope) | set(STATEMENT_DERIVED_COLUMNS)
    metrics = [c for c in df.columns if c not in skip]
    if only is not None:
        metrics = [c for c in metrics if snake_name(c) in set(only)]
    if not metrics:
        raise NoMetricColumnsError("unpivot: No metric columns besides the statement envelope")
    ids = df.select(
        "ticker", F.col("date").alias("period_end_date"), "statement_type", "period_type",
        F.col("fiscalYear").try_cast("int").alias("fiscal_year"),
        F.col("reportedCurrency").alias("reported_currency"), "source", "retrieved_at",
        *[F.col(f"`{m}`") for m in metrics])
    long = unpivot_numeric(ids, ["ticker", "period_end_date", "statement_type", "period_type",
                                 "fiscal_year", "reported_currency", "source", "retrieved_at"],
                           metrics)
    return long.select(*SILVER_FUNDAMENTALS_COLUMNS)


def variant_metrics(df: DataFrame, ids: Sequence[str], payload: str,
                    name_col: str = "metric_name", value_col: str = "metric_value",
                    envelope: Sequence[str] = ()) -> DataFrame:
    """Long metrics straight from a JSON payload through VARIANT.

    ``payload`` is JSON text (parsed once with ``try_parse_json``) or an
    already parsed VARIANT column. ``variant_explode`` yields (key, value)
    per field; values are ``try_variant_get`` as double (text that is not a
    number drops). No schema inference pass, and keys that differ only in
    case stay apart.
    """
    from pyspark.sql.types import VariantType
    pv = F.col(payload) if isinstance(df.schema[payload].dataType, VariantType) else F.try_parse_json(F.col(payload))
    v = df.select(*ids, pv.alias("__v"))  # variant_explode(NULL) yields no row
    exploded = v.lateralJoin(
        v.sparkSession.tvf.variant_explode(F.col("__v").outer()).select(
            F.col("key").alias("__k"), F.col("value").alias("__val")), how="inner")
    # Fast path: a JSON number rendered by to_json and cast from text gives the
    # same double as try_variant_get (both round correctly) at a fraction of the
    # cost; the exact path runs only where the fast one yields null (numeric
    # text in a JSON string, booleans, JSON null).
    val = F.col("__val")
    value = F.coalesce(F.to_json(val).try_cast("double"), F.try_variant_get(val, "$", "double"))
    out = exploded.select(*ids, camel_to_snake(F.col("__k")).alias(name_col), value.alias(value_col),
                          F.col("__k").alias("__raw"))
    if envelope:
        out = out.where(~F.col("__raw").isin(list(envelope)))
    return out.where(F.col(value_col).isNotNull()).drop("__raw")


def pivot_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                  name_col: str = "metric_name", value_col: str = "metric_value") -> DataFrame:
    """Long facts back to one row per ``keys`` with one column per metric.

    The metric list is explicit, so Spark needs no distinct-values job and the
    output schema is fixed; the aggregate is partial (map-side) per key.
    """
    return df.groupBy(*keys).pivot(name_col, list(metrics)).agg(F.max(value_col))


def statement_envelope(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Typed envelope fields pulled out of a statement payload (a VARIANT
    column; JSON text is parsed once into one)."""
    from pyspark.sql.types import VariantType
    if not isinstance(df.schema[payload].dataType, VariantType):
        df = df.withColumn(payload, F.try_parse_json(F.col(payload)))

    def get(field, typ="string"):
        return F.try_variant_get(F.col(payload), f"$.{field}", typ)
    return df.withColumns({"date": get("date"), "period": get("period"), "fiscalYear": get("fiscalYear"),
                           "reportedCurrency": get("reportedCurrency"), "symbol": get("symbol")})


def statements_from_payload(df: DataFrame, payload: str = "payload",
                            envelope: Sequence[str] = STATEMENT_ENVELOPE_COLUMNS) -> DataFrame:
    """Standardized payload statements -> Silver long rows (the VARIANT path).

    ``df`` carries ticker, statement_type, period_type, source, retrieved_at,
    a parsed ``date`` and ``fiscalYear``/``reportedCurrency`` (see
    :func:`statement_envelope`) plus the payload; every payload field outside
    the envelope becomes a (metric_name, metric_value) row.
    """
    ids = df.select("ticker", F.col("date").alias("period_end_date"), "statement_type", "period_type",
                    F.col("fiscalYear").try_cast("int").alias("fiscal_year"),
                    F.col("reportedCurrency").alias("reported_currency"), "source", "retrieved_at", payload)
    long = variant_metrics(ids, ["ticker", "period_end_date", "statement_type", "period_type", "fiscal_year",
                                 "reported_currency", "source", "retrieved_at"], payload, envelope=envelope)
    return long.select(*SILVER_FUNDAMENTALS_COLUMNS)


def without_typed(payload: Column, typed: Mapping[str, Column], envelope: Sequence[str] = STATEMENT_ENVELOPE_COLUMNS) -> Column:
    """A map of JSON fields without ``envelope`` and without fields whose text is that of their typed column.

    :func:`with_typed` puts the latter back, so rows that travel between the two carry no
    value twice; a field whose text is another ("1.50" for 1.5) stays in the map.
    """
    def same(k: Column, v: Column) -> Column:
        return F.coalesce(reduce(or_, [(k == n) & (v == c.cast("string")) for n, c in typed.items()]), F.lit(False))
    return F.map_filter(payload, lambda k, v: ~k.isin(list(envelope)) & ~same(k, v))


def with_typed(payload: Column, typed: Mapping[str, Column]) -> Column:
    """The map of :func:`without_typed` with the fields that it left to their typed columns."""
    known = F.map_from_arrays(F.array(*[F.lit(n) for n in typed]), F.array(*[c.cast("string") for c in typed.values()]))
    return F.map_concat(payload, F.map_filter(known, lambda n, v: v.isNotNull() & ~F.map_contains_key(payload, n)))


def metrics_from_map(df: DataFrame, ids: Sequence[str], payload: str, envelope: Sequence[str] = STATEMENT_ENVELOPE_COLUMNS,
                     name_col: str = "metric_name", value_col: str = "metric_value") -> DataFrame:
    """Long metrics from a ``map<string,string>`` of JSON fields (their literal text), parsed once upstream."""
    long = df.select(*ids, F.explode(payload).alias("__k", "__t")).where(~F.col("__k").isin(list(envelope)))
    out = long.select(*ids, camel_to_snake("__k").alias(name_col), F.col("__t").try_cast("double").alias(value_col))
    return out.where(F.col(value_col).isNotNull())


def statements_from_map(df: DataFrame, payload: str = "payload",
                        envelope: Sequence[str] = STATEMENT_ENVELOPE_COLUMNS) -> DataFrame:
    """Standardized statements whose fields are a map -> Silver long rows."""
    ids = df.select("ticker", F.col("date").alias("period_end_date"), "statement_type", "period_type",
                    F.col("fiscalYear").try_cast("int").alias("fiscal_year"),
                    F.col("reportedCurrency").alias("reported_currency"), "source", "retrieved_at", payload)
    return metrics_from_map(ids, [c for c in ids.columns if c != payload], payload, envelope).select(
        *SILVER_FUNDAMENTALS_COLUMNS)
