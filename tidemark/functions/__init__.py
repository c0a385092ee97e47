"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from tidemark.functions.columns import (
    camel_to_snake,
    iso_date_or_null,
    period_type,
    provenance,
    year_end_date,
)

__all__ = ["camel_to_snake", "iso_date_or_null", "period_type", "provenance", "year_end_date"]
