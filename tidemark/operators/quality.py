"""Data quality: cross-layer reconciliation and rule checks.

Every check returns a DataFrame (one row per check), never a driver dict, so
a whole suite is one plan and one action: each table is scanned once for
count, min and max, and the checks are computed from those one-row stats.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import iso_date_or_null

CHECK_COLUMNS = ["check_name", "check_kind", "passed", "source_count", "target_count", "difference",
                 "source_min", "source_max", "target_min", "target_max", "target_empty"]


class ReconciliationError(AssertionError):
    """Raised by :func:`raise_on_failure` when a check did not pass."""


def _side_stats(source: DataFrame, target: DataFrame, src_col: Column | None, tgt_col: Column | None,
                cast_to: str | None) -> DataFrame:
    """One pass over both inputs (union, no join) -> one row of counts/min/max."""
    def side(df, c, is_src):
        v = F.lit(None).cast(cast_to or "string") if c is None else (c.cast(cast_to) if cast_to else c)
        return df.select(F.lit(is_src).alias("__src"), v.alias("__v"))
    both = side(source, src_col, True).unionByName(side(target, tgt_col, False))
    s, t = F.col("__src"), ~F.col("__src")
    return both.agg(
        F.count_if(s).alias("source_count"), F.count_if(t).alias("target_count"),
        F.min(F.when(s, F.col("__v"))).alias("source_min"), F.max(F.when(s, F.col("__v"))).alias("source_max"),
        F.min(F.when(t, F.col("__v"))).alias("target_min"), F.max(F.when(t, F.col("__v"))).alias("target_max"))


def _as_type(df: DataFrame, column: str, cast_to: str) -> Column:
    """A column in the type a range is compared in. Text becomes a date by the same strict
    parse that Silver uses, so a loosely written date is a reject on both sides."""
    have = df.schema[column].dataType.simpleString()
    if have == cast_to:
        return F.col(column)
    if have == "string" and cast_to == "date":
        return iso_date_or_null(column)
    return F.col(column).try_cast(cast_to)


def compare_row_counts(source: DataFrame, target: DataFrame, exact: bool, name: str = "row_count"
                       ) -> DataFrame:
    """Exact: target count == source count; loose: target <= source.

    ``difference`` = source - target; ``target_empty`` flags the case where a
    loose check passes only because nothing was written.
    """
    st = _side_stats(source, target, None, None, None)
    passed = (F.col("target_count") == F.col("source_count")) if exact else \
        (F.col("target_count") <= F.col("source_count"))
    return st.select(
        F.lit(name).alias("check_name"), F.lit("count_exact" if exact else "count_loose").alias("check_kind"),
        passed.alias("passed"), "source_count", "target_count",
        (F.col("source_count") - F.col("target_count")).alias("difference"),
        *[F.lit(None).cast("string").alias(c) for c in ("source_min", "source_max", "target_min", "target_max")],
        (F.col("target_count") == 0).alias("target_empty"))


def compare_range(source: DataFrame, target: DataFrame, source_column: str, target_column: str,
                  name: str = "range", cast_to: str | None = None) -> DataFrame:
    """[min, max] of a column must be equal on both sides (null-safe).

    Both sides are brought to the target column's type first, so a text date in
    Bronze compares as a date with Silver's ``DateType`` (strictly parsed, as there).
    """
    cast_to = cast_to or target.schema[target_column].dataType.simpleString()
    src = _as_type(source, source_column, cast_to)
    st = _side_stats(source, target, src, F.col(target_column), cast_to)
    passed = F.col("source_min").eqNullSafe(F.col("target_min")) & \
        F.col("source_max").eqNullSafe(F.col("target_max"))
    return st.select(
        F.lit(name).alias("check_name"), F.lit("range").alias("check_kind"), passed.alias("passed"),
        "source_count", "target_count", (F.col("source_count") - F.col("target_count")).alias("difference"),
        *[F.col(c).cast("string").alias(c) for c in ("source_min", "source_max", "target_min", "target_max")],
        (F.col("target_count") == 0).alias("target_empty"))


def summarize(results: DataFrame) -> DataFrame:
    """One row: ``all_passed`` and the failed check names in check order.

    ``results`` needs ``check_name``, ``passed`` and optionally ``ordinal``.
    """
    ordered = F.coalesce(F.col("ordinal"), F.lit(0)) if "ordinal" in results.columns else F.lit(0)
    failed = F.collect_list(F.when(~F.col("passed"), F.struct(ordered.alias("o"), F.col("check_name").alias("n"))))
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.transform(F.array_sort(failed), lambda x: x["n"]).alias("failed"))


@dataclass(frozen=True)
class Check:
    """One entry of a reconciliation suite."""
    name: str
    kind: str                  # "count_exact" | "count_loose" | "range"
    source: str                # table name in the mapping passed to run_suite
    target: str
    source_column: str | None = None
    target_column: str | None = None


def _table_stats(name: str, df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """One aggregate over ``df``: its row count and min/max of each (column,
    type) pair, as long rows (table, column, cast_to, n, lo, hi) with the
    extremes rendered as text after the cast (equal text <=> equal value)."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, (c, t) in enumerate(columns):
        v = _as_type(df, c, t)
        aggs += [F.min(v).cast("string").alias(f"__lo{i}"), F.max(v).cast("string").alias(f"__hi{i}")]
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit("").alias("column"), F.lit("").alias("cast_to"),
                        F.lit(None).cast("string").alias("lo"), F.lit(None).cast("string").alias("hi"))]
    entries += [F.struct(F.lit(c).alias("column"), F.lit(t).alias("cast_to"), F.col(f"__lo{i}").alias("lo"),
                         F.col(f"__hi{i}").alias("hi")) for i, (c, t) in enumerate(columns)]
    return wide.select(F.lit(name).alias("table"), F.col("__n").alias("n"),
                       F.explode(F.array(*entries)).alias("s")).select("table", "n", "s.*")


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Run a declarative suite: one result row per check, with ``ordinal``.

    Every table is aggregated exactly once (count plus min/max of each range
    column it takes part in); the checks are then equi-joins of a small spec
    table against those stats rows on (table, column) — broadcast, no cross
    join — so the whole suite is a single plan and a single action.
    """
    needed: dict[str, list[tuple[str, str]]] = {n: [] for n in {c.source for c in checks} | {c.target for c in checks}}
    specs = []
    for i, ck in enumerate(checks):
        if ck.kind == "range":
            t = tables[ck.target].schema[ck.target_column].dataType.simpleString()
            for tb, col in ((ck.source, ck.source_column), (ck.target, ck.target_column)):
                if (col, t) not in needed[tb]:
                    needed[tb].append((col, t))
            specs.append((i, ck.name, ck.kind, ck.source, ck.source_column, ck.target, ck.target_column, t))
        else:
            specs.append((i, ck.name, ck.kind, ck.source, "", ck.target, "", ""))
    stats = None
    for name, cols in needed.items():
        st = _table_stats(name, tables[name], cols)
        stats = st if stats is None else stats.unionByName(st)
    spark = next(iter(tables.values())).sparkSession
    # two spec rows per check (its source side and its target side), so the
    # stats are joined once; a tiny aggregate folds the sides back together
    sides = [(o, n, k, side, tb, col, t) for (o, n, k, sb, sc, tb_, tc, t) in specs
             for side, tb, col in (("s", sb, sc), ("t", tb_, tc))]
    spec = spark.createDataFrame(sides, "ordinal int, check_name string, check_kind string, side string, "
                                        "tbl string, col string, cast_to string")
    # stats has one row per (table, column) named in the suite: bounded by the
    # check list, not by the data, so the broadcast needs no runtime check
    j = spec.join(F.broadcast(stats), (F.col("tbl") == F.col("table")) & (F.col("col") == F.col("column"))
                  & (spec["cast_to"] == stats["cast_to"]))
    def pick(side, c):
        return F.max(F.when(F.col("side") == side, F.col(c)))
    folded = j.groupBy("ordinal", "check_name", "check_kind").agg(
        pick("s", "n").alias("source_count"), pick("t", "n").alias("target_count"),
        pick("s", "lo").alias("source_min"), pick("s", "hi").alias("source_max"),
        pick("t", "lo").alias("target_min"), pick("t", "hi").alias("target_max"))
    kind = F.col("check_kind")
    passed = (F.when(kind == "count_exact", F.col("target_count") == F.col("source_count"))
              .when(kind == "count_loose", F.col("target_count") <= F.col("source_count"))
              .otherwise(F.col("source_min").eqNullSafe(F.col("target_min"))
                         & F.col("source_max").eqNullSafe(F.col("target_max"))))
    return folded.select(
        "check_name", "check_kind", passed.alias("passed"), "source_count", "target_count",
        (F.col("source_count") - F.col("target_count")).alias("difference"),
        "source_min", "source_max", "target_min", "target_max",
        (F.col("target_count") == 0).alias("target_empty"), "ordinal")


def raise_on_failure(results: DataFrame) -> None:
    """Job wrapper: one action on the summary, raise when any check failed."""
    row = summarize(results).first()
    if not row["all_passed"]:
        raise ReconciliationError(f"reconciliation failed: {row['failed']}")


# ---- rule-based checks (documented extensions) ------------------------------------

def orphan_counts(pairs: Sequence[tuple[str, DataFrame, DataFrame, Sequence[str]]]) -> DataFrame:
    """Referential integrity: for each (name, fact, dim, keys) count facts whose
    key is missing from the dimension (``left_anti``)."""
    out = None
    for name, fact, dim, keys in pairs:
        # pre-aggregate: one row per distinct key crosses the join, so a key
        # that holds a third of the facts is a single row in the shuffle
        f = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        d = dim.select(*keys).distinct().withColumn("__hit", F.lit(True))
        flagged = f.join(d, on=list(keys), how="left")
        row = flagged.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("fact_rows"),
                          F.coalesce(F.sum(F.when(F.col("__hit").isNull(), F.col("__n"))), F.lit(0))
                          .alias("orphan_rows")) \
            .select(F.lit(name).alias("check_name"), "fact_rows", "orphan_rows",
                    (F.col("orphan_rows") == 0).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column, all columns in one pass; rows (column_name, null_rate)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"__n{i}") for i, c in enumerate(cols)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("null_rate"))
        for i, c in enumerate(cols)])).alias("r")).select("r.*")


def violations(df: DataFrame, rules: Mapping[str, Column], out_col: str = "violations") -> DataFrame:
    """Add an array of names of the rules each row breaks (a rule is the
    *valid* condition; a null outcome counts as a violation)."""
    flags = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    return df.withColumn(out_col, F.filter(F.array(*flags), lambda x: x.isNotNull()))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their ``violations``)."""
    v = violations(df, rules)
    return v.where(F.size("violations") == 0).drop("violations"), v.where(F.size("violations") > 0)


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows (rule_name, violations) over the whole input, one pass."""
    aggs = [F.count_if(~F.coalesce(cond, F.lit(False))).alias(f"__r{i}") for i, cond in enumerate(rules.values())]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule_name"), F.col(f"__r{i}").alias("violations"))
        for i, n in enumerate(rules)])).alias("r")).select("r.*")


def price_rules() -> dict[str, Column]:
    """Bronze price sanity rules (ours): low <= open, close <= high; volume >= 0."""
    return {
        "low_le_open": F.col("low") <= F.col("open"),
        "open_le_high": F.col("open") <= F.col("high"),
        "low_le_close": F.col("low") <= F.col("close"),
        "close_le_high": F.col("close") <= F.col("high"),
        "volume_non_negative": F.col("volume") >= 0,
    }


def fx_rules() -> dict[str, Column]:
    """Bronze FX sanity rule (ours): the mid rate is positive."""
    return {"rate_positive": F.col("mid_rate") > 0}


def payload_field_types(df: DataFrame, batch_col: str, payload_col: str) -> DataFrame:
    """Distinct (batch, field, type class) of JSON object payloads via VARIANT.

    Type classes: integer, double, string, boolean, null, object, array.
    """
    v = df.select(F.col(batch_col).alias("batch"), F.try_parse_json(F.col(payload_col)).alias("__v"))
    e = v.lateralJoin(v.sparkSession.tvf.variant_explode(F.col("__v").outer())
                      .select(F.col("key").alias("field"), F.col("value").alias("__val")), how="inner")
    t = F.schema_of_variant(F.col("__val"))
    # JSON integers parse as BIGINT; any number written with a fraction or an
    # exponent parses as DECIMAL (even 12.0 -> DECIMAL(2,0)) or DOUBLE
    cls = (F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
           .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "double")
           .when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").when(t == "VOID", "null")
           .when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array").otherwise("other"))
    return e.select("batch", "field", cls.alias("type_class")).distinct()


def schema_drift(df: DataFrame, batch_col: str, payload_col: str, old_batch, new_batch) -> DataFrame:
    """Fields added, removed or retyped between two payload batches.

    Rows (field, type_class, change) with change in {added, removed}; a
    retyped field appears once as removed (old type) and once as added.
    """
    ft = payload_field_types(df.where(F.col(batch_col).isin(old_batch, new_batch)), batch_col, payload_col)
    # one grouping over (field, type) with a flag per batch: each payload is parsed once
    seen = ft.groupBy("field", "type_class").agg(F.bool_or(F.col("batch") == F.lit(old_batch)).alias("old"),
                                                 F.bool_or(F.col("batch") == F.lit(new_batch)).alias("new"))
    return seen.where(F.col("old") != F.col("new")).select(
        "field", "type_class", F.when(F.col("new"), "added").otherwise("removed").alias("change"))


def cross_source_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float
                      ) -> DataFrame:
    """Full outer join of two sources on ``keys``; status per key:
    only_a, only_b, match (|a - b| <= tolerance) or mismatch."""
    l = a.select(*keys, F.col(value).alias("value_a"), F.lit(True).alias("__a"))
    r = b.select(*keys, F.col(value).alias("value_b"), F.lit(True).alias("__b"))
    j = l.join(r, on=list(keys), how="full_outer")
    status = (F.when(F.col("__b").isNull(), "only_a").when(F.col("__a").isNull(), "only_b")
              .when(F.abs(F.col("value_a") - F.col("value_b")) <= F.lit(tolerance), "match")
              .otherwise("mismatch"))
    return j.select(*keys, "value_a", "value_b", status.alias("status"))


def field_presence_drift(df: DataFrame, batch_col: str, old_batch, new_batch,
                         ignore: Sequence[str] = ()) -> DataFrame:
    """Schema drift on wide, schema-merged Bronze (the inferred route).

    After additive appends every batch reads every column, so a field counts
    as present in a batch when it holds a non-null value there. One grouped
    aggregate (non-null counts per column, two batches) feeds the diff; rows
    (field, change) with change in {added, removed}.
    """
    cols = [c for c in df.columns if c != batch_col and c not in ignore]
    two = df.where(F.col(batch_col).isin(old_batch, new_batch))
    counts = two.groupBy(batch_col).agg(*[F.count(F.col(f"`{c}`")).alias(f"__c{i}") for i, c in enumerate(cols)])
    long = counts.select(F.col(batch_col).alias("batch"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"__c{i}").alias("n")) for i, c in enumerate(cols)])).alias("r")) \
        .select("batch", "r.*")
    wide = long.groupBy("field").agg(
        F.coalesce(F.sum(F.when(F.col("batch") == F.lit(old_batch), F.col("n"))), F.lit(0)).alias("old_n"),
        F.coalesce(F.sum(F.when(F.col("batch") == F.lit(new_batch), F.col("n"))), F.lit(0)).alias("new_n"))
    change = F.when((F.col("old_n") == 0) & (F.col("new_n") > 0), "added") \
        .when((F.col("old_n") > 0) & (F.col("new_n") == 0), "removed")
    return wide.select("field", change.alias("change")).where(F.col("change").isNotNull())
