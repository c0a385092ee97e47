"""Keyed upsert (MERGE: matched -> update all columns, not matched -> insert).

Where the table format supports row-level operations (Delta, Iceberg) use
:func:`merge_into_catalog`, i.e. ``DataFrame.mergeInto``. Plain Parquet has
no MERGE, so :func:`upsert` writes snapshot versions:

    <path>/v=00000001/   <- first write (create on first run)
    <path>/v=00000002/   <- target anti-join source, union source

A version is visible only once its commit marker exists (``_SUCCESS``, or our
own for committers that write none), so a job that
dies mid-write leaves the previous version current and can simply rerun (the
operation is idempotent). Readers resolve the newest committed version.
Concurrent writers are not serialized; run one writer per table.

Semantics: a null key never matches (as in SQL MERGE), duplicate source
keys raise, nothing is ever deleted. Schema evolution is additive: a column
new in the source is added (null in older rows); a source missing a target
column raises.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import DuplicateKeyError, assert_unique

_PREFIX = "v="
_COMMITTED = "_tidemark_committed"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Snapshot versions under ``path`` whose write committed (``_SUCCESS``)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(_PREFIX) and name[len(_PREFIX):].isdigit():
            if any(fs.exists(st.getPath().suffix(f"/{m}")) for m in ("_SUCCESS", _COMMITTED)):
                out.append(int(name[len(_PREFIX):]))
    return sorted(out)


def _version_path(path: str, v: int) -> str:
    return f"{path.rstrip('/')}/{_PREFIX}{v:08d}"


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when the table has a committed snapshot."""
    return bool(committed_versions(spark, path))


def read_current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest committed snapshot (or a given ``version``: time travel)."""
    vs = committed_versions(spark, path)
    if not vs:
        raise FileNotFoundError(f"no committed version under {path}")
    return spark.read.parquet(_version_path(path, vs[-1] if version is None else version))


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str],
           newer_wins: str | Sequence[str] | None = None) -> DataFrame:
    """The MERGE result as a plan: one full outer join of target and source on the keys.

    A key on one side only keeps that side's row; a key on both takes the
    source's. A null key matches nothing, so such rows of both sides stay.
    Each input is read once.

    ``newer_wins`` (a column such as ``retrieved_at``, or a list compared
    left to right such as ``["source_priority", "retrieved_at"]``) makes the
    update conditional: a source row whose stored counterpart ranks strictly
    higher is skipped, so replays, out-of-order increments and lower-priority
    sources cannot overwrite a row.
    """
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"upsert source lacks target columns {missing}")
    # additive schema evolution: columns new in the source are null in older rows
    added = [f for f in source.schema.fields if f.name not in target.columns]
    target = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added}) if added else target
    cols = target.columns

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*[F.col(f"`{k}`").alias(f"__{tag}{i}") for i, k in enumerate(keys)],
                         F.struct(*[F.col(f"`{c}`") for c in cols]).alias(f"__{tag}"))
    both = side(target, "t").join(side(source, "s"), [F.col(f"__t{i}") == F.col(f"__s{i}") for i in range(len(keys))],
                                  "full_outer")
    use_source = F.col("__t").isNull()
    if newer_wins:
        order = [newer_wins] if isinstance(newer_wins, str) else list(newer_wins)
        t_order, s_order = (F.struct(*[F.col(x)[c].alias(f"o{j}") for j, c in enumerate(order)]) for x in ("__t", "__s"))
        use_source = use_source | (F.col("__s").isNotNull() & ~(t_order > s_order))
    else:
        use_source = use_source | F.col("__s").isNotNull()
    types = {f.name: f.dataType for f in target.schema.fields}
    row = {c: F.when(use_source, F.col("__s")[c].cast(types[c])).otherwise(F.col("__t")[c]).alias(c) for c in cols}
    return both.select(*row.values())


def _staged_source(source: DataFrame, keys: Sequence[str], check_unique: bool, what: str) -> tuple[DataFrame, str]:
    """``source`` written once to the shared work folder, so that checks and merge read the same rows."""
    from tidemark.session import fresh_dir
    spark = source.sparkSession
    folder = fresh_dir(spark, "upsert-source")
    source.write.parquet(folder)
    staged = spark.read.schema(source.schema).parquet(folder)
    if check_unique:
        try:
            assert_unique(staged.dropna(subset=list(keys)), keys, "source")
        except DuplicateKeyError as e:
            _remove(spark, folder)
            raise DuplicateKeyError(f"upsert into {what}: {e}") from None
    return staged, folder


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
           partition_by: Sequence[str] = (), check_unique: bool = True,
           newer_wins: str | Sequence[str] | None = None) -> int:
    """Merge ``source`` into the Parquet table at ``path``; returns the new version.

    Creates the table on first run. ``partition_by`` lays each snapshot out in
    partitions for pruning by readers.
    """
    staged, folder = _staged_source(source, keys, check_unique, path)
    vs = committed_versions(spark, path)
    out = staged if not vs else merged(read_current(spark, path), staged, keys, newer_wins)
    new_v = (vs[-1] + 1) if vs else 1
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    w = out.write.mode("overwrite")  # the new version folder is invisible until committed
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(_version_path(path, new_v))
    _write_text(spark, f"{_version_path(path, new_v)}/{_COMMITTED}", "")
    _remove(spark, folder)
    return new_v


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` committed versions; returns deleted."""
    if keep < 1:
        raise ValueError("keep must be at least 1: the newest version is the table")
    vs = committed_versions(spark, path)
    fs, _ = _fs(spark, path)
    gone = vs[:-keep]
    for v in gone:
        fs.delete(_fs(spark, _version_path(path, v))[1], True)
    return gone


def merge_into_catalog(source: DataFrame, table: str, keys: Sequence[str],
                       newer_wins: str | Sequence[str] | None = None) -> None:
    """MERGE into a catalog table that supports row-level operations.

    Duplicate source keys raise, as in :func:`upsert`; ``newer_wins`` skips source rows
    whose stored counterpart ranks strictly higher.
    """
    spark = source.sparkSession
    assert_unique(source.dropna(subset=list(keys)), keys, "source")
    if not spark.catalog.tableExists(table):
        source.writeTo(table).create()
        return

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    def both(k: str, sign: str) -> str:
        return f"{table}.{quoted(k)} {sign} s.{quoted(k)}"
    cond = " AND ".join(both(k, "=") for k in keys)
    merge = source.alias("s").mergeInto(table, F.expr(cond))
    if newer_wins:
        order = [newer_wins] if isinstance(newer_wins, str) else list(newer_wins)
        sides = [", ".join(f"{x}.{quoted(c)}" for c in order) for x in (table, "s")]
        merge = merge.whenMatched(F.expr(f"NOT struct({sides[0]}) > struct({sides[1]})")).updateAll()
    else:
        merge = merge.whenMatched().updateAll()
    merge.whenNotMatched().insertAll().merge()


# ---------------------------------------------------------------------------------------
# Partition-scoped upsert: cost proportional to the partitions an increment touches.
# ---------------------------------------------------------------------------------------

_PENDING = "_tidemark_pending"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _stored_types(spark: SparkSession, path: str):
    """The schema kept beside a partitioned table (:data:`tidemark.sinks.tables.SCHEMA_FILE`), or None."""
    import json

    from pyspark.sql.types import StructType

    from tidemark.sinks.tables import SCHEMA_FILE
    text = _read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    return None if text is None else StructType.fromJson(json.loads(text))


def _read_all_columns(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table with the columns of all its files: by the stored schema, else from every file's footer."""
    known = _stored_types(spark, path)
    return spark.read.option("mergeSchema", True).parquet(path) if known is None else spark.read.schema(known).parquet(path)


def _overwrite_partitions(spark: SparkSession, staged: str, path: str, partition_by: Sequence[str]) -> None:
    # rebalance on the partition columns: few, advisory-sized files per
    # partition, and a hot partition is split across writers by AQE
    (spark.read.parquet(staged).hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def recover_partitioned(spark: SparkSession, path: str) -> bool:
    """Finish an interrupted partition overwrite (redo it from the staged copy).

    The staged copy holds the complete new content of every touched
    partition, so replaying the dynamic overwrite is idempotent.
    """
    marker = f"{path.rstrip('/')}/{_PENDING}"
    note = _read_text(spark, marker)
    if note is None:
        return False
    staged, cols = note.split("\n")[:2]
    _overwrite_partitions(spark, staged, path, cols.split(","))
    fs, p = _fs(spark, marker)
    fs.delete(p, False)
    return True


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Read a partition-upserted table, repairing an interrupted write first.

    Schemas are merged: after additive evolution only the rewritten
    partitions carry the new column.
    """
    recover_partitioned(spark, path)
    return _read_all_columns(spark, path)


def upsert_partitions(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                      partition_by: Sequence[str], check_unique: bool = True,
                      newer_wins: str | Sequence[str] | None = None) -> int:
    """Keyed upsert that rewrites only the partitions ``source`` touches.

    The table is plain partitioned Parquet. Partition columns must be part of
    the key, so a key lives in exactly one partition. Steps: (1) merge the
    touched partitions of the target with the source and write the result to
    a staged copy under the shared work folder (a lineage cut); (2) record
    the intent next to the table; (3) dynamic partition overwrite from the
    staged copy; (4) clear the intent. A crash in (3) is repaired by
    :func:`recover_partitioned`, which every upsert and read runs first.
    Returns the number of touched partitions.
    """
    from tidemark.session import fresh_dir
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must be part of the merge key")
    recover_partitioned(spark, path)
    staged, folder = _staged_source(source, keys, check_unique, path)
    touched = staged.select(*partition_by).distinct()
    # a stored schema says that the table exists without a walk through its files
    if _stored_types(spark, path) is not None or partitioned_exists(spark, path):
        target = _read_all_columns(spark, path)
        # dynamic partition pruning restricts the scan to the touched partitions
        names = {c: f"__touched{i}" for i, c in enumerate(partition_by)}
        scoped = target.join(touched.select(*[F.col(c).alias(n) for c, n in names.items()]),
                             [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()], "left_semi")
        out = merged(scoped, staged, keys, newer_wins)
    else:
        out = staged
    result = fresh_dir(spark, "upsert-stage")
    out.write.mode("overwrite").parquet(result)
    n = touched.count()
    from tidemark.sinks.tables import SCHEMA_FILE
    _write_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}", out.schema.json())  # a new column is null in older files
    _write_text(spark, f"{path.rstrip('/')}/{_PENDING}", f"{result}\n{','.join(partition_by)}\n")
    recover_partitioned(spark, path)
    _remove(spark, result)
    _remove(spark, folder)
    return n


def partitioned_exists(spark: SparkSession, path: str) -> bool:
    """True when the folder holds data files, whatever markers a committer wrote.

    The first write is staged and replayed like every other, so files can only be those
    of a table; a write of something else that was cut short has left ``_temporary`` and
    no marker, and then raises instead of guessing.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    data, pending = False, False
    while files.hasNext():
        parts = files.next().getPath().toString().split("/")
        pending = pending or "_temporary" in parts
        data = data or not any(x.startswith(("_", ".")) and "=" not in x for x in parts[len(p.toString().split("/")):])
        if data and not pending and fs.exists(_fs(spark, f"{path.rstrip('/')}/_SUCCESS")[1]):
            return True
    if pending and not data:
        raise RuntimeError(f"{path} holds an unfinished write and no data file; clear it before writing")
    return data


def compact_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], where=None) -> int:
    """Rewrite partitions of a partitioned Parquet table into fewer,
    advisory-sized files (same rows), e.g. Bronze days written by many small
    appends or micro-batches. ``where`` (a Column or SQL text on partition
    columns) limits the partitions touched. Crash-safe the same way as
    :func:`upsert_partitions`: staged copy, intent marker, replayable swap.
    Returns the number of rows rewritten.
    """
    from tidemark.session import fresh_dir
    recover_partitioned(spark, path)
    # all columns of all files: the rewritten files must not lose those of later appends
    df = _read_all_columns(spark, path)
    if where is not None:
        df = df.where(where)
    staged = fresh_dir(spark, "compact-stage")
    df.write.mode("overwrite").parquet(staged)
    n = spark.read.parquet(staged).count()
    _write_text(spark, f"{path.rstrip('/')}/{_PENDING}", f"{staged}\n{','.join(partition_by)}\n")
    recover_partitioned(spark, path)
    fs, _ = _fs(spark, path)
    fs.delete(_fs(spark, staged)[1], True)
    return n
