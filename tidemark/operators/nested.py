"""Schema drift at any depth of JSON payloads, from one aggregate per batch."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: type classes by the first word of a VARIANT type name; anything else keeps its name in lower case
_CLASSES = {"BIGINT": "number", "DOUBLE": "number", "FLOAT": "number", "DECIMAL": "number", "STRING": "string",
            "BOOLEAN": "boolean", "VOID": "null", "VARIANT": "mixed"}


def _parts(text: str) -> list[str]:
    """The top-level, comma-separated parts of the inside of ``OBJECT<...>``."""
    out, depth, quoted, start = [], 0, False, 0
    for k, c in enumerate(text):
        if c == "`":
            quoted = not quoted
        elif not quoted:
            depth += (c in "<(") - (c in ">)")
            if c == "," and depth == 0:
                out.append(text[start:k])
                start = k + 1
    return [*out, text[start:]] if text.strip() else []


def _field(part: str) -> tuple[str, str]:
    """(name, type) of ``name: TYPE``; a name with odd characters is quoted by backticks."""
    part = part.strip()
    if part.startswith("`"):
        end = 1
        while part[end] != "`" or part[end:end + 2] == "``":
            end += 2 if part[end] == "`" else 1
        return part[1:end].replace("``", "`"), part[end + 1:].lstrip(" :")
    name, _, kind = part.partition(":")
    return name, kind.strip()


def type_paths(type_name: str, path: str = "$") -> Iterator[tuple[str, str]]:
    """(path, type class) of every node of a VARIANT type such as ``OBJECT<a: ARRAY<BIGINT>>``.

    Members are ``.name``, elements ``[]``; classes are object, array, number, string,
    boolean, null and mixed.
    """
    kind, _, inside = type_name.strip().partition("<")
    inside = inside[:-1]
    if kind == "OBJECT":
        yield path, "object"
        for name, member in map(_field, _parts(inside)):
            yield from type_paths(member, f"{path}.{name}")
    elif kind == "ARRAY":
        yield path, "array"
        yield from type_paths(inside, f"{path}[]")
    else:
        yield path, _CLASSES.get(kind.partition("(")[0], kind.lower())


def payload_type_trees(df: DataFrame, batch_col: str, payload_col: str) -> DataFrame:
    """(batch, type): the type of all payloads of a batch, merged by a partial aggregate.

    Payloads that are no JSON are left out; fields of several types become VARIANT.
    """
    return (df.select(F.col(batch_col).alias("batch"), F.try_parse_json(F.col(payload_col).cast("string")).alias("v"))
            .where(F.col("v").isNotNull()).groupBy("batch").agg(F.schema_of_variant_agg("v").alias("type")))


def nested_drift(df: DataFrame, batch_col: str, payload_col: str, old_batch, new_batch) -> DataFrame:
    """(path, old_class, new_class, change) of the nodes that differ between two batches of payloads.

    ``change`` is added, removed or retyped. What lies below an added or removed node is listed
    too; below a node that changed its kind nothing is. The payloads are read by one aggregate
    that leaves one type per batch, so the driver sees two type names, whose size is that of
    the schema and not of the data. A batch without payloads has no nodes.
    """
    spark = df.sparkSession
    trees = payload_type_trees(df.where(F.col(batch_col).isin(old_batch, new_batch)), batch_col, payload_col)
    found = {r["batch"]: dict(type_paths(r["type"])) for r in trees.collect()}
    old, new = found.get(old_batch, {}), found.get(new_batch, {})
    rows = []
    for path in sorted(old.keys() | new.keys()):
        a, b = old.get(path), new.get(path)
        if a == b or any(_below(path, p) for p, x, y, _ in rows if x and y):
            continue
        rows.append((path, a, b, "added" if a is None else "removed" if b is None else "retyped"))
    return spark.createDataFrame(rows, "path string, old_class string, new_class string, change string")


def _below(path: str, parent: str) -> bool:
    return path.startswith((f"{parent}.", f"{parent}["))
