"""JSON text columns to flat columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from predia.operators.cleaning import quoted

# Names are never replaced: quoted ones are matched first, a plain one is followed by a colon.
_TYPE_WORD = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\b(?:VARIANT|VOID)\b(?!:)|\bDECIMAL\(\d+,\s*[1-9]\d*\)")


def _as_ddl(variant_schema: str) -> str:
    def word(match: re.Match) -> str:
        found = match.group()
        if found.startswith("`"):
            return found
        if found.startswith("OBJECT"):
            return "STRUCT<"
        return "DOUBLE" if found.startswith("DECIMAL") else "STRING"

    return _TYPE_WORD.sub(word, variant_schema)


class WideSchemaError(ValueError):
    """A JSON column whose keys look like data."""


def infer_json_schema(df: DataFrame, column: str, widest: int = 1 << 20) -> T.DataType:
    """The schema of a JSON text column over all rows, by one aggregate; only the schema text reaches the driver.

    Fractions are doubles; a field with values of several kinds, or with nulls only, is text. A schema of more than
    ``widest`` characters is an error: its keys are data, for which ``explode_keys`` gives rows.
    """
    schema = F.schema_of_variant_agg(F.try_parse_json(quoted(column)))
    row = df.agg(F.char_length(schema).alias("size"), F.when(F.char_length(schema) <= widest, schema).alias("s")).first()
    if (row["size"] or 0) > widest:
        raise WideSchemaError(f"the schema of {column} has {row['size']} characters: its keys are data, use explode_keys")
    return T.DataType.fromDDL(_as_ddl(row["s"]))


def explode_keys(
    df: DataFrame, column: str, keys: Sequence[str] = ("key",), value: str = "value",
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """A JSON text column whose keys are data, as rows: one per key, level by level.

    ``keys`` names a column for each level of keys; a level may also be an array, whose places are then the keys. What
    lies below the last level stays a variant in the column ``value``, or gives the ``fields``
    ``{column: "path type"}``, each null where it is missing or of another type. A row whose text is no JSON, is empty or
    has no keys stays, with nulls. No schema is inferred, and a new key is a new row, not a new column.
    """
    spark = df.sparkSession
    rows = df.withColumn("_variant", F.try_parse_json(quoted(column))).drop(column)
    for level in keys:
        exploded = spark.tvf.variant_explode_outer(F.col("_variant").outer()).toDF("_at", "_name", "_value")
        rows = rows.lateralJoin(exploded).withColumns({
            level: F.coalesce("_name", F.col("_at").cast("string")), "_variant": F.col("_value"),
        }).drop("_at", "_name", "_value")
    if fields is None:
        return rows.withColumnRenamed("_variant", value)
    found = {}
    for name, wanted in fields.items():
        path, _, kind = wanted.rpartition(" ")
        found[name] = F.try_variant_get("_variant", path, kind)
    return rows.withColumns(found).drop("_variant")


def autoflatten(df: DataFrame) -> DataFrame:
    """Repeat until no struct and no array is left: a struct gives ``parent_child`` columns, an array gives a row
    per element (one row when empty or null), so two arrays of one row give their product."""
    while True:
        nested = next((f for f in df.schema if isinstance(f.dataType, (T.StructType, T.ArrayType))), None)
        if nested is None:
            return df
        column = quoted(nested.name)
        if isinstance(nested.dataType, T.ArrayType):
            df = df.withColumn(nested.name, F.explode_outer(column))
            continue
        children = [column[child.name].alias(f"{nested.name}_{child.name}") for child in nested.dataType]
        df = df.select(*[quoted(c) for c in df.columns if c != nested.name], *children)


def flatten_json(
    df: DataFrame, column: str, schema: T.DataType | str | None = None, partition_column: str | None = None,
    strip: str = "_doc_",
) -> DataFrame:
    """``df`` with a JSON text column replaced by its flattened fields, named ``column_field``.

    ``schema`` avoids the inference pass. ``partition_column`` is dropped first; ``strip`` is removed from the names.
    """
    if partition_column is not None:
        df = df.drop(partition_column)
    if schema is None:
        schema = infer_json_schema(df, column)
    elif isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    if isinstance(schema, (T.StructType, T.ArrayType)):
        df = df.withColumn(column, F.from_json(quoted(column), schema))
    flat = autoflatten(df)
    return flat.toDF(*[name.replace(strip, "") for name in flat.columns])
