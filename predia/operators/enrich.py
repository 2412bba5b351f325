"""Enrichment: lookups, fan-out joins, attribute pivot, union of branches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from predia.operators.cleaning import quoted


def lookup(
    df: DataFrame, other: DataFrame, key: str, other_key: str, columns: Mapping[str, str | Column], how: str = "left"
) -> DataFrame:
    """``df`` with columns of ``other`` (``{new name: column}``), whose key is unique.

    Only the key and the asked columns of ``other`` take part, under private names, so equal names on both sides
    cannot clash and the key of ``df`` stays. No hint: see ``predia.session`` on broadcast and on hot keys.
    """
    values = {name: quoted(value) if isinstance(value, str) else value for name, value in columns.items()}
    side = other.select(quoted(other_key).alias("_key"), *[v.alias(f"_v{i}") for i, v in enumerate(values.values())])
    joined = df.join(side, quoted(key) == F.col("_key"), how).drop("_key")
    return joined.withColumnsRenamed({f"_v{i}": name for i, name in enumerate(values)})


def pivot_attributes(
    details: DataFrame, definitions: DataFrame, aliases: Sequence[str], entity: str, attribute: str, value: str,
    alias: str, order: str,
) -> DataFrame:
    """Entity–attribute–value rows to one row per entity, with a column per alias.

    The alias list is fixed, so no job runs to find it. When an entity holds an attribute twice the detail with the
    least ``order`` counts, then the least value. Details of other attributes still make their entity appear.
    """
    named = lookup(details, definitions, attribute, attribute, {"_alias": alias}, "inner")
    first = F.min(F.struct(quoted(order).alias("o"), quoted(value).alias("v")))
    wide = named.groupBy(quoted(entity)).pivot("_alias", list(aliases)).agg(first)
    return wide.select(quoted(entity), *[quoted(a)["v"].alias(a) for a in aliases])


def union_branches(*branches: DataFrame, distinct: bool = False) -> DataFrame:
    """Rows of all branches, matched by column name; a column that a branch lacks is null there."""
    first, *others = branches
    for branch in others:
        first = first.unionByName(branch, allowMissingColumns=True)
    return first.distinct() if distinct else first


def select_constants(df: DataFrame, values: Mapping[str, object], types: Mapping[str, str] | None = None) -> DataFrame:
    """Constant columns; a null needs its type in ``types``."""
    types = types or {}
    return df.withColumns({
        name: F.lit(value).cast(types[name]) if name in types else F.lit(value) for name, value in values.items()
    })


def observe_count(df: DataFrame, name: str, metric: str = "rows"):
    """``df`` and an observation that holds its row count once any action has run over it: no extra scan."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias(metric)), observation

