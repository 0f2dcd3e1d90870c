"""Nested records, lists in text, templates and merged results."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Every leaf of nested structs as a column named by its path."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()):
        for f in schema.fields:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name)

    return df.select(*[F.col(".".join(f"`{x}`" for x in p)).alias(separator.join(p)) for p in leaves(df.schema)])


def hits_to_rows(df: DataFrame, key: str, hits: str) -> DataFrame:
    return df.select(key, F.inline(hits))


def parse_list(text: Column, element: str = "string") -> Column:
    """A list written as text; null where it can't be read."""
    return F.from_json(text, f"array<{element}>")


def zip_lists(codes: Column, scores: Column) -> Column:
    """Pairs (code, score) by position; the longer list's rest is paired with nulls."""
    return F.transform(F.arrays_zip(codes.alias("a"), scores.alias("b")), lambda x: F.struct(x["a"].alias("code"), x["b"].alias("score")))


def list_to_columns(df: DataFrame, column: str, name: str, n: int) -> DataFrame:
    return df.withColumns({f"{name}_{i}": F.get(F.col(column), F.lit(i)) for i in range(n)})


def render(template: str, columns: list[str]) -> Column:
    """A template's {{name}} replaced by columns; an unknown name or a null gives nothing."""
    parts, at = [], 0
    for m in re.finditer(r"\{\{\s*(\w+)\s*\}\}", template):
        parts.append(F.lit(template[at : m.start()]))
        parts.append(F.coalesce(F.col(m[1]).cast("string"), F.lit("")) if m[1] in columns else F.lit(""))
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def with_error_rows(inputs: DataFrame, results: DataFrame, key: str, message: str) -> DataFrame:
    """All results with status ok, and a row with a message for each input that has none."""
    done = results.withColumn("status", F.lit("ok"))
    return done.unionByName(inputs.join(results.select(key), key, "left_anti").select(key).withColumn("status", F.lit(message)), allowMissingColumns=True)


def integrate(base: DataFrame, key: str, results: Mapping[str, DataFrame]) -> DataFrame:
    """Each named result's columns, prefixed by its name, joined to the base rows by key."""
    for name, df in results.items():
        base = base.join(df.withColumnsRenamed({c: f"{name}_{c}" for c in df.columns if c != key}), key, "left")
    return base


def merge_configuration(base: Mapping, changes: Mapping, environment: Mapping[str, str] | None = None, separator: str = "__") -> dict:
    """Nested settings merged key by key; then what the environment names by upper-case paths that exist."""

    def merged(a, b):
        return {k: merged(a[k], b[k]) if k in a and k in b and isinstance(a[k], Mapping) and isinstance(b[k], Mapping) else b.get(k, a.get(k)) for k in [*a, *[k for k in b if k not in a]]}

    def overridden(node, path):
        out = {}
        for k, v in node.items():
            name = separator.join([*path, str(k).upper()])
            out[k] = overridden(v, [*path, str(k).upper()]) if isinstance(v, Mapping) else (environment or {}).get(name, v)
        return out

    return overridden(merged(base, changes), [])
