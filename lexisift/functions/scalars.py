"""Column functions for keys, blanks, codes and dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """Null, empty, or nothing but spaces."""
    return c.isNull() | (F.trim(c) == "")


def null_if_blank(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def cut_front(c: Column, n: int) -> Column:
    """What follows the first n characters."""
    return F.substr(c, F.lit(n + 1))


def padded_key(*parts: tuple[str, int]) -> Column:
    """Zero-padded columns one after another; null if one is null."""
    return F.concat(*[F.lpad(F.col(c).cast("string"), n, "0") for c, n in parts])


def split_key(key: Column, first: int, last: int) -> tuple[Column, Column]:
    return F.left(key, F.lit(first)), F.right(key, F.lit(last))


def first_non_blank(pairs: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """The first value that isn't blank, and the name of the source it is from."""
    value = F.coalesce(*[null_if_blank(c) for _, c in pairs])
    source = F.coalesce(*[F.when(~is_blank(c), F.lit(n)) for n, c in pairs])
    return value, source


def sentinel(column: str) -> str:
    """The token that stands for a missing value of a column."""
    return column.replace("_", "") + "inconnue"


def fill_sentinel(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(null_if_blank(F.col(c)), F.lit(sentinel(c))) for c in columns})


def prefix_class(column: str, rules: Sequence[tuple[str, Sequence[str], tuple[str, Sequence[str]] | None]], default: str) -> Column:
    """The first class one of whose prefixes the column begins with, or whose list another column is in."""
    out = None
    for name, prefixes, listed in rules:
        test = F.lit(False)
        for p in prefixes:
            test = test | F.col(column).startswith(p)
        if listed:
            test = test | F.col(listed[0]).isin(*listed[1])
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out.otherwise(F.lit(default))


def map_lookup(c: Column, entries: Mapping[str, object], default: object = None) -> Column:
    """A dictionary's value for a column, or the default."""
    table = F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), F.lit(v))])
    found = F.try_element_at(table, c)
    return found if default is None else F.coalesce(found, F.lit(default))


def rounded(c: Column, digits: int = 6) -> Column:
    """A double rounded half away from zero after scaling, as SQL's round does it, without the decimals that Spark's round makes of each value."""
    size = F.abs(c) * float(10**digits)
    whole = F.floor(size)
    near = F.signum(c) * (whole + F.when(size - whole >= 0.5, 1).otherwise(0)).cast("double") / float(10**digits)
    return F.when(size < 2.0**52, near).otherwise(F.round(c, digits))
