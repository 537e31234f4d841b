"""Renaming, dropping, deriving and filtering columns and rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.values import pair_mean

_NAME_CLEANING = str.maketrans({" ": "_", "(": None, ")": None})


def normalised_name(name: str) -> str:
    return name.translate(_NAME_CLEANING)


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(renames))


def normalise_names(df: DataFrame) -> DataFrame:
    """Blanks become underscores and parentheses go; two names may not become one."""
    source: dict[str, str] = {}
    for name in df.columns:
        clean = normalised_name(name)
        if clean in source:
            raise ValueError(f"columns {source[clean]!r} and {name!r} both become {clean!r}")
        source[clean] = name
    return df.toDF(*source)


def drop_columns(df: DataFrame, names: Iterable[str], must_exist: bool = False) -> DataFrame:
    names = list(names)
    absent = [n for n in names if n not in df.columns]
    if must_exist and absent:
        raise ValueError(f"no such columns: {absent}")
    return df.drop(*names)


def drop_by_pattern(df: DataFrame, patterns: Iterable[str], names: Iterable[str] = ()) -> DataFrame:
    """Drop the columns whose name contains one of ``patterns`` or is one of ``names``."""
    patterns, names = tuple(patterns), frozenset(names)
    return df.drop(*[c for c in df.columns if c in names or any(p in c for p in patterns)])


def add_pair_means(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: pair_mean(a, b) for name, (a, b) in pairs.items()})


def contradiction(rules: Sequence[str]) -> Column:
    """True where any of the SQL predicates holds; a null predicate does not hold."""
    held = [F.coalesce(F.expr(rule), F.lit(False)) for rule in rules]
    return reduce(lambda a, b: a | b, held, F.lit(False))


def contradictory_rows(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    return df.filter(contradiction(rules))


def without_contradictions(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    return df.filter(~contradiction(rules)) if rules else df


def drop_classes(df: DataFrame, target: str, labels: Sequence[str]) -> DataFrame:
    """Remove the rows of the given classes; unlabelled rows stay."""
    return df.filter(~F.coalesce(F.col(target).isin(*labels), F.lit(False))) if labels else df


def append_by_name(base: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both tables, duplicates kept, columns matched by name."""
    return base.unionByName(new, allowMissingColumns=False)


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 20) -> DataFrame:
    return df.orderBy(*order_by).limit(rows)
