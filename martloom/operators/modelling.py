"""Splitting one wide table into dimensions and a fact, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from martloom.functions.scalars import stable_key
from martloom.operators.joins import star_join


@dataclass(frozen=True)
class SplitSpec:
    """``dims``: dimension name -> its columns in the wide table, natural key first.
    ``measures``: the columns that stay in the fact."""

    dims: Mapping[str, Sequence[str]]
    measures: Sequence[str]
    fact: str = "fact"
    key_suffix: str = "_sk"
    text_suffix: str = "_key"

    def key(self, dim: str) -> str:
        return dim + self.key_suffix

    def text(self, dim: str) -> str:
        return dim + self.text_suffix


def short_key(key: Column) -> Column:
    """The first 128 bits of a ``stable_key``, a quarter of its text, which is most of a
    fact row. Among a trillion keys, two share them with a chance of 1 in 10^15. The
    coalesce never applies, as in ``stable_key``."""
    return F.coalesce(F.unhex(F.substring(key, 1, 32)), F.lit(b""))


def with_key(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Surrogate key from values: the same on every rerun and in every table."""
    return df.withColumn(name, stable_key(*cols))


def dimension(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct attribute rows; repeats are merged before the shuffle."""
    return df.select(*cols).distinct()


def decompose(wide: DataFrame, spec: SplitSpec) -> dict[str, DataFrame]:
    """Dimensions and a fact that holds their keys.

    The key covers every attribute of the dimension, so rows that differ in any
    attribute stay apart and the split loses nothing. The fact refers to it by its
    ``short_key``, which a dimension holds beside the whole text. Results are lazy: each
    reads only its own columns of ``wide``, which should be a stored table.
    """
    tables = {
        name: with_key(dimension(wide, cols), cols, spec.text(name)).select(
            short_key(F.col(spec.text(name))).alias(spec.key(name)), spec.text(name), *cols)
        for name, cols in spec.dims.items()
    }
    tables[spec.fact] = wide.select(
        *[short_key(stable_key(*cols)).alias(spec.key(name)) for name, cols in spec.dims.items()],
        *spec.measures,
    )
    return tables


def recompose(tables: Mapping[str, DataFrame], spec: SplitSpec) -> DataFrame:
    """The wide table again, by joining every dimension to the fact. Where they are joined
    one by one, that is in the order of the spec: name the smallest last, Spark then knows its
    size before the fact is shuffled for it."""
    dims = {spec.key(name): tables[name].drop(spec.text(name)) for name in spec.dims}
    return star_join(tables[spec.fact], dims).select(*[c for cols in spec.dims.values() for c in cols], *spec.measures)
