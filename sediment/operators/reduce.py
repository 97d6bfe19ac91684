"""Reduce detail rows to the fact grain before any join, so a join cannot multiply measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.text import _col


def pivot_max(
    df: DataFrame, keys: Sequence[str], kind: str, value: str, columns: Mapping[str, str]
) -> DataFrame:
    """One column per listed kind (kind value -> output name), holding the kind's largest value."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(kind) == k, F.col(value))).alias(name) for k, name in columns.items()]
    )


def sum_of_products(quantity: Column | str, unit: Column | str) -> Column:
    return F.sum(_col(quantity) * _col(unit))


def count_declared(declared: Column | str) -> Column:
    return F.count(_col(declared))


def count_unread(declared: Column | str, ok: Column) -> Column:
    """Declarations that were not read; not knowing counts as not read."""
    return F.count_if(_col(declared).isNotNull() & ~F.coalesce(ok, F.lit(False)))


def strict_sum(value: Column | str, declared: Column | str, ok: Column) -> Column:
    """Sum that is NULL when nothing was declared or when any declaration could not be read."""
    return F.when(
        (count_declared(declared) > 0) & (count_unread(declared, ok) == 0), F.sum(_col(value))
    )


def any_declared(declared: Column | str) -> Column:
    return count_declared(declared) > 0


def fanout_report(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What joining two detail tables directly would cost: rows on each side, rows after, worst key.

    Both sides are counted per key before they meet, so the product is computed, never produced.
    """
    wide = "decimal(19,0)"
    left = a.groupBy(*keys).agg(F.count(F.lit(1)).cast(wide).alias("_n"))
    right = b.groupBy(*keys).agg(F.count(F.lit(1)).cast(wide).alias("_m"))
    product = (F.col("_n") * F.col("_m")).cast("decimal(38,0)")
    return left.join(right, list(keys), "inner").agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("_n").alias("left_rows"),
        F.sum("_m").alias("right_rows"),
        F.sum(product).alias("joined_rows"),
        F.max(product).alias("worst_key_rows"),
    )
