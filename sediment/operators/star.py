"""Dimensions, fact assembly and the wide mart.

No join here carries a broadcast hint: Spark broadcasts a side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges with adaptive skew splitting.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.keys import date_key, surrogate_key


def dim_entity(df: DataFrame, key: str, sk: str, attributes: Sequence[str]) -> DataFrame:
    """One row per entity row of the input, led by the hashed key."""
    return df.select(surrogate_key(key).alias(sk), key, *attributes)


def dim_place(df: DataFrame, sk: str, parts: Mapping[str, Column | str]) -> DataFrame:
    """Distinct combinations of the parts (output name -> column) with their hashed key.

    The distinct runs on the raw parts, and the hash is computed once per surviving row.
    """
    named = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in parts.items()]
    distinct = df.select(*named).distinct()
    return distinct.select(surrogate_key(*parts).alias(sk), *parts)


def dim_date(
    df: DataFrame,
    col: str,
    sk: str = "date_sk",
    date: str = "date",
    year: str = "year",
    month: str = "month",
    quarter: str = "quarter",
) -> DataFrame:
    """Distinct dates of a column with key, year, month and quarter."""
    days = df.select(F.col(col).cast("date").alias(date)).distinct()
    return days.select(
        date_key(date).alias(sk),
        F.col(date),
        F.year(date).alias(year),
        F.month(date).alias(month),
        F.quarter(date).alias(quarter),
    )


def join_on_hash(fact: DataFrame, dim: DataFrame, cols: Sequence[Column | str], sk: str) -> DataFrame:
    """Inner join to a dimension through the key computed from the fact's own columns."""
    return fact.withColumn(sk, surrogate_key(*cols)).join(dim, sk, "inner")


def join_date(fact: DataFrame, dim: DataFrame, col: str, date: str = "date") -> DataFrame:
    """Inner join to the date dimension on the calendar date."""
    on = fact[col].cast("date") == dim[date]
    joined = fact.join(dim, on, "inner")
    return joined if date != col else joined.drop(dim[date])


def attach(fact: DataFrame, measure: DataFrame, keys: Sequence[str], flag: str | None = None) -> DataFrame:
    """Left join of a measure that is already at the fact's grain, on exact key equality.

    ``flag`` names a boolean column telling whether the measure had a row for the key.
    """
    if flag is None:
        return fact.join(measure, list(keys), "left")
    marked = measure.withColumn(flag, F.lit(True))
    joined = fact.join(marked, list(keys), "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def build_mart(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Fact widened by its dimensions with inner joins on their keys.

    A column that a dimension also carries is dropped from the fact first, so each name occurs once.
    """
    mart = fact
    for dim, sk in dims:
        shared = [c for c in dim.columns if c != sk and c in mart.columns]
        mart = mart.drop(*shared).join(dim, sk, "inner")
    return mart


def with_parse_status(declared: DataFrame, parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of parse results to their declarations, for results produced elsewhere.

    Within one job :func:`sediment.functions.measures.with_quantity` gives the same columns without a join.
    """
    return declared.join(parsed, list(keys), "left")
