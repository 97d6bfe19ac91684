"""Data expectations: each one is a query for failing rows; a suite counts them in few passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.measures import non_negative_violation
from sediment.functions.text import _col

PASS, FAIL = "pass", "fail"


class ExpectationsFailed(Exception):
    """Raised by the gate; the message lists each failed expectation with its count."""


# --- failing rows -------------------------------------------------------------------------------


def grain_violations(df: DataFrame, keys: Sequence[str], name: str = "occurrences") -> DataFrame:
    """Key combinations that do not occur exactly once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) != 1)


def duplicates(df: DataFrame, col: str, name: str = "occurrences") -> DataFrame:
    """Non-null values that occur more than once."""
    return grain_violations(df.filter(F.col(col).isNotNull()), [col], name)


def orphans(child: DataFrame, parent: DataFrame, col: str, key: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    known = parent.select(F.col(key).alias("_known"))
    return child.filter(F.col(col).isNotNull()).join(known, F.col(col) == F.col("_known"), "left_anti")


def formula_violation(where: Column | str, got: Column | str, expected: Column, tolerance: float) -> Column:
    return F.coalesce(_col(where) & (F.abs(_col(got) - expected) > tolerance), F.lit(False))


# --- declarative suite --------------------------------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    """One named check on one table.

    ``violation`` is a row predicate for checks that a single pass can count; the other checks say
    how to get their failing rows from the tables.
    """

    table: str
    column: str
    kind: str
    violation: Column | None = None
    keys: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    expected: int | None = None

    def failing_rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        if self.violation is not None:
            return df.filter(self.violation)
        if self.parent is not None:
            return orphans(df, tables[self.parent[0]], self.column, self.parent[1])
        if self.expected is not None:
            return df.agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") != self.expected)
        if self.kind == "unique":
            return duplicates(df, self.column)
        return grain_violations(df, self.keys)

    def failure_count(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Number of failures for checks outside the shared pass."""
        if self.parent is None:
            return self.failing_rows(tables).agg(F.count(F.lit(1)).alias("failures"))
        # Both sides become one row per value before they meet, so no value can be hot in the join.
        # An outer join keeps that order; an anti join would be moved below the aggregation.
        child = tables[self.table].filter(F.col(self.column).isNotNull())
        per_value = child.groupBy(F.col(self.column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
        known = tables[self.parent[0]].select(F.col(self.parent[1]).alias("_value")).distinct()
        joined = per_value.join(known.withColumn("_found", F.lit(True)), "_value", "left")
        lost = F.sum(F.when(F.col("_found").isNull(), F.col("_n")))
        return joined.agg(F.coalesce(lost, F.lit(0)).alias("failures"))


def expect_not_null(table: str, col: str) -> Expectation:
    return Expectation(table, col, "not_null", F.col(col).isNull())


def expect_unique(table: str, col: str) -> Expectation:
    return Expectation(table, col, "unique")


def expect_in(table: str, col: str, values: Sequence[str]) -> Expectation:
    """NULL passes, as with any value check."""
    return Expectation(table, col, "accepted_values", F.coalesce(~F.col(col).isin(*values), F.lit(False)))


def expect_fk(table: str, col: str, parent: str, key: str) -> Expectation:
    return Expectation(table, col, "relationships", parent=(parent, key))


def expect_grain(table: str, keys: Sequence[str]) -> Expectation:
    return Expectation(table, ",".join(keys), "grain", keys=tuple(keys))


def expect_formula(
    table: str, col: str, where: Column | str, expected: Column, tolerance: float = 1e-4
) -> Expectation:
    return Expectation(table, col, "formula", formula_violation(where, col, expected, tolerance))


def expect_non_negative(table: str, cols: Sequence[str]) -> Expectation:
    return Expectation(table, ",".join(cols), "non_negative", non_negative_violation(*cols))


def expect_count(table: str, expected: int) -> Expectation:
    return Expectation(table, "*", "row_count", expected=expected)


def expect_interpreted(table: str, declared: str, ok: Column) -> Expectation:
    return Expectation(
        table, declared, "interpreted", F.col(declared).isNotNull() & ~F.coalesce(ok, F.lit(False))
    )


def expect_values(table: str, values: Mapping[str, object]) -> Expectation:
    """Every row carries exactly these values; a differing or missing one fails."""
    wrong = [~F.col(c).eqNullSafe(F.lit(v)) for c, v in values.items()]
    return Expectation(table, ",".join(values), "values", reduce(lambda a, b: a | b, wrong))


def run_suite(tables: Mapping[str, DataFrame], expectations: Sequence[Expectation]) -> DataFrame:
    """Results table: one row per expectation with its number of failures and its status.

    All row predicates on a table share one aggregation; only key checks need their own.
    """
    parts: list[DataFrame] = []
    for table in dict.fromkeys(e.table for e in expectations):
        own = [e for e in expectations if e.table == table]
        batched = [e for e in own if e.violation is not None]
        if batched:
            counts = tables[table].agg(
                *[F.count_if(e.violation).alias(f"f{i}") for i, e in enumerate(batched)]
            )
            rows = F.array(
                *[
                    F.struct(*_labels(e), F.col(f"f{i}").alias("failures"))
                    for i, e in enumerate(batched)
                ]
            )
            parts.append(counts.select(F.inline(rows)))
        for e in own:
            if e.violation is None:
                parts.append(e.failure_count(tables).select(*_labels(e), F.col("failures").cast("bigint")))
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("status", F.when(F.col("failures") == 0, PASS).otherwise(FAIL))


def _labels(e: Expectation) -> list[Column]:
    return [F.lit(e.table).alias("table"), F.lit(e.column).alias("column"), F.lit(e.kind).alias("kind")]


def quality_summary(results: DataFrame) -> DataFrame:
    """Number of expectations per kind and status, most frequent first."""
    return (
        results.groupBy("kind", "status")
        .agg(F.count(F.lit(1)).alias("expectations"))
        .orderBy(F.col("expectations").desc(), "kind", "status")
    )


def gate(results: DataFrame) -> None:
    """Raise when any expectation failed. The results hold one row per declared expectation."""
    failed = results.filter(F.col("status") == FAIL).collect()
    if failed:
        lines = [f"{r['table']}.{r['column']} {r['kind']}: {r['failures']}" for r in failed]
        raise ExpectationsFailed("; ".join(lines))
