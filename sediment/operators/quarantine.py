"""Keep what cannot be trusted: rows without a reliable key are set aside, not dropped."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sediment.functions.text import clean_text, safe_int, safe_key, valid_key
from sediment.session import scratch

# Fixed value: the reason written to quarantined rows.
REASON_INVALID_KEY = "ID_PREDIO_AUSENTE_OU_INVALIDO"

GOOD, BAD, STRUCTURAL = "good", "bad", "structural"


@dataclass(frozen=True)
class KeyRule:
    """Where the key and the identifying text are, and where the data rows begin.

    ``close_gaps`` also sets aside data rows that carry something else but neither key nor name, and
    digit keys that do not fit ``key_type``; without it such rows are left to the other outputs.
    """

    key: str
    required: str
    ordinal: str | None = None
    first_data_row: int = 5
    key_type: str = "int"
    close_gaps: bool = False

    def in_data(self) -> Column:
        if self.ordinal is None:
            return F.lit(True)
        return F.coalesce(safe_int(self.ordinal, "bigint") >= self.first_data_row, F.lit(False))

    def is_good(self) -> Column:
        good = valid_key(self.key)
        return good & safe_key(self.key, self.key_type).isNotNull() if self.close_gaps else good

    def is_bad(self) -> Column:
        named = clean_text(self.required).isNotNull()
        if self.close_gaps:
            named = named | clean_text(self.key).isNotNull()
        return self.in_data() & ~self.is_good() & named


def label_rows(df: DataFrame, rule: KeyRule, name: str = "record_kind") -> DataFrame:
    """One label per row: good, bad or structural (titles, header, blank lines)."""
    kind = F.when(rule.is_good(), GOOD).when(rule.is_bad(), BAD).otherwise(STRUCTURAL)
    return df.withColumn(name, kind)


def split_valid(df: DataFrame, rule: KeyRule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Good, bad and structural rows; every input row is in exactly one of them.

    The input is evaluated once: rows are stored by kind in the shared scratch folder and read from there.
    """
    path = scratch(df.sparkSession, "split")
    label_rows(df, rule, "_kind").write.partitionBy("_kind").parquet(path)
    schema = StructType([*df.schema.fields, StructField("_kind", StringType())])
    labelled = df.sparkSession.read.schema(schema).parquet(path)
    return tuple(labelled.filter(F.col("_kind") == k).drop("_kind") for k in (GOOD, BAD, STRUCTURAL))


def quarantine(
    df: DataFrame,
    rule: KeyRule,
    keep: Mapping[str, str],
    originals: Mapping[str, str],
    reason_column: str = "reason",
    reason: str = REASON_INVALID_KEY,
) -> DataFrame:
    """The bad rows with their provenance, their original texts and the reason.

    ``keep`` and ``originals`` map output names to input columns; originals are trimmed with blank
    as NULL, and the ordinal column among ``keep`` becomes an integer.
    """
    kept = [
        (safe_int(c) if c == rule.ordinal else F.col(c)).alias(name) for name, c in keep.items()
    ]
    return df.filter(rule.is_bad()).select(
        *kept,
        *[clean_text(c).alias(name) for name, c in originals.items()],
        F.lit(reason).alias(reason_column),
    )
