"""Parquet layers: each model is a folder of attempts, and numbered records say which one is current."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sediment.sources.files import children, exists, filesystem, put_if_absent, read_text


def _records(spark: SparkSession, root: str, name: str) -> list[str]:
    folder = f"{root.rstrip('/')}/{name}/_current"
    return children(spark, folder) if exists(spark, folder) else []


def layer_path(spark: SparkSession, root: str, name: str) -> str:
    """Folder with the current rows of a model."""
    records = _records(spark, root, name)
    if not records:
        raise FileNotFoundError(f"no layer {name} below {root}")
    return f"{root.rstrip('/')}/{name}/{read_text(spark, records[-1])}"


def read_layer(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(layer_path(spark, root, name))


def write_layer(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write one model and return it read back, so later stages start from the stored rows.

    The rows go to a folder of their own. They become current by one small record that is put in place only if its
    number is free; until then, and if anything fails before, readers find the former rows untouched. The rows
    before the former ones are removed, so a reader that started on the former ones can finish.
    """
    spark, base = df.sparkSession, f"{root.rstrip('/')}/{name}"
    records = _records(spark, root, name)
    fresh = f"rows-{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base}/{fresh}")
    number = int(records[-1].rsplit("/", 1)[-1]) + 1 if records else 0
    if not put_if_absent(spark, f"{base}/_current/{number:010d}", fresh):
        raise OSError(f"another writer stored {name} at the same time")
    for record in records[:-1]:
        old, fs = filesystem(spark, f"{base}/{read_text(spark, record)}")
        fs.delete(old, True)
        fs.delete(filesystem(spark, record)[0], False)
    return spark.read.parquet(f"{base}/{fresh}")
