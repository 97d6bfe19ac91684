"""Whole documents: one row per file, text unchanged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.sources.provenance import (
    DOCUMENT,
    _as_list,
    file_path,
    file_hashes,
    relative_to,
    with_provenance,
)


def read_document_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    version: str,
    root: str | None = None,
    content_hash: str | None = None,
) -> DataFrame:
    """Document text plus provenance. Each document must fit one value; files are read in parallel."""
    text = (
        spark.read.option("recursiveFileLookup", "true")
        .text(_as_list(paths), wholetext=True)
        .select(F.col("value").alias(DOCUMENT), file_path().alias("_file"))
    )
    origin = relative_to(F.col("_file"), root)
    if content_hash is not None:
        return with_provenance(text, version, content_hash, origin).drop("_file")
    hashes = file_hashes(spark, paths).select(F.col("path").alias("_file"), F.col("hash").alias("_sha"))
    return with_provenance(text.join(hashes, "_file"), version, F.col("_sha"), origin).drop("_file", "_sha")
