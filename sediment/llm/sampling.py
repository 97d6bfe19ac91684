"""A bounded sample of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 1 << 40


def bounded_sample(keys: DataFrame, docs: DataFrame, rows: int) -> DataFrame:
    """(label, text) of about ``rows`` documents, the same number for each label as far as there are any.

    ``keys`` has (doc_id, label). Which ids are taken follows from a hash of id and label, so it does not depend on
    order or partitions. The counts of the labels and the chosen ids, about ``rows`` of them, reach the driver;
    the ids go back as a table of that size, so the texts of all others are passed over where they are read. An id
    that names several rows stands for the smallest text of them.
    """
    keys = keys.toDF("doc_id", "label").where("doc_id is not null").distinct()
    counts = {r[0]: r[1] for r in keys.groupBy("label").count().collect()}
    each = max(rows // max(len(counts), 1), 1)
    limit = F.lit(-1).cast("long")
    for label, n in sorted(counts.items()):
        limit = F.when(F.col("label") == F.lit(label), F.lit(min(SCALE, each * SCALE // n))).otherwise(limit)
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "label"), F.lit(SCALE))
    ids = sorted(map(tuple, keys.where(place < limit).collect()))
    chosen = docs.sparkSession.createDataFrame(ids, keys.schema)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text")
