"""Snapshots that arrive over time, landed by a file stream."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sediment.sources.files import exists
from sediment.sources.ingest import Reader, ingest_snapshots, restore_newest
from sediment.sources.provenance import plain_path
from sediment.sources.snapshots import SnapshotTable

# A file of the folder's name with this at its end, beside it and not empty, says that the folder is complete.
COMPLETE = ".complete"
ARRIVAL_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_ingest(
    spark: SparkSession,
    directory: str,
    table: SnapshotTable,
    checkpoint: str,
    read: Reader,
    folders: bool = False,
) -> StreamingQuery:
    """Land every snapshot that has arrived in the directory, then stop; call again for later arrivals.

    The stream only notices files; their contents are read by the landing itself. With ``folders``
    a snapshot is a sub-folder of part files and lands when its marker stands beside it, a file with any content
    named like the folder with ``.complete`` added: until then the folder is passed over, and the arrival of the
    marker brings it back. Otherwise each file is a snapshot.
    Files may arrive in any order and a batch may be replayed: content already landed writes nothing, and an
    older snapshot never stays the current one.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(ARRIVAL_SCHEMA)
        .option("recursiveFileLookup", "true")
        .load(directory)
        .select(plain_path(F.col("_metadata.file_path")).alias("path"))
    )
    marked = F.regexp_replace("path", re.escape(COMPLETE) + "$", "")
    folder = F.when(F.endswith("path", F.lit(COMPLETE)), marked).otherwise(F.regexp_replace("path", "/[^/]*$", ""))
    source = folder if folders else F.col("path")
    return (
        arrivals.select(source.alias("source"))
        .writeStream.foreachBatch(lambda batch, _: land_arrivals(batch, table, read, folders))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_arrivals(batch: DataFrame, table: SnapshotTable, read: Reader, folders: bool = False) -> list[int]:
    """Land the sources named in one batch, then make the newest snapshot of all current.

    The batch holds file names, not data. The last step also repairs a batch that died half-way.
    """
    paths = [row[0] for row in batch.select("source").distinct().collect()]
    if folders:
        paths = [p for p in paths if exists(table.spark, p + COMPLETE)]
    if not paths:
        return []
    return ingest_snapshots(table, paths, read, minimum=1) + restore_newest(table)
