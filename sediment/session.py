"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def session_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings sized from the data: initial shuffle partitions of about 128 MB, merged at run time."""
    partitions = max(cores, math.ceil(input_bytes / TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting it is a folder inside the warehouse, which executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
