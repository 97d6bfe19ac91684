"""Layers that keep rows of many dates: a write replaces the dates it is about and leaves the others as they are.

Rows go to a folder of their own, one sub-folder per date. A numbered record maps every date to the folder that holds its
current rows and is put in place last, so a failed write changes nothing and readers see one state or the next. A writer
that finds its number taken reads the new state and tries again, unless the other one replaced one of the same dates.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from sediment.sources.files import children, exists, filesystem, put_if_absent, read_text

ATTEMPT = "_attempt"
EMPTY = "__HIVE_DEFAULT_PARTITION__"


class ReplacedMeanwhile(Exception):
    """Another writer replaced one of the same partitions first."""


def _base(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _records(spark: SparkSession, base: str) -> list[str]:
    return children(spark, f"{base}/_dates") if exists(spark, f"{base}/_dates") else []


def _state(spark: SparkSession, records: list[str]) -> dict:
    """Partition folder name -> attempt that holds it, with the column and schema."""
    return json.loads(read_text(spark, records[-1])) if records else {"by": None, "schema": None, "held": {}}


def _read(spark: SparkSession, base: str, state: dict, held: dict[str, str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(state["schema"]))
    if not held:
        return spark.createDataFrame([], schema)
    paths = [f"{base}/{ATTEMPT}={attempt}/{part}" for part, attempt in sorted(held.items())]
    rows = spark.read.schema(StructType([*schema.fields]).add(ATTEMPT, StringType())).option("basePath", base).parquet(*paths)
    return rows.select(*[f"`{f.name}`" for f in schema.fields])


def partition_name(by: str, value: object) -> str:
    """Folder of one value, as Spark names it; values are dates, numbers or plain words."""
    text = EMPTY if value is None else str(value)
    if not all(c.isalnum() or c in "-_." for c in text):
        raise ValueError(f"not a plain partition value: {value!r}")
    return f"{by}={text}"


def replace_partitions(df: DataFrame, root: str, name: str, by: str, values: Iterable[object] = ()) -> DataFrame:
    """Write ``df`` so that its values of ``by`` hold exactly its rows; returns these rows, read back.

    ``values`` are replaced even if ``df`` has no rows of them, so a rerun that finds nothing leaves nothing. The schema
    must stay the same from write to write. Folders that no record but the last two points to are removed.
    """
    spark, base = df.sparkSession, _base(root, name)
    attempt = uuid.uuid4().hex[:12]
    df.write.mode("errorifexists").partitionBy(by).parquet(f"{base}/{ATTEMPT}={attempt}")
    written = [p.rsplit("/", 1)[-1] for p in children(spark, f"{base}/{ATTEMPT}={attempt}")]
    new = {part: attempt for part in written}
    gone = {partition_name(by, v) for v in values} | set(new)
    fields = sorted(df.schema.fields, key=lambda f: f.name == by)  # the partition column is read last
    schema = StructType(fields).json()
    before = _state(spark, _records(spark, base))
    while True:
        records = _records(spark, base)
        state = _state(spark, records)
        if state["schema"] not in (None, schema):
            raise ValueError(f"{name} has another schema than the rows to be written")
        if any(state["held"].get(part) != before["held"].get(part) for part in gone):
            raise ReplacedMeanwhile(f"another writer replaced the same dates of {name}")
        held = {part: at for part, at in state["held"].items() if part not in gone} | new
        after = {"by": by, "schema": schema, "held": held}
        number = int(records[-1].rsplit("/", 1)[-1]) + 1 if records else 0
        if put_if_absent(spark, f"{base}/_dates/{number:010d}", json.dumps(after)):
            break
    _clean(spark, base, records, held)
    return _read(spark, base, after, new)


def _clean(spark: SparkSession, base: str, records: list[str], held: dict[str, str]) -> None:
    """Remove folders that only records before the former one point to; readers of the former state can finish."""
    if not records:
        return
    used = {*held.values(), *_state(spark, records)["held"].values()}
    for record in records[:-1]:
        for attempt in {*json.loads(read_text(spark, record))["held"].values()} - used:
            folder, fs = filesystem(spark, f"{base}/{ATTEMPT}={attempt}")
            fs.delete(folder, True)
        path, fs = filesystem(spark, record)
        fs.delete(path, False)


def read_partitions(spark: SparkSession, root: str, name: str, values: Iterable[object] | None = None) -> DataFrame:
    """Current rows of all dates, or of the given ones; only their folders are read."""
    base = _base(root, name)
    records = _records(spark, base)
    if not records:
        raise FileNotFoundError(f"no layer {name} below {root}")
    state = _state(spark, records)
    held = state["held"]
    if values is not None:
        wanted = {partition_name(state["by"], v) for v in values}
        held = {part: at for part, at in held.items() if part in wanted}
    return _read(spark, base, state, held)
