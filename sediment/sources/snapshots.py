"""Versioned snapshot tables: full Parquet snapshots plus one small commit record per version.

A version exists once its commit record exists. The record is put in place last, by a rename that
fails when the name is taken, so a job that dies leaves no version and two writers cannot both
claim one. Reads go through the records and never list data folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from sediment.sources.files import children, exists, put_if_absent, read_text

COMMIT_SCHEMA = (
    "version bigint, operation string, mode string, label string, content_hash string, "
    "rows bigint, files_added bigint, files_removed bigint, path string, schema string"
)


@dataclass(frozen=True)
class Commit:
    version: int
    operation: str
    mode: str
    label: str
    content_hash: str
    rows: int
    files_added: int
    files_removed: int
    path: str
    schema: str


class ConcurrentCommit(Exception):
    """Another writer committed the version first."""


class SnapshotTable:
    """A table whose every version is a complete snapshot of its source."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # --- history --------------------------------------------------------------------------------

    def commits(self) -> list[Commit]:
        """Commit records in version order: metadata only, one small file per version."""
        return [Commit(**row.asDict()) for row in self.commit_log(full=True).orderBy("version").collect()]

    def commit_log(self, full: bool = False) -> DataFrame:
        """The history as rows: version, operation, mode, rows, files added and removed."""
        if exists(self.spark, f"{self.path}/_commits"):
            log = self.spark.read.schema(COMMIT_SCHEMA).option("pathGlobFilter", "*.json").json(
                f"{self.path}/_commits"
            )
        else:
            log = self.spark.createDataFrame([], COMMIT_SCHEMA)
        return log if full else log.drop("path", "schema")

    def history(self) -> dict[str, int]:
        """Content hash -> latest version holding it."""
        return {c.content_hash: c.version for c in self.commits()}

    def latest(self) -> Commit | None:
        """The current commit: record names carry the version, so only one record is read."""
        folder = f"{self.path}/_commits"
        records = children(self.spark, folder, ".json") if exists(self.spark, folder) else []
        return self._record(records[-1]) if records else None

    def _record(self, path: str) -> Commit:
        return Commit(**json.loads(read_text(self.spark, path)))

    def current_version(self) -> int | None:
        last = self.latest()
        return None if last is None else last.version

    def current_hash(self) -> str | None:
        last = self.latest()
        return None if last is None else last.content_hash

    # --- writing --------------------------------------------------------------------------------

    def write(self, df: DataFrame, content_hash: str, label: str = "") -> bool:
        """Write the frame as the next version unless it already is the current content."""
        last = self.latest()
        if last is not None and last.content_hash == content_hash:
            return False
        version = 0 if last is None else last.version + 1
        data = f"version={version}/attempt={uuid.uuid4().hex[:12]}"
        df.write.mode("errorifexists").parquet(f"{self.path}/{data}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.path}/{data}")
        self._commit(
            Commit(
                version=version,
                operation="WRITE",
                mode="Overwrite",
                label=label,
                content_hash=content_hash,
                rows=written.count(),
                files_added=len(written.inputFiles()),
                files_removed=0 if last is None else last.files_added,
                path=data,
                schema=df.schema.json(),
            )
        )
        return True

    def restore(self, version: int) -> bool:
        """Make an earlier version current again by a commit that points to its stored files."""
        last, wanted = self.latest(), self._find(version)
        if last.content_hash == wanted.content_hash:
            return False
        self._commit(
            replace(wanted, version=last.version + 1, operation="RESTORE", files_removed=last.files_added)
        )
        return True

    def _commit(self, commit: Commit) -> None:
        if not put_if_absent(self.spark, self._record_path(commit.version), json.dumps(asdict(commit)) + "\n"):
            raise ConcurrentCommit(f"version {commit.version} of {self.path} was committed by another writer")

    # --- reading --------------------------------------------------------------------------------

    def read_version(self, version: int) -> DataFrame:
        """The snapshot as it was at that version, with that version's own schema."""
        return self._read(self._find(version))

    def current(self) -> DataFrame:
        last = self.latest()
        if last is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._read(last)

    def read_versions(self, versions: Sequence[int], name: str = "version") -> DataFrame:
        """Several versions in one scan, each row carrying its version.

        Columns a version does not have are NULL. Schemas come from the commit records, so no file
        footer is opened for them.
        """
        found = [self._find(v) for v in sorted(set(versions))]
        fields = {f.name: f for c in found for f in _schema(c).fields}
        schema = StructType([*fields.values()]).add("version", IntegerType()).add("attempt", StringType())
        rows = (
            self.spark.read.schema(schema)
            .option("basePath", self.path)
            .parquet(*sorted({f"{self.path}/{c.path}" for c in found}))
            .drop("attempt")
        )
        # A restored version has no files of its own: rows of the files it points to count for it too.
        stored: dict[int, list[int]] = {}
        for c in found:
            stored.setdefault(int(c.path.split("/")[0].split("=")[1]), []).append(c.version)
        versions_of = F.create_map(
            *[x for k, vs in stored.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]))]
        )
        labelled = rows.withColumn("version", F.explode(versions_of[F.col("version")]))
        return labelled.withColumnRenamed("version", name)

    def compare_versions(self, versions: Sequence[int], aggregates: Mapping[str, Column]) -> DataFrame:
        """The same aggregates (name -> column) over each version, in one pass over all of them."""
        rows = self.read_versions(versions)
        return rows.groupBy("version").agg(*[c.alias(n) for n, c in aggregates.items()]).orderBy("version")

    def _find(self, version: int) -> Commit:
        path = self._record_path(version)
        if not exists(self.spark, path):
            raise ValueError(f"no such version: {version}")
        return self._record(path)

    def _record_path(self, version: int) -> str:
        return f"{self.path}/_commits/{version:020d}.json"

    def _read(self, commit: Commit) -> DataFrame:
        return self.spark.read.schema(_schema(commit)).parquet(f"{self.path}/{commit.path}")


def _schema(commit: Commit) -> StructType:
    return StructType.fromJson(json.loads(commit.schema))

