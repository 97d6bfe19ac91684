"""Ordered, idempotent ingestion of source snapshots into a snapshot table."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from sediment.sources.delimited import profile, read_delimited_raw
from sediment.sources.documents import read_document_raw
from sediment.sources.elements import read_elements_raw
from sediment.sources.profile import Profile
from sediment.sources.provenance import source_hashes
from sediment.sources.snapshots import SnapshotTable

# A reader gets the source path, its version label and its content hash.
Reader = Callable[[str, str, str], DataFrame]


class DelimitedReader:
    """Reads delimited sources. The profile that gives a source's content hash also serves to read it, so a source is read twice in all."""

    def __init__(self, spark: SparkSession, root: str | None = None, sep: str = ";", **options):
        self.spark, self.root, self.sep, self.options = spark, root, sep, options
        self._profiles: dict[str, Profile] = {}

    def content_hash(self, path: str) -> str:
        self._profiles[path] = profile(self.spark, path, self.sep)
        return source_hashes(self.spark, [path], self._profiles[path].hashes())[path]

    def __call__(self, path: str, label: str, content_hash: str) -> DataFrame:
        known = self._profiles.pop(path, None)
        return read_delimited_raw(self.spark, path, label, self.sep, self.root, content_hash=content_hash, known=known, **self.options)


def delimited_reader(spark: SparkSession, root: str | None = None, sep: str = ";", **options) -> Reader:
    return DelimitedReader(spark, root, sep, **options)


def _content(spark: SparkSession, paths: Sequence[str], read: Reader) -> dict[str, str]:
    """Content hash of each source, by the reader if it finds it on its way."""
    if hasattr(read, "content_hash"):
        return {path: read.content_hash(path) for path in paths}
    return source_hashes(spark, paths)


def document_reader(spark: SparkSession, root: str | None = None) -> Reader:
    return lambda path, label, content_hash: read_document_raw(spark, path, label, root, content_hash)


def element_reader(spark: SparkSession, path: str, root: str | None = None) -> Reader:
    """For documents that are too large for one value: the elements of the array at ``path``, a row each."""
    return lambda source, label, content_hash: read_elements_raw(spark, source, label, path, root, content_hash)


def label_of(path: str) -> str:
    """Version label of a source: its file or folder name without the extension."""
    return re.sub(r"\.[A-Za-z0-9]+$", "", path.rstrip("/").rsplit("/", 1)[-1])


def ingest_one(table: SnapshotTable, path: str, read: Reader, version: str | None = None) -> bool:
    """Land one source as the current snapshot; False when its content already is current."""
    content_hash = _content(table.spark, [path], read)[path]
    label = label_of(path) if version is None else version
    if table.current_hash() == content_hash:
        return False
    return table.write(read(path, label, content_hash), content_hash, label)


def ingest_snapshots(
    table: SnapshotTable,
    paths: Sequence[str],
    read: Reader,
    minimum: int = 2,
) -> list[int]:
    """Land a series of snapshots in the order of their names; returns the versions written.

    A source is a file, or a folder of part files. Content already in the history is not written
    again; when the newest source is not the active content afterwards, its version is restored so
    that the current version is the newest source. A rerun writes nothing.
    """
    ordered = sorted(paths, key=label_of)
    if len(ordered) < minimum:
        raise FileNotFoundError(f"{minimum} snapshots are needed, {len(ordered)} found")
    content = _content(table.spark, ordered, read)
    seen = table.history()
    written: list[int] = []

    def land(path: str) -> None:
        if table.write(read(path, label_of(path), content[path]), content[path], label_of(path)):
            written.append(table.current_version())

    for path in ordered:
        if content[path] not in seen:
            land(path)
    newest = content[ordered[-1]] if ordered else None
    if newest is not None and table.restore(table.history()[newest]):
        written.append(table.current_version())
    return written


def restore_newest(table: SnapshotTable) -> list[int]:
    """Make the snapshot with the highest label current, for arrivals out of order."""
    commits = table.commits()
    newest = max(commits, key=lambda c: (c.label, c.version))
    return [table.current_version()] if table.restore(newest.version) else []
