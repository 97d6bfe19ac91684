"""Snapshot tables that know their rows' key: versions share the files that did not change, and two versions are compared
by reading only what differs.

Rows are dealt to buckets by a hash of their key, and each bucket has files of its own. A version is a tree of hashes: the
leaves say what is in a bucket and which folder holds its files, and every node above is the sum of the nodes below it.
A write stores the buckets whose leaf changed and points to the former files of the others.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from sediment.session import scratch
from sediment.sources.files import exists, put_if_absent, read_text
from sediment.sources.provenance import file_path, row_cells
from sediment.sources.snapshots import Commit, ConcurrentCommit, SnapshotTable, _schema

BUCKET, ATTEMPT, PIECE = "_bucket", "_attempt", "_piece"
FAN_OUT_BITS = 4
ROWS_PER_FILE = 5_000_000
TREE = "level int, node bigint, n bigint, h1 decimal(38,0), h2 decimal(38,0), attempt string, files bigint"
SAME = "a.n <=> b.n and a.h1 <=> b.h1 and a.h2 <=> b.h2"


class KeyedSnapshotTable(SnapshotTable):
    """A snapshot table over rows with a key. Keys may repeat or be NULL; a version is what was written, row by row.

    ``buckets`` is fixed with the first version and should give files of a good size; a bucket of more than
    ``rows_per_file`` rows, as a key of very many rows makes one, is written as several files by several tasks.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 256, rows_per_file: int = ROWS_PER_FILE):
        super().__init__(spark, path)
        self.key = list(key)
        self.buckets = buckets
        self.rows_per_file = rows_per_file
        self.levels = max(1, math.ceil(math.log2(max(buckets, 2)) / FAN_OUT_BITS))

    # --- writing --------------------------------------------------------------------------------

    def write(self, df: DataFrame, content_hash: str, label: str = "") -> bool:
        """Write the frame as the next version unless it already is the current content.

        When another writer commits first, the rows are set against that writer's version and committed after it, so
        both contents are kept in the order of their commits. The frame is read twice: for the hashes and for the rows.
        """
        self._check_layout()
        marked = df.withColumn(BUCKET, self._bucket_of(df)).withColumns({f"_h{k}": F.xxhash64(F.lit(k), *row_cells(df)) for k in (1, 2)})
        sums = [F.sum(F.col(f"_h{k}").cast("decimal(38,0)")).alias(f"h{k}") for k in (1, 2)]
        leaves = self._kept(marked.groupBy(F.col(BUCKET).alias("node")).agg(F.count(F.lit(1)).alias("n"), *sums), "leaves")
        while True:
            last = self.latest()
            if last is not None and last.content_hash == content_hash:
                return False
            try:
                self._write_version(df, marked.drop("_h1", "_h2"), leaves, last, content_hash, label)
                return True
            except ConcurrentCommit:
                continue

    def _write_version(self, df: DataFrame, marked: DataFrame, leaves: DataFrame, last: Commit | None, content_hash: str, label: str) -> None:
        schema = df.schema.json()
        attempt = uuid.uuid4().hex[:12]
        former = self._tree(last).where("level = 0") if last is not None else self.spark.createDataFrame([], TREE)
        usable = former if last is not None and last.schema == schema else former.where("false")
        both = self._kept(leaves.alias("a").join(usable.alias("b"), "node", "left").selectExpr("node", "a.n", "a.h1", "a.h2", f"if({SAME}, b.attempt, null) attempt", "b.files"), "compared")
        pieces = F.ceil(F.col("n") / self.rows_per_file)
        changed = both.where("attempt is null").select(F.col("node").alias(BUCKET), pieces.alias("_pieces"))
        rows = marked.join(changed, BUCKET).withColumn(PIECE, F.pmod(F.xxhash64(*row_cells(df)), F.col("_pieces")))
        at_once = max(1, min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.buckets))
        rows.repartition(at_once, BUCKET, PIECE).drop("_pieces", PIECE).write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{self.path}/data/{ATTEMPT}={attempt}")
        written = self._rows(df.schema, [(attempt, None)])
        files = written.groupBy(F.col(BUCKET).alias("node")).agg(F.count_distinct("_path").alias("new_files"))
        whole = both.join(files, "node", "left").select(
            F.lit(0).alias("level"), "node", "n", "h1", "h2", F.coalesce("attempt", F.lit(attempt)).alias("attempt"),
            F.when(F.col("attempt").isNull(), F.col("new_files")).otherwise(F.col("files")).alias("files"),
        )
        tree = level = whole
        for n in range(1, self.levels + 1):
            above = F.shiftright("node", FAN_OUT_BITS).alias("node")
            sums = [F.sum(c).cast(kind).alias(c) for c, kind in (("n", "bigint"), ("h1", "decimal(38,0)"), ("h2", "decimal(38,0)"))]
            level = level.groupBy(above).agg(*sums).select(F.lit(n).alias("level"), "node", "n", "h1", "h2", F.lit(None).cast("string").alias("attempt"), F.lit(None).cast("bigint").alias("files"))
            tree = tree.unionByName(level)
        path = f"trees/{attempt}"
        tree.write.mode("errorifexists").parquet(f"{self.path}/{path}")
        stored = self.spark.read.schema(TREE).parquet(f"{self.path}/{path}").where("level = 0")
        added = stored.where(F.col("attempt") == attempt).agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
        rows_total = stored.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self._commit(
            Commit(
                version=0 if last is None else last.version + 1, operation="WRITE", mode="Overwrite", label=label, content_hash=content_hash,
                rows=rows_total, files_added=added, files_removed=self._only_in(former, stored), path=path, schema=schema,
            )
        )

    def restore(self, version: int) -> bool:
        """Make an earlier version current again by a commit that points to its tree."""
        last, wanted = self.latest(), self._find(version)
        if last.content_hash == wanted.content_hash:
            return False
        old, new = (self._tree(c).where("level = 0") for c in (last, wanted))
        added, removed = self._only_in(new, old), self._only_in(old, new)
        self._commit(replace(wanted, version=last.version + 1, operation="RESTORE", files_added=added, files_removed=removed))
        return True

    @staticmethod
    def _only_in(leaves: DataFrame, others: DataFrame) -> int:
        """Files of the buckets that the other version does not hold from the same folder."""
        return leaves.join(others.select("node", "attempt"), ["node", "attempt"], "left_anti").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]

    def _bucket_of(self, df: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*row_cells(df.select(*self.key))), F.lit(self.buckets))

    def _check_layout(self) -> None:
        name = f"{self.path}/_layout"
        layout = json.dumps({"key": self.key, "buckets": self.buckets})
        if not exists(self.spark, name):
            put_if_absent(self.spark, name, layout)
        if read_text(self.spark, name) != layout:
            raise ValueError(f"{self.path} has another key or number of buckets: {read_text(self.spark, name)}")

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        where = scratch(self.spark, name)
        df.write.parquet(where)
        return self.spark.read.parquet(where)

    # --- reading --------------------------------------------------------------------------------

    def _tree(self, commit: Commit) -> DataFrame:
        return self.spark.read.schema(TREE).parquet(f"{self.path}/{commit.path}")

    def _rows(self, schema: StructType, places: Sequence[tuple[str, int | None]]) -> DataFrame:
        """Rows of buckets (of all of a folder where the bucket is None), with their folder, bucket and file."""
        whole = StructType([*schema.fields]).add(ATTEMPT, StringType()).add(BUCKET, LongType())
        if not places:
            return self.spark.createDataFrame([], StructType([*whole.fields]).add("_path", StringType()))
        data = f"{self.path}/data"
        paths = [f"{data}/{ATTEMPT}={a}" + ("" if b is None else f"/{BUCKET}={b}") for a, b in sorted(places, key=str)]
        return self.spark.read.schema(whole).option("basePath", data).parquet(*paths).withColumn("_path", file_path())

    def _places(self, leaves: DataFrame) -> list[tuple[str, int]]:
        """Folder and bucket of each leaf: one entry per bucket, metadata as any listing of files."""
        return [(r.attempt, r.node) for r in leaves.select("attempt", "node").collect()]

    def _read(self, commit: Commit) -> DataFrame:
        return self._rows(_schema(commit), self._places(self._tree(commit).where("level = 0"))).select(*_schema(commit).names)

    def read_versions(self, versions: Sequence[int], name: str = "version") -> DataFrame:
        """Several versions in one scan of the files they have between them, each row carrying its version."""
        found = [self._find(v) for v in sorted(set(versions))]
        schema = StructType([*{f.name: f for c in found for f in _schema(c).fields}.values()])
        held = None
        for c in found:
            leaves = self._tree(c).where("level = 0").select(F.col("attempt").alias(ATTEMPT), F.col("node").alias(BUCKET), F.lit(c.version).alias("_version"))
            held = leaves if held is None else held.unionByName(leaves)
        places = [(r[0], r[1]) for r in held.select(ATTEMPT, BUCKET).distinct().collect()]
        rows = self._rows(schema, places).join(held, [ATTEMPT, BUCKET])
        return rows.select(*schema.names, F.col("_version").alias(name))

    # --- comparing ------------------------------------------------------------------------------

    def unequal_buckets(self, before: int, after: int) -> DataFrame:
        """(node) of the buckets that differ between two versions, found from the root of the trees downwards."""
        a, b = self._find(before), self._find(after)
        alike = a.schema == b.schema
        differing = None
        for level in range(self.levels, -1, -1):
            sides = [self._tree(c).where(F.col("level") == level) for c in (a, b)]
            if differing is not None:
                above = differing.select(F.col("node").alias("above"))
                sides = [s.join(above, F.shiftright("node", FAN_OUT_BITS) == F.col("above"), "left_semi") for s in sides]
            both = sides[0].alias("a").join(sides[1].alias("b"), "node", "full")
            differing = (both.where(f"not ({SAME})") if alike else both).select("node")
        return differing

    def _sides(self, before: int, after: int) -> tuple[DataFrame, DataFrame]:
        """The rows of the buckets that differ, in either version."""
        buckets = self._kept(self.unequal_buckets(before, after), "unequal")
        sides = []
        for version in (before, after):
            commit = self._find(version)
            leaves = self._tree(commit).where("level = 0").join(buckets, "node", "left_semi")
            sides.append(self._rows(_schema(commit), self._places(leaves)).select(*_schema(commit).names))
        return sides[0], sides[1]

    def changed_keys(self, before: int, after: int) -> DataFrame:
        """Key, change (added, removed, changed) and number of rows in either version, for every key whose rows differ.

        The rows of a key are compared as a bag: their order does not count, repeated rows do. Only buckets that
        differ are read. A column that one version does not have makes every key that has it changed.
        """
        sums = {f"_s{k}": lambda df, k=k: F.sum(F.xxhash64(F.lit(k), *row_cells(df)).cast("decimal(38,0)")) for k in (1, 2)}
        sides = []
        for df in self._sides(before, after):
            schema = F.lit(",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema)))
            grouped = df.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n"), *[s(df).alias(c) for c, s in sums.items()])
            sides.append(grouped.withColumn("_shape", schema))
        same = " and ".join(f"a.`{k}` <=> b.`{k}`" for k in self.key)
        both = sides[0].alias("a").join(sides[1].alias("b"), F.expr(same), "full")
        differ = both.where("not (a.n <=> b.n and a._s1 <=> b._s1 and a._s2 <=> b._s2 and a._shape <=> b._shape)")
        change = F.when(F.col("a.n").isNull(), "added").when(F.col("b.n").isNull(), "removed").otherwise("changed")
        here = [F.when(F.col("a.n").isNull(), F.col(f"b.`{k}`")).otherwise(F.col(f"a.`{k}`")).alias(k) for k in self.key]
        count = lambda side, name: F.coalesce(f"{side}.n", F.lit(0)).alias(name)
        return differ.select(*here, change.alias("change"), count("a", "rows_before"), count("b", "rows_after"))

    def changed_rows(self, before: int, after: int, name: str = "change") -> DataFrame:
        """Rows that only the earlier version has (removed) or only the later one (added), repeated rows as often as they differ."""
        old, new = self._sides(before, after)
        fields = {f.name: f.dataType for df in (old, new) for f in df.schema.fields}
        old, new = (df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c) for c, kind in fields.items()]) for df in (old, new))
        return old.exceptAll(new).withColumn(name, F.lit("removed")).unionByName(new.exceptAll(old).withColumn(name, F.lit("added")))
