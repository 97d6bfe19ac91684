"""A suite over stored files that keeps the state of every file: a new file costs one reading of that file.

The state of a file is its rows and failing rows by predicate, its rows by key for key checks, and for reference checks
its rows by value on the one side and its values on the other. Such states add up over files, so results over any set of
files that have a state are those of a full run, and files that are gone simply do not count any more.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.operators.quality import FAIL, PASS, Expectation, _labels
from sediment.sources.files import children, exists, put_if_absent, qualified, read_text

FILE = "state_file"


def _file_path():
    """Path of a row's file as the file system prints it: not encoded, one slash after the scheme."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([A-Za-z0-9]+):///", "$1:/")


class SuiteStates:
    """States of the expectations below ``root``, one folder per table and set of expectations.

    Files are named by path and must not change once they are stored. ``reader`` makes rows of a list of files, Parquet by
    default. Other expectations on a table, in number, order or content, begin a new folder and read all files again.
    """

    def __init__(
        self, spark: SparkSession, root: str, expectations: Sequence[Expectation], reader: Callable[[list[str]], DataFrame] | None = None
    ):
        self.spark, self.root, self.expectations = spark, root.rstrip("/"), list(expectations)
        self.reader = reader or (lambda files: spark.read.parquet(*files))
        parents = [e.parent[0] for e in self.expectations if e.parent is not None]
        self.tables = list(dict.fromkeys([e.table for e in self.expectations] + parents))

    def add(self, files: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
        """Store the states of all files that have none yet; returns those files by table. The others are not read."""
        return {table: self._add_table(table, files.get(table, ())) for table in self.tables}

    def results(self, files: Mapping[str, Sequence[str]]) -> DataFrame:
        """What ``run_suite`` gives on the rows of ``files``, from their states alone.

        A table without a file and a file without a state are errors.
        """
        found = [self._counted(table, files) for table in dict.fromkeys(e.table for e in self.expectations)]
        for i, e in enumerate(self.expectations):
            if e.parent is not None:
                counted = self._lost(i, e, files)
            elif e.kind in ("unique", "grain"):
                counted = self._repeated(i, e, files)
            else:
                continue
            found.append(counted.select(*_labels(e), F.col("failures").cast("bigint")))
        results = reduce(DataFrame.unionByName, [f for f in found if f is not None])
        return results.withColumn("status", F.when(F.col("failures") == 0, PASS).otherwise(FAIL))

    # --- states of new files --------------------------------------------------------------------

    def _add_table(self, table: str, files: Sequence[str]) -> list[str]:
        wanted = sorted({qualified(self.spark, f) for f in files})
        records = self._records(table)
        known = {f for record in records for f in record["files"]}
        fresh = [f for f in wanted if f not in known]
        if fresh:
            batch = f"states-{uuid.uuid4().hex[:12]}"
            for name, state in self._states(table, self.reader(fresh).withColumn(FILE, _file_path())).items():
                state.write.parquet(f"{self._folder(table)}/{name}/{batch}")
            record = json.dumps({"batch": batch, "files": fresh})
            if not put_if_absent(self.spark, f"{self._folder(table)}/_done/{len(records):010d}", record):
                raise OSError(f"another writer added states of {table} at the same time")
        return fresh

    def _states(self, table: str, rows: DataFrame) -> dict[str, DataFrame]:
        n = F.count(F.lit(1)).alias("n")
        counts = [F.count_if(e.violation).alias(f"f{i}") for i, e in self._own(table) if e.violation is not None]
        states = {"rows": rows.groupBy(FILE).agg(n, *counts)}
        for i, e in self._own(table):
            if e.parent is not None:
                known = rows.filter(F.col(e.column).isNotNull())
                states[f"child{i}"] = known.groupBy(FILE, F.col(e.column).alias("k0")).agg(n)
            elif e.kind in ("unique", "grain"):
                keys, known = self._keys(e), rows
                if e.kind == "unique":
                    known = rows.filter(F.col(e.column).isNotNull())
                states[f"keys{i}"] = known.groupBy(FILE, *(F.col(k).alias(f"k{j}") for j, k in enumerate(keys))).agg(n)
        for i, e in enumerate(self.expectations):
            if e.parent is not None and e.parent[0] == table:
                states[f"parent{i}"] = rows.select(FILE, F.col(e.parent[1]).alias("k0")).filter("k0 is not null").distinct()
        return states

    # --- results --------------------------------------------------------------------------------

    def _counted(self, table: str, files: Mapping[str, Sequence[str]]) -> DataFrame | None:
        own = [(i, e) for i, e in self._own(table) if e.violation is not None or e.expected is not None]
        if not own:
            return None
        sums = self._read(table, "rows", files).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            *(F.coalesce(F.sum(f"f{i}"), F.lit(0)).alias(f"f{i}") for i, e in own if e.violation is not None),
        )
        failures = [F.col(f"f{i}") if e.violation is not None else (F.col("n") != e.expected).cast("bigint") for i, e in own]
        return sums.select(F.inline(F.array(*(F.struct(*_labels(e), f.alias("failures")) for (_, e), f in zip(own, failures, strict=True)))))

    def _repeated(self, i: int, e: Expectation, files: Mapping[str, Sequence[str]]) -> DataFrame:
        keys = [f"k{j}" for j in range(len(self._keys(e)))]
        total = self._read(e.table, f"keys{i}", files).groupBy(*keys).agg(F.sum("n").alias("n"))
        return total.agg(F.count_if(F.col("n") != 1).alias("failures"))

    def _lost(self, i: int, e: Expectation, files: Mapping[str, Sequence[str]]) -> DataFrame:
        # one row per value on either side before they meet, as in the full run
        child = self._read(e.table, f"child{i}", files).groupBy("k0").agg(F.sum("n").alias("n"))
        known = self._read(e.parent[0], f"parent{i}", files).select("k0").distinct().withColumn("found", F.lit(True))
        lost = F.sum(F.when(F.col("found").isNull(), F.col("n")))
        return child.join(known, "k0", "left").agg(F.coalesce(lost, F.lit(0)).alias("failures"))

    def _read(self, table: str, name: str, files: Mapping[str, Sequence[str]]) -> DataFrame:
        wanted = {qualified(self.spark, f) for f in files.get(table, ())}
        if not wanted:
            raise ValueError(f"no files of table {table}")
        records = self._records(table)
        known = {f for record in records for f in record["files"]}
        if wanted - known:
            raise ValueError(f"no state of {min(wanted - known)}")
        used = [r for r in records if wanted & set(r["files"])]
        states = self.spark.read.parquet(*(f"{self._folder(table)}/{name}/{r['batch']}" for r in used))
        if all(wanted >= set(r["files"]) for r in used):
            return states
        live = self.spark.createDataFrame([(f,) for f in sorted(wanted)], f"{FILE} string")
        return states.join(live, FILE, "left_semi")

    # --- names ----------------------------------------------------------------------------------

    def _own(self, table: str) -> list[tuple[int, Expectation]]:
        return [(i, e) for i, e in enumerate(self.expectations) if e.table == table]

    def _keys(self, e: Expectation) -> tuple[str, ...]:
        return (e.column,) if e.kind == "unique" else e.keys

    def _folder(self, table: str) -> str:
        about = [(i, e) for i, e in enumerate(self.expectations) if e.table == table or (e.parent is not None and e.parent[0] == table)]
        text = repr([(i, e.table, e.column, e.kind, str(e.violation), e.keys, e.parent) for i, e in about])
        return f"{self.root}/{table}-{hashlib.md5(text.encode()).hexdigest()[:12]}"

    def _records(self, table: str) -> list[dict]:
        folder = f"{self._folder(table)}/_done"
        names = children(self.spark, folder) if exists(self.spark, folder) else []
        return [json.loads(read_text(self.spark, n)) for n in names if n.rsplit("/", 1)[-1].isdigit()]
