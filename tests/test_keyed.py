"""Snapshot tables with a key: shared files, differences between versions, interleaved writers."""

import random
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sediment.sources.keyed import KeyedSnapshotTable

SCHEMA = "k int, j string, v string, n double"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedSnapshotTable(spark, f"{tmp_path}/t", ["k", "j"], buckets=40)


def some(n=300, seed=1):
    rng = random.Random(seed)
    out = [(k, rng.choice("ab"), rng.choice(["x", "y", None, ""]), rng.choice([None, 0.5, -1.0])) for k in range(n)]
    return out + [out[5], (None, None, "no key", 1.0), (7, None, "half a key", None)]


def frame(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def bag(df):
    return sorted(map(str, df.collect()))


def test_one_changed_key_adds_one_file(spark, table):
    first = some()
    assert table.write(frame(spark, first), "a")
    second = [(k, j, "new", n) if k == 17 else (k, j, v, n) for k, j, v, n in first]
    assert table.write(frame(spark, second), "b")
    assert not table.write(frame(spark, second), "b")
    log = rows(table.commit_log().select("version", "rows", "files_added", "files_removed"), "version")
    assert log[0][1] == len(first) and log[0][2] > 30 and log[0][3] == 0
    assert log[1] == (1, len(second), 1, 1)
    assert bag(table.read_version(0)) == bag(frame(spark, first)) and bag(table.current()) == bag(frame(spark, second))
    assert table.unequal_buckets(0, 1).count() == 1
    sides = table._sides(0, 1)
    assert [len(s.inputFiles()) for s in sides] == [1, 1]
    assert rows(table.changed_keys(0, 1)) == [(17, second[17][1], "changed", 1, 1)]
    assert {r.change: r.v for r in table.changed_rows(0, 1).collect()} == {"added": "new", "removed": first[17][2]}
    assert table.restore(0) and not table.restore(0)
    assert bag(table.current()) == bag(frame(spark, first)) and table.latest().files_added == 1
    third = table.read_versions([0, 1, 2])
    assert rows(third.groupBy("version").count(), "version") == [(v, len(first)) for v in (0, 1, 2)]
    assert rows(table.compare_versions([0, 1], {"new": F.count_if(F.col("v") == "new")})) == [(0, 0), (1, 1)]


@pytest.mark.parametrize("seed", range(3))
def test_differences_are_those_of_a_full_outer_join(spark, table, seed):
    rng = random.Random(seed)
    versions = [some(seed=seed)]
    for _ in range(2):
        last = versions[-1]
        rest = [r for r in last if rng.random() > 0.1]
        rest = [(k, j, "changed", n) if rng.random() < 0.05 else (k, j, v, n) for k, j, v, n in rest]
        versions.append(rest + [(1000 + rng.randrange(50), "a", "added", None) for _ in range(9)])
    for n, values in enumerate(versions):
        table.write(frame(spark, values), str(n))
    for a, b in ((0, 1), (1, 2), (0, 2), (2, 0), (1, 1)):
        bags = [{}, {}]
        for side, values in zip(bags, (versions[a], versions[b]), strict=True):
            for row in values:
                side.setdefault(row[:2], []).append(str(row))
        want = set()
        for key in {*bags[0], *bags[1]}:
            x, y = (sorted(side.get(key, [])) for side in bags)
            if x != y:
                want.add((*key, "added" if not x else "removed" if not y else "changed", len(x), len(y)))
        assert set(rows(table.changed_keys(a, b))) == want
        old, new = (frame(spark, versions[v]) for v in (a, b))
        got = table.changed_rows(a, b)
        assert bag(got.where("change = 'added'").drop("change")) == bag(new.exceptAll(old))
        assert bag(got.where("change = 'removed'").drop("change")) == bag(old.exceptAll(new))


def test_another_schema_rewrites_and_still_compares(spark, table):
    table.write(frame(spark, some(20)), "a")
    table.write(frame(spark, some(20)).withColumn("w", F.lit(1)), "b")
    assert table.current().columns == ["k", "j", "v", "n", "w"] and table.read_version(0).columns == ["k", "j", "v", "n"]
    keys = table.changed_keys(0, 1)
    assert keys.where("change = 'changed'").count() == keys.count() == len({r[:2] for r in some(20)})
    assert table.changed_rows(0, 1).count() == 2 * len(some(20))


def test_a_hot_key_is_written_as_several_files(spark, tmp_path):
    table = KeyedSnapshotTable(spark, f"{tmp_path}/t", ["k", "j"], buckets=4, rows_per_file=50)
    values = [(1, "a", str(n), float(n)) for n in range(400)] + some(20)
    table.write(frame(spark, values), "a")
    assert table.latest().files_added > 6 and bag(table.current()) == bag(frame(spark, values))


def test_empty_versions_and_another_layout(spark, tmp_path, table):
    table.write(frame(spark, []), "a")
    table.write(frame(spark, some(20)), "b")
    table.write(frame(spark, []), "c")
    assert [c.rows for c in table.commits()] == [0, 23, 0]
    assert table.current().collect() == [] and table.changed_keys(1, 2).where("change <> 'removed'").count() == 0
    with pytest.raises(ValueError, match="buckets"):
        KeyedSnapshotTable(spark, f"{tmp_path}/t", ["k"], buckets=40).write(frame(spark, []), "d")


def test_interleaved_writers_land_both_contents(spark, tmp_path, monkeypatch):
    """Both look at the same version, one commits first: the other's rows are set against it and follow."""
    path = f"{tmp_path}/t"
    KeyedSnapshotTable(spark, path, ["k", "j"], buckets=8).write(frame(spark, some(30)), "start")
    ready = threading.Barrier(2, timeout=120)
    commit = KeyedSnapshotTable._commit
    waited = set()

    def both_ready(self, record):
        if record.content_hash not in waited:
            waited.add(record.content_hash)
            ready.wait()
        commit(self, record)

    monkeypatch.setattr(KeyedSnapshotTable, "_commit", both_ready)
    contents = {name: some(30) + [(900 + n, "z", name, None)] for n, name in enumerate(("one", "two"))}
    done = {}

    def writer(name):
        table = KeyedSnapshotTable(spark, path, ["k", "j"], buckets=8)
        done[name] = table.write(frame(spark, contents[name]), name)

    threads = [threading.Thread(target=writer, args=(n,)) for n in contents]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    table = KeyedSnapshotTable(spark, path, ["k", "j"], buckets=8)
    log = table.commits()
    assert [c.version for c in log] == [0, 1, 2] and done == {"one": True, "two": True}
    assert {c.content_hash for c in log[1:]} == {"one", "two"}
    for c in log[1:]:
        assert bag(table.read_version(c.version)) == bag(frame(spark, contents[c.content_hash]))
