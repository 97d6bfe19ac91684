import threading

import pytest
from pyspark.sql import functions as F

from sediment.session import scratch
from sediment.sources import ingest as ing
from sediment.sources.layers import read_layer, write_layer
from sediment.sources.snapshots import ConcurrentCommit, SnapshotTable
from sediment.streaming.arrivals import stream_ingest


def snapshot(folder, label, rows, columns=2):
    folder.mkdir(exist_ok=True)
    (folder / f"{label}.csv").write_text(
        "".join(";".join(f"{r}{c}" for c in range(columns)) + "\n" for r in rows), encoding="utf-8"
    )
    return str(folder / f"{label}.csv")


@pytest.fixture
def register(spark, tmp_path):
    return SnapshotTable(spark, f"{tmp_path}/bronze/register")


def test_first_load_rerun_and_new_file(spark, tmp_path, register):
    raw = tmp_path / "raw"
    files = [snapshot(raw, "2026-08-17", "abc"), snapshot(raw, "2026-08-01", "ab")]
    read = ing.delimited_reader(spark, str(raw))
    assert ing.ingest_snapshots(register, files, read) == [0, 1]
    assert ing.ingest_snapshots(register, files, read) == []
    assert [c.label for c in register.commits()] == ["2026-08-01", "2026-08-17"]
    assert (register.read_version(0).count(), register.current().count()) == (2, 3)
    files.append(snapshot(raw, "2026-09-01", "abcd"))
    assert ing.ingest_snapshots(register, files, read) == [2]
    assert register.current_version() == 2


def test_too_few_snapshots(spark, tmp_path, register):
    with pytest.raises(FileNotFoundError):
        ing.ingest_snapshots(register, [snapshot(tmp_path, "a", "a")], ing.delimited_reader(spark))
    assert register.current_version() is None


def test_late_older_file_does_not_become_current(spark, tmp_path, register):
    raw = tmp_path / "raw"
    read = ing.delimited_reader(spark, str(raw))
    newer = snapshot(raw, "2026-08-17", "abc")
    ing.ingest_snapshots(register, [newer], read, minimum=1)
    older = snapshot(raw, "2026-08-01", "ab")
    assert ing.ingest_snapshots(register, [newer, older], read) == [1, 2]
    assert register.latest().label == "2026-08-17"
    assert register.latest().operation == "RESTORE"
    assert register.latest().path == register.commits()[0].path
    assert ing.ingest_snapshots(register, [newer, older], read) == []


def test_schema_may_widen_and_versions_compare(spark, tmp_path, register):
    raw = tmp_path / "raw"
    files = [snapshot(raw, "v1", "ab", 2), snapshot(raw, "v2", "abc", 3)]
    ing.ingest_snapshots(register, files, ing.delimited_reader(spark, str(raw)))
    register.restore(0)
    assert "col_03" not in register.read_version(0).columns
    assert "col_03" in register.read_version(1).columns
    got = register.compare_versions([0, 1, 2], {"n": F.count(F.lit(1)), "wide": F.count("col_03")}).collect()
    assert [tuple(r) for r in got] == [(0, 2, 0), (1, 3, 3), (2, 2, 0)]
    log = register.commit_log().orderBy("version").collect()
    assert [(r["version"], r["rows"], r["files_added"], r["files_removed"]) for r in log] == [
        (0, 2, 1, 0), (1, 3, 1, 1), (2, 2, 1, 1),
    ]
    assert len({r["content_hash"] for r in log}) == 2 and register.history() == {
        log[1]["content_hash"]: 1, log[2]["content_hash"]: 2,
    }


def test_same_content_is_not_written_again(spark, register):
    df = spark.range(5)
    assert register.write(df, "h1") and not register.write(df, "h1")
    assert register.write(spark.range(6), "h2") and register.write(df, "h1")
    assert [c.content_hash for c in register.commits()] == ["h1", "h2", "h1"]


def test_a_failed_write_leaves_no_version(spark, register):
    register.write(spark.range(5), "h1")
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        register.write(broken, "h2")
    assert register.current_version() == 0
    assert register.write(spark.range(7), "h3") and register.current().count() == 7


def test_two_writers_cannot_claim_one_version(spark, tmp_path):
    path, outcome = f"{tmp_path}/t", []
    ready = threading.Barrier(2)

    class Slow(SnapshotTable):
        def _commit(self, commit):
            ready.wait()
            super()._commit(commit)

    def work(n):
        try:
            outcome.append(Slow(spark, path).write(spark.range(n), f"h{n}"))
        except ConcurrentCommit:
            outcome.append("lost")

    writers = [threading.Thread(target=work, args=(n,)) for n in (3, 4)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert sorted(map(str, outcome)) == ["True", "lost"]
    table = SnapshotTable(spark, path)
    assert table.latest().rows == table.current().count()


def test_missing_version(register, spark):
    register.write(spark.range(1), "h")
    with pytest.raises(ValueError, match="no such version"):
        register.read_version(3)


def test_stream_lands_arrivals_once_and_in_order(spark, tmp_path, register):
    raw, checkpoint = tmp_path / "raw", scratch(spark, "checkpoint")
    read = ing.delimited_reader(spark, str(raw))

    def run():
        stream_ingest(spark, str(raw), register, checkpoint, read).awaitTermination()
        return [(c.version, c.label) for c in register.commits()]

    snapshot(raw, "2026-08-17", "abc")
    assert run() == [(0, "2026-08-17")]
    assert run() == [(0, "2026-08-17")]
    snapshot(raw, "2026-08-01", "ab")
    assert run()[1:] == [(1, "2026-08-01"), (2, "2026-08-17")]
    snapshot(raw, "2026-09-01", "abcd")
    assert run()[-1] == (3, "2026-09-01")
    assert register.current().count() == 4


def test_folder_lands_only_when_it_is_complete(spark, tmp_path, register):
    raw, checkpoint = tmp_path / "raw", f"{tmp_path}/checkpoint"
    (raw / "2026-08-01").mkdir(parents=True)
    read = ing.delimited_reader(spark, str(raw))

    def run():
        stream_ingest(spark, str(raw), register, checkpoint, read, folders=True).awaitTermination()
        return [(c.version, c.label, c.rows) for c in register.commits()]

    (raw / "2026-08-01" / "part-1.csv").write_text("1;a\n")
    assert run() == []
    (raw / "2026-08-01" / "part-2.csv").write_text("2;b\n")
    assert run() == []
    (raw / "2026-08-01.complete").write_text("yes")
    assert run() == [(0, "2026-08-01", 2)]
    assert run() == [(0, "2026-08-01", 2)]


def test_replayed_stream_batch_is_a_no_op(spark, tmp_path, register):
    raw = tmp_path / "raw"
    snapshot(raw, "a", "ab")
    read = ing.delimited_reader(spark, str(raw))
    for _ in range(2):  # a new checkpoint makes the stream deliver everything again
        stream_ingest(spark, str(raw), register, scratch(spark, "checkpoint"), read).awaitTermination()
    assert len(register.commits()) == 1


def test_layer_is_replaced_whole(spark, tmp_path):
    write_layer(spark.range(5), str(tmp_path), "t")
    write_layer(spark.range(3), str(tmp_path), "t")
    assert read_layer(spark, str(tmp_path), "t").count() == 3
    write_layer(spark.range(4), str(tmp_path), "t")
    kept = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("rows-")]
    assert len(kept) == 2 and read_layer(spark, str(tmp_path), "t").count() == 4
    write_layer(spark.range(3), str(tmp_path), "t")
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        write_layer(broken, str(tmp_path), "t")
    assert read_layer(spark, str(tmp_path), "t").count() == 3
