import csv
import io
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sediment.sources import delimited as d
from sediment.sources import profile as pr
from sediment.sources import provenance as pv
from sediment.sources.documents import read_document_raw

PIECES = ["a", '"', ";", "\n", '"";', "x y", "\n", '"q";', '""', "é", "\n\n", ";;", '"a\nb;""c"";"', ",", "\r\n"]


@pytest.fixture
def blocks(spark):
    """Set the size of file blocks for one test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_size(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_size
    for n, v in before.items():
        spark.conf.set(n, v)


def by_csv_module(path):
    with open(path, encoding="utf-8-sig", newline="") as f:
        return list(csv.reader(f, delimiter=";"))


def by_spark(spark, path, **options):
    got = d.read_records(spark, str(path), ";", **options).orderBy("_record").collect()
    assert [r["_record"] for r in got] == list(range(1, len(got) + 1))
    return [list(r["fields"]) for r in got]


def written(rng, rows, end):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";", lineterminator=end)
    for _ in range(rows):
        cells = rng.randint(1, 4)
        writer.writerow(
            ["".join(rng.choices(["a", "b;", '"', "\n", "z", "é", " ", "\r\n"], k=rng.randint(0, 9))) for _ in range(cells)]
        )
    return out.getvalue()


@pytest.mark.parametrize("seed", range(4))
def test_records_match_the_csv_module_at_any_block_size(spark, tmp_path, blocks, seed):
    rng = random.Random(seed)
    text = written(rng, 40, "\r\n" if seed % 2 else "\n") if seed < 2 else "".join(rng.choices(PIECES, k=150))
    path = tmp_path / "a file.csv"
    path.write_bytes(text.encode("utf-8-sig" if seed % 2 else "utf-8"))
    for size in (1 << 27, 61):
        blocks(size)
        assert by_spark(spark, path, multiline=True) == by_csv_module(path)
        assert by_spark(spark, path) == by_csv_module(path)


def test_plain_lines_keep_blank_records_over_blocks(spark, tmp_path, blocks):
    path = tmp_path / "plain.csv"
    path.write_text("title;;\n\n;;\nid;name\n" + "".join(f"{i};n{i}\n" for i in range(200)), encoding="utf-8")
    blocks(50)
    assert by_spark(spark, path, multiline=False) == by_csv_module(path)


def test_line_plan_refuses_to_split_a_record(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('1;"a\nb"\n', encoding="utf-8")
    with pytest.raises(Exception, match="multiline=True"):
        by_spark(spark, path, multiline=False)


def test_unclosed_quote_over_the_limit_stops_the_job(spark, tmp_path, blocks):
    path = tmp_path / "open.csv"
    path.write_text('1;"a\n' + "x\n" * 200, encoding="utf-8")
    blocks(64)
    with pytest.raises(Exception, match="quote not closed"):
        d.read_records(spark, str(path), multiline=True, record_limit=20).collect()


def landing(tmp_path):
    folder = tmp_path / "raw" / "sub dir"
    folder.mkdir(parents=True)
    path = folder / "2026-08-17.csv"
    path.write_bytes('Title;;\n\n;;\nKey;Name ;\n1;"say ""x"""\n2;b;c;d\n;;\n3;z\n'.encode("utf-8-sig"))
    return tmp_path / "raw", path


def test_landing_pads_and_keeps_every_record(spark, tmp_path):
    root, path = landing(tmp_path)
    raw = d.read_delimited_raw(spark, str(path), "2026-08-17", root=str(root))
    assert raw.columns == [
        "col_01", "col_02", "col_03", "col_04", "_linha_origem", "_arquivo_origem", "_versao_fonte", "_ingerido_em",
        "_hash_arquivo",
    ]
    assert {t for _, t in raw.dtypes} == {"string"}
    got = raw.orderBy(F.col("_linha_origem").cast("int")).collect()
    assert [tuple(r)[:5] for r in got] == [
        ("Title", "", "", "", "1"), ("", "", "", "", "2"), ("", "", "", "", "3"), ("Key", "Name ", "", "", "4"),
        ("1", 'say "x"', "", "", "5"), ("2", "b", "c", "d", "6"), ("", "", "", "", "7"), ("3", "z", "", "", "8"),
    ]
    assert {r["_hash_arquivo"] for r in got} == {pv.source_hash(spark, str(path))}
    assert {r["_arquivo_origem"] for r in got} == {"sub dir/2026-08-17.csv"}
    assert len({r["_ingerido_em"] for r in got}) == 1


def test_promote_header_drops_structure_and_blank_rows(spark, tmp_path):
    root, path = landing(tmp_path)
    raw = d.read_delimited_raw(spark, str(path), "v", root=str(root))
    named = d.promote_header(raw, 4)
    assert named.columns == ["Key", "Name", "col_03", "col_04"]
    assert sorted(map(tuple, named.collect())) == [("1", 'say "x"', "", ""), ("2", "b", "c", "d"), ("3", "z", "", "")]


def test_promote_header_keeps_unnamed_columns_and_refuses_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;;z\n;only;\n", encoding="utf-8")
    raw = d.read_delimited_raw(spark, str(tmp_path), "v")
    assert [tuple(r) for r in d.promote_header(raw, 1).collect()] == [("", "only", "")]
    (tmp_path / "b.csv").write_text("z;;id\n1;2;3\n", encoding="utf-8")
    with pytest.raises(ValueError, match="differ"):
        d.promote_header(d.read_delimited_raw(spark, str(tmp_path), "v"), 1)


@pytest.mark.parametrize("multiline", [True, False])
def test_a_record_wider_than_asked_stops_the_job(spark, tmp_path, multiline):
    (tmp_path / "a.csv").write_text("1;2;3;4;5\n1;2\n", encoding="utf-8")
    read = lambda width: d.read_delimited_raw(spark, str(tmp_path), "v", multiline=multiline, width=width)
    assert read(6).filter("col_05 = '5' and col_06 = ''").count() == 1
    with pytest.raises(Exception, match="more than 3 fields"):
        read(3).collect()


def test_record_limit_acts_alike_at_any_block_size(spark, tmp_path, blocks):
    path = tmp_path / "long.csv"
    path.write_text("1;short\n2;\"" + "line of text\n" * 300 + "\"\n3;after\n", encoding="utf-8")
    for size in (1 << 27, 500, 64):
        blocks(size)
        assert len(by_spark(spark, path, multiline=True, record_limit=4000)[1][1]) == 3900
        with pytest.raises(Exception, match="quote not closed"):
            d.read_records(spark, str(path), multiline=True, record_limit=2000).collect()


def test_exclude_keys_keeps_structure(spark):
    df = spark.createDataFrame([("1",), (" 2 ",), ("",), (None,), ("Key",)], "k string")
    assert sorted(str(r[0]) for r in d.exclude_keys(df, "k", ["2"]).collect()) == ["", "1", "Key", "None"]


def test_hashes_and_marks(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text(f"{name}\nx\n", encoding="utf-8")
    got = {r["path"].rsplit("/", 1)[-1]: r["hash"] for r in pv.file_hashes(spark, str(tmp_path)).collect()}
    assert len(set(got.values())) == 2 and all(m.startswith(pv.HASH_NAME) for m in got.values())
    assert pv.source_hash(spark, str(tmp_path / "a.csv")) == got["a.csv"]
    whole = pv.source_hash(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("b.csv\ny\n", encoding="utf-8")
    assert pv.source_hash(spark, str(tmp_path)) != whole


def test_file_hash_follows_content_and_not_blocks(spark, tmp_path, blocks):
    text = "".join(f"{i};näme {i % 7}\r\n" for i in range(500))
    variants = {
        "same": text.encode(), "bom": text.encode("utf-8-sig"), "cut": text.encode()[:-1], "lf": text.replace("\r", "").encode(),
        "swap": text.replace("1;", "X;", 1).replace("2;", "1;", 1).replace("X;", "2;", 1).encode(), "twice": text.encode() * 2,
        "moved": "".join(reversed(text.splitlines(keepends=True))).encode(), "bytes": b"\xff\xfe\n" + text.encode(),
    }
    seen = {}
    for size in (1 << 27, 1000, 77):
        blocks(size)
        for name, data in variants.items():
            (tmp_path / name).write_bytes(data)
            mark = pv.source_hash(spark, str(tmp_path / name))
            assert seen.setdefault(name, mark) == mark
    assert len(set(seen.values())) == len(variants)


def test_folder_hash_does_not_see_part_names(spark, tmp_path):
    for folder, names in (("v1", ("p-1", "p-2")), ("v2", ("x", "a"))):
        (tmp_path / folder).mkdir()
        for name, text in zip(names, ("1;a\n", "2;b\n")):
            (tmp_path / folder / name).write_text(text)
    marks = pv.source_hashes(spark, [str(tmp_path / "v1"), str(tmp_path / "v2")])
    assert len(set(marks.values())) == 1


def test_frame_fingerprint_ignores_order_and_layout(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("m"))
    mark = pv.frame_fingerprint(df)
    assert mark == pv.frame_fingerprint(df.orderBy(F.col("id").desc()).repartition(7).select("m", "id"))
    assert mark != pv.frame_fingerprint(df.filter("id <> 3"))
    assert mark != pv.frame_fingerprint(df.union(df.filter("id = 3")))


def test_inventory_counts_lines_of_csv_only(spark, tmp_path):
    root, _ = landing(tmp_path)
    (root / "doc.json").write_text("{}\n{}\n", encoding="utf-8")
    (root / "empty.csv").write_text("", encoding="utf-8")
    (root / "b.Csv").write_text("1\n2\n", encoding="utf-8")
    got = {r["file"]: (r["format"], r["bytes"] > 0, r["physical_lines"]) for r in d.file_inventory(spark, str(root)).collect()}
    assert got == {
        "doc.json": ("JSON", True, None), "sub dir/2026-08-17.csv": ("CSV", True, 8), "empty.csv": ("CSV", False, 0),
        "b.Csv": ("CSV", True, 2),
    }


def test_document_text_is_unchanged(spark, tmp_path):
    text = '{\n  "a": "é",\r\n "b": [1]\n}\n'
    (tmp_path / "d.json").write_bytes(text.encode("utf-8"))
    row = read_document_raw(spark, str(tmp_path / "d.json"), "v1", root=str(tmp_path)).first()
    assert row["conteudo_json"] == text
    assert (row["_arquivo_origem"], row["_versao_fonte"]) == ("d.json", "v1")
    assert row["_hash_arquivo"] == pv.source_hash(spark, str(tmp_path / "d.json"))


def test_separator_is_checked():
    with pytest.raises(ValueError):
        d._class('"')


def test_fingerprint_sees_where_a_value_is_missing(spark):
    a = spark.createDataFrame([(1, None, [1, None])], "a int, b int, c array<int>")
    b = spark.createDataFrame([(None, 1, [1, None])], "a int, b int, c array<int>")
    c = spark.createDataFrame([(1, None, [None, 1])], "a int, b int, c array<int>")
    assert len({pv.frame_fingerprint(x) for x in (a, b, c)}) == 3


def test_block_count_follows_the_block_size(spark, tmp_path, blocks):
    (tmp_path / "a.csv").write_text("x" * 100, encoding="utf-8")
    (tmp_path / "b.csv").write_text("x" * 10, encoding="utf-8")
    blocks(30)
    actual = d.read_lines(spark, str(tmp_path)).select("_file", "_block").distinct().count()
    assert actual <= d.block_count(spark, str(tmp_path)) <= 3 + 2 + spark.sparkContext.defaultParallelism


def test_records_over_lines_scan_twice_and_shuffle_the_text_once(spark, tmp_path, blocks):
    """Once for the profile, which shuffles no line, and once for the records, with hash and width from the profile."""
    path = tmp_path / "t.csv"
    path.write_text('1;"a\nb"\n2;c\n' * 200, encoding="utf-8")
    blocks(500)
    first = d.lines_with_effect(spark, str(path)).mapInArrow(lambda batches: batches, d.lines_with_effect(spark, str(path)).schema)
    assert first._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
    known = d.profile(spark, str(path))
    df = d.read_delimited_raw(spark, str(path), "v", known=known)
    assert df.count() == 400 and known.facts[1:] == (True, 2)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan text") == 1
    assert {r._hash_arquivo for r in df.collect()} == {pv.source_hash(spark, str(path))}


@pytest.mark.parametrize("seed", range(3))
def test_spans_compose(seed):
    """Any cut of lines gives the sums of the whole, and those are what a line-by-line count gives."""
    rng = random.Random(seed)
    n = 60
    c, o = np.array([rng.random() < 0.3 for _ in range(n)]).astype(int), np.array([rng.random() < 0.7 for _ in range(n)]).astype(int)
    s0, s1, size = (np.array([rng.randrange(9) for _ in range(n)]) for _ in range(3))
    for entry in (0, 1):
        whole = pr.span_of((c, o), (s0, s1), size, entry)
        state, sums, front = entry, [], [0, 0]
        for k in range(n):
            if state == 0:
                sums.append(0)
            if sums:
                sums[-1] += s1[k] if state else s0[k]
            else:
                front = [front[0] + size[k], front[1] + s1[k]]
            state = o[k] if state else c[k]
        want = pr.Span(state, len(sums), *front, sums[-1] if sums else 0, max(sums[:-1], default=-1) + 1)
        assert whole == want
        for _ in range(20):
            cuts = [0, *sorted(rng.sample(range(1, n), 3)), n]
            joined = pr.Span(entry, 0, 0, 0, 0, 0)
            for x, y in zip(cuts, cuts[1:]):
                joined = joined.then(pr.span_of((c[x:y], o[x:y]), (s0[x:y], s1[x:y]), size[x:y], joined.exit))
            assert joined == want


def test_widest_record_over_blocks(spark, tmp_path, blocks):
    path = tmp_path / "w.csv"
    path.write_text('1;2\n' * 30 + '1;"' + "x;\n" * 60 + '";3;"' + "y\n" * 40 + '";5\n' + "1\n" * 30, encoding="utf-8")
    for size in (1 << 27, 37):
        blocks(size)
        assert d.profile(spark, str(path)).facts[1:] == (True, 5)


def lines_of_one_block(texts, c, o):
    names = ("_file", "_block", "_text", "_c", "_o", "_entry", "_offset", "_added")
    n = len(texts)
    return pa.RecordBatch.from_pydict(dict(zip(names, (["f"] * n, [0] * n, texts, c, o, [0] * n, [0] * n, [0] * n), strict=True)))


def test_records_are_put_together_a_few_megabytes_at_a_time():
    """Python holds no copy of a whole batch of lines, and no batch of records is as large as that of the lines."""
    batch = lines_of_one_block(["x" * 10_000] * 4000, [False] * 4000, [True] * 4000)
    run, _ = pr.gather(1 << 26)
    tracemalloc.start()
    rows = sizes = 0
    for out in run(iter([batch])):
        rows, sizes = rows + out.num_rows, max(sizes, out.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4000
    assert peak < 4_000_000 and sizes < 6_000_000  # of 40 million


@pytest.mark.parametrize("seed", range(3))
def test_records_do_not_depend_on_the_lines_put_together_at_a_time(monkeypatch, seed):
    rng = random.Random(seed)
    n = 40
    lines = ["".join(rng.choices(["a", "é", "日", "\r"], k=rng.randrange(6))) for _ in range(n)]
    c, o = [rng.random() < 0.4 for _ in range(n)], [rng.random() < 0.6 for _ in range(n)]
    want, is_open = [], False
    for text, closed, opened in zip(lines, c, o, strict=True):
        leaves = opened if is_open else closed
        if not is_open:
            want.append([])
        want[-1].append(text if leaves else text.removesuffix("\r"))
        is_open = leaves
    for chars in (1, 7, 1 << 20):
        monkeypatch.setattr(pr, "GATHERED", chars)
        for size in (1, 9, n):
            parts = [lines_of_one_block(lines[i : i + size], c[i : i + size], o[i : i + size]) for i in range(0, n, size)]
            got = [(r["_record"], r["_piece"]) for out in pr.gather(1000)[0](iter(parts)) for r in out.to_pylist()]
            assert got == [(i, "\n".join(p)) for i, p in enumerate(want, 1)]
