"""Files that checks write for the job: their number and places follow the rows."""

import math

import pytest
from pyspark.sql import functions as F

from checks import load
from sediment.sources.files import children, walk

load()
from checks import portfolio, quality  # noqa: E402


@pytest.fixture
def settings(spark):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "32")
    spark.conf.set(names[1], "64k")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_halves_have_files_by_their_bytes_and_every_row_once(spark, tmp_path, settings):
    df = spark.range(60_000).select("id", F.md5(F.col("id").cast("string")).alias("word"))
    halves = quality.write_halves(df, f"{tmp_path}/rows")
    rows = [spark.read.parquet(*files).count() for files in halves]
    assert sum(rows) == 60_000 and min(rows) > 25_000
    both = spark.read.parquet(*sum(halves, []))
    assert both.columns == df.columns and both.exceptAll(df).count() == 0
    per_file = both.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file < 60_000 / 8  # four files, whatever the bytes, would hold 15,000 rows each


def test_one_row_still_has_its_file(spark, tmp_path):
    halves = quality.write_halves(spark.createDataFrame([(1, None)], "k long, v string"), f"{tmp_path}/rows")
    assert sorted(map(len, halves)) == [0, 1]


def test_no_rows_still_have_a_file(spark, tmp_path):
    halves = quality.write_halves(spark.createDataFrame([], "k long, v string"), f"{tmp_path}/rows")
    assert len(sum(halves, [])) >= 1
    assert spark.read.parquet(*sum(halves, [])).count() == 0


def test_files_of_the_job_follow_the_rows(spark, tmp_path, monkeypatch):
    """Documents of surveys share one folder, so listing them takes no task per document; parts are cut by rows."""
    n = 11
    tables = {
        "region": ([(0, "R")], "r_regionkey long, r_name string"),
        "nation": ([(0, 0, "N")], "n_nationkey long, n_regionkey long, n_name string"),
        "customer": ([(i, f"c{i}", 0, 1.0, "BUILDING") for i in range(n)], "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "orders": ([(i, "F", 10.5, p) for i in range(n) for p in ("1-URGENT", "5-LOW")], "o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(portfolio, "SURVEYS_PER_DOCUMENT", 2)
    monkeypatch.setattr(portfolio, "ROWS_PER_PART", 2)
    _, registers, measured, surveyed = portfolio.job_files(spark, str(tmp_path), clean=False)
    documents = [path for path, size in walk(spark, surveyed) if size]
    assert len(documents) == math.ceil(n / 2)
    assert {path.rsplit("/", 1)[0].split(":", 1)[-1].lstrip("/") for path in documents} == {surveyed.split(":", 1)[-1].lstrip("/")}
    texts = spark.read.text(surveyed, wholetext=True)
    one = texts.select(F.explode(F.from_json("value", "vistorias array<struct<id_predio:string>>")["vistorias"]).alias("s"))
    assert sorted(int(r[0]) for r in one.select("s.id_predio").collect()) == list(range(n))
    for path in (*registers, measured):
        folders = [c for c in children(spark, path) if "part=" in c]
        assert len(folders) == math.ceil(n / 2)
        heads = spark.read.text(folders).where("value like 'Cadastro%'").count()
        assert heads == len(folders)
