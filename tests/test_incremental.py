import random

import pytest
from pyspark.sql import functions as F

from sediment.operators import quality as q
from sediment.operators.incremental import SuiteStates

def suite():
    return [
        q.expect_not_null("a", "k"),
        q.expect_unique("a", "k"),
        q.expect_grain("a", ["k", "m"]),
        q.expect_fk("a", "ref", "b", "id"),
        q.expect_non_negative("a", ["m"]),
        q.expect_count("a", 45),
        q.expect_unique("b", "id"),
        q.expect_values("b", {"id": "3"}),
    ]


A, B = "k long, m int, ref string", "id string"


def key(df):
    return sorted(tuple(r) for r in df.select("table", "column", "kind", "failures", "status").collect())


@pytest.fixture
def parts(spark, tmp_path):
    """Files of both tables: keys repeat across files, one file of each has no rows."""
    rng, files = random.Random(4), {"a": [], "b": []}
    for i in range(4):
        rows = [(rng.choice([None, 1, 2, 3, rng.randrange(10**9)]), rng.randrange(-1, 4), rng.choice([None, "x", "y", "ü+%20"])) for _ in range(15 if i else 0)]
        for name, data, schema in (("a", rows, A), ("b", [(rng.choice(["x", "3", "ü+%20"]),)] * (i % 2), B)):
            path = f"{tmp_path}/{name} é+%41/{i}"
            spark.createDataFrame(data, schema).coalesce(1).write.parquet(path)
            files[name] += [str(p) for p in (tmp_path / f"{name} é+%41" / str(i)).glob("*.parquet")]
    return files


def test_states_give_what_a_full_run_gives(spark, tmp_path, parts):
    read = []

    def reader(paths):
        read.extend(paths)
        return spark.read.parquet(*paths)

    full = lambda files: key(q.run_suite({t: spark.read.parquet(*f) for t, f in files.items()}, suite()))
    states = SuiteStates(spark, f"{tmp_path}/states", suite(), reader)
    for upto in (2, 3, 4):
        files = {t: f[:upto] for t, f in parts.items()}
        before = len(read)
        added = states.add(files)
        assert sorted(sum(added.values(), [])) == sorted(read[before:])
        assert len(read) - before == (4 if upto == 2 else 2)  # only what is new is read
        assert key(states.results(files)) == full(files)
    assert {r[4] for r in full(parts)} == {"pass", "fail"}
    fewer = {t: f[1:3] for t, f in parts.items()}  # files that are gone do not count
    assert key(states.results(fewer)) == full(fewer)
    again = SuiteStates(spark, f"{tmp_path}/states", suite(), reader)
    before = len(read)
    assert again.add(parts) == {"a": [], "b": []} and key(again.results(parts)) == full(parts) and len(read) == before


def test_changed_expectations_and_missing_states(spark, tmp_path, parts):
    states = SuiteStates(spark, f"{tmp_path}/states", suite())
    with pytest.raises(ValueError, match="no state of"):
        states.results(parts)
    states.add(parts)
    with pytest.raises(ValueError, match="no files of table b"):
        states.results({"a": parts["a"]})
    other = SuiteStates(spark, f"{tmp_path}/states", [q.expect_in("a", "m", [1]), *suite()])
    assert len(other.add(parts)["a"]) == 4
    wrong = other.results(parts).filter(F.col("kind") == "accepted_values").first()
    assert wrong.failures == spark.read.parquet(*parts["a"]).filter("m <> 1").count()
