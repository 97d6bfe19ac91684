import random
from statistics import median

import pytest

from sediment.operators import metrics


@pytest.mark.parametrize("bracket", [0.01, 0.0, 0.49])
def test_sketch_median_is_exact(spark, monkeypatch, bracket):
    """Also with bounds that leave the middle out: those groups are counted in full."""
    monkeypatch.setattr(metrics, "BRACKET", bracket)
    rng, rows = random.Random(11), []
    rows += [("wide", rng.gauss(0, 1e6)) for _ in range(6001)]
    rows += [("even", float(rng.randrange(10**6))) for _ in range(4000)]
    rows += [("ties", float(rng.choice((1, 1, 1, 2)))) for _ in range(3000)]
    rows += [("halves", v) for v in (1.0, 2.0) for _ in range(1500)]
    rows += [(None, 5.0), (None, 7.0), ("none", None), ("one", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, []).append(v)
    got = {r.g: r.m for r in metrics.group_median_by_sketch(df, ["g"], "v", "m").collect()}
    assert got == {g: median(v) for g, v in want.items()}


def test_sketch_median_of_nan_and_no_rows(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", nan), ("a", nan), ("b", 1.0), ("b", 2.0), ("b", nan)], "g string, v double")
    got = {r.g: str(r.m) for r in metrics.group_median_by_sketch(df, ["g"], "v", "m").collect()}
    assert got == {"a": "nan", "b": "2.0"}
    assert metrics.group_median_by_sketch(df.limit(0), ["g"], "v", "m").count() == 0
