"""Hard negatives and searches against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sediment.llm import negatives as ng
from sediment.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x int"


def make(rng, n, dims=8):
    centres = [[rng.gauss(0, 0.4) for _ in range(dims)] for _ in range(4)]
    out = []
    for k in range(n):
        c = rng.choice(centres)
        out.append((k, [np.float32(v + rng.gauss(0, 0.2)).item() for v in c], rng.randrange(3), "x", 1))
    return out


def awkward(rng):
    rows = make(rng, 230)
    rows[3] = (3, None, 1, "x", 1)
    rows[4] = (4, [0.5, None] + [0.1] * 6, 1, "x", 1)
    rows[5] = (5, [float("nan")] * 8, 1, "x", 1)
    rows[6] = (6, [float("inf")] * 8, 1, "x", 1)
    rows[8] = (8, rows[9][1], None, "x", 1)
    rows[10] = (None, rows[9][1], 1, "x", 1)
    rows[11] = (11, [], 1, "x", 1)
    rows[12] = (12, [0.25, -0.75], 2, "x", 1)
    rows[13] = rows[14]
    for k in range(20, 60):
        rows[k] = (k, rows[20][1], k % 3, "x", 1)  # one vector very often: ties and a crowded cell
    return rows


def brute(rows, relabel):
    used = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        vector = [math.floor(256 * c) for c in v] + [0] * (8 - len(v))
        used[(i, (label + 1) % 10 if relabel and i % 7 == 0 else label, tuple(vector))] = None
    used = list(used)
    out = []
    for a in used:
        if a[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r) for r in used if r is not a)
        for s, i, _ in [x for x in scored if x[2][1] == a[1]][:5]:
            fits = [(-t, j) for t, j, r in scored if r[1] != a[1] and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a[0], i, k + 1, j, -s, t) for k, (t, j) in enumerate(fits[:10])]
    return sorted(out)


@pytest.mark.parametrize("centres,first_rows,block_rows", [(2, 1, 7), (5, 20, 1024), (None, 4096, 1024)])
def test_mining_is_exact(spark, monkeypatch, centres, first_rows, block_rows):
    rows = awkward(random.Random(3))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    used = ng.integer_rows(frame, label=label)
    index = ng.build(used, centres=centres, block_rows=block_rows)
    search = ng.search
    monkeypatch.setattr(ng, "search", lambda *a: search(*a, first_rows=first_rows))
    found = ng.hard_negatives(used, F.col("id") % 100 == 0, index=index)
    assert sorted(map(tuple, found.collect())) == brute(rows, True)


def test_query_reads_its_table(spark, tmp_path):
    rows = awkward(random.Random(5))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op13_hard_negatives"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == brute(rows, True)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert QUERIES["op13_hard_negatives"](spark, f"{tmp_path}/none").collect() == []


def test_the_heap_yields_all_cells_by_falling_bounds():
    rng = np.random.default_rng(1)
    cells = ng.Cells((rng.normal(size=(5, 3)), rng.normal(size=(7, 3))), (rng.random(5), rng.random(7)), {}, 6, 100)
    query = rng.normal(size=6) * 10
    got = list(ng.cells_in_order(query, cells))
    assert len({(i, j) for _, i, j in got}) == 35 and all(x[0] >= y[0] for x, y in zip(got, got[1:]))
    for bound, i, j in got:
        row = np.concatenate([cells.centres[0][i], cells.centres[1][j]])
        far = np.concatenate([query[:3] / np.linalg.norm(query[:3]) * cells.radii[0][i], query[3:] / np.linalg.norm(query[3:]) * cells.radii[1][j]])
        assert bound >= query @ (row + far) - 1e-9


def test_scores_beyond_64_bits_stop_the_job(spark):
    frame = spark.createDataFrame([(0, [1e9, 1.0], 1, "", 0)], SCHEMA)
    with pytest.raises(ValueError, match="64 bits"):
        ng.build(ng.integer_rows(frame))
