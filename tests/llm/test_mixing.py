import hashlib
import random
from fractions import Fraction

import pytest

from sediment.llm.mixing import mix

LEVELS = ["a", "b", "c"]


def share_out(budget, children):
    """children: name -> (capacity, weight); plain water filling in whole tokens."""
    quota, open_ = {}, dict(children)
    left = budget
    while open_:
        w = sum(v[1] for v in open_.values())
        full = {k for k, v in open_.items() if Fraction(left * v[1], w) >= v[0]}
        if not full:
            break
        for k in full:
            quota[k] = open_.pop(k)[0]
        left -= sum(quota[k] for k in full)
    if open_:
        w = sum(v[1] for v in open_.values())
        down = {k: left * v[1] // w for k, v in open_.items()}
        spare = left - sum(down.values())
        for k in sorted(open_, key=lambda k: (-(left * open_[k][1] % w), k))[:spare]:
            down[k] += 1
        quota |= down
    return quota


def plain_mix(rows, weights, total, epochs, seed):
    """(id, epoch, prefix tokens) of all that is taken."""
    leaves = {}
    for i, path, n in rows:
        if n and all(weights.get(path[:k], 1) for k in (1, 2, 3)):
            leaves.setdefault(path, []).append((i, n))
    size = {p: sum(n for _, n in v) for p, v in leaves.items()}
    budget = {(): min(sum(size.values()) if total is None else total, epochs * sum(size.values()))}
    for depth in range(3):
        after = {}
        for parent, b in budget.items():
            children = {}
            for p in leaves:
                if p[:depth] == parent:
                    cap = children.get(p[: depth + 1], (0, 0))[0] + epochs * size[p]
                    children[p[: depth + 1]] = (cap, weights.get(p[: depth + 1], 1))
            after |= share_out(b, children)
        budget = after
    out = []
    for p, docs in leaves.items():
        full, rest = divmod(budget[p], size[p])
        out += [(i, e, n) for e in range(full) for i, n in docs]
        place = lambda i: (int(hashlib.md5(f"{seed}:{full}:{'' if i is None else i}".encode()).hexdigest()[:15], 16), str(i))  # noqa: B023, E731
        for i, n in sorted(docs, key=lambda d: (place(d[0])[0], '' if d[0] is None else str(d[0]), d[0] is not None, d[1])):
            if rest > 0:
                out.append((i, full, min(n, rest)))
            rest -= n
    return sorted(out, key=str)


@pytest.mark.parametrize("total,epochs", [(None, 4), (5000, 2), (10**9, 3), (1, 4), (0, 4)])
def test_mix_is_what_plain_loops_give(spark, total, epochs, monkeypatch):
    monkeypatch.setattr("sediment.llm.mixing.ROWS_PER_BUCKET", 4)
    rng = random.Random(6)
    rows = [(i, rng.choice("pq") if i % 3 else "p", rng.choice("xyz"), "big" if i % 3 == 0 else f"s{rng.randrange(5)}", rng.choice((0, 1, 5, 40, 300))) for i in range(400)]
    rows += [(900, None, "x", None, 7), (901, "p", "x", "big", None), (None, "q", "x", "s1", 3)]
    weights = {("p",): 5, ("p", "x"): 3, ("p", "x", "big"): 7, ("q", "y"): 2}
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc long, a string, b string, c string, n long, node_0 int").repartition(5)
    mixed = mix(df, LEVELS, "doc", "n", weights, total, epochs, seed=3)
    assert mixed.columns == [*df.columns, "epoch", "prefix_tokens"]
    got = sorted(((r.doc, r.epoch, r.prefix_tokens) for r in mixed.collect()), key=str)
    assert got == plain_mix([(r[0], tuple(x or "" for x in r[1:4]), r[4] or 0) for r in rows], weights, total, epochs, 3)
    if total:
        tokens = sum(r[4] or 0 for r in rows)
        assert sum(t for *_, t in got) == min(total, epochs * tokens)


@pytest.mark.parametrize("total", [12, 777, 5003, None])
def test_quotas_hold_for_repeated_and_missing_ids(spark, total, monkeypatch):
    monkeypatch.setattr("sediment.llm.mixing.ROWS_PER_BUCKET", 4)
    rng = random.Random(7)
    rows = [(rng.choice((None, None, 1, 2, 3)), "p", rng.choice("xy"), "s", rng.choice((10, 10, 10, 7, 0))) for _ in range(300)]
    rows += [(5, "p", "x", "s", 10)] * 150 + [(6, "q", "z", "s", 4)] * 40 + [(6, "none", "x", "s", 50)] * 9
    weights = {("p", "x"): 3, ("none",): 0}
    df = spark.createDataFrame(rows, "doc long, a string, b string, c string, n long").repartition(7)
    got = sorted(((r.doc, r.epoch, r.prefix_tokens) for r in mix(df, LEVELS, "doc", "n", weights, total, 3, seed=5).collect()), key=str)
    assert got == plain_mix([(r[0], tuple(r[1:4]), r[4]) for r in rows], weights, total, 3, 5)
    tokens = sum(r[4] for r in rows if r[1] != "none")
    assert sum(t for *_, t in got) == min(tokens if total is None else total, 3 * tokens)


def test_weights_of_zero_and_less(spark):
    df = spark.createDataFrame([(1, "p", 10), (2, "q", 10)], "doc long, a string, n long")
    assert [r.doc for r in mix(df, ["a"], "doc", "n", {("p",): 0}, total=30, max_epochs=1).collect()] == [2]
    assert mix(df, ["a"], "doc", "n", {("p",): 0, ("q",): 0}).count() == 0
    with pytest.raises(ValueError, match="negative"):
        mix(df, ["a"], "doc", "n", {("p",): -1})


def test_shortage_stays_among_siblings(spark):
    rows = [(1, "p", "x", 10), (2, "p", "y", 1000), (3, "q", "x", 1000)]
    df = spark.createDataFrame(rows, "doc long, a string, b string, n long")
    got = {r.doc: r.prefix_tokens for r in mix(df, ["a", "b"], "doc", "n", {}, total=400, max_epochs=1).collect()}
    assert got == {1: 10, 2: 190, 3: 200}
