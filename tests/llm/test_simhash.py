import random

import numpy as np
import pytest

from sediment.llm import simhash
from sediment.llm.components import smallest_reachable
from tests.llm.test_queries import components, simhash as word_simhash


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def prints_near(rng, n, spread):
    """Fingerprints in a few clusters."""
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, spread)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("distance,limit", [(2, 64), (2, 2), (3, 2), (1, 2), (0, 2), (4, 100)])
def test_links_connect_what_brute_force_connects(spark, distance, limit):
    values = prints_near(random.Random(distance * 10 + limit), 120, 5)
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    edges = simhash.links(df, distance, pairs_up_to=limit)
    pairs = [tuple(r) for r in edges.collect()]
    assert all(((u ^ v) & (1 << 64) - 1).bit_count() <= distance and u != v for u, v in pairs)
    root = {r.u: r.root for r in smallest_reachable(edges).collect()}
    of = components([(signed(v), v) for v in values], distance)
    assert all(root.get(signed(v), signed(v)) == of[v] for v in values)


def test_any_two_within_the_distance_share_a_key():
    rng = random.Random(1)
    together = np.zeros((64, 64))
    values = [rng.getrandbits(64) for _ in range(500)]
    for v in values:
        bits = np.array([v >> b & 1 for b in range(64)])
        together += np.outer(bits, bits)
    for distance in (0, 1, 2, 3, 5):
        for rows in (500, 10**7):
            parts = simhash.plan(together * rows / 500, rows, distance)
            masks = [m & (1 << 64) - 1 for m in simhash.key_masks(parts)]
            for _ in range(60):
                a = rng.getrandbits(64)
                b = a
                for bit in rng.sample(range(64), distance):
                    b ^= 1 << bit
                assert any((a ^ b) & m == 0 for m in masks)


def test_correlated_bits_share_a_partition():
    rng = random.Random(2)
    together = np.zeros((64, 64))
    for _ in range(400):
        bits = [rng.getrandbits(1) for _ in range(64)]
        bits[40], bits[7] = bits[3], bits[3]
        together += np.outer(bits, bits)
    group = next(g for g in simhash.group_bits(together, 400, 3) if 3 in g)
    assert 40 in group and 7 in group


def test_more_rows_make_keys_longer():
    together = np.full((64, 64), 0.25) + np.eye(64) * 0.25
    few, many = simhash.plan(together * 1e5, 10**5, 2), simhash.plan(together * 1e12, 10**12, 2)
    bits = lambda parts: min(len(g) - t for g, t in parts)
    assert bits(many) > bits(few)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.u: r.root for r in smallest_reachable(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {1000 + i: 1000 for i in range(300)} | {7: 7, 8: 7}
    assert got == want


@pytest.mark.parametrize("rows", [0, 1])
@pytest.mark.parametrize("distance", [2, 6])
def test_plans_of_no_rows_have_few_keys(rows, distance):
    assert len(simhash.key_masks(simhash.plan(np.zeros((64, 64)), rows, distance))) <= 64


def test_one_of_each_component_stays(spark, docs, doc_rows):
    """Against brute force, with copies, repeated rows, rows of one id and null ids; all columns stay."""
    rng = random.Random(5)
    base = [f"t{rng.randrange(5000)}" for _ in range(900)]
    rows = list(doc_rows)
    for i in range(40):  # copies with one word changed; some are equal
        words = list(base)
        words[rng.randrange(3) * 60] = f"new{i % 25}"
        rows.append((5000 + i % 37, " ".join(words), "en", "src0", 0, None, None, None, None, None))
    rows += [(None, "no id for this row here", None, None, None, None, None, None, None, None)] * 2
    kept = simhash.one_of_each(spark.createDataFrame(rows, docs.schema).repartition(4))
    assert kept.columns == docs.columns
    prints = [(r[0], word_simhash(r[1], 3)) for r in rows]
    of = components([(p, p) for _, p in prints], 2)
    roots = {}
    for i, p in prints:
        roots.setdefault(of[p], []).append((i is None, i or 0, signed(p)))
    got = sorted((r.doc_id is None, r.doc_id or 0, signed(word_simhash(r.text, 3))) for r in kept.collect())
    assert got == sorted(min(members) for members in roots.values())
