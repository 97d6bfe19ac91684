import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sediment.llm import decontaminate as d


def text(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


def least_edits(probe, doc):
    """Sellers' algorithm, whole table."""
    row = np.zeros(len(doc) + 1, dtype=int)
    for i, c in enumerate(probe):
        new = np.empty_like(row)
        new[0] = i + 1
        for j, e in enumerate(doc):
            new[j + 1] = min(row[j] + (c != e), row[j + 1] + 1, new[j] + 1)
        row = new
    return row.min()


def edited(rng, s, k):
    s = list(s)
    for _ in range(k):
        at = rng.randrange(len(s))
        op = rng.randrange(3)
        s[at : at + (op != 2)] = [] if op == 0 else ["z"]
    return "".join(s)


@pytest.fixture(scope="module")
def items():
    rng = random.Random(4)
    return [(i, text(rng, rng.randint(8, 50))) for i in range(12)]


def test_finds_what_brute_force_finds(items):
    rng = random.Random(9)
    probes = d.Probes.build(items)
    planted = 0
    for n in range(40):
        item = rng.randrange(len(items))
        doc = text(rng, 30) + " " + edited(rng, items[item][1], rng.choice((0, 1, 3, 6, 12, 30))) + " " + text(rng, 20)
        compared = d.normalise(doc)[0].tolist()
        found = {r[0]: r for r in d.find(doc, probes)}
        for number in range(len(items)):
            edits = [least_edits(probes.codes[p].tolist(), compared) for p in range(len(probes.codes)) if probes.item[p] == number]
            limits = [int(probes.edits[p]) for p in range(len(probes.codes)) if probes.item[p] == number]
            hits = [e for e, k in zip(edits, limits, strict=True) if e <= k]
            assert (number in found) == bool(hits), (n, number)
            if hits:
                planted += 1
                assert found[number][3] == min(hits) and found[number][4] == len(hits)
    assert planted > 15


def test_case_punctuation_and_position_do_not_matter(items):
    probes = d.Probes.build(items)
    doc = "«" + items[3][1].upper().replace(" ", " -\n ") + "»"
    (item, start, end, edits, _), *rest = d.find(doc, probes)
    assert (item, edits, rest) == (3, 0, []) and doc[start] == items[3][1][0].upper() and end == len(doc) - 1


def test_long_texts_are_searched_in_overlapping_windows(items, monkeypatch):
    monkeypatch.setattr(d, "WINDOW", 100)
    probes = d.Probes.build(items)
    rng = random.Random(2)
    before = text(rng, 200)
    found = d.find(before + " " + items[7][1] + " " + text(rng, 100), probes)
    assert [(r[0], r[3]) for r in found] == [(7, 0)]
    assert found[0][1] == len(before) + 1 and found[0][4] == sum(i == 7 for i in probes.item)


def test_hashes_follow_the_grams():
    codes = np.array([ord(c) for c in "abcdefghijklmnopqrstuvwxyz" * 2], dtype=np.uint32)
    hashes = d.gram_hashes(codes)
    assert len(hashes) == len(codes) + 1 - d.Q
    assert (hashes[:10] == hashes[26:36]).all() and len(set(hashes[:26].tolist())) == 26


def test_blocks_of_the_benchmark_find_the_same(spark, items, monkeypatch):
    docs = spark.createDataFrame([(i, "so " + t + " it is") for i, t in items] + [(99, None), (98, "")], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (50, None), (51, "tiny"), items[0]], "item_id long, text string")
    got = lambda: sorted((r[0], x.item_id, x.edits) for r in docs.select("doc_id", d.leaks(F.col("text"), bench)).collect() for x in r[1])
    one = got()
    assert one == [(i, i, 0) for i, _ in items]
    monkeypatch.setattr(d, "BLOCK_CHARS", 300)
    assert got() == one


def test_items_with_changed_words_and_short_quotes_are_found():
    """5 and 10 % of the words replaced or left out, and verbatim quotes of 13 and 20 words; hardly any is lost."""
    rng = random.Random(21)
    items = [(i, text(rng, rng.randint(30, 50))) for i in range(60)]
    probes = d.Probes.build(items)
    around = text(rng, 40), text(rng, 40)
    is_found = lambda number, words: number in {r[0] for r in d.find(" ".join([around[0], *words, around[1]]), probes)}
    for rate, most in ((0.05, 1), (0.1, 4)):
        for leave_out in (False, True):
            lost = 0
            for number, item in items:
                words = item.split()
                for at in sorted(rng.sample(range(len(words)), max(1, round(rate * len(words)))), reverse=True):
                    words[at : at + 1] = [] if leave_out else [text(rng, 1)]
                lost += not is_found(number, words)
            assert lost <= most, (rate, leave_out, lost)
    for length in (13, 20):
        for number, item in items:
            words = item.split()
            at = rng.randrange(len(words) - length)
            assert is_found(number, words[at : at + length])
    assert not d.find(text(rng, 5000), probes)
