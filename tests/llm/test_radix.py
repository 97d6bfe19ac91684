"""Exact duplicates against a dictionary of whole texts."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sediment.llm.queries import QUERIES
from sediment.llm.radix import exact_duplicates

LOWER = {c: c + 32 for c in range(65, 91)}


def classes(rows):
    """Sorted (id, keep_id, size) of each row, and the number of rows that stay in each class."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(LOWER)].append(i)
    return sorted(
        ((i, max((x for x in ids if x is not None), default=None), len(ids)) for ids in groups.values() for i in ids), key=str
    ), len(groups)


@pytest.mark.parametrize("widths", [(1,), (2, 3), (128, 2048)])
def test_classes_are_those_of_equal_texts(spark, widths):
    rng = random.Random(len(widths))
    texts = ["", None, "a", "A", "ab", "aB", "abc", "É", "é", "x" * 50, "x" * 51, "x" * 50 + "y", "日本", "日本語", "\x00", "a\x00"]
    texts += ["".join(rng.choice("abAB") for _ in range(rng.randrange(7))) for _ in range(60)]
    rows = [(rng.randrange(40), t) for t in texts] + [(None, "a"), (None, "only null"), (None, "only null"), (5, "twice"), (5, "twice")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"group": F.lit(1), "rest": F.lit("x"), "row": F.lit(2)})
    found = exact_duplicates(frame, carry=["row", "group"], widths=widths).collect()
    want, n = classes(rows)
    assert sorted(((r.id, r.keep_id, r.group_size) for r in found), key=str) == want
    stays = [r for r in found if r.kept]
    assert len(stays) == n and all(r.id == r.keep_id for r in stays) and {(r.row, r.group) for r in found} == {(2, 1)}


def test_a_large_group_and_a_hot_prefix(spark):
    rows = [(k, "same beginning " * 20 + ("copy" if k % 3 else str(k))) for k in range(900)]
    found = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), widths=(8, 64)).collect()
    want, n = classes(rows)
    assert sorted(((r.id, r.keep_id, r.group_size) for r in found), key=str) == want and sum(r.kept for r in found) == n


def test_query_on_awkward_rows(spark, tables, doc_rows):
    found = QUERIES["op12_exact_dedup"](spark, tables).collect()
    want, n = classes([(r[0], r[1]) for r in doc_rows])
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == want and sum(r.kept for r in found) == n
    digest = sorted(hashlib.sha256((r[1] or "").translate(LOWER).encode()).hexdigest() for r in doc_rows)
    assert sorted(r.text_sha256 for r in found) == digest
