import random
import statistics
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sediment.operators import documents as docs
from sediment.operators import metrics, star
from sediment.operators import quality as q
from sediment.operators import reduce as red
from sediment.operators.quarantine import KeyRule, label_rows, quarantine, split_valid


# --- quarantine ---------------------------------------------------------------------------------

RAW = [
    ("Title", "", "1"), ("", "", "2"), ("", "", "3"), ("ID", "Name", "4"), (" 7 ", "a", "5"), ("", "b", "6"),
    ("12\n", "c", "7"), ("99999999999", "d", "8"), ("9", "", "9"), ("", " ", "10"), ("x", "", "11"), (None, "e", "12"),
]


def test_quarantine_and_split(spark):
    df = spark.createDataFrame(RAW, "k string, n string, line string")
    rule = KeyRule("k", "n", "line")
    got = rows(quarantine(df, rule, {"line": "line"}, {"key": "k", "name": "n"}), "line")
    assert [r[:3] for r in got] == [(6, None, "b"), (7, "12\n", "c"), (12, None, "e")]
    good, bad, structural = split_valid(df.repartition(2), rule)
    assert (good.count(), bad.count(), structural.count()) == (3, 3, 6)


def test_close_gaps_option(spark):
    df = spark.createDataFrame(RAW, "k string, n string, line string")
    labelled = label_rows(df, KeyRule("k", "n", "line", close_gaps=True))
    kinds = dict(rows(labelled.groupBy("record_kind").count()))
    assert kinds == {"good": 2, "bad": 5, "structural": 5}


# --- joins and star -----------------------------------------------------------------------------


def test_attach_needs_the_exact_date_and_never_multiplies(spark):
    fact = spark.createDataFrame([(1, "d1"), (2, "d1"), (None, "d1")], "id int, day string")
    measure = spark.createDataFrame([(1, "d1", 5), (2, "d2", 6), (None, "d1", 7)], "id int, day string, v int")
    got = rows(star.attach(fact, measure, ["id", "day"], "has"), F.col("id").asc_nulls_last())
    assert got == [(1, "d1", 5, True), (2, "d1", None, False), (None, "d1", None, False)]


def test_dim_place_treats_missing_parts_as_a_value(spark):
    df = spark.createDataFrame([("A", None), ("A", None), (None, "A"), ("A", "B")], "c string, u string")
    dim = star.dim_place(df, "sk", {"city": "c", "state": "u"})
    assert dim.count() == 3 and dim.select("sk").distinct().count() == 3


def test_mart_has_each_column_once(spark):
    fact = spark.createDataFrame([("s1", 1, "x")], "sk string, id int, name string")
    dim = spark.createDataFrame([("s1", 1, "y"), ("s2", 2, "z")], "sk string, id int, name string")
    mart = star.build_mart(fact, [(dim, "sk")])
    assert sorted(mart.columns) == ["id", "name", "sk"] and rows(mart.select("name")) == [("y",)]


def test_join_on_hash_and_date(spark):
    fact = spark.createDataFrame([("A", None, "2026-08-17")], "c string, u string, d string").withColumn(
        "d", F.col("d").cast("date")
    )
    dim = star.dim_place(fact, "sk", {"city": "c", "state": "u"})
    assert star.join_on_hash(fact, dim, ["c", "u"], "sk").count() == 1
    joined = star.join_date(fact, star.dim_date(fact, "d"), "d")
    assert rows(joined.select("date_sk", "year", "month", "quarter")) == [(20260817, 2026, 8, 3)]


# --- reduction and documents --------------------------------------------------------------------


def test_strict_sum_cases(spark):
    data = [
        ("none", None, None, True), ("zero", "0", 0, True), ("both", "5", 5, True), ("both", "7", 7, True),
        ("bad", "5", 5, True), ("bad", "full", None, False), ("part", "5", 5, True), ("part", None, None, True),
    ]
    df = spark.createDataFrame(data, "k string, raw string, v bigint, ok boolean")
    got = df.groupBy("k").agg(red.strict_sum("v", "raw", F.col("ok")), red.any_declared("raw"))
    assert {r[0]: r[1:] for r in rows(got)} == {
        "none": (None, False), "zero": (0, True), "both": (12, True), "bad": (None, True), "part": (5, True),
    }


def test_fanout_of_a_hot_key_is_computed_not_produced(spark):
    hot = spark.range(300000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    row = red.fanout_report(hot, hot, ["k"]).first()
    assert (row["joined_rows"], row["worst_key_rows"]) == (100000**2 + 200000, 100000**2)


def test_explode_json_edges(spark):
    data = [
        ('{"a": {"xs": [{"k": "1"}, {"k": null}]}}',), ('{"a": {"xs": []}}',), ('{"a": {"xs": null}}',), ('{"b": 1}',), (None,),
    ]
    df = spark.createDataFrame(data, "doc string")
    typed = docs.explode_json(df, "doc", "$.a.xs", "x", "struct<k:string>")
    assert sorted(rows(typed.select("x.k")), key=str) == [("1",), (None,)]
    texts = docs.explode_json(df, "doc", "$.a.xs", "x")
    assert sorted(r[0] for r in rows(texts.select("x"))) == ['{"k":"1"}', '{"k":null}']
    broken = spark.createDataFrame([("{broken",)], "doc string")
    with pytest.raises(Exception):
        docs.explode_json(broken, "doc", "$.a", "x").collect()
    assert docs.explode_json(broken, "doc", "$.a", "x", strict=False).count() == 0


def test_merge_sources(spark):
    a = spark.createDataFrame(
        [(" 1 ", "old", "x", 1), ("1", "", "y", 2), ("2", "b", "z", 3), ("", "lost", "w", 4)], "id string, name string, p string, n int"
    )
    b = spark.createDataFrame([("1", "from b", "q1", 1), ("3", "c", "q3", 2)], "id string, name string, q string, n int")
    got = rows(docs.merge_sources(a, b, "id", ["name"], "n"), "id")
    assert got == [("1", "from b", "y", "q1"), ("2", "b", "z", ""), ("3", "c", "", "q3")]


# --- metrics ------------------------------------------------------------------------------------


def test_group_median_against_brute_force_with_a_hot_group(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 == 0 else rng.choice("abc"), rng.choice([None, 1.5, rng.randint(0, 50) / 4])) for i in range(4000)]
    data += [("one", 7.0), ("two", 1.0), ("two", 2.0), ("empty", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    got = dict(rows(metrics.group_median(df, ["g"], "v")))
    groups = {g: [v for k, v in data if k == g and v is not None] for g, _ in data}
    assert got == {g: statistics.median(vs) for g, vs in groups.items() if vs}


def test_cube_keeps_missing_apart_from_all(spark):
    data = [(None, "s", 1, 2, 50.0, True, True), ("d", "s", 3, 4, 75.0, True, True), ("d", "t", None, 4, None, False, True)]
    df = spark.createDataFrame(data, "d string, s string, num int, den int, idx double, ok boolean, m boolean")
    cube = metrics.kpi_cube(df, ["d", "s"], "num", "den", "idx", "ok", "m")
    got = {(r["d"], r["s"], r["level"]): r for r in cube.collect()}
    assert len(got) == 8
    total = got[(None, None, 3)]
    assert (total["rows"], total["eligible"], total["mean_index"], total["pooled_index"], total["eligible_pct"]) == (
        3, 2, 62.5, 66.67, 66.7,
    )
    assert got[(None, "s", 0)]["rows"] == 1 and got[(None, "s", 2)]["rows"] == 2
    assert got[("d", "t", 0)]["mean_index"] is None and got[("d", "t", 0)]["pooled_index"] is None


def test_mean_and_pooled_differ_and_empty_slice_is_null(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0, 50.0, True), ("a", 30.0, 100.0, 30.0, True), ("b", 1.0, None, None, False)],
        "g string, n double, d double, i double, ok boolean",
    )
    got = rows(metrics.summary(df, ["g"], "i", "n", "d", "ok"), "g")
    assert got == [("a", 2, 2, 40.0, 30.39), ("b", 1, 0, None, None)]


def test_sorting_rules(spark):
    df = spark.createDataFrame([(1, None, "Água"), (2, 5.0, "Bonito"), (3, 5.0, "agora"), (4, 9.0, "água")], "id int, m double, t string")
    assert [r["id"] for r in metrics.order_by_measure(df, "m", "id").collect()] == [4, 2, 3, 1]
    assert [r["id"] for r in metrics.order_by(df, "m", "id").collect()] == [2, 3, 4, 1]
    assert [r["t"] for r in metrics.order_by_text(df, "t", "id").collect()] == ["agora", "água", "Água", "Bonito"]
    assert [r["id"] for r in metrics.top_k(df, "m", 2, "id").collect()] == [4, 2]


def test_small_reports(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 2)], "a int, b int")
    assert rows(metrics.count_distinct_rows(df, ["a", "b"])) == [(2,)]
    assert rows(metrics.coverage(df, {"with_a": "a", "with_b": "b"})) == [(3, 2, 1)]
    assert metrics.slice_equal(df, a=1, b=None).count() == 2
    assert rows(metrics.gap_histogram(df, F.when(F.col("a").isNull(), "gap"))) == [("gap", 1)]


# --- expectations -------------------------------------------------------------------------------


def test_suite_counts_failures_and_gate_raises(spark):
    t = spark.createDataFrame(
        [(1, "a", -1.0, 10.0), (1, "z", 2.0, 20.0), (2, None, None, 30.0), (None, "a", 4.0, 41.0)], "k int, v string, m double, f double"
    )
    p = spark.createDataFrame([(1,)], "id int")
    checks = [
        q.expect_not_null("t", "k"),
        q.expect_unique("t", "k"),
        q.expect_in("t", "v", ["a"]),
        q.expect_fk("t", "k", "p", "id"),
        q.expect_grain("t", ["k", "v"]),
        q.expect_formula("t", "f", F.col("k").isNotNull(), F.col("k") * 10.0),
        q.expect_non_negative("t", ["m", "f"]),
        q.expect_count("t", 4),
        q.expect_interpreted("t", "v", F.col("m") > 0),
        q.expect_values("p", {"id": 1}),
    ]
    tables = {"t": t, "p": p}
    results = q.run_suite(tables, checks)
    got = {(r["kind"], r["failures"], r["status"]) for r in results.collect()}
    assert got == {
        ("not_null", 1, "fail"), ("unique", 1, "fail"), ("accepted_values", 1, "fail"), ("relationships", 1, "fail"),
        ("grain", 0, "pass"), ("formula", 2, "fail"), ("non_negative", 1, "fail"), ("row_count", 0, "pass"),
        ("interpreted", 1, "fail"), ("values", 0, "pass"),
    }
    for check in checks:  # the lazy failing rows agree with the counts
        failed = {(r["kind"]): r["failures"] for r in results.collect()}[check.kind]
        assert check.failing_rows(tables).count() == failed, check.kind
    assert Counter(r["status"] for r in q.quality_summary(results).collect()) == {"fail": 7, "pass": 3}
    with pytest.raises(q.ExpectationsFailed, match="t.k unique: 1"):
        q.gate(results)
    q.gate(results.filter("status = 'pass'"))


def test_positions_number_the_order(spark):
    from sediment.operators import metrics

    rows = [(i, [None, "é", "e", "z", "f"][i % 5]) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, t string").repartition(7)
    got = metrics.with_position(df, metrics.text_order("t", "i")).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 201))
    rank = {"e": 0, "é": 1, "f": 2, "z": 3, None: 4}
    assert [(r.i, r.t) for r in got] == sorted(rows, key=lambda r: (rank[r[1]], r[0]))


def test_last_row_wins_by_number_of_a_landed_ordinal(spark):
    from sediment.operators import documents

    df = spark.createDataFrame([("k", "nine", "9"), ("k", "ten", "10"), (" k ", "two", "2")], "key string, v string, n string")
    assert documents.latest_per_key(df, "key", "n").first().v == "ten"
