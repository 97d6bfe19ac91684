"""Layers that keep many dates, and answers merged from partial sums."""

import pytest
from conftest import rows
from test_portfolio import DAY, MEASURES, PREAMBLE, REGISTER, SURVEYS, delivery

from pyspark.sql import functions as F

from sediment.operators import metrics
from sediment.plans import portfolio as p
from sediment.sources import partitions as parts


def frame(spark, *values):
    return spark.createDataFrame(values, "day string, k int, v string")


def test_a_write_replaces_its_dates_only(spark, tmp_path):
    root = str(tmp_path)
    parts.replace_partitions(frame(spark, ("2026-01-01", 1, "a"), ("2026-01-02", 2, "b"), (None, 3, None)), root, "t", "day")
    new = parts.replace_partitions(frame(spark, ("2026-01-02", 5, "c"), ("2026-01-03", 6, "d")), root, "t", "day")
    assert rows(new.select("day", "k"), "k") == [("2026-01-02", 5), ("2026-01-03", 6)]
    every = parts.read_partitions(spark, root, "t")
    assert every.columns == ["k", "v", "day"] and dict(every.dtypes)["day"] == "string"
    assert rows(every.select("day", "k", "v"), "k") == [("2026-01-01", 1, "a"), (None, 3, None), ("2026-01-02", 5, "c"), ("2026-01-03", 6, "d")]
    parts.replace_partitions(frame(spark), root, "t", "day", ["2026-01-03", None])
    assert rows(parts.read_partitions(spark, root, "t").select("k"), "k") == [(1,), (5,)]
    one = parts.read_partitions(spark, root, "t", ["2026-01-01"])
    assert [r.k for r in one.collect()] == [1] and len(one.inputFiles()) == 1
    assert parts.read_partitions(spark, root, "t", ["2030-01-01"]).collect() == []


def test_old_rows_go_after_the_next_write_only(spark, tmp_path):
    root = str(tmp_path)
    parts.replace_partitions(frame(spark, ("a", 1, "")), root, "t", "day")
    former = parts.read_partitions(spark, root, "t")
    parts.replace_partitions(frame(spark, ("a", 2, "")), root, "t", "day")
    assert [r.k for r in former.collect()] == [1]
    parts.replace_partitions(frame(spark, ("a", 3, "")), root, "t", "day")
    assert len(list((tmp_path / "t").glob("_attempt=*"))) == 2
    assert [r.k for r in parts.read_partitions(spark, root, "t").collect()] == [3]


def test_writers_of_other_dates_do_not_disturb_each_other(spark, tmp_path, monkeypatch):
    """The other writer commits between this one's look at the state and its own record."""
    root = str(tmp_path)
    parts.replace_partitions(frame(spark, ("a", 1, "")), root, "t", "day")
    put, seen = parts.put_if_absent, []

    def slow(spark_, path, text):
        if not seen:
            seen.append(path)
            parts.replace_partitions(frame(spark, *other), root, "t", "day")
        return put(spark_, path, text)

    monkeypatch.setattr(parts, "put_if_absent", slow)
    other = [("b", 2, "")]
    parts.replace_partitions(frame(spark, ("c", 3, "")), root, "t", "day")
    assert rows(parts.read_partitions(spark, root, "t").select("day", "k"), "k") == [("a", 1), ("b", 2), ("c", 3)]
    seen.clear()
    other = [("c", 9, "")]
    with pytest.raises(parts.ReplacedMeanwhile):
        parts.replace_partitions(frame(spark, ("c", 4, "")), root, "t", "day")
    assert rows(parts.read_partitions(spark, root, "t").select("k"), "k") == [(1,), (2,), (9,)]


def test_another_schema_is_refused(spark, tmp_path):
    parts.replace_partitions(frame(spark, ("a", 1, "")), str(tmp_path), "t", "day")
    with pytest.raises(ValueError, match="schema"):
        parts.replace_partitions(frame(spark, ("b", 1, "")).drop("v"), str(tmp_path), "t", "day")
    with pytest.raises(ValueError, match="plain"):
        parts.read_partitions(spark, str(tmp_path), "t", ["../a"])


def test_merged_sums_are_the_summary_of_all_rows(spark):
    figures = ("i", "n", "d", "ok")
    mart = spark.createDataFrame(
        [(k % 3, k % 5, None if k % 4 == 0 else round(k / 7, 4), k + 0.25, k + 1.5, k % 4 != 0, k % 2 == 0) for k in range(200)],
        "a int, b int, i double, n double, d double, ok boolean, m boolean",
    )
    sums = metrics.partial_summary(mart, ["a", "b"], *figures, measured="m")
    for by in ([], ["a"], ["b"], ["a", "b"]):
        assert rows(metrics.merge_summaries(sums, by, True), *by) == rows(metrics.summary(mart, by, *figures, measured="m"), *by)
    none = metrics.merge_summaries(sums.where("a = 99"), [])
    assert rows(none) == [(None, None, None, None)]


def test_a_job_keeps_its_dates(spark, tmp_path):
    """Two runs of two dates, then one date again with a changed measurement; answers equal a recomputation from all rows."""
    out = str(tmp_path / "out")
    source = tmp_path / "first"
    source.mkdir()
    names, measures, document = delivery(source)

    def run(day, register, built):
        folder = tmp_path / f"{day}-{built}"
        folder.mkdir()
        (folder / f"{day}.csv").write_text((source / "register" / f"{DAY}.csv").read_text(encoding="utf-8-sig").replace("Obra nova", f"Obra {day}"), encoding="utf-8")
        header = "ID Prédio;Nome Oficial;Situação;Construída;Terreno;Arquivo;Observação"
        lines = [MEASURES[0].replace("23.364,50", built), *MEASURES[1:]]
        (folder / "m.csv").write_text(PREAMBLE.format(";" * 6) + header + "\n" + "\n".join(lines) + "\n", encoding="utf-8")
        (folder / "s.json").write_text((source / "surveys.json").read_text().replace(DAY, day))
        return p.run(
            spark, [str(folder / f"{day}.csv")], str(folder / "m.csv"), str(folder / "s.json"), out, day, root=str(folder),
            minimum_registers=1, large_surveys=day == "2026-09-01", keep_dates=True,
        )

    run("2026-08-17", REGISTER, "23.364,50")
    run("2026-09-01", REGISTER, "20.000,00")
    fact = p.history(spark, out)
    assert rows(fact.groupBy("data_referencia").count().select(F.col("data_referencia").cast("string"), "count"), "data_referencia") == [
        ("2026-08-17", 5), ("2026-09-01", 5),
    ]
    before = rows(fact.where("data_referencia = '2026-08-17'"), "id_predio")
    again = run("2026-09-01", REGISTER, "10.000,00")
    fact = p.history(spark, out)
    assert rows(fact.where("data_referencia = '2026-08-17'"), "id_predio") == before
    assert again.tables["fato_imovel_snapshot"].count() == 5
    area = fact.where("id_predio = 1").select(F.col("data_referencia").cast("string").alias("d"), F.col("area_construida_m2").cast("double"))
    assert rows(area, "d") == [("2026-08-17", 23364.5), ("2026-09-01", 10000.0)]
    mart = p.history(spark, out, "mart_indicadores_imoveis")
    for by in ([p.DATE], [p.DATE, "comarca"], ["situacao_patrimonial"], []):
        whole = metrics.summary(mart, by, *p.FIGURES, measured="tem_medicao_patrimonial", names=p.SUMMARY_NAMES)
        assert rows(p.answer_over(spark, out, by), *by) == rows(whole, *by)
    one = p.answer_over(spark, out, dates=["2026-09-01"])
    assert rows(one) == rows(again.tables["agg_aproveitamento_geral"])
