"""Arrays inside JSON files, cut at several block sizes, against a JSON reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sediment.operators.documents import explode_json
from sediment.plans import portfolio as p
from sediment.sources import elements as e
from sediment.sources.documents import read_document_raw

AWKWARD = ['a,b', '],[{"x":1},', '\\', '\\"', '"', '{"vistorias": [1,2]}', "line\nbreak, and\ttab", "é🙂,日本", "", ",,,", '\\",[', "}" * 5]


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind >= 6:
        return {rng.choice(AWKWARD) + str(k): value(rng, depth + 1) for k in range(rng.randrange(4))}
    if kind == 5:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return [None, True, rng.randrange(-9, 9999), rng.choice(AWKWARD), rng.random()][kind]


def sized(spark, block):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


@pytest.fixture
def blocks(spark):
    yield lambda block: sized(spark, block)
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


@pytest.mark.parametrize("block", [70, 1000, 1 << 27])
def test_elements_of_awkward_documents(spark, tmp_path, blocks, block):
    rng = random.Random(4)
    wanted = {}
    for n, (ascii_, indent) in enumerate([(True, None), (False, 1), (False, None)]):
        rows = [value(rng) for _ in range(60)]
        meta = {"vistorias": {"x": [1, 2]}, "a,\"vistorias": [7, 8], "other": [[1, [2]], {"vistorias": [3]}]}
        whole = {"meta": meta, "before": [9, "],"], "vistorias": rows, "after": {"vistorias": [5, 6]}, "z": "[,"}
        (tmp_path / f"d{n}.json").write_text(json.dumps(whole, ensure_ascii=ascii_, indent=indent), encoding="utf-8")
        wanted[f"d{n}.json"] = rows
    blocks(block)
    found = e.explode_elements(spark, str(tmp_path), "$.vistorias").collect()
    for name, rows in wanted.items():
        got = {r._element: r.element for r in found if r._file.endswith(name)}
        assert sorted(got) == list(range(1, len(rows) + 1))
        for k, row in enumerate(rows):
            text = got[k + 1]
            assert text == row if isinstance(row, str) else row is None and text is None or json.loads(text) == row
    nested = e.explode_elements(spark, str(tmp_path), "$.meta.other", element="string").collect()
    assert sorted((r._element, json.loads(r.element)) for r in nested if r._file.endswith("d1.json")) == [(1, [1, [2]]), (2, {"vistorias": [3]})]
    if block < 1000:
        assert e.read_pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 10


def test_top_level_arrays_missing_and_empty_ones(spark, tmp_path):
    for name, text in {"a": '[1, "x,y", [2, 3], {"a": [4]}]', "b": " [ ] ", "c": '{"x": 1}', "d": "[[]]", "e": "﻿[true\n]\n"}.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    got = {(r._file[-6:-5], r._element, r.element) for r in e.explode_elements(spark, str(tmp_path), "$").collect()}
    assert got == {("a", 1, "1"), ("a", 2, "x,y"), ("a", 3, "[2, 3]"), ("a", 4, '{"a": [4]}'), ("d", 1, "[]"), ("e", 1, "true")} or got == {
        ("a", 1, "1"), ("a", 2, "x,y"), ("a", 3, "[2,3]"), ("a", 4, '{"a":[4]}'), ("d", 1, "[]"), ("e", 1, "true")
    }
    assert e.explode_elements(spark, str(tmp_path), "$.x").collect() == []


@pytest.mark.parametrize("text", ['{"v": [1, 2}', '{"v": [1, 2]', '{"v": ["1, 2]}', '{"v": [1]} {"v": [2]}', '{"v": [1]}]', '{"v": [1, , 2]}'])
def test_malformed_documents_stop_the_job(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception):
        e.explode_elements(spark, str(tmp_path), "$.v", element="int").collect()


def test_a_faulty_file_gives_no_row_when_not_strict(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"v": [1, 2]')
    (tmp_path / "good.json").write_text('{"v": [3]}')
    got = e.explode_elements(spark, str(tmp_path), "$.v", element="int", strict=False).collect()
    assert [(r._file[-9:], r.element) for r in got] == [("good.json", 3)]


def test_long_elements_stop_the_job(spark, tmp_path):
    (tmp_path / "long.json").write_text(json.dumps({"v": ["x," * 40, "y"]}))
    with pytest.raises(ValueError, match="element 1"):
        e.explode_elements(spark, str(tmp_path), "$.v", limit=50)
    assert e.explode_elements(spark, str(tmp_path), "$.v", limit=90).count() == 2


def test_surveys_by_element_are_the_surveys_of_the_document(spark, tmp_path, blocks):
    surveys = [
        {
            "id_predio": str(n), "nome_na_fonte": f'Fórum "{n}", [sala]', "data_referencia": "2026-08-17",
            "sanitarios": [{"tipo": "coletivo", "quantidade_declarada": str(n % 5)}],
            "reservatorios": [{"posicao": "A", "capacidade_declarada": "2 x 500, e {1}", "material_declarado": None}],
            "loucas": {"vasos_declarados": "3", "mictorios_declarados": None, "lavatorios_declarados": "x"},
        }
        for n in range(200)
    ]
    source = tmp_path / "s.json"
    source.write_text(json.dumps({"origem": ["a", "b"], "vistorias": surveys}, ensure_ascii=False))
    whole = sorted(map(str, p.stage_survey(read_document_raw(spark, str(source), "v")).collect()))
    assert len(whole) == 200
    for block in (500, 4000, 1 << 27):
        blocks(block)
        raw = e.read_elements_raw(spark, str(source), "v", p.SURVEYS, root=str(tmp_path))
        assert sorted(map(str, p.stage_survey(raw).collect())) == whole
    typed = e.explode_elements(spark, str(source), p.SURVEYS, "s", p.SURVEY_TYPE)
    same = explode_json(read_document_raw(spark, str(source), "v"), "conteudo_json", p.SURVEYS, "s", p.SURVEY_TYPE)
    assert typed.select(F.to_json("s").alias("s")).exceptAll(same.select(F.to_json("s").alias("s"))).count() == 0
