"""The job on a small invented portfolio, and on a real delivery when its files are named.

PORTFOLIO_ROOT      folder that the origin column is relative to
PORTFOLIO_REGISTERS register snapshots, separated by ':'
PORTFOLIO_MEASURES  measurement file of the newest snapshot's date
"""

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sediment.operators import metrics
from sediment.operators.quality import ExpectationsFailed
from sediment.plans import portfolio as p
from sediment.sources.snapshots import SnapshotTable

PREAMBLE = "Titulo{0}\nNota{0}\n{0}\n"
REGISTER = [
    "1;Sede;Próprio / ocupado;Órgão;Fátima do Sul;Rua A;1;Fátima do Sul;ms;;;",
    "2;Anexo;Próprio — Prédio avulso;Órgão;Fátima do sul;Rua B;2;Fátima do Sul;MS;;;",
    "3;Posto;PID — cedido;Município;Norte;Rua C;3;Norte;MS;;;",
    "4;Depósito;;Órgão;Norte;Rua D;4;Norte;MS;;;",
    '5;Sala;Próprio / ocupado;Órgão;Norte;"Rua E; fundos\nbloco 2";5;Norte;MS;;;',
    ";Obra nova;A definir;A definir;Norte;;;Norte;MS;;;",
]
MEASURES = [
    '1;Sede;próprio;23.364,50;7.045,36;;"Nome: ""Sede"""',
    "2;Anexo;Próprio;815,62;6.480,00;135;",
    "3;Posto;cedido;396,37;;0;",
    "5;Sala;outro;100;0;x;",
]
DAY = "2026-08-17"


def tank(position, capacity):
    return {"posicao": position, "capacidade_declarada": capacity, "material_declarado": " "}


def survey(key, shared, private, a, b, basins=""):
    return {
        "id_predio": key,
        "nome_na_fonte": " nome ",
        "data_referencia": DAY,
        "sanitarios": [
            {"tipo": "coletivo", "quantidade_declarada": shared},
            {"tipo": "privativo", "quantidade_declarada": private},
        ],
        "loucas": {"vasos_declarados": basins, "mictorios_declarados": "0", "lavatorios_declarados": "2"},
        "reservatorios": [tank("a", a), tank("B", b)],
    }


SURVEYS = [
    survey("1", "4", "6", "1 x 20.000 + 2 x 10.000 + 3x30.000", "", "3"),
    survey("2", "4", "", "2 x 10.000 + 30.000", "0"),
    survey("3", "1", "1", "", ""),
]


def delivery(folder, register=REGISTER, surveys=SURVEYS):
    header = "ID Prédio;Nome Oficial;Tipo de Imóvel;Responsável;Comarca;Logradouro;Número;Cidade;UF;CEP;Telefone;Observação"
    (folder / "register").mkdir()
    names = []
    for label, lines in (("2026-08-01", [r for r in register if not r.startswith("5;")]), (DAY, register)):
        path = folder / "register" / f"{label}.csv"
        text = PREAMBLE.format(";" * 11) + header + "\n" + "\n".join(lines) + "\n"
        path.write_bytes(text.encode("utf-8-sig"))
        names.append(str(path))
    measures = folder / "measures.csv"
    columns = "ID Prédio;Nome Oficial;Situação;Construída;Terreno;Arquivo;Observação"
    measures.write_bytes((PREAMBLE.format(";" * 6) + columns + "\n" + "\n".join(MEASURES) + "\n").encode("utf-8-sig"))
    document = folder / "surveys.json"
    document.write_text(json.dumps({"fonte": "x", "vistorias": surveys}, ensure_ascii=False, indent=2), encoding="utf-8")
    return names, str(measures), str(document)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivery")
    names, measures, document = delivery(folder)
    expected = {
        "quarantined": 1,
        "coverage": {"imoveis_cadastrados": 5, "imoveis_com_medicao_patrimonial": 4, "imoveis_elegiveis": 2},
        "answers": {"media_indice_individual_pct": 172.11, "indice_global_ponderado_pct": 178.78},
    }
    args = (names, measures, document, str(folder / "out"), DAY)
    return folder, args, p.run(spark, *args, root=str(folder), expected=expected)


def test_every_stage_and_expectation_passes(small):
    _, _, run = small
    assert [(name, status) for name, status, _ in run.stages] == [
        ("ingest", "ok"), ("silver", "ok"), ("gold", "ok"), ("expectations", "ok"),
    ]
    assert run.results.count() == 54
    kinds = dict(rows(run.results.groupBy("kind").count()))
    assert (kinds["not_null"], kinds["unique"], kinds["accepted_values"], kinds["relationships"]) == (20, 9, 9, 7)


def test_typed_rows(small):
    t = small[2].tables
    got = rows(t["stg_imoveis"].select("id_predio", "propriedade", "categoria_funcional", "comarca_normalizada", "uf"), "id_predio")
    assert got == [
        (1, "PROPRIO", "IMOVEL_INSTITUCIONAL", "FÁTIMA DO SUL", "MS"),
        (2, "PROPRIO", "PREDIO_AVULSO", "FÁTIMA DO SUL", "MS"),
        (3, "CEDIDO", "PID", "NORTE", "MS"),
        (4, "NAO_INFORMADO", "IMOVEL_INSTITUCIONAL", "NORTE", "MS"),
        (5, "PROPRIO", "IMOVEL_INSTITUCIONAL", "NORTE", "MS"),
    ]
    assert rows(t["stg_imoveis"].filter("id_predio = 5").select("logradouro")) == [("Rua E; fundos\nbloco 2",)]
    assert rows(t["quarentena_imoveis"].select("linha_origem", "id_predio_original", "nome_original")) == [(10, None, "Obra nova")]
    status = rows(t["stg_patrimonio"].select("id_predio", "situacao_patrimonial", F.col("area_arquivo_m2").cast("double")), "id_predio")
    assert status == [(1, "PROPRIO", None), (2, "PROPRIO", 135.0), (3, "CEDIDO", 0.0), (5, "NAO_INFORMADO", None)]
    assert t["dim_localidade"].count() == 2


def test_fact_measures(small):
    fact = small[2].tables["fato_imovel_snapshot"]
    got = rows(
        fact.select(
            "id_predio", "indice_aproveitamento_pct", "sanitarios_total", "vasos", "mictorios", "capacidade_total_litros",
            "tem_reservacao_informada", "tem_medicao_patrimonial", "tem_vistoria_infraestrutura",
            "densidade_sanitaria_por_1000_m2", "reserva_litros_por_m2",
        ),
        "id_predio",
    )
    assert got == [
        (1, 331.6296, 10, 3, 0, 130000, True, True, True, 0.428, 5.564),
        (2, 12.5867, None, None, 0, 50000, True, True, True, None, 61.3031),
        (3, None, 2, None, 0, None, False, True, True, 5.0458, None),
        (4, None, None, None, None, None, False, False, False, None, None),
        (5, None, None, None, None, None, False, True, False, None, None),
    ]


def test_answers_and_gaps(small):
    run = small[2]
    read = p.answer(run.tables)
    assert rows(read["cobertura"]) == [(5, 4, 3, 2, 2, 2)]
    district = [tuple(r)[1:] for r in read["por_comarca"].collect()]
    assert district == [
        ("FÁTIMA DO SUL", "PROPRIO", 2, 2, 172.11, 178.78),
        ("NORTE", "CEDIDO", 1, 0, None, None),
        ("NORTE", "NAO_INFORMADO", 2, 0, None, None),
    ]
    gaps = dict(rows(p.gaps(run.tables["mart_indicadores_imoveis"])))
    assert gaps == {"Sem registro patrimonial": 1, "Falta área de terreno": 1, "Área de terreno igual a zero": 1}


def test_versions_of_the_register(spark, small):
    table = SnapshotTable(spark, f"{small[0]}/out/bronze/imoveis")
    assert rows(p.compare_register(table, [0, 1])) == [(0, 9, 4, 1), (1, 10, 5, 1)]


def test_rerun_adds_no_version(spark, small):
    folder, args, _ = small
    p.run(spark, *args, root=str(folder))
    assert SnapshotTable(spark, f"{folder}/out/bronze/imoveis").current_version() == 1
    assert SnapshotTable(spark, f"{folder}/out/bronze/patrimonio").current_version() == 0


def test_bad_delivery_is_stopped(spark, tmp_path):
    names, measures, document = delivery(tmp_path, surveys=[survey("1", "1", "1", "cheia", ""), survey("77", "1", "1", "5", "")])
    with pytest.raises(ExpectationsFailed) as failed:
        p.run(spark, names, measures, document, str(tmp_path / "out"), DAY, root=str(tmp_path))
    message = str(failed.value)
    assert "stg_reservatorios.capacidade_original interpreted: 1" in message
    assert "stg_vistorias.id_predio relationships: 1" in message


@pytest.mark.skipif("PORTFOLIO_REGISTERS" not in os.environ, reason="no real delivery named")
def test_published_answers(spark, tmp_path):
    document = tmp_path / "surveys.json"
    document.write_text(json.dumps({"vistorias": [survey("1", "4", "6", "2 x 10.000 + 30.000", "")]}), encoding="utf-8")
    expected = {
        "quarantined": 1,
        "coverage": {"imoveis_cadastrados": 102, "imoveis_com_medicao_patrimonial": 79, "imoveis_elegiveis": 60},
        "answers": {"media_indice_individual_pct": 37.49, "indice_global_ponderado_pct": 35.85},
    }
    run = p.run(
        spark, os.environ["PORTFOLIO_REGISTERS"].split(":"), os.environ["PORTFOLIO_MEASURES"], str(document),
        str(tmp_path / "out"), DAY, root=os.environ["PORTFOLIO_ROOT"], expected=expected,
    )
    mart = run.tables["mart_indicadores_imoveis"]
    assert rows(mart.filter("id_predio in (1, 3, 200)").select("id_predio", "indice_aproveitamento_pct"), "id_predio") == [
        (1, 331.6296), (3, 12.5867), (200, None),
    ]
    median = metrics.group_median(mart, ["data_referencia"], "indice_aproveitamento_pct").first()["median"]
    assert round(median, 2) == 21.78
    assert mart.select("comarca").distinct().count() == 55 and run.tables["dim_localidade"].count() == 78
    assert dict(rows(p.gaps(mart))) == {
        "Sem registro patrimonial": 23, "Falta área de terreno": 16, "Falta área construída e área de terreno": 3,
    }
    district = run.tables["agg_aproveitamento_comarca"]
    one = {r["comarca"]: r for r in district.filter("situacao_patrimonial = 'PROPRIO'").collect()}
    assert (one["CAMPO GRANDE"]["media_indice_individual_pct"], one["CAMPO GRANDE"]["indice_global_ponderado_pct"]) == (117.42, 95.04)
    assert one["DOURADOS"]["indice_global_ponderado_pct"] == 279.0


def test_measurement_rows_without_a_key_are_set_aside(spark):
    rows_ = [(str(n), *cells) for n, cells in enumerate([
        ("Titulo", "", "", "", "", "", ""), ("", "", "", "", "", "", ""), ("", "", "", "", "", "", ""), ("ID", "Nome", "S", "C", "T", "A", "O"),
        ("1", "Sede", "próprio", "1,00", "", "", ""), ("x", "Sala", "cedido", "2,00", "", "", ""), ("", "", "", "3,00", "", "", ""),
        ("", " ", "", "", "", "", ""), (None, None, None, None, None, None, "nota"), ("99999999999", "", "", "", "", "", ""),
    ], 1)]
    columns = [p.RECORD_NUMBER, *(f"col_0{k}" for k in range(1, 8))]
    raw = spark.createDataFrame(rows_, ", ".join(f"{c} string" for c in columns)).withColumns({p.ORIGIN: F.lit("f"), p.VERSION: F.lit(DAY)})
    aside = p.stage_measure_quarantine(raw)
    got = rows(aside.select("linha_origem", "id_predio_original", "area_construida_original", "observacao_fonte"), "linha_origem")
    assert got == [(6, "x", "2,00", None), (7, None, "3,00", None), (9, None, None, "nota")]
    assert sorted(r.linha_origem for r in p.stage_measure(raw).collect()) == [5, 10]
