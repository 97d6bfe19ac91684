"""The real-estate job: what share of its land a portfolio builds on, by district and tenure status.

Layers: raw snapshots -> typed and quarantined rows -> collections at the entity grain -> star ->
answers. Every stage is stored, and the next one starts from the stored rows.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.functions.keys import date_key, surrogate_key
from sediment.functions.measures import (
    STATUS_PARSED,
    STATUS_UNDECLARED,
    STATUS_UNPARSED,
    classify_gap,
    complete,
    default,
    parse_decimal,
    ratio,
    strict_add,
    with_quantity,
)
from sediment.functions.text import (
    classify_like,
    clean_text,
    conform,
    map_domain,
    safe_date,
    safe_int,
    safe_key,
    valid_key,
)
from sediment.operators import metrics
from sediment.operators import quality as q
from sediment.operators import reduce as red
from sediment.operators.documents import explode_json
from sediment.operators.quarantine import REASON_INVALID_KEY, KeyRule, quarantine
from sediment.operators.star import attach, build_mart, dim_date, dim_entity, dim_place
from sediment.sources.ingest import delimited_reader, document_reader, element_reader, ingest_one, ingest_snapshots
from sediment.sources.layers import write_layer
from sediment.sources.partitions import read_partitions, replace_partitions
from sediment.sources.provenance import DOCUMENT, ELEMENT, ORIGIN, RECORD_NUMBER, VERSION
from sediment.sources.snapshots import SnapshotTable

# --- Fixed values: positions, names and domains of the published data ---------------------------

KEY = "id_predio"
DATE = "data_referencia"
UNINFORMED = "NAO_INFORMADO"
REGISTER_TEXT = {
    "nome_oficial": "col_02",
    "classificacao_original": "col_03",
    "responsavel_manutencao": "col_04",
    "comarca": "col_05",
    "logradouro": "col_06",
    "numero": "col_07",
    "cidade": "col_08",
    "uf": "col_09",
    "cep": "col_10",
    "telefone": "col_11",
    "observacao": "col_12",
}
QUARANTINE_TEXT = {
    "id_predio_original": "col_01",
    "nome_original": "col_02",
    "classificacao_original": "col_03",
    "comarca_original": "col_05",
}
MEASURE_TEXT = {
    "nome_na_fonte": "col_02",
    "area_construida_original": "col_04",
    "area_terreno_original": "col_05",
    "area_arquivo_original": "col_06",
    "observacao_fonte": "col_07",
}
AREAS = ("area_construida", "area_terreno", "area_arquivo")
OWNERSHIP = [("PRÓPRIO%", "PROPRIO"), ("PID%", "CEDIDO")]
CATEGORY = [("PID%", "PID"), ("%PRÉDIO AVULSO%", "PREDIO_AVULSO")]
CATEGORY_DEFAULT = "IMOVEL_INSTITUCIONAL"
TENURE = {"próprio": "PROPRIO", "cedido": "CEDIDO", "alugado": "ALUGADO"}
STATES = ["MS"]
SURVEYS = "$.vistorias"
SURVEY_TYPE = (
    "struct<id_predio:string,nome_na_fonte:string,data_referencia:string,sanitarios:string,reservatorios:string,"
    "loucas:struct<vasos_declarados:string,mictorios_declarados:string,lavatorios_declarados:string>>"
)
ITEM_TYPE = "struct<tipo:string,quantidade_declarada:string>"
TANK_TYPE = "struct<posicao:string,capacidade_declarada:string,material_declarado:string>"
ITEM_KINDS = {"COLETIVO": "sanitarios_coletivos", "PRIVATIVO": "sanitarios_privativos"}
TANK_POSITIONS = ["A", "B"]
SUMMARY_NAMES = {
    "rows": "imoveis_cadastrados",
    "measured": "imoveis_com_medicao_patrimonial",
    "eligible": "imoveis_elegiveis",
    "mean": "media_indice_individual_pct",
    "pooled": "indice_global_ponderado_pct",
}
COVERAGE = {
    "com_area_construida": "area_construida_m2",
    "com_area_terreno": "area_terreno_m2",
    "elegiveis_indice": "indice_aproveitamento_pct",
    "com_sanitarios_completos": "sanitarios_total",
    "com_reservacao_informada": "capacidade_total_litros",
}
GAP_WORDS = {
    "parts": {"area_construida_m2": "área construída", "area_terreno_m2": "área de terreno"},
    "no_measure": "Sem registro patrimonial",
    "missing_prefix": "Falta ",
    "joiner": " e ",
    "zero": "Área de terreno igual a zero",
}
FACT_COLUMNS = [
    "id_predio", "data_referencia", "imovel_sk", "localidade_sk", "data_referencia_sk", "situacao_patrimonial",
    "area_construida_m2", "area_terreno_m2", "area_arquivo_m2", "sanitarios_coletivos", "sanitarios_privativos",
    "sanitarios_total", "tem_sanitarios_completos", "vasos", "mictorios", "lavatorios", "capacidade_total_litros",
    "tem_reservacao_informada", "tem_medicao_patrimonial", "tem_vistoria_infraestrutura",
]

REGISTER_RULE = KeyRule(key="col_01", required="col_02", ordinal=RECORD_NUMBER, first_data_row=5)

# --- typed layer --------------------------------------------------------------------------------


def _typed(raw: DataFrame, text: Mapping[str, str]) -> DataFrame:
    """Rows with a digit key: key, cleaned texts, snapshot date and provenance."""
    return raw.filter(valid_key("col_01")).select(
        safe_key("col_01").alias(KEY),
        *[clean_text(c).alias(name) for name, c in text.items()],
        safe_date(VERSION).alias(DATE),
        ORIGIN,
        safe_int(RECORD_NUMBER).alias("linha_origem"),
        "col_03",
    )


def stage_entity(raw: DataFrame) -> DataFrame:
    """Identified entities; the mixed type field is separated into ownership and category."""
    return (
        _typed(raw, REGISTER_TEXT)
        .drop("col_03")
        .withColumns(
            {
                "uf": conform("uf"),
                "propriedade": classify_like("classificacao_original", OWNERSHIP, UNINFORMED),
                "categoria_funcional": classify_like("classificacao_original", CATEGORY, CATEGORY_DEFAULT),
                "tipo_imovel": F.lit(UNINFORMED),
                "comarca_normalizada": conform("comarca"),
                "cidade_normalizada": conform("cidade"),
            }
        )
    )


def stage_quarantine(raw: DataFrame) -> DataFrame:
    """Register rows that name something but carry no reliable key."""
    keep = {ORIGIN: ORIGIN, "linha_origem": RECORD_NUMBER}
    return quarantine(raw, REGISTER_RULE, keep, QUARANTINE_TEXT, "motivo_quarentena")


def stage_measure(raw: DataFrame) -> DataFrame:
    """Areas as decimals beside their original text, and the tenure status."""
    areas = {f"{a}_m2": parse_decimal(f"{a}_original") for a in AREAS}
    tenure = {"situacao_patrimonial": map_domain("col_03", TENURE, UNINFORMED)}
    return _typed(raw, MEASURE_TEXT).withColumns({**tenure, **areas}).drop("col_03")


def stage_measure_quarantine(raw: DataFrame) -> DataFrame:
    """Measurement rows below the header that hold anything but have no digit key: with ``stage_measure`` no such row is lost."""
    cells = ["col_01", "col_03", *MEASURE_TEXT.values()]
    filled = F.exists(F.array(*map(clean_text, cells)), lambda v: v.isNotNull())
    rows = raw.filter(REGISTER_RULE.in_data() & ~F.coalesce(valid_key("col_01"), F.lit(False)) & filled)
    return rows.select(
        ORIGIN,
        safe_int(RECORD_NUMBER).alias("linha_origem"),
        clean_text("col_01").alias("id_predio_original"),
        clean_text("col_03").alias("situacao_original"),
        *[clean_text(c).alias(name) for name, c in MEASURE_TEXT.items()],
        F.lit(REASON_INVALID_KEY).alias("motivo_quarentena"),
    )


def stage_survey(raw: DataFrame) -> DataFrame:
    """One row per survey in the document; its collections stay JSON text for their own models.

    ``raw`` has whole documents, or their surveys landed one by one.
    """
    if ELEMENT in raw.columns:
        rows = raw.withColumn("s", F.from_json(ELEMENT, SURVEY_TYPE, {"mode": "FAILFAST"}))
    else:
        rows = explode_json(raw, DOCUMENT, SURVEYS, "s", SURVEY_TYPE)
    fittings = {n: safe_int(F.col(f"s.loucas.{n}_declarados")) for n in ("vasos", "mictorios", "lavatorios")}
    return rows.select(
        safe_int("s.id_predio").alias(KEY),
        clean_text("s.nome_na_fonte").alias("nome_na_fonte"),
        safe_date("s.data_referencia").alias(DATE),
        F.col("s.sanitarios").alias("sanitarios_json"),
        F.col("s.reservatorios").alias("reservatorios_json"),
        *[c.alias(n) for n, c in fittings.items()],
    )


def stage_items(surveys: DataFrame) -> DataFrame:
    """One declared kind of sanitary fitting per row."""
    rows = explode_json(surveys, "sanitarios_json", "$", "i", ITEM_TYPE)
    declared = F.nullif(F.col("i.quantidade_declarada"), F.lit(""))
    return rows.select(
        KEY, DATE,
        conform("i.tipo").alias("tipo_sanitario"),
        declared.alias("quantidade_original"),
        safe_int(declared).alias("quantidade"),
    )


def stage_capacity(surveys: DataFrame) -> DataFrame:
    """One declared tank per row, its capacity text read as a quantity."""
    rows = explode_json(surveys, "reservatorios_json", "$", "t", TANK_TYPE).select(
        KEY, DATE,
        conform("t.posicao").alias("posicao"),
        clean_text("t.capacidade_declarada").alias("capacidade_original"),
        clean_text("t.material_declarado").alias("material_original"),
    )
    return with_quantity(
        rows, "capacidade_original", "termos_reconhecidos", "capacidade_total_litros", "status_interpretacao"
    )


# --- collections at the entity grain ------------------------------------------------------------


def reduce_items(items: DataFrame, surveys: DataFrame) -> DataFrame:
    """Fittings per entity and date; a total exists only when both kinds were declared."""
    wide = red.pivot_max(items, [KEY, DATE], "tipo_sanitario", "quantidade", ITEM_KINDS)
    kinds = list(ITEM_KINDS.values())
    totals = wide.withColumns(
        {"sanitarios_total": strict_add(*kinds), "tem_sanitarios_completos": complete(*kinds)}
    )
    return totals.join(surveys.select(KEY, DATE, "vasos", "mictorios", "lavatorios"), [KEY, DATE])


def reduce_capacity(tanks: DataFrame) -> DataFrame:
    """Capacity per entity and date; one unread declaration leaves the entity without a total."""
    read = F.col("status_interpretacao") == STATUS_PARSED
    declared = "capacidade_original"
    return tanks.groupBy(KEY, DATE).agg(
        red.count_declared(declared).alias("declaracoes_capacidade"),
        red.count_unread(declared, read).alias("declaracoes_nao_interpretadas"),
        red.strict_sum("capacidade_total_litros", declared, read).alias("capacidade_total_litros"),
        red.any_declared(declared).alias("tem_reservacao_informada"),
    )


# --- star ---------------------------------------------------------------------------------------

PLACE = {"comarca": "comarca_normalizada", "cidade": "cidade_normalizada", "uf": "uf"}


def dims(entities: DataFrame) -> dict[str, DataFrame]:
    attributes = [
        "nome_oficial", "tipo_imovel", "propriedade", "categoria_funcional", "classificacao_original",
        "responsavel_manutencao",
    ]
    return {
        "dim_imovel": dim_entity(entities, KEY, "imovel_sk", attributes),
        "dim_localidade": dim_place(entities, "localidade_sk", PLACE),
        "dim_tempo": dim_date(entities, DATE, "data_sk", "data", "ano", "mes", "trimestre"),
    }


def build_fact(entities: DataFrame, measures: DataFrame, items: DataFrame, capacity: DataFrame) -> DataFrame:
    """One row per entity and date. All three attachments share the (entity, date) partitioning, and
    the surrogate keys are computed from the row, so no dimension is looked up here. A row without key or
    date stays, for the expectations to see."""
    keyed = entities.select(
        KEY, DATE,
        surrogate_key(KEY).alias("imovel_sk"),
        surrogate_key(*PLACE.values()).alias("localidade_sk"),
        date_key(DATE).alias("data_referencia_sk"),
    )
    areas = [f"{a}_m2" for a in AREAS]
    base = attach(keyed, measures.select(KEY, DATE, "situacao_patrimonial", *areas), [KEY, DATE], "tem_medicao_patrimonial")
    base = attach(base, items, [KEY, DATE], "tem_vistoria_infraestrutura")
    base = attach(base, capacity.select(KEY, DATE, "capacidade_total_litros", "tem_reservacao_informada"), [KEY, DATE])
    defaults = {
        "situacao_patrimonial": default("situacao_patrimonial", UNINFORMED),
        "tem_sanitarios_completos": default("tem_sanitarios_completos", False),
        "tem_reservacao_informada": default("tem_reservacao_informada", False),
    }
    return (
        base.withColumns(defaults)
        .select(*FACT_COLUMNS)
        .withColumns(
            {
                "elegivel_indice_aproveitamento": complete(
                    "area_construida_m2", "area_terreno_m2", positive="area_terreno_m2"
                ),
                "indice_aproveitamento_pct": ratio("area_construida_m2", "area_terreno_m2", 100),
                "densidade_sanitaria_por_1000_m2": ratio("sanitarios_total", "area_construida_m2", 1000),
                "reserva_litros_por_m2": ratio("capacidade_total_litros", "area_construida_m2"),
            }
        )
    )


def wide_mart(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Fact and dimension attributes side by side, each column once."""
    entity = dimensions["dim_imovel"].drop("classificacao_original")
    day = dimensions["dim_tempo"].withColumnsRenamed({"data_sk": "data_referencia_sk", "data": DATE})
    return build_mart(
        fact, [(entity, "imovel_sk"), (dimensions["dim_localidade"], "localidade_sk"), (day, "data_referencia_sk")]
    )


FIGURES = ("indice_aproveitamento_pct", "area_construida_m2", "area_terreno_m2", "elegivel_indice_aproveitamento")
PARTIAL_SUMS = "somas_aproveitamento"


def partial_answers(mart: DataFrame) -> DataFrame:
    """Sums by date, district and status, from which answers over any dates are merged."""
    return metrics.partial_summary(mart, [DATE, "comarca", "situacao_patrimonial"], *FIGURES, measured="tem_medicao_patrimonial")


def answer_over(spark: SparkSession, out_dir: str, by: Sequence[str] = (DATE,), dates: Sequence[str] | None = None) -> DataFrame:
    """The answer by the given columns over all dates of a job that keeps them, or over the given ones.

    Read from the stored sums: neither fact nor mart is touched.
    """
    sums = read_partitions(spark, f"{out_dir.rstrip('/')}/gold", PARTIAL_SUMS, dates)
    return metrics.merge_summaries(sums, by, True, SUMMARY_NAMES)


def history(spark: SparkSession, out_dir: str, name: str = "fato_imovel_snapshot") -> DataFrame:
    """Fact or mart rows of all dates of a job that keeps them."""
    return read_partitions(spark, f"{out_dir.rstrip('/')}/gold", name)


def answers(mart: DataFrame) -> dict[str, DataFrame]:
    """The overall answer with its coverage, and the same by district and status."""
    return {
        "agg_aproveitamento_geral": metrics.summary(
            mart, [DATE], *FIGURES, measured="tem_medicao_patrimonial", names=SUMMARY_NAMES
        ),
        "agg_aproveitamento_comarca": metrics.summary(
            mart, [DATE, "comarca", "situacao_patrimonial"], *FIGURES, names=SUMMARY_NAMES
        ),
    }


def answer(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What a reader asks for: overall figures, figures by district and status, coverage, exceptions."""
    return {
        "geral": tables["agg_aproveitamento_geral"],
        "por_comarca": metrics.order_by(tables["agg_aproveitamento_comarca"], "comarca", "situacao_patrimonial"),
        "cobertura": metrics.coverage(tables["mart_indicadores_imoveis"], COVERAGE, "total_imoveis"),
        "quarentena": metrics.order_by(tables["quarentena_imoveis"], ORIGIN, "linha_origem"),
    }


def gaps(mart: DataFrame) -> DataFrame:
    """Why entities are outside the index."""
    gap = classify_gap("elegivel_indice_aproveitamento", "tem_medicao_patrimonial", **GAP_WORDS)
    return metrics.gap_histogram(mart, gap, "falta")


def compare_register(table: SnapshotTable, versions: Sequence[int]) -> DataFrame:
    """Identified and keyless entities in several versions of the raw register."""
    keyed = valid_key(REGISTER_RULE.key)
    return table.compare_versions(
        versions,
        {
            "linhas_fisicas": F.count(F.lit(1)),
            "imoveis_com_id": F.count_if(keyed),
            "registros_sem_id": F.count_if(REGISTER_RULE.is_bad()),
        },
    )


# --- expectations -------------------------------------------------------------------------------


def expectations(expected: Mapping[str, Mapping[str, object] | int] | None = None) -> list[q.Expectation]:
    """All checks of the job. ``expected`` adds the regression values of one delivery: ``quarantined``
    (a row count), ``coverage`` and ``answers`` (values of the overall row)."""
    status = list(dict.fromkeys([*TENURE.values(), UNINFORMED]))
    built, land = F.col("area_construida_m2").cast("double"), F.col("area_terreno_m2").cast("double")
    overall = "agg_aproveitamento_geral"
    checks = [
        q.expect_not_null("stg_imoveis", KEY),
        q.expect_unique("stg_imoveis", KEY),
        q.expect_not_null("stg_imoveis", "nome_oficial"),
        q.expect_in("stg_imoveis", "uf", STATES),
        q.expect_in("stg_imoveis", "propriedade", [*[v for _, v in OWNERSHIP], UNINFORMED]),
        q.expect_in("stg_imoveis", "categoria_funcional", [*[v for _, v in CATEGORY], CATEGORY_DEFAULT]),
        q.expect_not_null("quarentena_imoveis", "motivo_quarentena"),
        q.expect_in("quarentena_imoveis", "motivo_quarentena", [REASON_INVALID_KEY]),
        q.expect_in("stg_patrimonio", "situacao_patrimonial", status),
        q.expect_not_null("stg_vistorias", DATE),
        q.expect_in("stg_sanitarios", "tipo_sanitario", list(ITEM_KINDS)),
        q.expect_in("stg_reservatorios", "posicao", TANK_POSITIONS),
        q.expect_in("stg_reservatorios", "status_interpretacao", [STATUS_PARSED, STATUS_UNPARSED, STATUS_UNDECLARED]),
        q.expect_in("fato_imovel_snapshot", "situacao_patrimonial", status),
        q.expect_not_null(overall, "imoveis_cadastrados"),
        q.expect_not_null(overall, "media_indice_individual_pct"),
        q.expect_not_null(overall, "indice_global_ponderado_pct"),
    ]
    for table in ("stg_patrimonio", "stg_vistorias"):
        checks += [q.expect_not_null(table, KEY), q.expect_unique(table, KEY), q.expect_fk(table, KEY, "stg_imoveis", KEY)]
    for table in ("stg_sanitarios", "stg_reservatorios"):
        checks += [q.expect_not_null(table, KEY), q.expect_fk(table, KEY, "stg_imoveis", KEY)]
    for table, key in (
        ("dim_imovel", "imovel_sk"),
        ("dim_imovel", KEY),
        ("dim_localidade", "localidade_sk"),
        ("dim_tempo", "data_sk"),
        ("mart_indicadores_imoveis", KEY),
        (overall, DATE),
    ):
        checks += [q.expect_not_null(table, key), q.expect_unique(table, key)]
    for col, dim, key in (
        ("imovel_sk", "dim_imovel", "imovel_sk"),
        ("localidade_sk", "dim_localidade", "localidade_sk"),
        ("data_referencia_sk", "dim_tempo", "data_sk"),
    ):
        checks += [q.expect_not_null("fato_imovel_snapshot", col), q.expect_fk("fato_imovel_snapshot", col, dim, key)]
    checks += [
        q.expect_grain("fato_imovel_snapshot", ["imovel_sk", "data_referencia_sk"]),
        q.expect_grain("stg_sanitarios", [KEY, DATE, "tipo_sanitario"]),
        q.expect_grain("stg_reservatorios", [KEY, DATE, "posicao"]),
        q.expect_formula(
            "fato_imovel_snapshot", "indice_aproveitamento_pct", "elegivel_indice_aproveitamento",
            F.round(100 * F.try_divide(built, land), 4), 1e-4,
        ),
        q.expect_non_negative(
            "fato_imovel_snapshot", [*[f"{a}_m2" for a in AREAS], "sanitarios_total", "capacidade_total_litros"]
        ),
        q.expect_interpreted("stg_reservatorios", "capacidade_original", F.col("status_interpretacao") == STATUS_PARSED),
    ]
    if expected:
        checks += [
            q.expect_count("quarentena_imoveis", expected["quarantined"]),
            q.expect_values(overall, expected["coverage"]),
            q.expect_values(overall, expected["answers"]),
        ]
    return checks


# --- the whole job ------------------------------------------------------------------------------


@dataclass
class Run:
    """Stored tables of a run, its expectation results and (stage, status, seconds) in order."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    results: DataFrame | None = None
    stages: list[tuple[str, str, float]] = field(default_factory=list)

    def stage(self, name: str, work) -> None:
        started = time.monotonic()
        status = "failed"
        try:
            work()
            status = "ok"
        finally:
            self.stages.append((name, status, round(time.monotonic() - started, 3)))


def run(
    spark: SparkSession,
    registers: Sequence[str],
    measures: str,
    surveys: str,
    out_dir: str,
    reference_date: str,
    root: str | None = None,
    expected: Mapping[str, Mapping[str, object] | int] | None = None,
    minimum_registers: int = 2,
    large_surveys: bool = False,
    keep_dates: bool = False,
    quarantine_measures: bool = False,
    gated: bool = True,
) -> Run:
    """Ingest the raw sources, build every layer, store it and check it.

    ``registers`` are the register snapshots, named by their date; ``measures`` and ``surveys`` are
    single sources of ``reference_date``. With ``large_surveys`` the survey documents are landed by their elements,
    so that no task holds a whole one. With ``keep_dates`` fact, mart and partial answers keep the rows of earlier dates:
    a run replaces those of the newest register's date only (see :func:`history` and :func:`answer_over`), while the
    tables of the run and its checks are about that date. ``quarantine_measures`` also stores the measurement rows without a
    key, which are left out otherwise. The first failing stage ends the run, and so does any
    failed expectation, unless ``gated`` is off: then the run ends with its results, failed ones among them.
    """
    out = out_dir.rstrip("/")
    done = Run()
    bronze = {n: SnapshotTable(spark, f"{out}/bronze/{n}") for n in ("imoveis", "patrimonio", "infraestrutura_predial")}

    def store(layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        done.tables[name] = write_layer(df, f"{out}/{layer}", name, partition_by)

    def store_dated(name: str, df: DataFrame) -> None:
        if keep_dates:
            newest = bronze["imoveis"].latest().label
            done.tables[name] = replace_partitions(df, f"{out}/gold", name, DATE, [newest])
        else:
            store("gold", name, df)

    def ingest() -> None:
        csv = delimited_reader(spark, root)
        ingest_snapshots(bronze["imoveis"], registers, csv, minimum_registers)
        ingest_one(bronze["patrimonio"], measures, csv, reference_date)
        documents = element_reader(spark, SURVEYS, root) if large_surveys else document_reader(spark, root)
        ingest_one(bronze["infraestrutura_predial"], surveys, documents, reference_date)

    def silver() -> None:
        register = bronze["imoveis"].current()
        store("silver", "stg_imoveis", stage_entity(register))
        store("silver", "quarentena_imoveis", stage_quarantine(register))
        store("silver", "stg_patrimonio", stage_measure(bronze["patrimonio"].current()))
        if quarantine_measures:
            store("silver", "quarentena_patrimonio", stage_measure_quarantine(bronze["patrimonio"].current()))
        store("silver", "stg_vistorias", stage_survey(bronze["infraestrutura_predial"].current()))
        store("silver", "stg_sanitarios", stage_items(done.tables["stg_vistorias"]))
        store("silver", "stg_reservatorios", stage_capacity(done.tables["stg_vistorias"]))

    def gold() -> None:
        t = done.tables
        for name, df in dims(t["stg_imoveis"]).items():
            store("gold", name, df)
        fact = build_fact(
            t["stg_imoveis"],
            t["stg_patrimonio"],
            reduce_items(t["stg_sanitarios"], t["stg_vistorias"]),
            reduce_capacity(t["stg_reservatorios"]),
        )
        store_dated("fato_imovel_snapshot", fact)
        store_dated("mart_indicadores_imoveis", wide_mart(t["fato_imovel_snapshot"], t))
        if keep_dates:
            store_dated(PARTIAL_SUMS, partial_answers(t["mart_indicadores_imoveis"]))
        for name, df in answers(t["mart_indicadores_imoveis"]).items():
            store("gold", name, df)

    def check() -> None:
        done.results = q.run_suite(done.tables, expectations(expected))
        if gated:
            q.gate(done.results)

    for name, work in (("ingest", ingest), ("silver", silver), ("gold", gold), ("expectations", check)):
        done.stage(name, work)
    return done
