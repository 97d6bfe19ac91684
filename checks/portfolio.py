"""Every stage of the portfolio job over raw records made from the given tables.

Register: one record per customer; customers in debt come without a key. Measurements: customers with
orders of the first three priorities, filled ones as built area and open ones as land. Surveys: one per
customer with orders of the other priorities, whose counts become fittings and tank texts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import functions as F

from checks.registry import query
from sediment.functions.measures import format_decimal, from_scaled, scaled
from sediment.operators import metrics
from sediment.operators import quality as q
from sediment.operators.documents import nest_items
from sediment.plans import portfolio as p
from sediment.plans.order_star import table
from sediment.session import scratch
from sediment.sources.layers import write_layer
from sediment.sources.snapshots import SnapshotTable
from sediment.sources.provenance import DOCUMENT, ORIGIN, RECORD_NUMBER, VERSION

DAY = "2001-08-01"
KINDS = {"BUILDING": "Próprio / ocupado", "FURNITURE": "PID — cedido", "HOUSEHOLD": "Próprio — Prédio avulso"}

BASE_SQL = """
with placed as (
  select c_custkey as id, c_acctbal >= 0 as keyed, c_custkey + 5 as line, c_name as name, c_mktsegment as segment,
         upper(n_name) as comarca, upper(r_name) as cidade
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
), reg as (
  select *, case segment when 'BUILDING' then 'PROPRIO' when 'HOUSEHOLD' then 'PROPRIO' when 'FURNITURE' then 'CEDIDO'
              else 'NAO_INFORMADO' end as ownership,
            case segment when 'FURNITURE' then 'PID' when 'HOUSEHOLD' then 'PREDIO_AVULSO'
              else 'IMOVEL_INSTITUCIONAL' end as category
  from placed
), urgent as (
  select o_custkey as id, sum(cast(round(o_totalprice * 100) as bigint)) filter (where o_orderstatus = 'F') as built,
         sum(cast(round(o_totalprice * 100) as bigint)) filter (where o_orderstatus = 'O') as land,
         count(*) filter (where o_orderstatus = 'P') as partial
  from orders where o_orderpriority < '4' group by o_custkey
), measure as (
  select id, built::double / 100 as built, land::double / 100 as land,
         case partial when 0 then 'PROPRIO' when 1 then 'CEDIDO' else 'NAO_INFORMADO' end as status from urgent
), low as (
  select o_custkey as id, count(*) filter (where o_orderstatus = 'F') as f,
         count(*) filter (where o_orderstatus = 'O') as o, count(*) filter (where o_orderstatus = 'P') as p
  from orders where o_orderpriority >= '4' group by o_custkey
), tank as (
  select id, 'A' as posicao, case when f > 0 then f || ' x 1.000 + ' || o when o > 0 then 'cheia' end as raw,
         case when f > 0 then 2 end as terms, case when f > 0 then f * 1000 + o end as litres from low
  union all
  select id, 'B', case when p > 0 then p || '.000 litros' end, case when p > 0 then 1 end,
         case when p > 0 then p * 1000 end from low
), capacity as (
  select id, count(raw) as declared, count(*) filter (where raw is not null and terms is null) as unread,
         case when count(raw) > 0 and count(*) filter (where raw is not null and terms is null) = 0
              then sum(litres)::bigint end as litres
  from tank group by id
), items as (
  select id, f::integer as shared, case when p > 0 then p::integer end as private, o::integer as basins from low
), fact as (
  select r.id, r.comarca, r.cidade, r.ownership, coalesce(m.status, 'NAO_INFORMADO') as status, m.built, m.land,
         i.shared + i.private as fittings, i.basins, c.litres, m.id is not null as measured, i.id is not null as surveyed,
         m.built is not null and m.land is not null and m.land > 0 as eligible,
         case when m.land > 0 then round(100 * m.built / m.land, 4) end as idx,
         case when m.built > 0 then round(1000.0 * (i.shared + i.private) / m.built, 4) end as density,
         case when m.built > 0 then round(c.litres / m.built, 4) end as reserve
  from reg r left join measure m using (id) left join items i using (id) left join capacity c using (id) where r.keyed
)
"""


def provenance(line):
    return [
        F.lit("derived").alias(ORIGIN),
        F.lit(DAY).alias(VERSION),
        line.cast("string").alias(RECORD_NUMBER),
    ]


def raw_register(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    )
    kind = F.lit("A definir")
    for segment, words in KINDS.items():
        kind = F.when(F.col("c_mktsegment") == segment, words).otherwise(kind)
    key = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" "), F.col("c_custkey").cast("string"))).otherwise("")
    cells = {
        "col_01": key, "col_02": F.col("c_name"), "col_03": kind, "col_04": F.col("c_mktsegment"),
        "col_05": F.lower("n_name"), "col_08": F.initcap("r_name"), "col_09": F.lit("ms"),
    }
    blank = [c for c in (f"col_{i:02d}" for i in range(1, 13)) if c not in cells]
    return rows.select(
        *[v.alias(k) for k, v in cells.items()],
        *[F.lit("").alias(c) for c in blank],
        *provenance(F.col("c_custkey") + 5),
    )


def raw_measures(spark, sf_dir):
    cents, status = scaled("o_totalprice"), F.col("o_orderstatus")
    urgent = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") < "4")
        .groupBy("o_custkey")
        .agg(
            F.sum(F.when(status == "F", cents)).alias("built"),
            F.sum(F.when(status == "O", cents)).alias("land"),
            F.count_if(status == "P").alias("partial"),
        )
    )

    def shown(c):
        return F.when(F.col(c).isNull(), "").otherwise(format_decimal(from_scaled(c)))

    tenure = F.when(F.col("partial") == 0, " Próprio ").when(F.col("partial") == 1, "cedido").otherwise("vários")
    return urgent.select(
        F.col("o_custkey").cast("string").alias("col_01"), F.lit("").alias("col_02"), tenure.alias("col_03"),
        shown("built").alias("col_04"), shown("land").alias("col_05"), F.lit("").alias("col_06"), F.lit("").alias("col_07"),
        *provenance(F.col("o_custkey") + 5),
    )


def raw_surveys(spark, sf_dir):
    status = F.col("o_orderstatus")
    low = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") >= "4")
        .groupBy("o_custkey")
        .agg(*[F.count_if(status == s.upper()).alias(s) for s in "fop"])
        .select("o_custkey", *[F.col(s).cast("string").alias(s) for s in "fop"])
    )
    private = F.when(F.col("p") == "0", "").otherwise(F.col("p"))
    tank_a = (
        F.when(F.col("f") != "0", F.concat("f", F.lit(" x 1.000 + "), "o")).when(F.col("o") != "0", "cheia").otherwise("")
    )
    tank_b = F.when(F.col("p") != "0", F.concat("p", F.lit(".000 litros"))).otherwise("")

    def tank(position, text):
        return F.struct(
            F.lit(position).alias("posicao"), text.alias("capacidade_declarada"), F.lit("x").alias("material_declarado")
        )

    survey = F.struct(
        F.col("o_custkey").cast("string").alias("id_predio"),
        F.lit(" s ").alias("nome_na_fonte"),
        F.lit(DAY).alias("data_referencia"),
        nest_items("tipo", "quantidade_declarada", {"coletivo": "f", "privativo": private}).alias("sanitarios"),
        F.struct(
            F.col("o").alias("vasos_declarados"), F.lit("").alias("mictorios_declarados"), F.lit("0").alias("lavatorios_declarados")
        ).alias("loucas"),
        F.array(tank("a", tank_a), tank("b", tank_b)).alias("reservatorios"),
    )
    return low.select(F.to_json(F.struct(F.array(survey).alias("vistorias"))).alias(DOCUMENT))


def entities(spark, sf_dir):
    return p.stage_entity(raw_register(spark, sf_dir))


def measures(spark, sf_dir):
    return p.stage_measure(raw_measures(spark, sf_dir))


def surveys(spark, sf_dir):
    return p.stage_survey(raw_surveys(spark, sf_dir))


def items_at_grain(spark, sf_dir):
    found = surveys(spark, sf_dir)
    return p.reduce_items(p.stage_items(found), found)


def capacity_at_grain(spark, sf_dir):
    return p.reduce_capacity(p.stage_capacity(surveys(spark, sf_dir)))


def fact(spark, sf_dir):
    return p.build_fact(
        entities(spark, sf_dir), measures(spark, sf_dir), items_at_grain(spark, sf_dir), capacity_at_grain(spark, sf_dir)
    )


def mart(spark, sf_dir):
    return p.wide_mart(fact(spark, sf_dir), p.dims(entities(spark, sf_dir)))


def doubles(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query(
    "stage_entity",
    BASE_SQL
    + f"""
select id::integer as id_predio, name as nome_oficial, ownership as propriedade, category as categoria_funcional,
  comarca as comarca_normalizada, cidade as cidade_normalizada, 'MS' as uf, '{DAY}' as data_referencia,
  line::integer as linha_origem, 'NAO_INFORMADO' as tipo_imovel, cast(null as varchar) as cep
from reg where keyed
""",
)
def stage_entity(spark, sf_dir):
    return entities(spark, sf_dir).select(
        "id_predio", "nome_oficial", "propriedade", "categoria_funcional", "comarca_normalizada", "cidade_normalizada",
        "uf", F.col("data_referencia").cast("string").alias("data_referencia"), "linha_origem", "tipo_imovel", "cep",
    )


@query(
    "stage_quarantine",
    BASE_SQL
    + """
select 'derived' as _arquivo_origem, line::integer as linha_origem, cast(null as varchar) as id_predio_original,
  name as nome_original, case segment when 'BUILDING' then 'Próprio / ocupado' when 'FURNITURE' then 'PID — cedido'
    when 'HOUSEHOLD' then 'Próprio — Prédio avulso' else 'A definir' end as classificacao_original,
  lower(comarca) as comarca_original, 'ID_PREDIO_AUSENTE_OU_INVALIDO' as motivo_quarentena
from reg where not keyed
""",
)
def stage_quarantine(spark, sf_dir):
    return p.stage_quarantine(raw_register(spark, sf_dir))


@query(
    "stage_measure",
    BASE_SQL
    + """
select id::integer as id_predio, status as situacao_patrimonial, built as area_construida_m2, land as area_terreno_m2,
  cast(null as double) as area_arquivo_m2 from measure
""",
)
def stage_measure(spark, sf_dir):
    areas = ["area_construida_m2", "area_terreno_m2", "area_arquivo_m2"]
    return doubles(measures(spark, sf_dir).select("id_predio", "situacao_patrimonial", *areas), *areas)


@query(
    "stage_survey",
    BASE_SQL
    + f"""
select id::integer as id_predio, 's' as nome_na_fonte, '{DAY}' as data_referencia, basins as vasos,
  cast(null as integer) as mictorios, 0 as lavatorios from items
""",
)
def stage_survey(spark, sf_dir):
    found = surveys(spark, sf_dir).drop("sanitarios_json", "reservatorios_json")
    return found.withColumn("data_referencia", F.col("data_referencia").cast("string"))


@query(
    "stage_items",
    BASE_SQL
    + """
select id::integer as id_predio, 'COLETIVO' as tipo_sanitario, shared as quantidade, shared::varchar as quantidade_original
from items union all select id::integer, 'PRIVATIVO', private, private::varchar from items
""",
)
def stage_items(spark, sf_dir):
    return p.stage_items(surveys(spark, sf_dir)).drop("data_referencia")


@query(
    "stage_capacity",
    BASE_SQL
    + """
select id::integer as id_predio, posicao, raw as capacidade_original, terms::bigint as termos_reconhecidos,
  litres::bigint as capacidade_total_litros, case when raw is null then 'SEM_CAPACIDADE_DECLARADA'
  when terms is null then 'NAO_INTERPRETADO' else 'INTERPRETADO' end as status_interpretacao from tank
""",
)
def stage_capacity(spark, sf_dir):
    return p.stage_capacity(surveys(spark, sf_dir)).drop("data_referencia", "material_original")


@query(
    "reduce_items",
    BASE_SQL
    + """
select id::integer as id_predio, shared as sanitarios_coletivos, private as sanitarios_privativos,
  shared + private as sanitarios_total, private is not null as tem_sanitarios_completos, basins as vasos,
  cast(null as integer) as mictorios, 0 as lavatorios from items
""",
)
def reduce_items(spark, sf_dir):
    return items_at_grain(spark, sf_dir).drop("data_referencia")


@query(
    "reduce_capacity",
    BASE_SQL
    + """
select id::integer as id_predio, declared as declaracoes_capacidade, unread as declaracoes_nao_interpretadas,
  litres as capacidade_total_litros, declared > 0 as tem_reservacao_informada from capacity
""",
)
def reduce_capacity(spark, sf_dir):
    return capacity_at_grain(spark, sf_dir).drop("data_referencia")


@query(
    "build_fact",
    BASE_SQL
    + """
select id::integer as id_predio, md5(id::varchar) as imovel_sk, md5(comarca || '|' || cidade || '|MS') as localidade_sk,
  20010801 as data_referencia_sk, status as situacao_patrimonial, fittings as sanitarios_total, basins as vasos,
  litres as capacidade_total_litros, measured as tem_medicao_patrimonial, surveyed as tem_vistoria_infraestrutura,
  eligible as elegivel_indice_aproveitamento, idx as indice_aproveitamento_pct,
  density as densidade_sanitaria_por_1000_m2, reserve as reserva_litros_por_m2 from fact
""",
)
def build_fact(spark, sf_dir):
    return fact(spark, sf_dir).drop(
        "data_referencia", "area_construida_m2", "area_terreno_m2", "area_arquivo_m2", "sanitarios_coletivos",
        "sanitarios_privativos", "tem_sanitarios_completos", "mictorios", "lavatorios", "tem_reservacao_informada",
    )


@query(
    "wide_mart",
    BASE_SQL
    + f"""
select id::integer as id_predio, comarca, cidade, 'MS' as uf, ownership as propriedade, status as situacao_patrimonial,
  built as area_construida_m2, land as area_terreno_m2, idx as indice_aproveitamento_pct, '{DAY}' as data_referencia,
  2001 as ano, 8 as mes, 3 as trimestre from fact
""",
)
def wide_mart(spark, sf_dir):
    rows = mart(spark, sf_dir).select(
        "id_predio", "comarca", "cidade", "uf", "propriedade", "situacao_patrimonial", "area_construida_m2",
        "area_terreno_m2", "indice_aproveitamento_pct", F.col("data_referencia").cast("string").alias("data_referencia"),
        "ano", "mes", "trimestre",
    )
    return doubles(rows, "area_construida_m2", "area_terreno_m2")


ANSWER_SQL = """
  count(*) as imoveis_cadastrados, {measured} count(idx) as imoveis_elegiveis,
  floor(100 * (sum(idx) / count(idx)) + 0.5) / 100 as media_indice_individual_pct,
  floor(100 * (100.0::double * (sum(round(built * 100)::bigint) filter (where eligible))::double
        / nullif((sum(round(land * 100)::bigint) filter (where eligible))::double, 0)) + 0.5) / 100
    as indice_global_ponderado_pct
"""


@query(
    "answer_overall",
    BASE_SQL
    + f"select '{DAY}' as data_referencia,"
    + ANSWER_SQL.format(measured="count(*) filter (where measured) as imoveis_com_medicao_patrimonial,")
    + "from fact",
)
def answer_overall(spark, sf_dir):
    found = p.answers(mart(spark, sf_dir))["agg_aproveitamento_geral"]
    return found.withColumn("data_referencia", F.col("data_referencia").cast("string"))


@query(
    "answer_by_district",
    BASE_SQL
    + f"select '{DAY}' as data_referencia, comarca, status as situacao_patrimonial,"
    + ANSWER_SQL.format(measured="")
    + "from fact group by comarca, status",
)
def answer_by_district(spark, sf_dir):
    found = p.answers(mart(spark, sf_dir))["agg_aproveitamento_comarca"]
    return found.withColumn("data_referencia", F.col("data_referencia").cast("string"))


@query(
    "answer_coverage",
    BASE_SQL
    + """
select count(*) as total_imoveis, count(built) as com_area_construida, count(land) as com_area_terreno,
  count(idx) as elegiveis_indice, count(fittings) as com_sanitarios_completos, count(litres) as com_reservacao_informada
from fact
""",
)
def answer_coverage(spark, sf_dir):
    tables = {"mart_indicadores_imoveis": mart(spark, sf_dir), "quarentena_imoveis": stage_quarantine(spark, sf_dir)}
    found = p.answers(tables["mart_indicadores_imoveis"])
    return p.answer({**tables, **found})["cobertura"]


@query(
    "answer_gaps",
    BASE_SQL
    + """
select case when not measured then 'Sem registro patrimonial'
  when built is null and land is null then 'Falta área construída e área de terreno'
  when built is null then 'Falta área construída' when land is null then 'Falta área de terreno'
  else 'Área de terreno igual a zero' end as falta, count(*) as rows
from fact where not eligible group by 1
""",
)
def answer_gaps(spark, sf_dir):
    return p.gaps(fact(spark, sf_dir))


SUITE_SQL = """
with orphans as (
  select id from (select distinct o_custkey as id from orders where o_orderpriority < '4')
  where id not in (select c_custkey from customer where c_acctbal >= 0)
), lost as (
  select id from (select distinct o_custkey as id from orders where o_orderpriority >= '4')
  where id not in (select c_custkey from customer where c_acctbal >= 0)
), unread as (
  select o_custkey from orders where o_orderpriority >= '4' group by 1
  having count(*) filter (where o_orderstatus = 'F') = 0 and count(*) filter (where o_orderstatus = 'O') > 0
)
select 'stg_patrimonio' as "table", 'relationships' as kind, (select count(*) from orphans) as failures
union all select 'stg_vistorias', 'relationships', (select count(*) from lost)
union all select 'stg_sanitarios', 'relationships', (select 2 * count(*) from lost)
union all select 'stg_reservatorios', 'relationships', (select 2 * count(*) from lost)
union all select 'stg_reservatorios', 'interpreted', (select count(*) from unread)
"""


@query("portfolio_suite", SUITE_SQL)
def portfolio_suite(spark, sf_dir):
    """All checks of the job over its stored tables; those that fail, with their counts."""
    root, tables = scratch(spark, "portfolio"), {}

    def store(name, df):
        tables[name] = write_layer(df, root, name)
        return tables[name]

    raw = raw_register(spark, sf_dir)
    register = store("stg_imoveis", p.stage_entity(raw))
    store("quarentena_imoveis", p.stage_quarantine(raw))
    areas = store("stg_patrimonio", measures(spark, sf_dir))
    found = store("stg_vistorias", surveys(spark, sf_dir))
    items = store("stg_sanitarios", p.stage_items(found))
    tanks = store("stg_reservatorios", p.stage_capacity(found))
    dims = {name: store(name, df) for name, df in p.dims(register).items()}
    star = p.build_fact(register, areas, p.reduce_items(items, found), p.reduce_capacity(tanks))
    wide = store("mart_indicadores_imoveis", p.wide_mart(store("fato_imovel_snapshot", star), dims))
    for name, df in p.answers(wide).items():
        store(name, df)
    results = q.run_suite(tables, p.expectations())
    return results.filter(F.col("status") == q.FAIL).select("table", "kind", "failures")


@query(
    "measure_quarantine",
    BASE_SQL
    + """
select case when id % 10 <> 0 then id end::integer as id_predio, (id + 5)::integer as linha_origem,
  case when id % 10 = 0 then 'ID_PREDIO_AUSENTE_OU_INVALIDO' end as motivo_quarentena, built as area_construida_m2
from measure
""",
)
def measure_quarantine(spark, sf_dir):
    """Every measurement row is either typed or set aside: every tenth one comes without a key."""
    raw = raw_measures(spark, sf_dir)
    raw = raw.withColumn("col_01", F.when(F.col("col_01").cast("bigint") % 10 == 0, F.lit(" ")).otherwise(F.col("col_01")))
    typed = p.stage_measure(raw).select(p.KEY, "linha_origem", F.lit(None).cast("string").alias("motivo_quarentena"), "area_construida_m2")
    aside = p.stage_measure_quarantine(raw)
    aside = aside.select(F.lit(None).cast("int").alias(p.KEY), "linha_origem", "motivo_quarentena", p.parse_decimal("area_construida_original").alias("area_construida_m2"))
    return typed.unionByName(aside).withColumn("area_construida_m2", F.col("area_construida_m2").cast("double"))


# --- the whole job, from text files to answers -----------------------------------------------------

PARTS = 4  # files of each register snapshot, at least
ROWS_PER_PART = 100_000
SURVEYS_PER_DOCUMENT = 1000
PREAMBLE = [["Cadastro"], ["Nota"], [], ["ID Prédio", "Nome Oficial", "Tipo de Imóvel", "", "Comarca", "", "", "Cidade", "UF"]]
SNAPSHOTS = {"2001-07-01": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], DAY: None}

# In these files every tank text can be read and only customers with a key are measured, so the gate lets them pass.
JOB_SQL = BASE_SQL.replace("then 'cheia' end", "then o || ' litros' end").replace(
    "case when f > 0 then 2 end as terms, case when f > 0 then f * 1000 + o end",
    "case when f > 0 then 2 when o > 0 then 1 end as terms, case when f > 0 then f * 1000 + o when o > 0 then o end",
)


def parts_of(spark, sf_dir):
    """Files of each register snapshot: a file is written by one task, so their number follows the rows."""
    return max(PARTS, math.ceil(table(spark, sf_dir, "customer").count() / ROWS_PER_PART))


def write_parts(rows, path, number, parts=PARTS):
    """Semicolon-separated files, each with four records in front: title, note, blank and header."""
    spark, columns = rows.sparkSession, [c for c in rows.columns if c.startswith("col_")]
    rows = rows.select(F.pmod(number, F.lit(parts)).cast("int").alias("part"), number.cast("bigint").alias("at"), *columns)
    front = [(k, n - 10, *(cells + [""] * len(columns))[: len(columns)]) for k in range(parts) for n, cells in enumerate(PREAMBLE)]
    both = rows.unionByName(spark.createDataFrame(front, rows.schema))
    both.repartition("part").sortWithinPartitions("part", "at").drop("at").write.options(
        sep=";", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue=""
    ).partitionBy("part").csv(path)
    return path


def job_files(spark, sf_dir, clean=True, parts=None):
    """Two register snapshots, measurements and surveys as files below a fresh folder.

    ``clean`` leaves out what the gate would stop; otherwise every row of the three sources is written as it is.
    """
    root = scratch(spark, "job-raw")
    parts = parts or parts_of(spark, sf_dir)
    register = raw_register(spark, sf_dir)
    number = F.col(RECORD_NUMBER).cast("bigint")
    snapshots = []
    for label, segments in SNAPSHOTS.items():
        rows = register if segments is None else register.filter(F.col("col_04").isin(segments))
        snapshots.append(write_parts(rows, f"{root}/imoveis/{label}", number, parts))
    keyed = table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").cast("string").alias("col_01"))
    areas = raw_measures(spark, sf_dir)
    measured = write_parts(areas.join(keyed, "col_01") if clean else areas, f"{root}/patrimonio", F.col("col_01").cast("bigint"), parts)
    one = F.from_json(F.replace(DOCUMENT, F.lit('"cheia"'), F.lit('"READ"')) if clean else DOCUMENT, "vistorias array<string>").getField("vistorias")
    surveys = raw_surveys(spark, sf_dir).select(F.explode(one).alias("survey"))
    surveys = surveys.withColumn("id_predio", F.get_json_object("survey", "$.id_predio"))
    if clean:
        basins = F.get_json_object("survey", "$.loucas.vasos_declarados")
        readable = F.replace("survey", F.lit('"READ"'), F.concat(F.lit('"'), basins, F.lit(' litros"')))
        surveys = surveys.join(keyed.withColumnRenamed("col_01", "id_predio"), "id_predio").withColumn("survey", readable)
    batch = F.floor(F.col("id_predio").cast("bigint") / SURVEYS_PER_DOCUMENT)
    bodies = surveys.groupBy(batch.alias("batch")).agg(F.array_join(F.sort_array(F.collect_list("survey")), ", ").alias("body"))
    document = F.concat(F.lit('{"vistorias": ['), "body", F.lit("]}"))
    # one document per file, all in one folder: a folder for each would cost the listing a task per document
    bodies.select(document.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{root}/vistorias")
    return root, snapshots, measured, f"{root}/vistorias"


def job(spark, sf_dir, parts=None):
    root, registers, measured, surveyed = job_files(spark, sf_dir, parts=parts)
    out = scratch(spark, "job")
    return p.run(spark, registers, measured, surveyed, out, DAY, root=root), out


@query(
    "portfolio_run",
    JOB_SQL
    + f"select '{DAY}' as data_referencia, comarca, status as situacao_patrimonial,"
    + ANSWER_SQL.format(measured="")
    + ", row_number() over (order by comarca, status) as position from fact group by comarca, status",
)
def portfolio_run(spark, sf_dir):
    """The whole job from text files, through ingestion, all layers and the gate, to the answer by district in order."""
    done, _ = job(spark, sf_dir)
    found = done.tables["agg_aproveitamento_comarca"].withColumn("data_referencia", F.col("data_referencia").cast("string"))
    return metrics.with_position(found, metrics.key_order("comarca", "situacao_patrimonial"))


@query("portfolio_failures", SUITE_SQL)
def portfolio_failures(spark, sf_dir):
    """The whole job on files from which nothing was taken out: the expectations that fail, with their counts."""
    root, registers, measured, surveyed = job_files(spark, sf_dir, clean=False)
    done = p.run(spark, registers, measured, surveyed, scratch(spark, "job"), DAY, root=root, gated=False)
    return done.results.filter(F.col("status") == q.FAIL).select("table", "kind", "failures")


@query(
    "portfolio_models",
    JOB_SQL
    + """
, counts(model, rows) as (
  select 'stg_imoveis', count(*) from reg where keyed union all select 'quarentena_imoveis', count(*) from reg where not keyed
  union all select 'stg_patrimonio', count(*) from measure join reg using (id) where keyed
  union all select 'stg_vistorias', count(*) from items join reg using (id) where keyed
  union all select 'stg_sanitarios', 2 * count(*) from items join reg using (id) where keyed
  union all select 'stg_reservatorios', count(*) from tank join reg using (id) where keyed
  union all select 'dim_imovel', count(*) from reg where keyed
  union all select 'dim_localidade', count(*) from (select distinct comarca, cidade from reg where keyed)
  union all select 'dim_tempo', 1 union all select 'fato_imovel_snapshot', count(*) from fact
  union all select 'mart_indicadores_imoveis', count(*) from fact union all select 'agg_aproveitamento_geral', 1
  union all select 'agg_aproveitamento_comarca', count(*) from (select distinct comarca, status from fact))
select model, rows::bigint as rows from counts
""",
)
def portfolio_models(spark, sf_dir):
    """Rows of every stored model of the whole job."""
    done, _ = job(spark, sf_dir)
    counted = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("model"), "rows") for n, df in done.tables.items()]
    return reduce(lambda a, b: a.unionByName(b), counted)


@query(
    "answer_quarantine",
    BASE_SQL
    + """
select name as nome_original, 'ID_PREDIO_AUSENTE_OU_INVALIDO' as motivo_quarentena,
  row_number() over (order by name) as position from reg where not keyed
""",
)
def answer_quarantine(spark, sf_dir):
    """The rows set aside by the whole job, in order."""
    done, _ = job(spark, sf_dir)
    rows = done.tables["quarentena_imoveis"].select("nome_original", "motivo_quarentena")
    return metrics.with_position(rows, metrics.key_order("nome_original"))


@query(
    "compare_register",
    BASE_SQL
    + f"""
select v.version, (count(*) + {4 * PARTS})::bigint as linhas_fisicas, count(*) filter (where keyed) as imoveis_com_id,
  count(*) filter (where not keyed) as registros_sem_id
from reg, (values (0), (1)) v(version) where v.version = 1 or segment <> 'AUTOMOBILE' group by v.version
""",
)
def compare_register(spark, sf_dir):
    """Both register snapshots, as landed by the whole job, side by side."""
    _, out = job(spark, sf_dir, PARTS)
    return p.compare_register(SnapshotTable(spark, f"{out}/bronze/imoveis"), [0, 1])


@query(
    "collections_fanout",
    BASE_SQL
    + """
select sum(2)::bigint as items, sum(2)::bigint as tanks, sum(4)::bigint as product from items
""",
)
def collections_fanout(spark, sf_dir):
    """What joining the two collections of a survey without reducing them first would give: computed, not made."""
    found = surveys(spark, sf_dir)
    items = p.stage_items(found).groupBy(p.KEY).agg(F.count(F.lit(1)).alias("items"))
    tanks = p.stage_capacity(found).groupBy(p.KEY).agg(F.count(F.lit(1)).alias("tanks"))
    both = items.join(tanks, p.KEY)
    return both.agg(F.sum("items").alias("items"), F.sum("tanks").alias("tanks"), F.sum(F.col("items") * F.col("tanks")).alias("product"))
