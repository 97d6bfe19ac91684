"""Typing, conforming, classification, number formats and quantity texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from sediment.functions import measures, text
from sediment.functions.keys import date_key
from sediment.operators.quarantine import KeyRule, label_rows, quarantine, split_valid
from sediment.plans.order_star import table

# Raw view of the pages: the last part of the path is sometimes a clean number, sometimes not.
PAGE_SQL = """
with raw as (
  select page_id, url, split_part(url, '/', 5) as tail, split_part(url, '/', 4) as section from pages
)
"""


def raw_pages(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.split_part(url, F.lit("/"), F.lit(5)).alias("tail"),
        F.split_part(url, F.lit("/"), F.lit(4)).alias("section"),
    )


@query(
    "clean_and_safe_cast",
    PAGE_SQL
    + """
select page_id, nullif(trim(section), '') as section, upper(nullif(trim(section), '')) as section_upper,
  case when regexp_full_match(trim(tail), '[0-9]+') then cast(trim(tail) as integer) end as number,
  regexp_full_match(trim(tail), '[0-9]+') as is_key, cast(null as varchar) as kind
from raw
""",
)
def clean_and_safe_cast(spark, sf_dir):
    section = text.clean_text("section")
    return raw_pages(spark, sf_dir).select(
        "page_id",
        section.alias("section"),
        text.conform(section).alias("section_upper"),
        text.safe_key("tail").alias("number"),
        text.valid_key("tail").alias("is_key"),
        F.lit(None).cast("string").alias("kind"),
    )


@query(
    "safe_typed_columns",
    """
select event_id, try_cast(trim(cast(value as varchar)) as decimal(18,2))::double as amount,
  cast(round(value) as integer) as whole, cast(cast(ts as date) as varchar) as day,
  cast(null as varchar) as not_a_day, cast(strftime(ts, '%Y%m%d') as integer) as day_key
from events
""",
)
def safe_typed_columns(spark, sf_dir):
    """Numbers and dates that arrive as text; the event type is not a date and becomes NULL."""
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("value").cast("string").alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "event_type",
    )
    day = text.safe_date("day")
    return raw.select(
        "event_id",
        F.col("value").try_cast("decimal(18,2)").cast("double").alias("amount"),
        text.safe_int("value").alias("whole"),
        day.cast("string").alias("day"),
        text.safe_date("event_type").cast("string").alias("not_a_day"),
        date_key(day).alias("day_key"),
    )


@query(
    "classify_like",
    """
select p_partkey, case when upper(p_name) like 'SMALL%' then 'SMALL' when upper(p_name) like '%BOLT%' then 'FASTENER'
  when upper(p_name) like '%RING' then 'RING' else 'OTHER' end as family, 'UNKNOWN' as physical_type
from part
""",
)
def classify_like(spark, sf_dir):
    rules = [("SMALL%", "SMALL"), ("%BOLT%", "FASTENER"), ("%RING", "RING")]
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.classify_like("p_name", rules, "OTHER").alias("family"),
        F.lit("UNKNOWN").alias("physical_type"),
    )


@query(
    "map_domain",
    """
select o_orderkey, case o_orderpriority when '1-URGENT' then 'HIGH' when '2-HIGH' then 'HIGH' when '5-LOW' then 'LOW'
  else 'UNSPECIFIED' end as priority from orders
""",
)
def map_domain(spark, sf_dir):
    domain = {"1-urgent": "HIGH", "2-high": "HIGH", "5-low": "LOW"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.map_domain("o_orderpriority", domain, "UNSPECIFIED").alias("priority")
    )


@query(
    "br_decimal_roundtrip",
    "select l_returnflag, count(*) as rows, count(*) as equal_rows, "
    "sum(cast(l_extendedprice as decimal(18,2)))::double as total from lineitem group by l_returnflag",
)
def br_decimal_roundtrip(spark, sf_dir):
    """Write every price as 44.473,56 and read it back."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    back = measures.parse_decimal("shown")
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_returnflag", price.alias("price"), measures.format_decimal(price, 2).alias("shown"))
        .groupBy("l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(back == F.col("price")).alias("equal_rows"),
            F.sum(back).cast("double").alias("total"),
        )
    )


@query(
    "br_format",
    """
select c_custkey, coalesce(translate(format('{:,.2f}', case when c_acctbal >= 0 then c_acctbal end), ',.', '.,'), '—')
  as shown from customer
""",
)
def br_format(spark, sf_dir):
    """Negative balances count as not shown."""
    credit = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(18,2)"))
    return table(spark, sf_dir, "customer").select("c_custkey", measures.format_decimal(credit, 2).alias("shown"))


@query(
    "quantity_expr",
    """
select l_returnflag, count(*) as rows, sum(l_linenumber * cast(l_quantity * 1000 as bigint) + cast(l_quantity as bigint))
  ::bigint as total, (2 * count(*))::bigint as terms, count(*) as interpreted from lineitem group by l_returnflag
""",
)
def quantity_expr(spark, sf_dir):
    """Every line item written as '3 x 17.000 + 17 litros' and read back."""
    whole = F.col("l_quantity").cast("bigint")
    declared = F.concat(
        F.col("l_linenumber").cast("string"), F.lit(" x "), whole.cast("string"), F.lit(".000 + "),
        whole.cast("string"), F.lit(" litros"),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", declared.alias("declared"))
    read = measures.with_quantity(lines, "declared", strict=True)
    return read.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("total").alias("total"),
        F.sum("terms").alias("terms"),
        F.count_if(F.col("status") == measures.STATUS_PARSED).alias("interpreted"),
    )


@query(
    "quantity_in_text",
    """
with found as (
  select doc_id, lower(text) as t,
    regexp_extract_all(lower(text), '(?:[0-9]+[ \\t\\n\\f\\r\\v]*x[ \\t\\n\\f\\r\\v]*)?[0-9][0-9.]*') as terms
  from documents
), amounts as (
  select *, list_transform(terms, lambda e:
      (case when contains(e, 'x') then try_cast(trim(split_part(e, 'x', 1)) as bigint) else 1 end)::hugeint
      * try_cast(replace(trim(list_extract(string_split(e, 'x'), -1)), '.', '') as bigint)::hugeint) as parts
  from found
), fitting as (
  select *, case when len(parts) > 0 and len(list_filter(parts, lambda a: a is null or a > 9223372036854775807)) = 0
                  and list_sum(parts) <= 9223372036854775807 then list_sum(parts)::bigint end as whole from amounts
)
select doc_id, nullif(len(terms), 0)::bigint as terms,
  whole as total, case when whole is null then 'NAO_INTERPRETADO' else 'INTERPRETADO' end as status
from fitting
""",
)
def quantity_in_text(spark, sf_dir):
    """The same grammar over whole documents, where most text is not a quantity."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return measures.with_quantity(documents, "text").drop("text")


# Documents keyed by their label: the ones without a label have a name but no reliable key.
REGISTER_SQL = """
with register as (
  select d.doc_id + 1 as line, coalesce(' ' || cast(l.doc_id as varchar) || ' ', '') as key, d.source, d.lang,
         case when l.toxic = 1 then '' else d.source end as name
  from documents d left join labels l on d.doc_id = l.doc_id
)
"""


def register(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    joined = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(
        labels.select("doc_id", "toxic", F.col("doc_id").alias("label_id")), "doc_id", "left"
    )
    padded = F.concat(F.lit(" "), F.col("label_id").cast("string"), F.lit(" "))
    return joined.select(
        (F.col("doc_id") + 1).cast("string").alias("line"),
        F.coalesce(padded, F.lit("")).alias("key"),
        "source",
        "lang",
        F.when(F.col("toxic") == 1, "").otherwise(F.col("source")).alias("name"),
    )


RULE = KeyRule("key", "name", "line", first_data_row=5)


@query(
    "quarantine_rows",
    REGISTER_SQL
    + """
select line::integer as line, nullif(trim(key), '') as original_key, nullif(trim(name), '') as original_name,
  nullif(trim(lang), '') as original_lang, 'ID_PREDIO_AUSENTE_OU_INVALIDO' as reason
from register where line >= 5 and trim(key) = '' and trim(name) <> ''
""",
)
def quarantine_rows(spark, sf_dir):
    originals = {"original_key": "key", "original_name": "name", "original_lang": "lang"}
    return quarantine(register(spark, sf_dir), RULE, {"line": "line"}, originals)


@query(
    "split_valid",
    REGISTER_SQL
    + """
select case when trim(key) <> '' then 'good' when line >= 5 and trim(name) <> '' then 'bad' else 'structural' end as part,
  count(*) as rows, min(line)::bigint as first_line, max(line)::bigint as last_line from register group by 1
""",
)
def split_rows(spark, sf_dir):
    good, bad, structural = split_valid(register(spark, sf_dir), RULE)
    parts = [df.withColumn("part", F.lit(n)) for n, df in (("good", good), ("bad", bad), ("structural", structural))]
    line = F.col("line").cast("bigint")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min(line).alias("first_line"), F.max(line).alias("last_line")
    )


@query(
    "record_kinds",
    REGISTER_SQL
    + """
select lang, case when trim(key) <> '' then 'good' when line >= 5 and trim(name) <> '' then 'bad' else 'structural' end
  as record_kind, count(*) as rows from register group by 1, 2
""",
)
def record_kinds(spark, sf_dir):
    return label_rows(register(spark, sf_dir), RULE).groupBy("lang", "record_kind").agg(
        F.count(F.lit(1)).alias("rows")
    )
