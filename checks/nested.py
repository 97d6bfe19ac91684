"""Nested collections, reduction to the fact grain and merges of source tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from sediment.functions.measures import STATUS_PARSED, complete, strict_add, with_quantity
from sediment.operators import documents as docs
from sediment.operators import reduce as red
from sediment.operators.star import with_parse_status
from sediment.plans.order_star import table


@query(
    "json_scalar",
    """
select event_id, json_extract_string(props, '$.k') as k, cast(json_extract_string(props, '$.k') as integer) as k_number,
  json_extract_string(props, '$.absent') as absent from events
""",
)
def json_scalar(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        docs.json_text("props", "$.k").alias("k"),
        docs.json_text("props", "$.k").try_cast("int").alias("k_number"),
        docs.json_text("props", "$.absent").alias("absent"),
    )


def customer_documents(spark, sf_dir):
    """One document per customer with its figures nested as (kind, declared) items."""
    items = docs.nest_items("kind", "declared", {"balance": "c_acctbal", "nation": "c_nationkey"})
    customers = table(spark, sf_dir, "customer").select(
        "*", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment")
    )
    return docs.nest_collections(customers, ["c_custkey", "c_name", "segment"], {"figures": items})


@query(
    "nest_collections",
    """
select c_custkey::varchar as id, json_type_name as segment_type, segment, nation::integer as nation from (
  select c_custkey, case when c_acctbal >= 0 then 'text' else 'null' end as json_type_name,
         case when c_acctbal >= 0 then c_mktsegment end as segment, c_nationkey as nation from customer)
""",
)
def nest_collections(spark, sf_dir):
    """Missing text stays visible in the document as JSON null."""
    shown = F.col("document").contains('"segment":null')
    return customer_documents(spark, sf_dir).select(
        docs.json_text("document", "$.c_custkey").alias("id"),
        F.when(shown, "null").otherwise("text").alias("segment_type"),
        docs.json_text("document", "$.segment").alias("segment"),
        docs.json_text("document", "$.figures[1].declared").try_cast("int").alias("nation"),
    )


@query(
    "json_explode",
    """
select c_custkey, 'BALANCE' as kind, c_acctbal as amount from customer
union all select c_custkey, 'NATION', cast(c_nationkey as double) from customer
""",
)
def json_explode(spark, sf_dir):
    rows = docs.explode_json(
        customer_documents(spark, sf_dir), "document", "$.figures", "item", "struct<kind:string,declared:string>"
    )
    return rows.select(
        docs.json_text("document", "$.c_custkey").try_cast("bigint").alias("c_custkey"),
        F.upper("item.kind").alias("kind"),
        F.col("item.declared").try_cast("double").alias("amount"),
    )


@query(
    "variant_explode",
    """
with items as (
  select c_custkey, 0 as item_pos, 'BALANCE' as kind, c_acctbal as amount from customer
  union all select c_custkey, 1, 'NATION', cast(c_nationkey as double) from customer)
select c_custkey, item_pos, 'kind' as field, kind, cast(null as double) as amount from items
union all select c_custkey, item_pos, 'declared', null, amount from items
""",
)
def variant_explode(spark, sf_dir):
    """Items of a collection and then the fields of each item, without the shape of either being named."""
    items = docs.explode_variant(customer_documents(spark, sf_dir), "document", "$.figures", "item")
    fields = docs.explode_variant(items, "item", "$", "field")
    name, value = F.col("field_key"), docs.variant_value("field", "$")
    return fields.select(
        docs.variant_value(F.parse_json("document"), "$.c_custkey", "bigint").alias("c_custkey"),
        "item_pos",
        name.alias("field"),
        F.when(name == "kind", F.upper(value)).alias("kind"),
        F.when(name == "declared", value.try_cast("double")).alias("amount"),
    )


@query(
    "json_explode_text",
    "select conv_id, turn, role, text from conversations",
)
def json_explode_text(spark, sf_dir):
    """Whole conversation texts through a nested document and back, element by element as JSON text."""
    turn = F.array(F.struct("role", "text"))
    nested = docs.nest_collections(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], {"turns": turn})
    rows = docs.explode_json(nested, "document", "$.turns", "item")
    return rows.select(
        docs.json_text("document", "$.conv_id").try_cast("bigint").alias("conv_id"),
        docs.json_text("document", "$.turn").try_cast("bigint").alias("turn"),
        docs.json_text("item", "$.role").alias("role"),
        docs.json_text("item", "$.text").alias("text"),
    )


@query(
    "item_pivot",
    """
with p as (
  select l_orderkey, max(case when l_returnflag = 'A' then cast(l_quantity as bigint) end) as accepted,
         max(case when l_returnflag = 'R' then cast(l_quantity as bigint) end) as returned
  from lineitem group by l_orderkey)
select l_orderkey, accepted, returned, accepted + returned as both_kinds,
  accepted is not null and returned is not null as is_complete from p
""",
)
def item_pivot(spark, sf_dir):
    """The sum of the two kinds exists only where both do."""
    lines = table(spark, sf_dir, "lineitem").withColumn("quantity", F.col("l_quantity").cast("bigint"))
    wide = red.pivot_max(lines, ["l_orderkey"], "l_returnflag", "quantity", {"A": "accepted", "R": "returned"})
    return wide.withColumns(
        {"both_kinds": strict_add("accepted", "returned"), "is_complete": complete("accepted", "returned")}
    )


@query(
    "strict_add",
    """
select source, count(*) as rows, sum(case when quality is not null and toxic is not null then quality + toxic end)::bigint
  as total, count(*) filter (where quality is not null and toxic is not null) as complete_rows
from documents left join labels using (doc_id) group by source
""",
)
def strict_add_query(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(strict_add("quality", "toxic")).alias("total"),
        F.count_if(complete("quality", "toxic")).alias("complete_rows"),
    )


@query(
    "sum_of_products",
    """
select l_suppkey, sum(l_linenumber * cast(l_quantity as bigint))::bigint as total from lineitem group by l_suppkey
""",
)
def sum_of_products(spark, sf_dir):
    total = red.sum_of_products(F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint"))
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(total.alias("total"))


# A label is a declaration: toxic ones count as unread, documents without a label declare nothing.
@query(
    "strict_sum",
    """
with d as (
  select source, lang, n_chars, quality, toxic from documents left join labels using (doc_id))
select source, lang, count(quality) as declared, count(*) filter (where quality is not null and toxic = 1) as unread,
  case when count(quality) > 0 and count(*) filter (where quality is not null and toxic = 1) = 0
       then sum(case when quality is not null then n_chars end)::bigint end as chars, count(quality) > 0 as any_declared
from d group by source, lang
""",
)
def strict_sum(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    ok = F.coalesce(F.col("toxic") != 1, F.lit(True))
    value = F.when(F.col("quality").isNotNull(), F.col("n_chars"))
    return rows.groupBy("source", "lang").agg(
        red.count_declared("quality").alias("declared"),
        red.count_unread("quality", ok).alias("unread"),
        red.strict_sum(value, "quality", ok).alias("chars"),
        red.any_declared("quality").alias("any_declared"),
    )


@query(
    "declared_text_sum",
    """
with d as (
  select conv_id, regexp_extract_all(lower(text), '(?:[0-9]+[ \\t\\n\\f\\r\\v]*x[ \\t\\n\\f\\r\\v]*)?[0-9][0-9.]*') as terms
  from conversations),
a as (
  select conv_id, list_sum(list_transform(terms, lambda e:
      (case when contains(e, 'x') then cast(trim(split_part(e, 'x', 1)) as bigint) else 1 end)::hugeint
      * cast(replace(trim(list_extract(string_split(e, 'x'), -1)), '.', '') as bigint)::hugeint))::bigint as amount from d)
select conv_id, count(*) as declared, count(*) filter (where amount is null) as unread, count(*) > 0 as any_declared,
  case when count(amount) = count(*) then sum(amount)::bigint end as total
from a group by conv_id
""",
)
def declared_text_sum(spark, sf_dir):
    """Turns read as quantity texts; one unread turn leaves the conversation without a total."""
    read = with_quantity(table(spark, sf_dir, "conversations"), "text")
    ok = F.col("status") == STATUS_PARSED
    return read.groupBy("conv_id").agg(
        red.count_declared("text").alias("declared"),
        red.count_unread("text", ok).alias("unread"),
        red.any_declared("text").alias("any_declared"),
        red.strict_sum("total", "text", ok).alias("total"),
    )


@query(
    "fanout_report",
    """
with o as (select o_custkey as k, count(*) as n from orders group by 1),
     l as (select o_custkey as k, count(*) as m from lineitem join orders on l_orderkey = o_orderkey group by 1)
select count(*) as keys, sum(n)::double as left_rows, sum(m)::double as right_rows,
  sum(n::hugeint * m)::double as joined_rows, max(n * m)::double as worst_key_rows
from o join l using (k)
""",
)
def fanout_report(spark, sf_dir):
    """Orders and line items of a customer: two collections that must not meet unreduced."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    report = red.fanout_report(orders.select("o_custkey"), lines.join(orders, "o_orderkey"), ["o_custkey"])
    return report.withColumns(
        {c: F.col(c).cast("double") for c in ("left_rows", "right_rows", "joined_rows", "worst_key_rows")}
    )


@query(
    "full_outer_merge",
    """
with a as (select cast(doc_id // 3 as varchar) as id, arg_max(lang, doc_id) as name, arg_max(source, doc_id) as source
           from documents group by 1),
     b as (select cast(doc_id as varchar) as id, case when toxic = 1 then '' else 'labelled' end as name,
                  cast(quality as varchar) as quality from labels)
select coalesce(a.id, b.id) as id, coalesce(nullif(a.name, ''), nullif(b.name, ''), '') as name,
  coalesce(source, '') as source, coalesce(quality, '') as quality from a full join b on a.id = b.id
""",
)
def full_outer_merge(spark, sf_dir):
    """Documents, three to a key, and labels: each side has keys the other lacks; ordinals are text, as landed."""
    a = table(spark, sf_dir, "documents").select(
        F.concat(F.lit(" "), F.expr("doc_id div 3").cast("string")).alias("id"), F.col("lang").alias("name"), "source",
        F.col("doc_id").cast("string").alias("line"),
    )
    b = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("toxic") == 1, "").otherwise("labelled").alias("name"),
        F.col("quality").cast("string").alias("quality"),
        F.col("doc_id").cast("string").alias("line"),
    )
    return docs.merge_sources(a, b, "id", ["name"], "line")


@query(
    "last_row_wins",
    """
select cast(conv_id as varchar) as id, arg_max(role, turn) as role, arg_max(text, turn) as text
from conversations group by conv_id
""",
)
def last_row_wins(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), "role", "text", "turn"
    )
    return docs.latest_per_key(turns, "id", "turn").drop("turn")


@query(
    "parse_status_join",
    """
select d.doc_id, case when l.quality = 1 then 'INTERPRETADO' when l.quality = 0 then 'NAO_INTERPRETADO' end as status
from documents d left join labels l using (doc_id)
""",
)
def parse_status_join(spark, sf_dir):
    parsed = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "INTERPRETADO").otherwise("NAO_INTERPRETADO").alias("status")
    )
    return with_parse_status(table(spark, sf_dir, "documents").select("doc_id"), parsed, ["doc_id"])
