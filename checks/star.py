"""Star schema, attachment and answer tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from sediment.functions.measures import default, has, scaled
from sediment.operators import metrics, star
from sediment.plans import order_star
from sediment.plans.order_star import table

# Shared start of the SQL: orders with place, date, status and measures at the order grain.
FACT_SQL = """
with placed as (
  select n_nationkey, upper(n_name) as nation, upper(r_name) as region
  from nation join region on n_regionkey = r_regionkey
), staged as (
  select o_orderkey, o_orderpriority, cast(o_orderdate as date) as order_date,
         case lower(trim(o_orderstatus)) when 'f' then 'FILLED' when 'o' then 'OPEN' when 'p' then 'PARTIAL'
              else 'UNKNOWN' end as order_status, nation, region
  from orders join customer on o_custkey = c_custkey join placed on c_nationkey = n_nationkey
), measures as (
  select l_orderkey, count(*) as n,
         sum(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2))) as discounted,
         sum(cast(l_extendedprice as decimal(18,2))) as gross
  from lineitem group by l_orderkey
), fact as (
  select s.*, m.discounted, m.gross, coalesce(m.n, 0) as lines, m.l_orderkey is not null as has_lines,
         m.discounted is not null and m.gross is not null and m.gross > 0 as eligible,
         case when m.gross > 0 then
           cast(floor(1e4 * (100.0::double * cast(m.discounted as double) / cast(m.gross as double)) + 0.5) / 1e4
                as decimal(18,4)) end as discount_pct
  from staged s left join measures m on s.o_orderkey = m.l_orderkey
)
"""

ANSWER_SQL = """
  count(*) as orders, count(*) filter (where has_lines) as measured, count(discount_pct) as eligible,
  floor(100 * (cast(sum(discount_pct) as double) / count(discount_pct)) + 0.5) / 100 as mean_index,
  floor(100 * (100.0::double * cast(sum(discounted) filter (where eligible) as double)
        / nullif(cast(sum(gross) filter (where eligible) as double), 0)) + 0.5) / 100 as pooled_index
"""


def _answer(mart, by):
    return metrics.summary(
        mart, by, "discount_pct", "discounted", "gross", "eligible", "has_lines", names={"rows": "orders"}
    )


@query(
    "flagship_star_answer",
    FACT_SQL + "select nation, order_status," + ANSWER_SQL + "from fact group by nation, order_status",
)
def flagship_star_answer(spark, sf_dir):
    """District-by-status answer: only the place dimension is needed, so only it is joined."""
    s = order_star.build(spark, sf_dir)
    return _answer(star.build_mart(s.fact, [(s.place, "place_sk")]), ["nation", "order_status"])


@query("overall_summary", FACT_SQL + "select order_status," + ANSWER_SQL + "from fact group by order_status")
def overall_summary(spark, sf_dir):
    return _answer(order_star.fact_rows(spark, sf_dir), ["order_status"])


@query(
    "mart",
    FACT_SQL
    + """
select md5(cast(o_orderkey as varchar)) as order_sk,
       md5(coalesce(nation, '') || '|' || coalesce(region, '')) as place_sk,
       cast(strftime(order_date, '%Y%m%d') as integer) as date_sk,
       o_orderkey, o_orderpriority, nation, region, cast(order_date as varchar) as order_date,
       cast(year(order_date) as integer) as year, cast(month(order_date) as integer) as month,
       cast(quarter(order_date) as integer) as quarter, order_status,
       cast(discounted as double) as discounted, cast(gross as double) as gross, lines, has_lines, eligible,
       cast(discount_pct as double) as discount_pct
from fact
""",
)
def mart(spark, sf_dir):
    return (
        order_star.mart(spark, sf_dir)
        .withColumns({c: F.col(c).cast("double") for c in ("discounted", "gross", "discount_pct")})
        .withColumn("order_date", F.col("order_date").cast("string"))
    )


@query(
    "hash_dimension",
    """
select md5(coalesce(upper(n_name), '') || '|' || coalesce(upper(r_name), '')) as place_sk,
       upper(n_name) as nation, upper(r_name) as region
from (select distinct c_nationkey from customer) join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
""",
)
def hash_dimension(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_nationkey")
    places = order_star.places(spark, sf_dir)
    located = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return star.dim_place(located, "place_sk", {"nation": "nation", "region": "region"})


@query(
    "entity_dimension",
    "select md5(cast(p_partkey as varchar)) as part_sk, p_partkey, p_name, p_brand, p_type from part",
)
def entity_dimension(spark, sf_dir):
    return star.dim_entity(table(spark, sf_dir, "part"), "p_partkey", "part_sk", ["p_name", "p_brand", "p_type"])


@query(
    "date_dim",
    """
select distinct cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_sk,
       strftime(o_orderdate, '%Y-%m-%d') as date, cast(year(o_orderdate) as integer) as year,
       cast(month(o_orderdate) as integer) as month, cast(quarter(o_orderdate) as integer) as quarter
from orders
""",
)
def date_dim(spark, sf_dir):
    dim = star.dim_date(table(spark, sf_dir, "orders"), "o_orderdate")
    return dim.withColumn("date", F.col("date").cast("string"))


@query(
    "join_on_hash",
    """
select n_name, c_mktsegment, count(*) as customers
from customer join nation on c_nationkey = n_nationkey group by n_name, c_mktsegment
""",
)
def join_on_hash(spark, sf_dir):
    """Customers meet the nation dimension through the hash of the nation key."""
    dim = star.dim_entity(table(spark, sf_dir, "nation"), "n_nationkey", "nation_sk", ["n_name"])
    joined = star.join_on_hash(table(spark, sf_dir, "customer"), dim, ["c_nationkey"], "nation_sk")
    return joined.groupBy("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "join_date",
    """
select cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
       count(*) as orders, sum(cast(round(o_totalprice * 100) as bigint))::bigint as cents
from orders group by 1, 2
""",
)
def join_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    joined = star.join_date(orders, star.dim_date(orders, "o_orderdate"), "o_orderdate")
    return joined.groupBy("year", "quarter").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(scaled("o_totalprice")).alias("cents")
    )


@query(
    "composite_join",
    """
select p_brand, p_type, count(*) as parts, min(t.cheapest) as cheapest
from part join (select p_brand, p_type, min(p_retailprice) as cheapest from part group by p_brand, p_type) t
using (p_brand, p_type) group by p_brand, p_type
""",
)
def composite_join(spark, sf_dir):
    """Inner join on a two-column key at the reduced grain."""
    part = table(spark, sf_dir, "part")
    keys = ["p_brand", "p_type"]
    cheapest = part.groupBy(*keys).agg(F.min("p_retailprice").alias("cheapest"))
    return (
        part.join(cheapest, keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("parts"), F.min("cheapest").alias("cheapest"))
    )


@query(
    "left_attach_flags",
    """
select d.doc_id, d.lang, l.quality, coalesce(l.toxic, 0) as toxic, l.doc_id is not null as labelled
from documents d left join labels l on d.doc_id = l.doc_id
""",
)
def left_attach_flags(spark, sf_dir):
    """Labels cover some documents: the rest keep NULL quality, a default and a false flag."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = star.attach(documents, table(spark, sf_dir, "labels"), ["doc_id"], "labelled")
    return joined.withColumn("toxic", default("toxic", 0))


@query(
    "presence_by_key",
    """
select o_orderstatus, count(*) as orders, count(*) filter (where l_orderkey is not null) as with_lines
from orders left join (select distinct l_orderkey from lineitem) on o_orderkey = l_orderkey group by o_orderstatus
""",
)
def presence_by_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(has("l_orderkey")).alias("with_lines")
    )
