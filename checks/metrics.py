"""Mean against pooled ratio, coverage, cubes, rankings, medians and ordered output."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.star import FACT_SQL
from sediment.functions.measures import classify_gap, complete, from_scaled, ratio_decimal, scaled
from sediment.operators import metrics
from sediment.plans import order_star
from sediment.plans.order_star import table

# Documents with their labels. "Density" is characters per word, "graded" needs a label row.
LABELLED_SQL = """
with labelled as (
  select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, l.doc_id is not null as measured,
         case when l.quality is not null then d.n_chars end as chars,
         case when l.quality is not null then length(d.text) - length(replace(d.text, ' ', '')) end as spaces
  from documents d left join labels l on d.doc_id = l.doc_id
), rated as (
  select *, chars is not null and spaces is not null and chars > 0 as eligible,
    case when chars > 0 and spaces is not null then
      cast(floor(1e4 * (100.0::double * cast(spaces as double) / cast(chars as double)) + 0.5) / 1e4
           as decimal(18,4)) end as space_pct
  from labelled
)
"""


def rated_documents(spark, sf_dir):
    """Share of spaces in each labelled document; documents without a label have no measurement."""
    # counted before the join, so that no text travels
    spaces = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    documents = table(spark, sf_dir, "documents").withColumn("spaces", spaces).drop("text")
    labels = table(spark, sf_dir, "labels").withColumn("measured", F.lit(True))
    joined = documents.join(labels, "doc_id", "left").withColumn("measured", F.coalesce("measured", F.lit(False)))
    graded = F.col("quality").isNotNull()
    return joined.select(
        "doc_id", "lang", "source", "quality", "toxic", "measured",
        F.when(graded, F.col("n_chars")).alias("chars"),
        F.when(graded, F.col("spaces")).cast("bigint").alias("spaces"),
    ).withColumns(
        {
            "eligible": complete("chars", "spaces", positive="chars"),
            "space_pct": ratio_decimal("spaces", "chars", 100.0, 4),
        }
    )


@query(
    "mean_vs_pooled_ratio",
    """
with r as (
  select l_returnflag, cast(l_quantity as decimal(18,2)) as num, cast(l_extendedprice as decimal(18,2)) as den
  from lineitem
), i as (
  select *, case when den > 0 then cast(floor(1e4 * (1000.0::double * cast(num as double) / cast(den as double))
     + 0.5) / 1e4 as decimal(18,4)) end as idx from r
)
select l_returnflag, count(*) as rows, count(idx) as eligible,
  floor(100 * (cast(sum(idx) as double) / count(idx)) + 0.5) / 100 as mean_index,
  floor(100 * (100.0::double * cast(sum(num) as double) / cast(sum(den) as double)) + 0.5) / 100 as pooled_index
from i group by l_returnflag
""",
)
def mean_vs_pooled_ratio(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        from_scaled(scaled("l_quantity")).alias("num"),
        from_scaled(scaled("l_extendedprice")).alias("den"),
    )
    rated = lines.withColumns(
        {"idx": ratio_decimal("num", "den", 1000.0, 4), "ok": complete("num", "den", positive="den")}
    )
    return metrics.summary(rated, ["l_returnflag"], "idx", "num", "den", "ok")


@query(
    "coverage_counts",
    LABELLED_SQL
    + """
select count(*) as total, count(quality) as with_quality, count(toxic) as with_toxic, count(space_pct) as rated
from rated
""",
)
def coverage_counts(spark, sf_dir):
    cols = {"with_quality": "quality", "with_toxic": "toxic", "rated": "space_pct"}
    return metrics.coverage(rated_documents(spark, sf_dir), cols)


@query(
    "gap_histogram",
    """
with spend as (
  select c_custkey, c_acctbal, case when c_acctbal >= 0 then c_acctbal end as credit,
         count(o_orderkey) as orders, sum(case when o_orderstatus = 'F' then 1 end) as filled
  from customer left join orders on o_custkey = c_custkey
  group by c_custkey, c_acctbal
), gaps as (
  select case when credit is not null and filled is not null and filled > 0 then null
              when orders = 0 then 'no order'
              when credit is null and filled is null then 'missing credit and filled order'
              when credit is null then 'missing credit'
              when filled is null then 'missing filled order'
              else 'zero filled' end as gap from spend
)
select gap, count(*) as rows from gaps where gap is not null group by gap
""",
)
def gap_histogram(spark, sf_dir):
    """Why a customer has no index of filled orders: no order, no credit, nothing filled, or both."""
    ordered = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(F.when(F.col("o_orderstatus") == "F", 1)).alias("filled"))
    )
    spend = (
        table(spark, sf_dir, "customer")
        .join(ordered, "c_custkey", "left")
        .select(
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("credit"),
            "filled",
            F.col("orders").isNotNull().alias("measured"),
        )
    )
    gap = classify_gap(
        complete("credit", "filled", positive="filled"),
        "measured",
        {"credit": "credit", "filled": "filled order"},
        no_measure="no order",
        missing_prefix="missing ",
        joiner=" and ",
        zero="zero filled",
    )
    return metrics.gap_histogram(spend, gap)


CUBE_SQL = """
  count(*) as rows, count(*) filter (where {measured}) as measured, count(*) filter (where eligible) as eligible,
  floor(100 * (cast(sum({idx}) filter (where eligible) as double) / nullif(count(*) filter (where eligible), 0))
        + 0.5) / 100 as mean_index,
  floor(100 * (100.0::double * cast(sum({num}) filter (where eligible) as double)
        / nullif(cast(sum({den}) filter (where eligible) as double), 0)) + 0.5) / 100 as pooled_index,
  floor(10 * (100.0::double * count(*) filter (where eligible) / count(*)) + 0.5) / 10 as eligible_pct
"""


@query(
    "kpi_cube",
    FACT_SQL
    + "select nation, order_status, cast(grouping_id(nation, order_status) as integer) as level,"
    + CUBE_SQL.format(measured="has_lines", idx="discount_pct", num="discounted", den="gross")
    + "from fact group by cube (nation, order_status)",
)
def kpi_cube(spark, sf_dir):
    """Every slice a reader could pick in two lists, at once."""
    return metrics.kpi_cube(
        order_star.fact_rows(spark, sf_dir),
        ["nation", "order_status"],
        "discounted", "gross", "discount_pct", "eligible", "has_lines",
    )


@query(
    "document_cube",
    LABELLED_SQL
    + "select lang, source, cast(grouping_id(lang, source) as integer) as level,"
    + CUBE_SQL.format(measured="measured", idx="space_pct", num="spaces", den="chars")
    + "from rated group by cube (lang, source)",
)
def document_cube(spark, sf_dir):
    return metrics.kpi_cube(
        rated_documents(spark, sf_dir),
        ["lang", "source"], "spaces", "chars", "space_pct", "eligible", "measured",
    )


@query(
    "slice_filter",
    LABELLED_SQL + "select doc_id, lang, source, measured from rated where lang = 'en'",
)
def slice_filter(spark, sf_dir):
    """Language fixed, source left free."""
    rows = rated_documents(spark, sf_dir)
    return metrics.slice_equal(rows, lang="en", source=None).select("doc_id", "lang", "source", "measured")


@query(
    "ranked_ratio",
    FACT_SQL
    + """
select nation, count(*) as eligible,
  floor(100 * (100.0::double * cast(sum(discounted) as double) / cast(sum(gross) as double)) + 0.5) / 100 as pooled_index,
  row_number() over (order by pooled_index desc, nation) as position
from fact where eligible group by nation
""",
)
def ranked_ratio(spark, sf_dir):
    ranked = metrics.ranked_ratio(order_star.fact_rows(spark, sf_dir), ["nation"], "discounted", "gross", "eligible")
    return metrics.with_position(ranked, [F.col("pooled_index").desc_nulls_last(), F.col("nation").asc()])


@query(
    "share_of_total",
    LABELLED_SQL
    + """
select lang, count(*) as rows, floor(10 * (100.0::double * count(*) filter (where eligible) / count(*)) + 0.5) / 10
  as eligible_pct from rated group by lang
""",
)
def share_of_total(spark, sf_dir):
    pct = metrics.share(F.count_if("eligible"), F.count(F.lit(1)), 1)
    return rated_documents(spark, sf_dir).groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"), pct.alias("eligible_pct")
    )


@query(
    "median_by_group",
    """
select l_returnflag, median(l_extendedprice) as median_price from lineitem group by l_returnflag
""",
)
def median_by_group(spark, sf_dir):
    return metrics.group_median(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", "median_price")


@query(
    "median_by_sketch",
    """
select l_returnflag, l_linestatus, median(l_extendedprice) as median_price
from lineitem group by l_returnflag, l_linestatus
""",
)
def median_by_sketch(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return metrics.group_median_by_sketch(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", "median_price")


@query(
    "filtered_counts",
    """
select l_linestatus, count(*) filter (where l_discount > 0.05) as discounted,
       count(*) filter (where l_returnflag = 'R' and l_quantity >= 25) as large_returns, count(*) as rows
from lineitem group by l_linestatus
""",
)
def filtered_counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 25)).alias("large_returns"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(
    "distinct_combos",
    """
select count(*) as combinations from (
  select distinct d.lang, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id)
""",
)
def distinct_combos(spark, sf_dir):
    """Combinations with a missing part count too."""
    return metrics.count_distinct_rows(rated_documents(spark, sf_dir), ["lang", "quality", "toxic"])


@query("latest_date", "select cast(max(cast(o_orderdate as date)) as varchar) as latest from orders")
def latest_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return metrics.maximum(orders, "day", "latest").withColumn("latest", F.col("latest").cast("string"))


@query(
    "top_k",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10",
)
def top_k(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return metrics.top_k(orders, "o_totalprice", 10, "o_orderkey")


@query(
    "sorted_measure",
    """
select d.doc_id, l.quality, row_number() over (order by l.quality desc nulls last, d.doc_id) as position
from documents d left join labels l on d.doc_id = l.doc_id
""",
)
def sorted_measure(spark, sf_dir):
    rows = rated_documents(spark, sf_dir).select("doc_id", "quality")
    return metrics.with_position(rows, metrics.measure_order("quality", "doc_id"))


@query(
    "sorted_answer",
    """
select n_name, c_mktsegment, c_custkey, c_acctbal, row_number() over (order by n_name, c_mktsegment, c_custkey) as position
from customer join nation on c_nationkey = n_nationkey
""",
)
def sorted_answer(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    rows = joined.select("n_name", "c_mktsegment", "c_custkey", "c_acctbal")
    return metrics.with_position(rows, metrics.key_order("n_name", "c_mktsegment", "c_custkey"))


@query(
    "sorted_text",
    """
select conv_id, turn, role, text, row_number() over (order by text collate pt, conv_id, turn) as position from conversations
""",
)
def sorted_text(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return metrics.with_position(rows, metrics.text_order("text", "conv_id", "turn", locale="pt"))
