"""Tables that grow by date or version, and large documents, over the given tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks.registry import query
from checks.star import ANSWER_SQL, FACT_SQL
from sediment.operators import metrics, star
from sediment.plans import order_star
from sediment.plans.order_star import table
from sediment.session import scratch
from sediment.sources.elements import explode_elements
from sediment.sources.keyed import KeyedSnapshotTable
from sediment.sources.partitions import read_partitions, replace_partitions

ROWS_PER_DOCUMENT = 100_000


@query("json_elements", "select conv_id, turn, role, text from conversations")
def json_elements(spark, sf_dir):
    """All turns in a few JSON documents, each one line long, cut into elements by many tasks."""
    turns = table(spark, sf_dir, "conversations")
    parts = max(2, math.ceil(turns.count() / ROWS_PER_DOCUMENT))
    path = scratch(spark, "turn-documents")
    number = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(parts)).cast("int").alias("part")
    body = F.concat(F.lit(","), F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}))
    lines = turns.select(number, F.lit(1).alias("place"), body.alias("value"))
    frame = [(k, place, text) for k in range(parts) for place, text in ((0, '{"meta": [[1], {"turns": []}], "data": {"turns": [{"conv_id": null}'), (2, "]}}"))]
    whole = lines.unionByName(spark.createDataFrame(frame, "part int, place int, value string"))
    whole.repartition(parts, "part").sortWithinPartitions("part", "place").drop("place").write.option("lineSep", " ").partitionBy("part").text(path)
    found = explode_elements(spark, path, "$.data.turns", "t", "struct<conv_id:bigint,turn:bigint,role:string,text:string>")
    return found.where("_element > 1").select("t.conv_id", "t.turn", "t.role", "t.text")


def dated_orders(spark, sf_dir):
    s = order_star.build(spark, sf_dir)
    mart = star.build_mart(s.fact, [(s.place, "place_sk"), (s.date, "date_sk")])
    return mart.select("order_status", "nation", "discounted", "gross", "eligible", "has_lines", "discount_pct", "year")


@query("partitioned_answer", FACT_SQL + "select nation, order_status," + ANSWER_SQL + "from fact group by nation, order_status")
def partitioned_answer(spark, sf_dir):
    """Partial sums kept by year: first from a part of the orders, then every year replaced, one of them twice; the answer is merged from them."""
    root = scratch(spark, "dated")
    mart = dated_orders(spark, sf_dir)

    def keep(rows):
        sums = metrics.partial_summary(rows, ["year", "nation", "order_status"], "discount_pct", "discounted", "gross", "eligible", "has_lines")
        replace_partitions(sums, root, "sums", "year")

    keep(mart.where("order_status = 'FILLED'"))
    keep(mart)
    keep(mart.where("year = 1995"))
    return metrics.merge_summaries(read_partitions(spark, root, "sums"), ["nation", "order_status"], True, {"rows": "orders"})


BUCKETS = 16
# Versions of the orders: all; then without partly delivered ones, some with another priority and some under a new key.
VERSION_SQL = """
with v0 as (select o_orderkey as k, o_orderstatus as s, o_orderpriority as p from orders),
v1 as (select k, s, case when k % 97 = 0 then 'changed' else p end as p from v0 where s <> 'P'
       union all select k + 1000000000, s, p from v0 where k % 50 = 0)
"""


def versioned_orders(spark, sf_dir):
    first = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    changed = first.where("s <> 'P'").withColumn("p", F.when(F.col("k") % 97 == 0, "changed").otherwise(F.col("p")))
    new = first.where("k % 50 = 0").withColumn("k", F.col("k") + 1_000_000_000)
    kept = KeyedSnapshotTable(spark, scratch(spark, "keyed"), ["k"], BUCKETS)
    kept.write(first, "all")
    kept.write(changed.unionByName(new), "changed")
    return kept, first


@query(
    "version_difference",
    VERSION_SQL
    + """
select coalesce(v0.k, v1.k) as k, case when v0.k is null then 'added' when v1.k is null then 'removed' else 'changed' end as change,
  (v0.k is not null)::bigint as rows_before, (v1.k is not null)::bigint as rows_after
from v0 full join v1 on v0.k = v1.k where v0.k is null or v1.k is null or v0.p <> v1.p
""",
)
def version_difference(spark, sf_dir):
    """Keys that were added, removed or changed between two versions."""
    return versioned_orders(spark, sf_dir)[0].changed_keys(0, 1)


@query(
    "version_rows",
    VERSION_SQL
    + """
select *, 'removed' as change from (from v0 except all from v1) union all select *, 'added' from (from v1 except all from v0)
""",
)
def version_rows(spark, sf_dir):
    """Rows that only one of two versions has."""
    return versioned_orders(spark, sf_dir)[0].changed_rows(0, 1)


@query(
    "shared_files",
    f"""
with n as (select count(*) as rows, max(o_orderkey) as k from orders)
select 0::bigint as version, rows, {BUCKETS}::bigint as files_added, 0::bigint as files_removed from n
union all select 1, rows, 1, 1 from n union all select 2, rows, 1, 1 from n
""",
)
def shared_files(spark, sf_dir):
    """A version with one changed key adds one file, and a restore takes it back."""
    kept = KeyedSnapshotTable(spark, scratch(spark, "shared"), ["o_orderkey"], BUCKETS)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    newest = orders.agg(F.max("o_orderkey").alias("newest"))
    kept.write(orders, "all")
    one = orders.join(newest, F.col("o_orderkey") == F.col("newest"), "left")
    changed = F.when(F.col("newest").isNotNull(), "changed").otherwise(F.col("o_orderpriority"))
    kept.write(one.withColumn("o_orderpriority", changed).drop("newest"), "one changed")
    kept.restore(0)
    return kept.commit_log().select("version", "rows", "files_added", "files_removed")
