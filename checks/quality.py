"""Expectations on the given tables, which hold real violations of every kind checked here."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from sediment.functions.measures import from_scaled, scaled
from sediment.operators import quality as q
from sediment.operators.incremental import SuiteStates
from sediment.plans.order_star import table
from sediment.session import scratch
from sediment.sources.files import walk


def labelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )


def tables(spark, sf_dir):
    names = ("customer", "orders", "lineitem", "documents", "labels", "conversations")
    found = {n: table(spark, sf_dir, n) for n in names}
    gross = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        from_scaled(F.sum(scaled("l_extendedprice"))).alias("gross")
    )
    found["labelled"] = labelled(spark, sf_dir)
    found["priced"] = found["orders"].join(gross, "o_orderkey", "left")
    return found


@query(
    "grain_violations",
    "select l_orderkey, l_linenumber, count(*) as occurrences from lineitem group by 1, 2 having count(*) <> 1",
)
def grain_violations(spark, sf_dir):
    return q.grain_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "orphans",
    "select doc_id, lang, source from documents where doc_id not in (select doc_id from labels)",
)
def orphans(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return q.orphans(documents, table(spark, sf_dir, "labels"), "doc_id", "doc_id")


@query(
    "q_not_null",
    "select doc_id, lang from documents left join labels using (doc_id) where quality is null",
)
def q_not_null(spark, sf_dir):
    rule = q.expect_not_null("labelled", "quality")
    return rule.failing_rows({"labelled": labelled(spark, sf_dir)}).select("doc_id", "lang")


@query(
    "q_unique",
    "select p_name, count(*) as occurrences from part where p_name is not null group by 1 having count(*) > 1",
)
def q_unique(spark, sf_dir):
    return q.expect_unique("part", "p_name").failing_rows({"part": table(spark, sf_dir, "part")})


@query(
    "q_accepted",
    "select o_orderkey, o_orderpriority from orders where o_orderpriority not in ('1-URGENT', '2-HIGH', '5-LOW')",
)
def q_accepted(spark, sf_dir):
    rule = q.expect_in("orders", "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])
    return rule.failing_rows({"orders": table(spark, sf_dir, "orders")}).select("o_orderkey", "o_orderpriority")


@query(
    "q_non_negative",
    "select c_custkey, c_acctbal from customer where c_acctbal < 0",
)
def q_non_negative(spark, sf_dir):
    rule = q.expect_non_negative("customer", ["c_acctbal", "c_nationkey"])
    return rule.failing_rows({"customer": table(spark, sf_dir, "customer")}).select("c_custkey", "c_acctbal")


@query(
    "q_formula",
    """
select o_orderkey, o_totalprice from orders join (
  select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as gross from lineitem group by 1)
on o_orderkey = l_orderkey where abs(o_totalprice - cast(gross as double)) > 100000
""",
)
def q_formula(spark, sf_dir):
    """Order totals against the sum of their lines; orders without lines have nothing to compare."""
    gross = F.col("gross")
    rule = q.expect_formula("priced", "o_totalprice", gross.isNotNull(), gross.cast("double"), 100000)
    return rule.failing_rows(tables(spark, sf_dir)).select("o_orderkey", "o_totalprice")


def suite():
    return [
        q.expect_not_null("customer", "c_custkey"),
        q.expect_unique("customer", "c_custkey"),
        q.expect_non_negative("customer", ["c_acctbal"]),
        q.expect_in("customer", "c_mktsegment", ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]),
        q.expect_not_null("labelled", "quality"),
        q.expect_in("labelled", "quality", [0, 1]),
        q.expect_fk("orders", "o_custkey", "customer", "c_custkey"),
        q.expect_fk("documents", "doc_id", "labels", "doc_id"),
        q.expect_grain("conversations", ["conv_id", "turn"]),
        q.expect_grain("lineitem", ["l_orderkey", "l_linenumber"]),
        q.expect_count("labels", 0),
        q.expect_interpreted("labelled", "quality", F.col("toxic") == 0),
        q.expect_values("labels", {"toxic": 0}),
    ]


SUITE_SQL = """
with failures as (
  select 'customer' as "table", 'c_custkey' as "column", 'not_null' as kind,
         (select count(*) from customer where c_custkey is null) as failures
  union all select 'customer', 'c_custkey', 'unique',
         (select count(*) from (select c_custkey from customer group by 1 having count(*) > 1))
  union all select 'customer', 'c_acctbal', 'non_negative', (select count(*) from customer where c_acctbal < 0)
  union all select 'customer', 'c_mktsegment', 'accepted_values',
         (select count(*) from customer where c_mktsegment not in ('BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'))
  union all select 'labelled', 'quality', 'not_null',
         (select count(*) from documents left join labels using (doc_id) where quality is null)
  union all select 'labelled', 'quality', 'accepted_values', (select count(*) from labels where quality not in (0, 1))
  union all select 'orders', 'o_custkey', 'relationships',
         (select count(*) from orders where o_custkey not in (select c_custkey from customer))
  union all select 'documents', 'doc_id', 'relationships',
         (select count(*) from documents where doc_id not in (select doc_id from labels))
  union all select 'conversations', 'conv_id,turn', 'grain',
         (select count(*) from (select 1 from conversations group by conv_id, turn having count(*) <> 1))
  union all select 'lineitem', 'l_orderkey,l_linenumber', 'grain',
         (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) <> 1))
  union all select 'labels', '*', 'row_count', (select count(*) from (select count(*) as n from labels) where n <> 0)
  union all select 'labelled', 'quality', 'interpreted',
         (select count(*) from documents left join labels using (doc_id) where quality is not null and toxic <> 0)
  union all select 'labels', 'toxic', 'values', (select count(*) from labels where toxic is distinct from 0)
)
"""


@query(
    "quality_suite",
    SUITE_SQL
    + "select \"table\", \"column\", kind, failures, case when failures = 0 then 'pass' else 'fail' end as status "
    "from failures",
)
def quality_suite(spark, sf_dir):
    return q.run_suite(tables(spark, sf_dir), suite())


def write_halves(df, path):
    """Rows in two folders of files, by their content; Spark deals them to files by the bytes there are. Files of each half."""
    half = F.pmod(F.xxhash64(*df.columns), F.lit(2)).alias("half")
    df.select("*", half).hint("rebalance").write.partitionBy("half").parquet(path)
    files = [file for file, _ in walk(df.sparkSession, path)]
    if not files:  # no rows: one file that says so
        df.write.parquet(f"{path}/half=0")
        files = [file for file, _ in walk(df.sparkSession, path)]
    return [[f for f in files if f"/half={k}/" in f] for k in (0, 1)]


@query(
    "incremental_suite",
    SUITE_SQL
    + "select \"table\", \"column\", kind, failures, case when failures = 0 then 'pass' else 'fail' end as status "
    "from failures",
)
def incremental_suite(spark, sf_dir):
    """The same suite over files that arrive one half after the other: the second time, only the new half is read."""
    root, found = scratch(spark, "suite"), tables(spark, sf_dir)
    states, files = SuiteStates(spark, f"{root}/states", suite()), {}
    for name in states.tables:
        files[name] = write_halves(found[name], f"{root}/{name}")
    states.add({name: first for name, (first, _) in files.items()})
    both = {name: first + second for name, (first, second) in files.items()}
    states.add(both)
    return states.results(both)


@query(
    "quality_summary",
    SUITE_SQL
    + "select kind, case when failures = 0 then 'pass' else 'fail' end as status, count(*) as expectations "
    "from failures group by 1, 2",
)
def quality_summary(spark, sf_dir):
    return q.quality_summary(q.run_suite(tables(spark, sf_dir), suite()))
