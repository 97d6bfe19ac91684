"""The star over orders: order = entity, nation = place, order date = date, line items = detail measures.

Line items are reduced to the order grain before they meet the orders. An order's index is the
discount given as a share of the gross price; orders without priced lines have no index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sediment.functions.keys import date_key, surrogate_key
from sediment.functions.measures import complete, default, from_scaled, ratio_decimal, scaled
from sediment.functions.text import map_domain
from sediment.operators.star import attach, build_mart, dim_date, dim_entity, dim_place

STATUS = {"f": "FILLED", "o": "OPEN", "p": "PARTIAL"}
UNKNOWN = "UNKNOWN"


@dataclass(frozen=True)
class Star:
    entity: DataFrame
    place: DataFrame
    date: DataFrame
    fact: DataFrame


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from a file footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation and region names per nation key."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", F.upper("n_name").alias("nation"), F.upper("r_name").alias("region")
    )


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their place names, date and conformed status."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    located = customers.join(places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        table(spark, sf_dir, "orders")
        .join(located, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            "o_orderpriority",
            F.col("o_orderdate").cast("date").alias("order_date"),
            map_domain("o_orderstatus", STATUS, UNKNOWN).alias("order_status"),
            "nation",
            "region",
        )
    )


def line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items at the order grain. Cents and hundredths are summed as integers, exact in any order."""
    price, discount = scaled("l_extendedprice", 2), scaled("l_discount", 2)
    sums = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(price * discount).alias("_discounted"), F.sum(price).alias("_gross"), F.count(F.lit(1)).alias("lines"))
    )
    return sums.select(
        "o_orderkey",
        from_scaled("_discounted", 4).alias("discounted"),
        from_scaled("_gross", 2).alias("gross"),
        "lines",
    )


def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with attached measures, eligibility and index; natural columns still present."""
    base = attach(staged_orders(spark, sf_dir), line_measures(spark, sf_dir), ["o_orderkey"], "has_lines")
    return base.withColumns(
        {
            "lines": default("lines", 0),
            "eligible": complete("discounted", "gross", positive="gross"),
            "discount_pct": ratio_decimal("discounted", "gross", 100.0, 4),
        }
    )


def build(spark: SparkSession, sf_dir: str) -> Star:
    """Dimensions and fact. The keys in the fact are computed from the row, without lookups."""
    orders = table(spark, sf_dir, "orders")
    fact = fact_rows(spark, sf_dir).select(
        surrogate_key("o_orderkey").alias("order_sk"),
        surrogate_key("nation", "region").alias("place_sk"),
        date_key("order_date").alias("date_sk"),
        "order_status",
        "discounted",
        "gross",
        "lines",
        "has_lines",
        "eligible",
        "discount_pct",
    )
    return Star(
        entity=dim_entity(orders, "o_orderkey", "order_sk", ["o_orderpriority"]),
        place=dim_place(places(spark, sf_dir), "place_sk", {"nation": "nation", "region": "region"}),
        date=dim_date(orders, "o_orderdate", "date_sk", "order_date"),
        fact=fact,
    )


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = build(spark, sf_dir)
    return build_mart(star.fact, [(star.entity, "order_sk"), (star.place, "place_sk"), (star.date, "date_sk")])
