"""op8: near-duplicate classes of all documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.registry import query, table
from sediment.llm.simhash import near_duplicates

WIDTH, MAX_DISTANCE = 3, 2


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=WIDTH, max_distance=MAX_DISTANCE)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")
