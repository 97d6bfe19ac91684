"""op3: benchmark items in all documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.decontaminate import leaks
from sediment.llm.registry import query, table


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", F.explode(leaks(F.col("text"), table(spark, sf_dir, "benchmark"))).alias("leak"))
    return found.select("doc_id", "leak.item_id", "leak.from", "leak.to", "leak.edits", "leak.probes")
