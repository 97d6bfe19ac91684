"""op10: the quality score of every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.common import fold
from sediment.llm.quality import ACCEPT, fit, quality_score
from sediment.llm.registry import query, table


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
