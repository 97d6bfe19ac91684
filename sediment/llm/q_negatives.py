"""op13: hard negatives of every hundredth row of the embeddings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.negatives import hard_negatives, integer_rows
from sediment.llm.registry import query, table


@query("op13_hard_negatives")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(integer_rows(vectors, label=label), F.col("id") % 100 == 0)
