"""op11: how two tokenizers align over every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.align import linked_documents
from sediment.llm.registry import query, table


@query("op11_tokenizer_alignment")
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    found, _ = linked_documents(table(spark, sf_dir, "documents"), derive={"groups_sha256": digest})
    return found.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
