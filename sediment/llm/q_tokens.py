"""op4: tokens of every document by paragraph."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.registry import query, table
from sediment.llm.tokens import VOCABULARY, count_by_section, paragraphs, read_vocabulary


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = count_by_section(F.col("text"), paragraphs(F.col("text")), read_vocabulary(VOCABULARY), "majority")
    found = docs.select("doc_id", F.explode(counts).alias("s"))
    return found.select(
        "doc_id", "s.section", "s.chars", F.col("s.tokens").cast("long").alias("tokens"), F.col("s.crossing").alias("crossing")
    )
