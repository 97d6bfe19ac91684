"""op7: the language of every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.common import fold
from sediment.llm.language import fit, identify
from sediment.llm.registry import query, table


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = fit(docs, ~held_out)
    found = docs.select("doc_id", held_out.alias("held_out"), identify(F.col("text"), model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
