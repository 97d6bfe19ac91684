"""op12: classes of equal documents, case of A-Z aside."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.radix import LOWER, UPPER, exact_duplicates, normalised
from sediment.llm.registry import query, table

SQL = f"""
WITH texts AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""


@query("op12_exact_dedup", SQL)
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = docs.select("doc_id", "text", F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256"))
    return exact_duplicates(slim, carry=["text_sha256"]).withColumnRenamed("id", "doc_id")
