"""op6: licence findings in every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.licenses import scan
from sediment.llm.registry import query, table


@query("op6_licenses")
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", scan(F.col("text")).alias("s"))
    found = found.select("doc_id", "s.n_words", "s.findings")
    base = F.filter("findings", lambda f: f["kind"] == "base")
    starts = F.transform(base, lambda f: f["word"])
    joined = lambda findings: F.array_join(F.array_sort(F.array_distinct(F.transform(findings, lambda f: f["label"]))), ",")
    doubt = F.aggregate("findings", F.lit(1.0), lambda rest, f: rest * (F.lit(1.0) - f["weight"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("findings")).alias("labels"),
        (F.lit(1.0) - doubt).alias("score"),
        F.array_max(F.transform("findings", lambda f: f["duty"])).alias("duty"),
    )
