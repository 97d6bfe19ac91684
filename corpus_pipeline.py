"""Corpus pipeline: documents through quality, language, near-duplicate, contamination and mixing stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame. ``run`` writes
each result as Parquet in the shared folder and hands it on. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm import language, quality
from sediment.llm.common import fold, free_name, stored
from sediment.llm.decontaminate import leaks
from sediment.llm.mixing import mix
from sediment.llm.q_mixing import MAX_EPOCHS, SEED, WEIGHTS, with_tree
from sediment.llm.q_simhash import MAX_DISTANCE, WIDTH
from sediment.llm.registry import table
from sediment.llm.simhash import one_of_each

#: Languages with a lower score are as good as guessed among those that were learned.
LEAST_LANGUAGE_SCORE = 0.3


def _where(docs: DataFrame, name: str, value, condition) -> DataFrame:
    """Rows for which ``condition`` of the computed value holds, with the columns of ``docs`` only."""
    name = free_name(docs, name)
    return docs.withColumn(name, value).where(condition(F.col(name))).drop(name)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score ``quality.ACCEPT`` or more; the model is fitted to the labelled ones among them."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    return _where(docs, "quality_score", quality.quality_score(F.col("text"), model), lambda s: s >= quality.ACCEPT)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language can be told; those without a letter or at the level of a guess go."""
    model = language.fit(docs, fold(F.col("doc_id"), 5) != 0)
    found = language.identify(F.col("text"), model)
    return _where(docs, "language", found, lambda s: (s["lang_pred"] != language.UNDETERMINED) & (s["score"] >= LEAST_LANGUAGE_SCORE))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of linked fingerprints, by the shingles and the distance of ``op8_simhash``."""
    return one_of_each(docs, width=WIDTH, max_distance=MAX_DISTANCE)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no benchmark item is found."""
    return _where(docs, "leaks", leaks(F.col("text"), table(spark, sf_dir, "benchmark")), lambda s: F.size(s) == 0)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once for each epoch in which they are taken, with epoch and prefix_tokens after their own columns."""
    tree = with_tree(docs.drop("domain", "n_tokens"))
    mixed = mix(tree, ["domain", "lang", "source"], "doc_id", "n_tokens", WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED)
    return mixed.drop("n_tokens")


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: The classifiers are trained; no SQL gives their rows. Each stage is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
