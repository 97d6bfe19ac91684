import corpus_pipeline
from sediment.llm import language, quality
from sediment.llm.common import fold
from sediment.llm.decontaminate import Probes, find
from pyspark.sql import functions as F


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_stages_keep_columns_and_decide(spark, docs, tables):
    current = spark.read.parquet(f"{tables}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, current, tables)
        assert after.columns[: len(docs.columns) - (k == 4)] == [c for c in docs.columns if k < 4 or c != "epoch"], name
        texts = {r.text for r in after.collect()}
        assert texts <= {r.text for r in current.collect()}
        if name == "quality classifier":
            assert not any("!!" in (t or "") for t in texts) and len(texts) > 70
        if name == "language ID":
            assert all(any(c.isalpha() for c in t or "") for t in texts) and len(texts) > 65
        current = after
    assert current.count() > 0


def test_stages_on_no_rows(spark, empty_docs, empty_tables):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty_docs, empty_tables).count() == 0


def test_filtering_stages_agree_with_their_models(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    everything = docs.collect()
    model = quality.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"), fold(F.col("doc_id"), 4) != 2)
    want = [r for r in everything if model.score(quality.subword_counts(r.text or "", quality.BITS)) >= 0.7]
    assert rows_of(corpus_pipeline.quality_stage(spark, docs, tables)) == sorted(map(str, want))
    model = language.fit(docs, fold(F.col("doc_id"), 5) != 0)
    told = [(r, *model.predict(language.letter_grams(r.text or "", language.BITS))) for r in everything]
    want = [r for r, lang, score in told if lang != "und" and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE]
    assert rows_of(corpus_pipeline.language_stage(spark, docs, tables)) == sorted(map(str, want))


def test_contaminated_documents_go(spark, docs, tables):
    item = "What is the height of the tower, measured at noon by the old keeper?"
    leak = spark.createDataFrame([(7001, f"Before. {item} After.", "en", "src0", 0, None, None, None, None, None)], docs.schema)
    both = docs.unionByName(leak)
    after = corpus_pipeline.decontamination_stage(spark, both, tables)
    assert rows_of(after) == rows_of(docs)
    assert find(f"x {item}", Probes.build([(1, item)]))


def test_run_is_the_stages_in_order(spark, tables):
    found = corpus_pipeline.run(spark, tables)
    assert {"doc_id", "text", "epoch", "prefix_tokens"} <= set(found.columns)
    assert found.count() > 0
