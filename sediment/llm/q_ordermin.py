"""op5: Order MinHash of every document, of its edited form, and its likeness to the next document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.common import stored
from sediment.llm.ordermin import following_ids, likeness, signature
from sediment.llm.registry import query, table


@query("op5_order_minhash")
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that share an id each get a row; their text for the document before is the one of the smallest crc32."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    follows = stored(following_ids(docs), "following")
    longest = docs.groupBy("id").agg(F.max(F.floor(F.char_length("text") / 2)).cast("int").alias("need"))
    wanted = follows.join(longest, follows.id.eqNullSafe(longest.id)).select(
        follows.id.alias("before"), follows.next_id.alias("id"), "need"
    )
    # only as much of the next text travels as its predecessor can take in
    heads = docs.alias("d").join(wanted.alias("w"), F.expr("d.id <=> w.id")).selectExpr(
        "w.before as before", "struct(crc32(d.text), left(d.text, w.need) as head) as first"
    )
    heads = heads.groupBy("before").agg(F.min("first")["head"].alias("head"))
    half = F.expr("cast(floor(n_chars / 2) as int)")
    both = docs.join(heads, docs.id.eqNullSafe(heads.before)).select("id", "text", "head", F.char_length("text").cast("long").alias("n_chars"))
    both = both.withColumn("edited", F.concat(F.left("text", (F.col("n_chars") - half).cast("int")), F.left("head", half)))
    prints = both.select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        signature(F.col("text")).alias("own"),
        signature(F.col("edited")).alias("changed"),
        F.crc32("text").alias("sum"),
    )
    prints = stored(prints, "order-minhash")
    smallest = prints.groupBy("id").agg(F.min(F.struct("sum", "own"))["own"].alias("other"))
    nexts = follows.join(smallest, follows.next_id.eqNullSafe(smallest.id)).select(follows.id.alias("before"), "other")
    return prints.join(nexts, prints.id.eqNullSafe(nexts.before)).select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        F.array_join("own", "").alias("fingerprint"),
        F.array_join("changed", "").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
    )
