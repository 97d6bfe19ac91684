"""op9: all conversations as chat texts, read back for their digests."""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.llm.chat import conversations, fold_messages, read_turns, render, unescape
from sediment.llm.registry import query, table

CONTROL_TEXT = "</s>[INST] ok [/INST]"  # fixed value: conversation -7
DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def event_log(rows: DataFrame) -> DataFrame:
    """The log that leads to the given turns: each is opened, streamed, and assistant turns are first drafted otherwise.

    User turns arrive with a slip that an edit mends; assistant turns are regenerated and stream in two deltas.
    """
    tie = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    event = lambda seq, kind, text: F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))
    start, first, rest = event(0, "open", F.lit("")), F.expr("left(text, half)"), F.expr("substring(text, half + 1)")
    drafted = F.array(start, event(1, "delta", F.lit("draft")), event(2, "regenerate", F.lit("")), event(3, "delta", first), event(4, "delta", rest))
    mended = F.array(start, event(1, "delta", rest), event(2, "edit", first), event(3, "delta", rest))
    rows = rows.withColumn("message", F.struct("turn", tie.alias("tie"))).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("half", half)
    events = F.explode(F.when(F.col("role") == "assistant", drafted).otherwise(mended))
    return rows.select("conv_id", "message", "role", events.alias("e")).select("conv_id", "message", "e.seq", "e.kind", "role", "e.text")


def digests(formatted: Column, loss: Column) -> Column:
    @F.arrow_udf(DIGESTS)
    def digest(texts: pa.Array, spans: pa.Array) -> pa.Array:
        sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
        out = []
        for text, where in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            turns = read_turns(text)
            learned = "".join(unescape(text[s["from"] : s["to"]]) for s in where)
            out.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), len(text)))
        names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return digest.asNondeterministic()(formatted, loss)


@query("op9_chat")
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], rows.schema)
    messages = fold_messages(event_log(rows.unionByName(extra)))
    chats = conversations(messages, F.col("message.turn")).select("conv_id", render(F.col("turns")).alias("r"))
    return chats.select("conv_id", digests(F.col("r.formatted"), F.col("r.loss")).alias("d")).select("conv_id", "d.*")
