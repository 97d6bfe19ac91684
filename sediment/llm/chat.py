"""Chat formatting from an event log: events are folded into messages, messages into conversations, then rendered.

Events of a message are applied in their order: ``open`` names the role, ``delta`` appends text, ``edit`` puts its
text in place of what there is, ``regenerate`` starts over with nothing.

A conversation is rendered as ``<s>[INST]role[/INST]text</s>`` for each turn. A control string inside a role or text
gets a backslash after its first character, one more than it may already have there, so reading back is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256  # messages joined at once before a conversation is put together
OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
_PLAIN = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def fold_messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final state of each message of the log.

    ``events`` has conv_id, message (anything that sorts), seq, kind, role and text. Null text counts as empty, a
    message that was never opened has an empty role, and rows with the same seq are taken in order of kind and text.
    One group is one message; the deltas of a long conversation never meet.
    """
    entry = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    log = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(entry)).alias("log"))
    resets = F.transform(F.filter(F.transform("log", lambda e, i: F.struct(e["kind"].alias("kind"), i.alias("i"))), lambda e: e["kind"].isin("edit", "regenerate")), lambda e: e["i"])
    log = log.withColumn("from", F.coalesce(F.array_max(resets), F.lit(0)))
    kept = F.filter("log", lambda e, i: (i >= F.col("from")) & e["kind"].isin("delta", "edit"))
    opened = F.filter("log", lambda e: e["kind"] == "open")
    return log.select(
        "conv_id",
        "message",
        F.coalesce(F.get(opened, F.size(opened) - 1)["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"),
    )


def conversations(messages: DataFrame, position: Column) -> DataFrame:
    """(conv_id, turns): all messages of a conversation in order of ``message``.

    ``position`` is a number that grows with the message. Messages are first gathered by blocks of neighbouring
    positions, so what meets in the last step is whole blocks; the result is one value per conversation as it must be.
    """
    one = F.struct("message", "role", "text")
    blocks = messages.groupBy("conv_id", F.floor(F.coalesce(position, F.lit(-1)) / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(one)).alias("part")
    )
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "part"))).alias("parts"))
    return whole.select("conv_id", F.flatten(F.transform("parts", lambda p: p["part"])).alias("turns"))


def render_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text, and where the texts of assistant turns stand in it: the loss mask, from and to."""
    pieces, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + MIDDLE, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        pieces += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(pieces), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


RENDERED = "formatted string, loss array<struct<from:long,to:long>>"


def render(turns: Column) -> Column:
    """struct(formatted, loss) of an array of turns (structs with role and text)."""

    @F.arrow_udf(RENDERED)
    def rendered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        span = pa.struct([("from", pa.int64()), ("to", pa.int64())])
        for batch in batches:
            done = [render_turns([(t["role"] or "", t["text"] or "") for t in turns.as_py() or ()]) for turns in batch]
            texts = pa.array([d[0] for d in done], pa.string())
            spans = pa.array([[{"from": a, "to": b} for a, b in d[1]] for d in done], pa.list_(span))
            yield pa.StructArray.from_arrays([texts, spans], ["formatted", "loss"])

    return rendered.asNondeterministic()(turns)
