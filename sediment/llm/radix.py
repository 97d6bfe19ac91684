"""Exact duplicates by distributed most-significant-digit radix partitioning.

All texts start in one group. In each round the next bytes of a text are its digit: rows of a group with the same digit
form a group of the next round, rows that are alone leave, and so do groups whose texts have ended, which are equal.
Bytes are compared as they are; no text is ever represented by a digest. Digits grow from round to round, so long texts
take few rounds, and only texts that still share all bytes so far with another one are carried on.

A group is counted by a partial aggregate before its rows are shuffled and its rows meet one row that describes it, so
groups of any size are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import stored

#: Bytes of the digits of the first rounds; the last width is used for all further rounds and bounds the size of a key.
WIDTHS = (128, 2048, 32768, 524288)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _partition(rows: DataFrame, width: int, carry: Sequence[str]) -> DataFrame:
    """One round: rows (id, group, rest, carried) with what is known of their next group.

    Where ``rest`` is null in the result the row has left: keep_id, group_size, first (the row that stays) are final.
    """
    keyed = rows.select("id", "group", *carry, F.substring("rest", 1, width).alias("digit"), F.expr(f"substring(rest, {width + 1})").alias("rest"))
    groups = keyed.groupBy("group", "digit").agg(F.count(F.lit(1)).alias("group_size"), F.max("id").alias("keep_id")).where("group_size > 1")
    groups = stored(groups.withColumn("next", F.monotonically_increasing_id()), "radix-groups")
    # rows meet their group by a merge join at every size: a hot group is split there, and no group table is broadcast
    found = keyed.join(groups.hint("merge"), ["group", "digit"], "left")
    ended = F.octet_length("digit") < width
    goes_on = F.col("next").isNotNull() & ~ended
    return found.select(
        "id",
        *carry,
        F.when(F.col("next").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("next").alias("group"),
        F.when(goes_on, F.col("rest")).alias("rest"),
        F.monotonically_increasing_id().alias("row"),
    )


def _left(round_: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The rows that left in a round, one of each group marked as kept: the first of those with the largest id."""
    left = round_.where(F.col("rest").isNull())
    alone = left.where("group is null").select("id", "keep_id", "group_size", F.lit(True).alias("kept"), *carry)
    groups = left.where("group is not null")
    # only rows of the largest id have to be told apart, so a large group of other rows is not brought together
    largest, others = groups.where("id <=> keep_id"), groups.where("not (id <=> keep_id)")
    stays = largest.groupBy("group").agg(F.min("row").alias("first"))
    largest = largest.join(stays.hint("merge"), "group").select("id", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"), *carry)
    return alone.unionByName(largest).unionByName(others.select("id", "keep_id", "group_size", F.lit(False).alias("kept"), *carry))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None, carry: Sequence[str] = (), widths: Sequence[int] = WIDTHS) -> DataFrame:
    """(id, keep_id, group_size, kept, and the columns of ``carry``) for every row of ``docs``.

    ``text`` gives the value that is compared (``normalised`` text column by default); null counts as empty, and empty
    texts are equal. ``keep_id`` is the largest id of the rows with an equal text and ``kept`` is true for exactly one
    row of each group: one with that id, if the id is repeated. Null ids come before all others; a group of null ids
    only has a null ``keep_id``. An empty table gives no rows. Other columns are not looked at, whatever their names.
    """
    value = normalised(F.col("text")) if text is None else text
    taken = {c: f"carried_{n}" for n, c in enumerate(carry)}
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.lit(0).cast("bigint").alias("group"),
        F.coalesce(value, F.lit("")).cast("binary").alias("rest"),
        *(F.col(c).alias(t) for c, t in taken.items()),
    )
    names = list(taken.values())
    done: list[DataFrame] = []
    at = 0
    while True:
        round_ = stored(_partition(rows, widths[min(at, len(widths) - 1)], names), "radix-round")
        done.append(_left(round_, names))
        rows = round_.where(F.col("rest").isNotNull()).select("id", "group", "rest", *names)
        at += 1
        if rows.isEmpty():
            break
    found = reduce(DataFrame.unionByName, done)
    return found.select("id", "keep_id", "group_size", "kept", *(F.col(t).alias(c) for c, t in taken.items()))
