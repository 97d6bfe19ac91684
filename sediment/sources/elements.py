"""Elements of an array inside JSON files of any size: a file is read and cut by many tasks.

A file is read in pieces between commas, whatever a comma stands for. What a piece does to the reader's state is known for
both states it can be entered in, outside and inside a string: whether it turns the one into the other, and how much
deeper it leads into brackets. These effects compose, so each block of a file is summed up in one row, and running sums
over the rows of a file give the state at the start of every block. A comma parts two elements where it stands outside
strings at the depth of the array. Only pieces that reach above the array are looked at bracket by bracket, to find the
array that the path names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.session import scratch
from sediment.sources.provenance import ELEMENT, RECORD_NUMBER, _as_list, file_hashes, file_path, relative_to, with_provenance

BLOCK = ["_file", "_block"]
PIECE = ["_file", "_block", "_pos"]
ELEMENT_LIMIT = 64 * 1024 * 1024
ESCAPED = r"(?s)\\."
STRING = r'"[^"]*+(?:"|\z)'
# Strings, single brackets, and what is between them: together the whole of a piece.
TOKENS = r'(?s)"(?:[^"\\]++|\\.)*+(?:"|\\?\z)|[\[\]{}]|[^"\[\]{}]++'
BLANKS = " \t\r\n"


def _path_steps(path: str) -> list[str]:
    names = path.removeprefix("$").strip(".")
    steps = names.split(".") if names else []
    if not all(re.fullmatch(r"\w+", s) for s in steps):
        raise ValueError(f"only plain field paths are supported: {path}")
    return steps


def _kept(df: DataFrame, name: str) -> DataFrame:
    where = scratch(df.sparkSession, name)
    df.write.parquet(where)
    return df.sparkSession.read.parquet(where)


def read_pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Pieces between commas with their file, block and position."""
    return (
        spark.read.option("lineSep", ",")
        .option("recursiveFileLookup", "true")
        .text(_as_list(paths))
        .select(
            F.col("value").alias("_text"),
            file_path().alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_pos"),
        )
    )


def _steps_of(brackets: Column) -> Column:
    """How deep the brackets lead, and the lowest depth on the way (0 at most)."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("low"))

    def step(acc: Column, c: Column) -> Column:
        depth = acc["depth"] + F.when(c.isin("[", "{"), 1).when(c == "", 0).otherwise(-1)
        return F.struct(depth.alias("depth"), F.least(acc["low"], depth).alias("low"))

    return F.aggregate(F.split(brackets, ""), start, step)


def with_effect(pieces: DataFrame) -> DataFrame:
    """Adds what a piece does: ``_flips`` of the string state, and depth and lowest depth entered outside (0) and inside (1) a string.

    Escaped characters never change the state, and a comma may be one of them, so a piece is entered in one of two states only.
    """
    text = F.col("_text")
    plain = F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, ESCAPED, "")).otherwise(text)
    brackets = {
        0: F.regexp_replace(F.regexp_replace("_plain", STRING, ""), r"[^\[\]{}]++", ""),
        1: F.regexp_replace(F.regexp_replace(F.concat(F.lit('"'), "_plain"), STRING, ""), r"[^\[\]{}]++", ""),
    }
    quotes = F.length("_plain") - F.length(F.replace("_plain", F.lit('"'), F.lit("")))
    known = pieces.withColumn("_plain", plain).withColumn("_flips", quotes % 2)
    known = known.withColumns({f"_in{e}": _steps_of(b) for e, b in brackets.items()})
    parts = {f"_{part}{e}": F.col(f"_in{e}.{part}") for e in (0, 1) for part in ("depth", "low")}
    return known.withColumns(parts).drop("_plain", "_in0", "_in1")


def block_states(effects: DataFrame) -> DataFrame:
    """One row per block: string state and depth at its start, and the same after it (``_then``, ``_deeper``)."""
    before = Window.partitionBy(*BLOCK).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    state = F.pmod(F.coalesce(F.sum("_flips").over(before), F.lit(0)), F.lit(2))
    inside = effects.select(*PIECE, "_flips", "_depth0", "_depth1").withColumn("_state", state)
    outside = F.col("_state") == 0
    blocks = inside.groupBy(*BLOCK).agg(
        F.pmod(F.sum("_flips"), F.lit(2)).alias("_turn"),
        F.sum(F.when(outside, F.col("_depth0")).otherwise(F.col("_depth1"))).alias("_down0"),
        F.sum(F.when(outside, F.col("_depth1")).otherwise(F.col("_depth0"))).alias("_down1"),
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_entry", F.pmod(F.coalesce(F.sum("_turn").over(earlier), F.lit(0)), F.lit(2)))
    blocks = blocks.withColumn("_down", F.when(F.col("_entry") == 0, F.col("_down0")).otherwise(F.col("_down1")))
    return blocks.select(
        *BLOCK,
        "_entry",
        F.coalesce(F.sum("_down").over(earlier), F.lit(0)).alias("_start"),
        F.pmod(F.col("_entry") + F.col("_turn"), F.lit(2)).alias("_then"),
        "_down",
    )


def _placed(effects: DataFrame, blocks: DataFrame) -> DataFrame:
    """Pieces with the string state and depth at their start, and the lowest depth inside."""
    before = Window.partitionBy(*BLOCK).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    joined = effects.join(blocks.select(*BLOCK, "_entry", "_start"), BLOCK, "left")
    # both passes must see the same blocks; a piece that lost its block stops the job
    entry = F.coalesce("_entry", F.raise_error(F.lit("file blocks changed between passes")).cast("bigint"))
    joined = joined.withColumn("_state", F.pmod(entry + F.coalesce(F.sum("_flips").over(before), F.lit(0)), F.lit(2)))
    outside = F.col("_state") == 0
    own = {part: F.when(outside, F.col(f"_{part}0")).otherwise(F.col(f"_{part}1")) for part in ("depth", "low")}
    joined = joined.withColumn("_own", own["depth"])
    joined = joined.withColumn("_at", F.col("_start") + F.coalesce(F.sum("_own").over(before), F.lit(0)))
    return joined.select(*PIECE, "_text", "_state", "_at", (F.col("_at") + own["low"]).alias("_lowest"))


def _brackets(placed: DataFrame, depth: int) -> DataFrame:
    """The brackets around levels up to ``depth``: which, where (character of the piece), level inside, and name if it has one."""
    rare = placed.where((F.col("_at") < depth) | (F.col("_lowest") < depth))
    cut_in = F.col("_state") == 1  # the piece begins inside a string: a quote in front makes it whole
    tokens = F.regexp_extract_all(F.when(cut_in, F.concat(F.lit('"'), "_text")).otherwise(F.col("_text")), F.lit(TOKENS), F.lit(0))
    found = "array<struct<bracket:string,at:int,level:int,name:string>>"
    start = F.struct(
        F.when(cut_in, -1).otherwise(0).alias("at"),
        F.col("_at").cast("int").alias("depth"),
        F.lit(None).cast("string").alias("name"),
        F.expr(f"cast(array() as {found})").alias("found"),
    )

    def step(acc: Column, token: Column) -> Column:
        opens, closes = token.isin("[", "{"), token.isin("]", "}")
        level = acc["depth"] + F.when(opens, 1).otherwise(0)
        one = F.struct(token.alias("bracket"), (acc["at"] + 1).alias("at"), level.alias("level"), F.when(opens, acc["name"]).alias("name"))
        whole = F.startswith(token, F.lit('"')) & F.endswith(token, F.lit('"')) & (F.length(token) > 1) & (acc["at"] >= 0)
        name = F.when(whole, token).when(opens | closes, F.lit(None)).otherwise(acc["name"])
        return F.struct(
            (acc["at"] + F.length(token)).alias("at"),
            (level - F.when(closes, 1).otherwise(0)).alias("depth"),
            name.alias("name"),
            F.when((opens | closes) & (level <= depth), F.concat(acc["found"], F.array(one))).otherwise(acc["found"]).alias("found"),
        )

    events = rare.select(*PIECE, F.explode(F.aggregate(tokens, start, step, lambda acc: acc["found"])).alias("e")).select(*PIECE, "e.*")
    # names are JSON strings themselves and may hold escapes
    name = F.get(F.from_json(F.concat(F.lit("["), "name", F.lit("]")), "array<string>"), F.lit(0))
    return events.select("_file", F.struct("_block", "_pos", "at").alias("place"), "bracket", "level", name.alias("name"))


def _array_span(events: DataFrame, steps: Sequence[str]) -> DataFrame:
    """(_file, open, close) of the array at the path: the last of that name inside the last of the name before, as JSON readers take it."""
    outer = events.where("level = 1 and bracket in ('[', '{')").groupBy("_file").agg(F.min("place").alias("open"), F.first("bracket").alias("bracket"))
    for level in range(1, len(steps) + 2):
        closes = events.where((F.col("level") == level) & F.col("bracket").isin("]", "}")).select("_file", F.col("place").alias("close"))
        outer = outer.join(closes, "_file").where("close > open").groupBy("_file", "open", "bracket").agg(F.min("close").alias("close"))
        if level <= len(steps):
            named = events.where((F.col("level") == level + 1) & F.col("bracket").isin("[", "{") & (F.col("name") == steps[level - 1]))
            named = named.select("_file", F.struct("place", "bracket").alias("inner"))
            inside = outer.where("bracket = '{'").join(named, "_file").where("inner.place > open and inner.place < close")
            inside = inside.groupBy("_file").agg(F.max("inner").alias("inner"))
            outer = inside.select("_file", F.col("inner.place").alias("open"), F.col("inner.bracket").alias("bracket"))
    return outer.where("bracket = '['").select("_file", "open", "close")


def explode_elements(
    spark: SparkSession,
    paths: str | Sequence[str],
    path: str,
    out: str = "element",
    element: str | None = None,
    strict: bool = True,
    limit: int = ELEMENT_LIMIT,
) -> DataFrame:
    """``_file, _element`` (from 1) and the element, for every element of the array at ``path`` in each file.

    ``element`` is the DDL type of an element; without it every element is kept as JSON text. Files without the array,
    or with an empty one, give no row. A file that is not one JSON value (brackets or strings left open or closed too
    often, several values) stops the job, or gives no row with ``strict`` off. An element longer than ``limit``
    characters stops the job before any element is put together.
    """
    steps = _path_steps(path)
    depth = len(steps) + 1
    effects = with_effect(read_pieces(spark, paths))
    blocks = _kept(block_states(effects), "json-blocks")
    placed = _kept(_placed(effects, blocks), "json-pieces")
    # one row per file at most is left of the brackets
    events = _kept(_brackets(placed, depth), "json-brackets")
    last = F.max_by("_then", "_block").alias("then")
    ends = blocks.groupBy("_file").agg(F.sum("_down").alias("depth"), last)
    roots = events.where("level = 1 and bracket in ('[', '{')").groupBy("_file").agg(F.count(F.lit(1)).alias("roots"))
    lowest = placed.groupBy("_file").agg(F.min("_lowest").alias("lowest"))
    faulty = ends.join(lowest, "_file").join(roots, "_file", "left").where("depth <> 0 or then <> 0 or lowest < 0 or roots > 1")
    if strict and (bad := faulty.select("_file").take(1)):
        raise ValueError(f"{bad[0][0]} is not one JSON value: brackets or quotes do not close")
    span = _array_span(events, steps).join(faulty.select("_file"), "_file", "left_anti")
    place = F.struct("_block", "_pos")
    opened, closed = (F.struct(F.col(f"{c}._block").alias("_block"), F.col(f"{c}._pos").alias("_pos")) for c in ("open", "close"))
    within = placed.join(_kept(span, "json-spans"), "_file").where((place >= opened) & (place <= closed))
    begins = (place == opened) | ((F.col("_state") == 0) & (F.col("_at") == depth))
    first = F.when(place == opened, F.col("open.at") + 1).otherwise(1)
    behind = F.when(place == closed, F.col("close.at")).otherwise(F.length("_text") + 1)
    within = within.select(*PIECE, begins.cast("bigint").alias("_begins"), F.substring("_text", first, behind - first).alias("_piece"))
    starts = within.groupBy(*BLOCK).agg(F.sum("_begins").alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(*BLOCK, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy("_file")).alias("_all"))
    upto = Window.partitionBy(*BLOCK).orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = within.join(_kept(starts, "json-starts"), BLOCK).withColumn("_element", F.col("_before") + F.sum("_begins").over(upto))
    sizes = numbered.groupBy("_file", "_element").agg(F.sum(F.length("_piece") + 1).alias("size"))
    if long := sizes.where(F.col("size") > limit + 1).select("_file", "_element").take(1):
        raise ValueError(f"element {long[0][1]} of {long[0][0]} is longer than {limit} characters")
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_pos", "_piece")))
    text = F.array_join(F.transform(pieces, lambda p: p["_piece"]), ",")
    whole = numbered.groupBy("_file", "_element", "_all").agg(F.trim(text, F.lit(BLANKS)).alias("_whole"))
    whole = whole.where((F.col("_whole") != "") | (F.col("_all") > 1))  # an empty array is one blank element
    # the element is read as the only one of an array, so texts and numbers are elements as well
    read = F.from_json(F.concat(F.lit("["), "_whole", F.lit("]")), f"array<{element or 'string'}>", {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    if strict:
        read = F.when(F.col("_whole") == "", F.raise_error(F.concat(F.lit("an element is missing in "), "_file")).cast(f"array<{element or 'string'}>")).otherwise(read)
    return whole.select("_file", "_element", F.get(read, F.lit(0)).alias(out))


def read_elements_raw(
    spark: SparkSession, paths: str | Sequence[str], version: str, path: str, root: str | None = None, content_hash: str | None = None
) -> DataFrame:
    """One row per element as JSON text, with its ordinal in the file and provenance: a document in parts instead of one value."""
    rows = explode_elements(spark, paths, path, ELEMENT).withColumnRenamed("_element", RECORD_NUMBER).withColumn(RECORD_NUMBER, F.col(RECORD_NUMBER).cast("string"))
    origin = relative_to(F.col("_file"), root)
    if content_hash is not None:
        return with_provenance(rows, version, content_hash, origin).drop("_file")
    hashes = file_hashes(spark, paths).select(F.col("path").alias("_file"), F.col("hash").alias("_sha"))
    return with_provenance(rows.join(hashes, "_file"), version, F.col("_sha"), origin).drop("_file", "_sha")
