"""Faithful reading of delimited text: every record, every value as text, no header promoted.

The files are split by Spark's text source, so one large file is read by many tasks. Records whose
quoted fields hold line breaks are found by following the open/closed state of quotes from line to
line: within a block by the task that reads it, across blocks by their summaries (see ``profile.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.session import TARGET_PARTITION_BYTES
from sediment.sources.files import content_size, walk
from sediment.sources.profile import BLOCK, Profile, gather
from sediment.sources.provenance import (
    POSITION_PREFIX,
    RECORD_NUMBER,
    file_path,
    _as_list,
    relative_to,
    with_provenance,
)

LINE_END = r"\r\z"
# A block row is a path and three numbers: a million of them stay within a few hundred megabytes.
BROADCAST_BLOCKS = 1_000_000


def _quoted(closing: str) -> str:
    return '"[^"]*+(?:""[^"]*+)*+' + closing


def _field(sep: str) -> str:
    """One field: quoted with an optional tail, or unquoted; quotes inside unquoted text are plain text."""
    s = _class(sep)
    return f'(?:{_quoted(chr(34))}[^{s}]*+|[^{s}"][^{s}]*+)'


def _class(sep: str) -> str:
    if len(sep) != 1 or sep in '"\n\r':
        raise ValueError("the separator is one character other than a quote or a line break")
    return "\\" + sep if not sep.isalnum() and sep.isascii() else sep


def _leaves_open(line: Column, sep: str) -> Column:
    """True when the line, begun outside quotes, ends inside a quoted field."""
    s = _class(sep)
    f = _field(sep)
    return F.contains(line, F.lit('"')) & line.rlike(f"^(?:(?:{f})?+{s})*+{_quoted(chr(92) + 'z')}")


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Physical lines with their file, block and position; a byte-order mark is stripped by the source."""
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(_as_list(paths))
        .select(
            F.col("value").alias("_text"),
            file_path().alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("_metadata.file_size").alias("_size"),
            F.monotonically_increasing_id().alias("_pos"),
        )
    )


def block_count(spark: SparkSession, paths: str | Sequence[str]) -> int:
    """At most how many blocks the files are read in, from their sizes; contents are not read."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b")
    bytes_per_block = int(size) if size.isdigit() else TARGET_PARTITION_BYTES
    total, files = content_size(spark, _as_list(paths))
    # Small inputs are cut finer, so that every core gets a block.
    cores = spark.sparkContext.defaultParallelism
    return total // bytes_per_block + files + cores


def with_record_number(df: DataFrame, name: str = RECORD_NUMBER, blocks_known: int | None = None) -> DataFrame:
    """Number the lines of each file from 1, by block offsets instead of one window per file.

    Expects the columns of :func:`read_lines`. Only the block table, one row per file block, is
    summed up in order. When the number of blocks is known and small the table is broadcast, so the
    text is not shuffled; otherwise Spark chooses by measured size.
    """
    blocks = df.groupBy(*BLOCK).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_offset", F.coalesce(F.sum("_lines").over(before), F.lit(0))).drop("_lines")
    if blocks_known is not None and blocks_known <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    joined = df.join(offsets, BLOCK, "left")
    number = F.col("_offset") + F.col("_pos") - F.col("_first") + 1
    # The two passes must see the same blocks; a row that lost its block stops the job.
    return joined.withColumn(
        name,
        F.coalesce(number, F.raise_error(F.lit("file blocks changed between passes")).cast("bigint")),
    ).drop("_offset", "_first")


def lines_with_effect(spark: SparkSession, paths: str | Sequence[str], sep: str = ";") -> DataFrame:
    """Lines with what each does to the quote state, begun closed (``_c``) and begun open (``_o``), and its separators outside quotes."""
    text = F.col("_text")
    quoted = F.contains(text, F.lit('"'))
    behind = F.concat(F.lit('"'), text)
    plain = F.when(F.endswith(text, F.lit("\r")), F.expr("left(_text, length(_text) - 1)")).otherwise(text)
    count = F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))
    # an empty record has no field, hence one separator less than none
    separators = F.when(quoted, F.size(_split_fields(plain, sep)) - 1).when(plain == "", -1).otherwise(count)
    return (
        read_lines(spark, paths)
        .withColumns(
            {
                "_c": quoted & _leaves_open(text, sep),
                "_o": ~quoted | _leaves_open(behind, sep),
                "_s0": separators,
                "_s1": F.when(quoted, F.size(_split_fields(behind, sep)) - 1).otherwise(0),
            }
        )
    )


def profile(spark: SparkSession, paths: str | Sequence[str], sep: str = ";") -> Profile:
    """One pass over the text: all that reading, hashing and numbering its records need to know of its blocks."""
    return Profile(lines_with_effect(spark, paths, sep))


def _records_by_line(spark: SparkSession, paths, sep: str, known: Profile) -> DataFrame:
    """Each line is a record; a quote left open stops the job instead of splitting a record."""
    lines = _with_block(read_lines(spark, paths), known, "_first", "_offset")
    guarded = F.when(
        _leaves_open(F.col("_text"), sep),
        F.raise_error(F.lit("a quoted field holds a line break: read with multiline=True")).cast("string"),
    ).otherwise(F.regexp_replace("_text", LINE_END, ""))
    return lines.select("_file", (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).alias("_record"), guarded.alias("_text"))


def _with_block(lines: DataFrame, known: Profile, *columns: str) -> DataFrame:
    """Lines with columns of their block's row, in order within each block; a line that lost its block stops the job."""
    count = known.facts[0]
    blocks = known.placed().select(*BLOCK, *columns)
    joined = lines.join(F.broadcast(blocks) if count <= BROADCAST_BLOCKS else blocks, BLOCK, "left")
    changed = F.raise_error(F.lit("file blocks changed between passes")).cast("bigint")
    joined = joined.withColumns({c: F.coalesce(F.col(c), changed) for c in columns})
    return joined if count <= BROADCAST_BLOCKS else joined.sortWithinPartitions(*BLOCK, "_pos")


def _records_across_lines(spark: SparkSession, paths, sep: str, record_limit: int, known: Profile) -> DataFrame:
    lines = _with_block(lines_with_effect(spark, paths, sep).select(*BLOCK, "_pos", "_text", "_c", "_o"), known, "_entry", "_offset", "_added")
    run, schema = gather(record_limit)
    parts = lines.drop("_pos").mapInArrow(run, schema)
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_piece")))
    whole = F.array_join(F.transform(pieces, lambda p: p["_piece"]), "\n")
    records = parts.groupBy("_file", "_record").agg(whole.alias("_text"))
    return records.select("_file", "_record", _within_limit(F.col("_text"), F.length("_text"), record_limit).alias("_text"))


def _within_limit(value: Column, size: Column, limit: int) -> Column:
    message = f"a record is longer than {limit} characters: is a quote not closed?"
    return F.when(size <= limit, value).otherwise(F.raise_error(F.lit(message)).cast("string"))


def _split_fields(record: Column, sep: str) -> Column:
    """Fields of one record as an array of text; an empty line has none."""
    s = _class(sep)
    end = '(?:"|' + "\\z)"
    pattern = f'{s}((?:{_quoted(end)}[^{s}]*+|[^{s}]*+))'
    raw = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(pattern), F.lit(1))
    inner = r'^"([^"]*+(?:""[^"]*+)*+)("?)([\s\S]*)\z'

    def value(f: Column) -> Column:
        return F.when(
            F.startswith(f, F.lit('"')),
            F.concat(
                F.replace(F.regexp_extract(f, inner, 1), F.lit('""'), F.lit('"')), F.regexp_extract(f, inner, 3)
            ),
        ).otherwise(f)

    quoted = F.contains(record, F.lit('"'))
    return (
        F.when(record == "", F.expr("cast(array() as array<string>)"))
        .when(quoted, F.transform(raw, value))
        .otherwise(F.split(record, s, -1))
    )


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    multiline: bool | None = None,
    record_limit: int = 64 * 1024 * 1024,
    known: Profile | None = None,
) -> DataFrame:
    """``_file, _record, fields``: every record of every file with its ordinal and its fields.

    The text is read twice: for its :func:`profile`, unless one of the same paths is given, and for the records. By
    default records are put together from lines only where the profile has a quoted field with a line break. Text is
    UTF-8, with or without a byte-order mark; lines end in LF or CRLF.
    """
    known = known or profile(spark, paths, sep)
    if known.facts[1] if multiline is None else multiline:
        records = _records_across_lines(spark, paths, sep, record_limit, known)
    else:
        records = _records_by_line(spark, paths, sep, known)
    return records.select("_file", "_record", _split_fields(F.col("_text"), sep).alias("fields"))


def positional_columns(width: int) -> list[str]:
    return [f"{POSITION_PREFIX}{i:02d}" for i in range(1, width + 1)]


def read_delimited_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    version: str,
    sep: str = ";",
    root: str | None = None,
    multiline: bool | None = None,
    width: int | None = None,
    content_hash: str | None = None,
    known: Profile | None = None,
) -> DataFrame:
    """Positional text columns plus record ordinal and provenance.

    Records shorter than the widest are padded with empty text. ``width`` is the number of columns, that of the widest
    record if it is not given; a record with more fields stops the job. Without ``content_hash`` each file's own hash is
    joined. Width, hash and record numbers come from one :func:`profile` of the text, which may be given.
    """
    known = known or profile(spark, paths, sep)
    records = read_records(spark, paths, sep, multiline, known=known)
    width = known.facts[2] if width is None else width
    message = F.concat(F.lit("record "), F.col("_record"), F.lit(f" has more than {width} fields in "), F.col("_file"))
    records = records.withColumn(
        "fields", F.when(F.size("fields") <= width, F.col("fields")).otherwise(F.raise_error(message).cast("array<string>"))
    )
    cells = [
        F.coalesce(F.get("fields", F.lit(i)), F.lit("")).alias(c)
        for i, c in enumerate(positional_columns(width))
    ]
    numbered = records.select(*cells, F.col("_record").cast("string").alias(RECORD_NUMBER), "_file")
    origin = relative_to(F.col("_file"), root)
    if content_hash is not None:
        return with_provenance(numbered, version, content_hash, origin).drop("_file")
    hashes = known.hashes().select(F.col("path").alias("_file"), F.col("hash").alias("_sha"))
    landed = with_provenance(numbered.join(hashes, "_file"), version, F.col("_sha"), origin)
    return landed.drop("_file", "_sha")


def promote_header(
    df: DataFrame, header_row: int = 4, ordinal: str = RECORD_NUMBER, keep: Sequence[str] = ()
) -> DataFrame:
    """Name the positional columns after one record and keep the records below it, blank ones dropped.

    Files that differ in that record stop the job. Columns without a name keep the name of their position.
    Only distinct header records come to the driver, two at most.
    """
    positions = [c for c in df.columns if c.startswith(POSITION_PREFIX)]
    number = F.col(ordinal).cast("bigint")
    headers = df.filter(number == header_row).select(*[F.trim(c).alias(c) for c in positions]).distinct().take(2)
    if len(headers) != 1:
        raise ValueError(f"files differ in record {header_row}" if headers else f"no record {header_row} to take names from")
    names = {c: headers[0][c] or c for c in positions}
    repeated = {n for n in names.values() if list(names.values()).count(n) > 1}
    if repeated:
        raise ValueError(f"header names repeat: {sorted(repeated)}")
    filled = F.exists(F.array(*names), lambda v: F.trim(v) != "")
    rows = df.filter((number > header_row) & filled)
    return rows.select(*[F.col(c).alias(n) for c, n in names.items()], *keep)


def exclude_keys(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """All rows but those with one of the keys; titles, headers and blank records stay."""
    return df.filter(~F.coalesce(F.trim(col).isin(*keys), F.lit(False)))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Name below the root, format, size and, for CSV, number of physical lines of each file.

    The listing is metadata, one entry per file; the lines are counted by Spark.
    """
    files = spark.createDataFrame(walk(spark, root), "path string, bytes bigint")
    name = relative_to(F.col("path"), root, encoded=False)
    suffix = F.when(name.contains("."), F.upper(F.substring_index(name, ".", -1))).otherwise("")
    listed = files.select(name.alias("file"), suffix.alias("format"), "bytes")
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .text(root)
        .groupBy(file_path().alias("_path"))
        .agg(F.count(F.lit(1)).alias("_lines"))
        .select(relative_to(F.col("_path"), root).alias("file"), "_lines")
    )
    counted = F.when(F.col("format") == "CSV", F.coalesce("_lines", F.lit(0)))
    return listed.join(lines, "file", "left").select("file", "format", "bytes", counted.alias("physical_lines"))
