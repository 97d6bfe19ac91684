"""Technical columns added on landing: origin, version label, instant and content hash."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sediment.sources.files import qualified

# Names of the technical columns and of the positional and document columns.
ORIGIN = "_arquivo_origem"
VERSION = "_versao_fonte"
INGESTED_AT = "_ingerido_em"
CONTENT_HASH = "_hash_arquivo"
RECORD_NUMBER = "_linha_origem"
DOCUMENT = "conteudo_json"
ELEMENT = "elemento_json"
POSITION_PREFIX = "col_"

# Scheme and leading slashes: the same file is written with one or three of them.
SCHEME = "^[A-Za-z0-9+.-]+:/+|^/+"
NESTED = (ArrayType, MapType, StructType)

# Name of the definition that file hashes follow; another definition needs another name.
HASH_NAME = "lines-1:"
HASH_MODULUS = (1 << 31) - 1


def file_path() -> Column:
    return F.col("_metadata.file_path")


def plain_path(path: Column) -> Column:
    """File path without URL escapes; most paths have none and pass through."""
    escaped = F.contains(path, F.lit("%"))
    return F.when(escaped, F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def relative_to(path: Column, root: str | None, encoded: bool = True) -> Column:
    """Path below the root, with '/' between folders; the bare file name when there is no root."""
    decoded = plain_path(path) if encoded else path
    if root is None:
        return F.substring_index(decoded, "/", -1)
    folder = root.split(":", 1)[-1].lstrip("/").rstrip("/") + "/"
    at = F.locate(folder, decoded)
    below = F.substring(decoded, at + F.lit(len(folder)), F.length(decoded))
    return F.when(at > 0, below).otherwise(F.substring_index(decoded, "/", -1))


def _files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_as_list(paths))


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path, size and modification time of the files; contents are not read."""
    return _files(spark, paths).select(file_path().alias("path"), "length", "modificationTime")


def file_hashes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, length, hash`` of each file with any content: one definition for all sizes, in one pass.

    Two hashes of every line are summed, plain and multiplied by the number of the line in its file, and the size
    in bytes and the number of lines go in as well. Sums are made per file block and put together from the block
    table, so neither block size nor number of cores matters, and no file has to be one value.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(_as_list(paths)).select(
        file_path().alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
        *[F.pmod(F.xxhash64(F.lit(seed), "value"), F.lit(HASH_MODULUS)).alias(f"_h{seed}") for seed in (1, 2)],
    )
    wide = lambda c: c.cast("decimal(38,0)")
    sums = {f"_s{k}": F.sum(wide(F.col(f"_h{k}"))) for k in (1, 2)}
    placed = {f"_p{k}": F.sum(wide(F.col(f"_h{k}")) * wide(F.col("_pos"))) for k in (1, 2)}
    blocks = lines.groupBy("path", "length", "_block").agg(
        F.count(F.lit(1)).alias("_lines"), F.min("_pos").alias("_first"), *[c.alias(n) for n, c in {**sums, **placed}.items()]
    )
    return file_hashes_of_blocks(blocks.withColumns({f"_p{k}": F.col(f"_p{k}") - F.col(f"_s{k}") * F.col("_first") for k in (1, 2)}))


def file_hashes_of_blocks(blocks: DataFrame) -> DataFrame:
    """``path, length, hash`` from one row per block: lines, sums of both line hashes (``_s``), and sums with each hash times the
    number of its line in the block, from 0 (``_p``)."""
    wide = lambda c: c.cast("decimal(38,0)")
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_offset", F.coalesce(F.sum("_lines").over(before), F.lit(0)))
    moved = [F.sum(wide(F.col(f"_p{k}") + wide(F.col(f"_s{k}")) * wide(F.col("_offset")))).cast("string") for k in (1, 2)]
    plain = [F.sum(f"_s{k}").cast("string") for k in (1, 2)]
    mark = F.concat_ws(":", F.col("length").cast("string"), F.sum("_lines").cast("string"), *plain, *moved)
    return blocks.groupBy("path", "length").agg(F.concat(F.lit(HASH_NAME), F.sha2(mark, 256)).alias("hash"))


def _fingerprint(*row: Column) -> Column:
    """Order-independent mark of a set of rows: count and sums of two independent 64-bit hashes."""
    wide = "decimal(38,0)"
    return F.concat_ws(
        ":",
        F.count(F.lit(1)).cast("string"),
        F.sum(F.xxhash64(*row).cast(wide)).cast("string"),
        F.sum(F.xxhash64(F.lit(1), *row).cast(wide)).cast("string"),
    )


def row_cells(df: DataFrame) -> list[Column]:
    """What a hash of a row is taken over: all cells by column name, and whether each is missing."""
    cells: list[Column] = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        if isinstance(field.dataType, NESTED):
            # Missing parts inside a nested value must count, so it is hashed as text.
            cells.append(F.to_json(F.struct(field.name), {"ignoreNullFields": "false"}))
        else:
            # The hash passes over NULL, so whether the cell is missing goes in as well.
            cells += [F.col(field.name), F.col(field.name).isNull()]
    return cells


def frame_fingerprint(df: DataFrame) -> str:
    """Content hash of a DataFrame: the same rows give the same hash in any order and layout."""
    cells = row_cells(df)
    schema = ",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema))
    mark = _fingerprint(*cells) if cells else F.count(F.lit(1)).cast("string")
    return df.agg(F.sha2(F.concat_ws(":", F.lit(schema), mark), 256)).first()[0]


def source_hashes(spark: SparkSession, paths: Sequence[str], files: DataFrame | None = None) -> dict[str, str]:
    """Content hash of each source, all in one pass: that of a single file, or a mark over the hashes of
    the files of a folder, whatever their names. ``files`` gives the hashes of files that are known already."""
    named = {path: _bare(qualified(spark, path)) for path in paths}
    files = (file_hashes(spark, list(named)) if files is None else files).withColumn("path", F.regexp_replace(plain_path(F.col("path")), SCHEME, ""))
    # A file belongs to the source that is its path or one of the folders above it: an equi-join on those.
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    sources = spark.createDataFrame([(bare,) for bare in set(named.values())], "_source string")
    marks = (
        files.select("hash", F.explode(above).alias("_source"))
        .join(sources, "_source")
        .groupBy("_source")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.max("hash").alias("only"),
            F.sha2(_fingerprint(F.col("hash")), 256).alias("mark"),
        )
        .collect()
    )
    found = {r["_source"]: r["only"] if r["files"] == 1 else r["mark"] for r in marks}
    if missing := [p for p, bare in named.items() if bare not in found]:
        raise FileNotFoundError(f"no content at {missing}")
    return {path: found[bare] for path, bare in named.items()}


def source_hash(spark: SparkSession, path: str) -> str:
    return source_hashes(spark, [path])[path]


def _bare(path: str) -> str:
    return re.sub(SCHEME, "", path)


def with_provenance(
    df: DataFrame, version: str, content_hash: Column | str, origin: Column, instant: str | None = None
) -> DataFrame:
    """Add the technical columns, all text; the instant is fixed once for the whole batch."""
    now = instant or datetime.now(timezone.utc).isoformat()
    return df.withColumns(
        {
            ORIGIN: origin,
            VERSION: F.lit(version),
            INGESTED_AT: F.lit(now),
            CONTENT_HASH: F.lit(content_hash) if isinstance(content_hash, str) else content_hash,
        }
    )


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)
