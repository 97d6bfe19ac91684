"""What a pass over delimited text leaves of every file block: one row from which content hashes, the widest record, record
numbers and the quote state at the start of each block follow.

A line is known by what it does when it begins outside quotes and when it begins inside: whether it ends inside, and how
many separators it has outside quotes. A block is known in the same two ways, and so are two blocks one behind the other
(:meth:`Span.then`), so blocks are summed up by the tasks that read them, in the order of their lines and without a
shuffle of lines; what crosses their bounds is put together from the rows of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.session import scratch
from sediment.sources.provenance import HASH_MODULUS, file_hashes_of_blocks

BLOCK = ["_file", "_block"]
SLICE = 8192  # lines whose sums fit 64 bits
GATHERED = 4 * 1024 * 1024  # characters of lines that are put together at a time


@dataclass(frozen=True)
class Span:
    """Consecutive lines begun in one of the two states (0 outside quotes, 1 inside)."""

    exit: int
    begun: int  # records that begin here
    front: int  # characters, with line breaks, before the first of them
    front_separators: int
    tail_separators: int  # of the last record begun here, as far as it goes
    widest: int  # fields of the records that begin and end here, but for the last

    def then(self, after: Span) -> Span:
        """These lines with ``after``, which must be begun in the state that these end in."""
        inner = self.tail_separators + after.front_separators
        first = self.begun == 0
        return Span(
            after.exit,
            self.begun + after.begun,
            self.front + after.front if first else self.front,
            self.front_separators + after.front_separators if first else self.front_separators,
            after.tail_separators if after.begun else 0 if first else inner,
            max(self.widest, after.widest, inner + 1 if self.begun and after.begun else 0),
        )


def states(ends: tuple[np.ndarray, np.ndarray], entry: int) -> tuple[np.ndarray, int]:
    """State in front of each line, and after the last, of lines with the given end state for either begin."""
    closed, opened = ends
    flips = closed & ~opened
    total = np.cumsum(flips)
    at = np.arange(len(closed))
    last = np.maximum.accumulate(np.where(closed == opened, at, -1))
    after = np.where(last >= 0, closed[last] + total - total[last], entry + total) % 2
    return np.concatenate([[entry], after[:-1]]), int(after[-1])


def span_of(ends: tuple[np.ndarray, np.ndarray], separators: tuple[np.ndarray, np.ndarray], lengths: np.ndarray, entry: int) -> Span:
    before, leaves = states(ends, entry)
    record = np.cumsum(before == 0)
    begun = int(record[-1])
    sums = np.bincount(record, np.where(before == 0, *separators), minlength=begun + 1).astype(np.int64)
    front = record == 0
    return Span(leaves, begun, int(lengths[front].sum()), int(sums[0]), int(sums[-1]) if begun else 0, int(sums[1:-1].max()) + 1 if begun > 1 else 0)


@dataclass
class _BlockSums:
    file: str
    block: int
    size: int
    first: int
    lines: int = 0
    opens: bool = False
    spans: tuple[Span, Span] = (Span(0, 0, 0, 0, 0, 0), Span(1, 0, 0, 0, 0, 0))
    sums: tuple[int, int] = (0, 0)
    placed: tuple[int, int] = (0, 0)

    def add(self, c: np.ndarray, o: np.ndarray, s0: np.ndarray, s1: np.ndarray, lengths: np.ndarray, hashes: Sequence[np.ndarray]) -> None:
        new = [span_of((c, o), (s0, s1), lengths, e) for e in (0, 1)]
        self.spans = tuple(old.then(new[old.exit]) for old in self.spans)
        at = np.arange(len(c))
        sums = [int(h.sum()) for h in hashes]
        self.placed = tuple(p + int((h * at).sum()) + s * self.lines for p, h, s in zip(self.placed, hashes, sums, strict=True))
        self.sums = tuple(x + y for x, y in zip(self.sums, sums, strict=True))
        self.opens |= bool(c.any())
        self.lines += len(c)

    def row(self) -> dict:
        spans = {f"_{n}{e}": getattr(self.spans[e], n) for e in (0, 1) for n in Span.__dataclass_fields__}
        sums = {f"_{n}{k}": Decimal(v[k - 1]) for n, v in (("s", self.sums), ("p", self.placed)) for k in (1, 2)}
        return {"_file": self.file, "_block": self.block, "_size": self.size, "_first": self.first, "_lines": self.lines, "_opens": self.opens} | spans | sums


def runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, slice]]:
    """File, block and rows of each stretch of lines of one block."""
    files, blocks = batch.column("_file").dictionary_encode(), batch.column("_block").to_numpy()
    codes = files.indices.to_numpy()
    bounds = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
    for start, end in zip([0, *bounds.tolist()], [*bounds.tolist(), len(codes)], strict=True):
        yield files.dictionary[int(codes[start])].as_py(), int(blocks[start]), slice(start, end)


NUMBERS = ("_c", "_o", "_s0", "_s1", "_length", "_h1", "_h2")
SCHEMA = (
    "_file string, _block bigint, _size bigint, _first bigint, _lines bigint, _opens boolean, "
    + ", ".join(f"_{n}{e} bigint" for e in (0, 1) for n in Span.__dataclass_fields__)
    + ", _s1 decimal(38,0), _s2 decimal(38,0), _p1 decimal(38,0), _p2 decimal(38,0)"
)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "decimal(38,0)": pa.decimal128(38, 0)}
    schema = pa.schema([(n, kinds[t]) for n, t in (f.split(" ") for f in SCHEMA.split(", "))])
    block: _BlockSums | None = None
    for batch in batches:
        columns = [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in NUMBERS]
        for file, start, at in runs(batch):
            if block is None or (block.file, block.block) != (file, start):
                if block is not None:
                    yield pa.RecordBatch.from_pylist([block.row()], schema)
                block = _BlockSums(file, start, batch.column("_size")[at.start].as_py(), batch.column("_pos")[at.start].as_py())
            for n in range(at.start, at.stop, SLICE):
                c, o, s0, s1, lengths, *hashes = (x[n : min(n + SLICE, at.stop)] for x in columns)
                block.add(c, o, s0, s1, lengths, hashes)
    if block is not None:
        yield pa.RecordBatch.from_pylist([block.row()], schema)


class Profile:
    """The block rows of some files, read once and stored."""

    def __init__(self, lines: DataFrame):
        """``lines`` are those of :func:`sediment.sources.delimited.lines_with_effect`."""
        hashes = [F.pmod(F.xxhash64(F.lit(seed), "_text"), F.lit(HASH_MODULUS)).alias(f"_h{seed}") for seed in (1, 2)]
        narrow = lines.select("_file", "_block", "_size", "_pos", "_c", "_o", "_s0", "_s1", (F.length("_text") + 1).alias("_length"), *hashes)
        where = scratch(lines.sparkSession, "line-blocks")
        narrow.mapInArrow(_fold, SCHEMA).write.parquet(where)
        self.spark: SparkSession = lines.sparkSession
        self.blocks = self.spark.read.parquet(where)

    @cached_property
    def facts(self) -> tuple[int, bool, int]:
        """Number of blocks, whether a quoted field may hold a line break, and the most fields of a record."""
        row = self.placed().agg(F.count(F.lit(1)), F.bool_or("_opens"), F.max("_width")).first()
        return row[0], bool(row[1]), row[2] or 0

    def hashes(self) -> DataFrame:
        """``path, length, hash`` of each file, by the definition of :func:`sediment.sources.provenance.file_hashes`."""
        return file_hashes_of_blocks(self.blocks.withColumnsRenamed({"_file": "path", "_size": "length"}))

    def placed(self) -> DataFrame:
        """Per block: state at entry, records begun earlier in the file, characters that later blocks add to its last
        record, and the most fields of the records that begin in it."""
        before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        sets = F.col("_exit0") == F.col("_exit1")
        flips = F.when(sets, 0).otherwise(F.col("_exit0"))
        upto = F.sum(flips).over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        known = self.blocks.withColumn("_flips", flips).withColumn("_upto", upto)
        anchor = F.last(F.when(sets, F.col("_exit0") + F.col("_upto")), ignorenulls=True).over(before)
        known = known.withColumn("_entry", F.pmod(F.coalesce(anchor, F.lit(0)) + F.col("_upto") - F.col("_flips"), F.lit(2)))
        for name in Span.__dataclass_fields__:
            known = known.withColumn(f"_{name}", F.when(F.col("_entry") == 0, F.col(f"_{name}0")).otherwise(F.col(f"_{name}1")))
        owner = F.last(F.when(F.col("_begun") > 0, F.col("_block")), ignorenulls=True).over(before)
        known = known.withColumns({"_offset": F.coalesce(F.sum("_begun").over(before), F.lit(0)), "_owner": owner})
        # the front of a block belongs to the last record of its owner
        fronts = known.where("_entry = 1").groupBy("_file", F.col("_owner").alias("_block"))
        fronts = fronts.agg(F.sum("_front").alias("_added"), F.sum("_front_separators").alias("_more"))
        both = known.join(fronts, BLOCK, "left")
        last = F.when(F.col("_begun") > 0, F.col("_tail_separators") + F.coalesce("_more", F.lit(0)) + 1)
        return both.select(
            *BLOCK, "_first", "_opens", "_entry", "_offset", F.coalesce("_added", F.lit(0)).alias("_added"), F.greatest("_widest", last).alias("_width")
        )


@dataclass
class _Record:
    """A record on its way through a block."""

    number: int
    pieces: list[str]
    size: int = 0

    def add(self, piece: str, size: int) -> None:
        self.pieces.append(piece)
        self.size += size


def _joined(texts: pa.Array, leaves: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The lines from each start up to the next as one text; a line that ends outside quotes loses its carriage return."""
    if pc.any(pc.ends_with(texts, "\r")).as_py():
        texts = pc.if_else(pa.array(leaves == 1), texts, pc.replace_substring_regex(texts, "\r\\z", ""))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([*starts, len(texts)], pa.int32()), texts), "\n")


def gather(limit: int):
    """Function for mapInArrow over lines with the row of their block: records, and parts of records that cross a block's bounds.

    Lines stay in Arrow and are put together some megabytes at a time, so a worker holds little beside the batch it was
    given and the one record that is not complete.
    """
    message = f"a record is longer than {limit} characters: is a quote not closed?"
    schema = pa.schema([("_file", pa.string()), ("_record", pa.int64()), ("_block", pa.int64()), ("_piece", pa.string())])

    def rows(at: tuple[str, int], numbers: Sequence[int], pieces: pa.Array) -> pa.RecordBatch:
        n = len(pieces)
        return pa.RecordBatch.from_arrays([pa.repeat(at[0], n), pa.array(numbers, pa.int64()), pa.repeat(at[1], n), pieces], schema=schema)

    def put(at: tuple[str, int], record: _Record, size: int) -> Iterator[pa.RecordBatch]:
        if record.pieces:
            if size > limit:
                raise ValueError(message)
            yield rows(at, [record.number], pa.array(["\n".join(record.pieces)], pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        state = added = 0
        record = _Record(0, [])
        for batch in batches:
            texts = batch.column("_text").cast(pa.string())
            ends = tuple(batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("_c", "_o"))
            sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            megabytes = np.cumsum(sizes) // GATHERED
            for file, start, stretch in runs(batch):
                if at != (file, start):
                    if at is not None:
                        yield from put(at, record, record.size + added)
                    at = (file, start)
                    state, added = batch.column("_entry")[stretch.start].as_py(), batch.column("_added")[stretch.start].as_py()
                    record = _Record(batch.column("_offset")[stretch.start].as_py(), [])
                cuts = stretch.start + 1 + np.flatnonzero(np.diff(megabytes[stretch]))
                for begin, end in zip([stretch.start, *cuts.tolist()], [*cuts.tolist(), stretch.stop], strict=True):
                    before, after = states(tuple(e[begin:end] for e in ends), state)
                    begins = np.flatnonzero(before == 0)
                    starts = begins if before[0] == 0 else np.concatenate([[0], begins])
                    pieces = _joined(texts.slice(begin, end - begin), np.concatenate([before[1:], [after]]), starts)
                    lengths = np.add.reduceat(sizes[begin:end], starts)
                    if len(starts) > len(begins):
                        record.add(pieces[0].as_py(), int(lengths[0]))
                        pieces, lengths = pieces.slice(1), lengths[1:]
                    if len(begins):
                        # all but the last record begun here are complete; the last may go on in the next lines
                        yield from put(at, record, record.size)
                        if (lengths[:-1] > limit).any():
                            raise ValueError(message)
                        whole = len(begins) - 1
                        if whole:
                            yield rows(at, np.arange(record.number + 1, record.number + 1 + whole), pieces.slice(0, whole))
                        record = _Record(record.number + len(begins), [pieces[whole].as_py()], int(lengths[whole]))
                    if record.size > limit + 2:
                        raise ValueError(message)
                    state = after
        if at is not None and record.pieces:
            if record.size + added > limit + 2:
                raise ValueError(message)
            yield rows(at, [record.number], pa.array(["\n".join(record.pieces)], pa.string()))

    return run, "_file string, _record bigint, _block bigint, _piece string"
