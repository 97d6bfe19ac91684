"""Alignment of two tokenizers over the same texts, and how often their tokens are linked in the corpus.

Tokenizer A is a byte-level BPE, B a sentencepiece model with byte fallback that puts a space before the text, so A
reads the text behind a space too. Character offsets of A and proto spans of B are coarse cuts of the text. Where tokens
end inside a character (several tokens of A with the span of one character, pieces <0xHH> of B) the decoded bytes of the
tokens place the cut. Where tokens of both end together a group ends; tokens whose bytes overlap are linked.

No token of either reaches over a space between two plain characters: A splits there before it merges, and no piece of B
has a space behind another character, which is checked when the model is read. A text is cut at such spaces and each
different segment is encoded once for many documents, with the same tokens as in the whole text.

Counts of linked pairs are summed by block of documents first, so the shuffle carries each pair once a block. A
document keeps its pairs as places in its block's list, and meets the corpus counts of that list, not of each link.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from sediment.llm.common import stored
from sediment.llm.tokens import read_vocabulary

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"

BLOCK_CHARS = 8_000_000
RUN_CHARS = 20_000  # that are encoded at once
OUT_CHARS = 4_000_000
SLICE = 1 << 18
REMEMBERED = 800_000  # segments of earlier blocks
SPACE = "▁"
PLAIN = "!-~À-ɏ"  # characters that are neither white space nor combine with others
SEGMENTS = re.compile(f"(?<=[{PLAIN}])(?= [{PLAIN}])")
PLAIN_SET = frozenset(map(chr, [*range(ord("!"), ord("~") + 1), *range(ord("À"), ord("ɏ") + 1)]))
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


def byte_level_alphabet() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


@dataclass(frozen=True)
class Aligner:
    """Both tokenizers and the bytes of their ids; ``cut`` is off where the pieces of B do not allow segments."""

    a: Tokenizer
    b: sentencepiece.SentencePieceProcessor
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    b_is_byte: np.ndarray
    cut: bool

    def segments(self, text: str) -> list[str]:
        """The text behind a space, in pieces that both tokenizers encode as they do within the whole."""
        return SEGMENTS.split(" " + text) if self.cut else [" " + text]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A, their ends in bytes, ids of B, their ends, for a text that begins with a space; None if the tokens' bytes are not its bytes."""
        raw = text.encode()
        encoded = self.a.encode(text, add_special_tokens=False)
        proto = self.b.encode(text[1:], return_type="proto").pieces
        both = [(p.id, p.end) for p in proto]
        a, b = encoded.ids, [i for i, _ in both]
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a_coarse = np.fromiter(map(itemgetter(1), encoded.offsets), np.int64, len(a))
        if len(raw) != len(text):
            starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
            a_coarse = np.append(starts, len(raw))[a_coarse]
        b_coarse = np.fromiter(map(itemgetter(1), both), np.int64, len(b)) + 1  # the space before the text is not in the spans
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        b_coarse[self.b_is_byte[b]] = len(raw)
        return a, refined(a_coarse, self.a_sizes[a]), b, refined(b_coarse, self.b_sizes[b])


def refined(coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where tokens end in bytes: at their coarse cuts, or before them by their decoded bytes where they end inside a character."""
    return np.minimum(coarse, np.cumsum(sizes))


@dataclass(frozen=True)
class Segments:
    """Aligned segments one behind the other. The ``*_at`` have the first item of each segment, and of the end.

    A segment that has no alignment is not ``sound`` and has no items.
    """

    sound: np.ndarray
    a: np.ndarray
    a_ends: np.ndarray
    a_at: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray
    b_at: np.ndarray
    ends: np.ndarray  # of groups, in bytes from the first segment
    ends_at: np.ndarray
    links: np.ndarray  # id of A and id of B in one number
    links_at: np.ndarray
    texts: list[str]  # of the groups


def align_segments(both: Aligner, pieces: list[str]) -> Segments:
    """Tokens, groups and links of each piece; pieces that stay apart behind each other are encoded together."""
    runs: list[tuple[int, int]] = []
    chars, joins = 0, False
    for n, piece in enumerate(pieces):
        plain = both.cut and len(piece) > 1 and piece[1] in PLAIN_SET and piece[-1] in PLAIN_SET
        if plain and joins and chars + len(piece) <= RUN_CHARS:
            runs[-1] = (runs[-1][0], n + 1)
            chars += len(piece)
        else:
            runs.append((n, n + 1))
            chars, joins = len(piece), plain
    sizes = np.array([len(p) if p.isascii() else len(p.encode()) for p in pieces], dtype=np.int64)
    sound = np.ones(len(pieces), dtype=bool)
    parts: list[tuple[np.ndarray, ...]] = []
    base = 0
    while runs:
        start, end = runs.pop()
        found = both.tokens("".join(pieces[start:end]))
        bounds = np.cumsum(sizes[start:end])
        if end > start + 1 and (found is None or not (np.isin(bounds, found[1]).all() and np.isin(bounds, found[3]).all())):
            runs.extend((n, n + 1) for n in range(start, end))
        elif found is None:
            sound[start] = False
        else:
            parts.append((start, *found))
    sizes[~sound] = 0
    stops = np.cumsum(sizes)
    parts.sort(key=lambda p: p[0])
    base = stops - sizes
    a, a_ends, b, b_ends = (np.concatenate([p[k] + (base[p[0]] if k in (2, 4) else 0) for p in parts] or [np.zeros(0, np.int64)]) for k in (1, 2, 3, 4))
    ends, cuts = np.intersect1d(a_ends, b_ends, assume_unique=True), np.union1d(a_ends, b_ends)
    links = a[np.searchsorted(a_ends, cuts)] << 32 | b[np.searchsorted(b_ends, cuts)]
    first = lambda x: np.concatenate([[0], np.searchsorted(x, stops, side="right")])
    a_at, b_at = first(a_ends), first(b_ends)
    texts = _group_texts(a, a_ends, b, b_ends, ends, a_at + b_at)
    return Segments(sound, a, a_ends, a_at, b, b_ends, b_at, ends, first(ends), links, first(cuts), texts)


def _group_texts(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, ends: np.ndarray, items_at: np.ndarray) -> list[str]:
    """The groups of each segment as text: ids of A, a bar, ids of B, groups joined by semicolons."""
    if not len(a):
        return [""] * (len(items_at) - 1)
    of_a, of_b = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
    b_before = np.concatenate([[0], np.searchsorted(b_ends, ends, side="right")])[of_a]
    a_through = np.searchsorted(a_ends, ends, side="right")[of_b]
    place = np.concatenate([np.arange(len(a)) + b_before, np.arange(len(b)) + a_through])
    ids = np.empty(len(place), dtype=np.int64)
    marks = np.empty(len(place), dtype=np.uint8)
    ids[place] = np.concatenate([a, b])
    marks[place] = np.concatenate([np.where(a_ends == ends[of_a], ord("|"), ord(",")), np.where(b_ends == ends[of_b], ord(";"), ord(","))])
    digits, lengths = _decimals(max(int(ids.max()), 99_999))
    table = digits[ids]
    length = lengths[ids]
    table[np.arange(len(ids)), length] = marks
    raw = table[np.arange(table.shape[1]) <= length[:, None]].tobytes().decode()
    at = np.concatenate([[0], np.cumsum(length + 1)])[items_at].tolist()
    return [raw[x : y - 1] if y > x else "" for x, y in pairwise(at)]


@lru_cache(maxsize=2)
def _decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers up to ``most``, from the left, with room for a mark; and how many there are."""
    texts = np.arange(most + 1).astype(f"S{len(str(most)) + 1}")
    table = texts.view(np.uint8).reshape(most + 1, -1)
    return table, (table > 0).sum(axis=1)


@lru_cache(maxsize=2)
def aligner(vocabulary_a: bytes, vocabulary_b: bytes) -> Aligner:
    a = Tokenizer.from_str(vocabulary_a.decode())
    a.encode_special_tokens = True  # their strings in a text are plain text
    alphabet = byte_level_alphabet()
    entries = json.loads(vocabulary_a)["model"]["vocab"]
    a_bytes = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        a_bytes[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
    b = sentencepiece.SentencePieceProcessor(model_proto=vocabulary_b)
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    byte = [BYTE_PIECE.fullmatch(p) if b.is_byte(i) else None for i, p in enumerate(pieces)]
    b_bytes = [bytes.fromhex(m[1]) if m else p.replace(SPACE, " ").encode() for m, p in zip(byte, pieces, strict=True)]
    cut = not any(SPACE in p.lstrip(SPACE) for p in pieces)
    sizes = [np.array(list(map(len, x)), dtype=np.int64) for x in (a_bytes, b_bytes)]
    return Aligner(a, b, a_bytes, b_bytes, *sizes, np.array([m is not None for m in byte]), cut)


GROUPS = "array<struct<start:int,end:int,a:array<int>,b:array<int>>>"


def groups(text: Column, vocabulary_a: bytes, vocabulary_b: bytes) -> Column:
    """The groups of a text: byte span within the text behind a space, and the ids of both tokenizers in it; empty without tokens."""

    @F.arrow_udf(GROUPS)
    def align(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        both = aligner(vocabulary_a, vocabulary_b)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            yield pa.array([_spans(both, value.as_py()) for value in batch], kind)

    return align.asNondeterministic()(text)


def _spans(both: Aligner, text: str | None) -> list[dict]:
    found = align_segments(both, both.segments(text)) if text else None
    if found is None or not found.sound.all():
        return []
    i, j = (np.searchsorted(x, found.ends, side="right").tolist() for x in (found.a_ends, found.b_ends))
    starts = [(0, 0, 0), *zip(found.ends.tolist(), i, j, strict=True)]
    return [{"start": s, "end": e, "a": found.a[x:u].tolist(), "b": found.b[y:v].tolist()} for (s, x, y), (e, u, v) in pairwise(starts)]


FIRST_PASS = pa.schema(
    [
        ("id", pa.int64()),
        ("block", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups", pa.string()),
        ("places", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
        ("pairs", pa.list_(pa.int64())),
        ("documents", pa.list_(pa.int32())),
    ]
)
FIRST_PASS_DDL = "id long, block long, n_a long, n_b long, n_groups long, n_links long, groups string, places array<int>, times array<int>, pairs array<long>, documents array<int>"


class _Memory:
    """Segments that a worker has aligned, with the figures of each; it forgets all of them when there are too many.

    Results do not depend on what it holds.
    """

    def __init__(self, both: Aligner):
        self.both = both
        self.clear()

    def clear(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__  # a new segment gets the next number
        self.sound = np.zeros(0, dtype=bool)
        self.counts = np.zeros((4, 0), dtype=np.int64)  # tokens of A, of B, groups, links
        self.links = np.zeros(0, dtype=np.int64)
        self.texts: list[str] = []

    def complete(self) -> None:
        """Align the segments that got a number since the last time."""
        new = list(islice(self.numbers, len(self.texts), None))
        found = align_segments(self.both, new)
        counts = np.stack([np.diff(x) for x in (found.a_at, found.b_at, found.ends_at, found.links_at)])
        self.sound = np.concatenate([self.sound, found.sound])
        self.counts = np.concatenate([self.counts, counts], axis=1)
        self.links = np.concatenate([self.links, found.links])
        self.texts += found.texts


class _Block:
    """Documents of a block until it is full: rows of documents, then one row (without n_a) with the pairs of the block."""

    def __init__(self, number: int, memory: _Memory):
        self.number, self.memory, self.size = number, memory, 0
        self.ids: list[int | None] = []
        self.texts: list[np.ndarray] = []  # the segments of each text, by number
        if len(memory.texts) > REMEMBERED:
            memory.clear()

    def add(self, doc_id: int | None, text: str | None) -> None:
        self.size += len(text or "") + 100
        pieces = self.memory.both.segments(text) if text else []
        self.ids.append(doc_id)
        self.texts.append(np.fromiter(map(self.memory.numbers.__getitem__, pieces), np.int32, len(pieces)))

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        memory = self.memory
        memory.complete()
        texts, n_links = memory.texts, memory.counts[3]
        links_at = np.cumsum(n_links) - n_links
        sound = [len(at) > 0 and bool(memory.sound[at].all()) for at in self.texts]
        used = np.zeros(len(texts), dtype=bool)
        for at, whole in zip(self.texts, sound, strict=True):
            used[at] |= whole
        here = np.repeat(used, n_links)
        places = np.zeros(len(memory.links), dtype=np.int64)
        pairs, places[here] = np.unique(memory.links[here], return_inverse=True)
        documents = np.zeros(len(pairs), dtype=np.int64)
        rows: list[tuple] = []
        size = 0
        for doc_id, at, whole in zip(self.ids, self.texts, sound, strict=True):
            if whole:
                held = np.zeros(0, np.int64)
                times = np.zeros(0, np.int64)
                for start in range(0, len(at), SLICE):  # a very long text is counted by parts
                    part = at[start : start + SLICE]
                    lengths = n_links[part]
                    ends = np.cumsum(lengths)
                    links = np.repeat(links_at[part] - ends + lengths, lengths) + np.arange(ends[-1])
                    p, t = np.unique(places[links], return_counts=True)
                    if start:
                        both, inverse = np.unique(np.concatenate([held, p]), return_inverse=True)
                        p, t = both, np.bincount(inverse, np.concatenate([times, t])).astype(np.int64)
                    held, times = p, t
                documents[held] += 1
                joined = ";".join(map(texts.__getitem__, at.tolist()))
                rows.append((doc_id, *map(int, memory.counts[:, at].sum(axis=1)), joined, held, times))
                size += len(joined)
            else:
                rows.append((doc_id, 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)))
            if size > OUT_CHARS:
                yield self._rows(rows)
                rows, size = [], 0
        if rows:
            yield self._rows(rows)
        one = {"block": self.number, "pairs": pairs, "documents": documents}
        yield pa.RecordBatch.from_arrays([pa.array([one.get(f.name)], f.type) for f in FIRST_PASS], schema=FIRST_PASS)

    def _rows(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        cut = pa.array(np.concatenate([[0], np.cumsum([len(r[6]) for r in rows])]), pa.int32())
        lists = [pa.ListArray.from_arrays(cut, pa.array(np.concatenate(c), pa.int32())) for c in columns[6:]]
        nothing = [pa.nulls(len(rows), pa.list_(pa.int64())), pa.nulls(len(rows), pa.list_(pa.int32()))]
        numbers = [pa.array(columns[0], pa.int64()), pa.array([self.number] * len(rows), pa.int64()), *(pa.array(c, pa.int64()) for c in columns[1:5])]
        return pa.RecordBatch.from_arrays([*numbers, pa.array(columns[5]), *lists, *nothing], schema=FIRST_PASS)


@lru_cache(maxsize=1)
def _memory(vocabulary_a: bytes, vocabulary_b: bytes) -> _Memory:
    """The memory of this worker; tasks of a worker run one after the other."""
    return _Memory(aligner(vocabulary_a, vocabulary_b))


def _first_pass(vocabulary_a: bytes, vocabulary_b: bytes, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(vocabulary_a, vocabulary_b)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number, memory)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                block.add(doc_id.as_py(), text.as_py())
                if block.size >= block_chars:
                    yield from block.batches()
                    number += 1
                    block = _Block(number, memory)
        yield from block.batches()

    return run


FOUND = pa.struct([("place", pa.int32()), ("n", pa.int64()), ("best", pa.bool_())])


def _sums(key, docs: pa.Table, lists: pa.Table) -> pa.Table:
    """Sums over the links of each document of a block, from the corpus counts of the block's pairs."""
    pairs = pa.concat_arrays([c.flatten() for c in lists["found"].chunks if len(c)] or [pa.array([], FOUND)])
    order = np.argsort(pairs.field("place").to_numpy(zero_copy_only=False))
    count, best = (pairs.field(c).to_numpy(zero_copy_only=False)[order] for c in ("n", "best"))
    places, times = docs["places"].to_pylist(), docs["times"].to_pylist()
    sums = [[], []]
    for p, t in zip(places, times, strict=True):
        t = np.array(t, dtype=np.int64)
        p = np.array(p, dtype=np.int64)
        sums[0].append(int(t[best[p]].sum()) if len(p) else 0)
        sums[1].append(int((t * count[p]).sum()) if len(p) else 0)
    kept = docs.drop_columns(["block", "places", "times"])
    return kept.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))


def linked_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_a: str = VOCABULARY_A,
    vocabulary_b: str = VOCABULARY_B,
    derive: Mapping[str, Column] | None = None,
    block_chars: int = BLOCK_CHARS,
) -> tuple[DataFrame, DataFrame]:
    """Documents and pairs: (id, n_a, n_b, n_groups, n_links, derived columns, n_best, count_sum) and (a, b, documents, best).

    ``documents`` of a pair is the number of rows of ``docs`` that hold it linked; ``best`` pairs have the most of all
    pairs of their A id, ties included. ``derive`` gives further columns, computed from ``groups``: the groups as text,
    ids of A joined by commas, a bar, ids of B, groups joined by semicolons. Texts that are null or empty, and texts that
    the tokens of either do not give back byte for byte, have no tokens: zeros and empty groups. Repeated rows count each,
    null ids stay. A text of any length is one value; blocks of ``block_chars`` characters bound what is held besides.
    """
    read = read_vocabulary(vocabulary_a), read_vocabulary(vocabulary_b)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    derive = dict(derive or {})
    first = slim.mapInArrow(_first_pass(*read, block_chars), FIRST_PASS_DDL)
    first = stored(first.select(*(c for c in FIRST_PASS.names if c != "groups"), *(v.alias(k) for k, v in derive.items())), "aligned")
    lists = first.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "documents")).alias("place", "p"))
    lists = lists.select("block", "place", "p.pairs", "p.documents")
    counts = lists.groupBy("pairs").agg(F.sum("documents").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pairs", 32))  # at most as many rows as B has ids
    counts = stored(counts.withColumn("best", F.col("n") == F.max("n").over(of_a)), "pairs")
    known = lists.join(counts, "pairs").groupBy(F.col("block").alias("of_block")).agg(F.collect_list(F.struct("place", "n", "best")).alias("found"))
    rows = first.where("pairs is null").drop("pairs", "documents")
    fields = [f for f in rows.schema if f.name not in ("block", "places", "times")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_best long, count_sum long"
    documents = rows.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_sums, schema)
    pairs = counts.select(F.shiftright("pairs", 32).cast("int").alias("a"), F.expr("cast(pairs & 4294967295 as int)").alias("b"), F.col("n").alias("documents"), "best")
    return documents, pairs
