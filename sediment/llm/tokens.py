"""Token counts by section: whole texts are encoded once and tokens attributed by their character spans.

The vocabulary is byte-level, so the tokens of a text are consecutive pieces of its bytes. Their lengths give byte
spans, and those give character spans: a character belongs to the token that holds its first byte. Spans are joined
with the sections of the text by interval, in order.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VOCABULARY_LIMIT = 64 << 20

# Fixed value: how the vocabulary's library splits text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

RULES = ("first", "majority", "share")


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file as the driver sees it; it is sent to tasks with the function and has a size limit."""
    size = Path(path).stat().st_size
    if size > VOCABULARY_LIMIT:
        raise ValueError(f"{path} has {size} bytes, over {VOCABULARY_LIMIT}")
    return Path(path).read_bytes()


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding, and the bytes of each token id."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for piece, rank in ranks.items():
        lengths[rank] = len(piece)
    return tiktoken.Encoding("sections", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, vocabulary: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of each token; a token inside a character has an empty span at its end."""
    encoding, lengths = encoder(vocabulary)
    ids = encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()) if text else np.zeros(0, np.uint32)
    ends = np.cumsum(lengths[ids])
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if len(raw) == len(text):
        return np.concatenate([[0], ends[:-1]]) if len(ends) else ends, ends
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    ends = chars[ends]
    return np.concatenate([[0], ends[:-1]]) if len(ends) else ends, ends


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and how many of them cross a section's bound.

    ``bounds`` are the section starts and the end of the last one; sections follow each other. ``first`` gives a
    token to the section of its first character, ``majority`` to the one that holds most of it (the earlier of
    equals), ``share`` to all it touches by their characters. Tokens with an empty span go by their place.
    """
    n = len(bounds) - 1
    last = np.maximum(ends - 1, starts)
    first_in = np.clip(np.searchsorted(bounds, starts, side="right") - 1, 0, n - 1)
    last_in = np.clip(np.searchsorted(bounds, last, side="right") - 1, 0, n - 1)
    crossing = first_in != last_in
    crossed = np.bincount(first_in[crossing], minlength=n).astype(np.int64)
    counts = np.bincount(first_in[~crossing] if rule != "first" else first_in, minlength=n).astype(np.float64)
    if rule != "first":
        for s, e, a, b in zip(starts[crossing], ends[crossing], first_in[crossing], last_in[crossing], strict=True):
            cut = np.clip(bounds[a : b + 2], s, e)
            parts = np.diff(cut)
            if rule == "share":
                counts[a : b + 1] += parts / (e - s)
            else:
                counts[a + int(np.argmax(parts))] += 1
    return counts, crossed


COUNTS = "array<struct<section:int,chars:long,tokens:double,crossing:long>>"


def count_by_section(text: Column, section_chars: Column, vocabulary: bytes, rule: str = "majority") -> Column:
    """array of (section, chars, tokens, crossing) of a text whose sections have the given lengths in characters.

    ``section_chars`` is an array of lengths in order that add up to the text's length; a text without sections,
    or a null text, gives an empty array. Sections of no characters get no tokens.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")

    @F.arrow_udf(COUNTS)
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        names = ["section", "chars", "tokens", "crossing"]
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.int64()]
        for texts, lengths in batches:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            offsets = [0]
            for text, chars in zip(texts, lengths, strict=True):
                sizes = np.array(chars.as_py() or (), dtype=np.int64)
                if len(sizes):
                    bounds = np.concatenate([[0], np.cumsum(sizes)])
                    starts, ends = token_spans(text.as_py() or "", vocabulary)
                    tokens, crossing = attribute(starts, ends, bounds, rule)
                    for column, values in zip(columns, (np.arange(len(sizes)), sizes, tokens, crossing), strict=True):
                        column.append(values)
                offsets.append(offsets[-1] + len(sizes))
            flat = [pa.array(np.concatenate(c) if c else np.zeros(0), k, safe=False) for c, k in zip(columns, kinds, strict=True)]
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(flat, names))

    return count.asNondeterministic()(text, section_chars)


def paragraphs(text: Column) -> Column:
    """Lengths of the lines of a text, each with the line break that ends it; an empty text has one empty section."""
    def lengths(lines: Column) -> Column:
        broken = F.transform(F.slice(lines, 1, F.size(lines) - 1), lambda line: F.char_length(line) + 1)
        return F.concat(broken, F.array(F.char_length(F.element_at(lines, -1))))

    return F.transform(F.array(F.split(text, "\n", -1)), lengths)[0]  # bound once: texts are split once, not once a line
