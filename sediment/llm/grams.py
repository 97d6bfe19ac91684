"""Hashed character n-gram and word features of whole texts, as numpy arrays."""

from __future__ import annotations

import numpy as np

from sediment.llm.common import character_tables, code_points

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)
WINDOW = 1 << 18


def _buckets(hashes: np.ndarray, bits: int, salt: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64(salt * 0x51ED27)) * MULTIPLIER
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _windows(codes: np.ndarray, overlap: int):
    """Slices of a long text that overlap so that every n-gram lies in exactly one."""
    for at in range(0, max(len(codes) - overlap, 1), WINDOW):
        yield codes[at : at + WINDOW + overlap]


def add_char_grams(counts: np.ndarray, codes: np.ndarray, sizes: tuple[int, ...], bits: int) -> None:
    """Count the n-grams of each size, each size with hashes of its own."""
    for n in sizes:
        if len(codes) < n:
            continue
        for part in _windows(codes, n - 1):
            wide = part.astype(np.uint64)
            h = wide[: len(wide) - n + 1].copy()
            for k in range(1, n):
                h *= BASE
                h += wide[k : len(wide) - n + 1 + k]
            counts += np.bincount(_buckets(h, bits, n), minlength=1 << bits)


def letter_grams(text: str, bits: int, sizes: tuple[int, ...] = (1, 2, 3)) -> np.ndarray | None:
    """Unit vector of root counts of n-grams over lower-case letters and word gaps; None without a letter."""
    lower, letter, _ = character_tables()
    codes = code_points(text)
    is_letter = letter[codes]
    if not is_letter.any():
        return None
    codes = np.where(is_letter, lower[codes], 32)
    keep = np.ones(len(codes) + 1, dtype=bool)
    keep[1:-1] = is_letter[1:] | is_letter[:-1]
    padded = np.concatenate([[32], codes[keep[:-1]], [32]]).astype(np.uint32)
    counts = np.zeros(1 << bits, dtype=np.int64)
    add_char_grams(counts, padded, sizes, bits)
    vector = np.sqrt(counts.astype(np.float32))
    return vector / np.linalg.norm(vector)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash for each run of characters other than white space, in text order."""
    inside = (codes > 32) & (codes != 0xA0)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    firsts = starts if starts[0] == 0 else np.concatenate([[0], starts])
    position = np.arange(len(codes), dtype=np.int64) - np.repeat(firsts, np.diff(np.append(firsts, len(codes))))
    place = (position.astype(np.uint64) + np.uint64(1)) * MULTIPLIER
    place ^= place >> np.uint64(29)
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * (place | np.uint64(1))
    mixed ^= mixed >> np.uint64(31)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(np.where(inside, mixed, np.uint64(0)), dtype=np.uint64)])
    return (sums[ends] - sums[starts]) * MULTIPLIER


def subword_counts(text: str, bits: int) -> np.ndarray:
    """Counts of hashed words, of character 2- and 3-grams as written, and of words repeated close by.

    A word that equals one of the eight before it also counts as a pseudo-word of its own, by distance.
    """
    counts = np.zeros(1 << bits, dtype=np.int64)
    codes = code_points(text)
    if not len(codes):
        return counts
    add_char_grams(counts, codes, (2, 3), bits)
    words = word_hashes(codes)
    counts += np.bincount(_buckets(words, bits, 11), minlength=1 << bits)
    for lag in range(1, 9):
        same = int((words[lag:] == words[:-lag]).sum())
        if same:
            counts[_buckets(np.array([lag], dtype=np.uint64), bits, 13)[0]] += same
    return counts
