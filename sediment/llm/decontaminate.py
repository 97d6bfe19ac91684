"""Benchmark passages in documents: q-gram lemma filter in diagonal bands, then banded alignment.

Texts are compared as lower-case letters and digits with single spaces between words. Benchmark items are cut into
overlapping probes of two sizes: long ones that allow for a changed word, short ones for quotes. A place within k edits of a probe of m characters keeps at least ``m + 1 - q - k * q`` of its
q-grams, on diagonals at most k apart. Diagonals are counted in bands of twice k + 1 that overlap by half, so one band
holds all of them: only bands with that many different probe q-grams are aligned, and only along the band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import character_tables, code_points

Q = 8
PROBE = 96  # longest probe
SIZES = ((96, 24, 9), (48, 12, 4))  # characters, step and edits of probes: a changed long word, and short quotes
LEAST_CHARS = 24  # shorter items are no evidence of anything
BLOCK_CHARS = 8_000_000  # of benchmark text searched for at once
WINDOW = 1 << 20
FILTER_BITS = 22
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the compared form, and the place of each in the text."""
    lower, _, word = character_tables()
    codes = code_points(text)
    is_word = word[codes]
    codes = np.where(is_word, lower[codes], np.uint32(32))
    keep = is_word.copy()
    keep[1:] |= is_word[:-1]
    at = np.flatnonzero(keep)
    return codes[at], at


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash for each q-gram, built from those of half the length."""
    h, size, power = codes.astype(np.uint64) + np.uint64(1), 1, FACTOR
    total, length = None, 0
    rest = Q
    while rest:
        if rest & 1:
            if total is None:
                total, length = h, size
            else:  # the longer part comes first, then the one so far
                n = min(len(h), len(total) - size)
                shift = np.uint64(pow(int(FACTOR), length, 1 << 64))
                total, length = h[:n] * shift + total[size : size + n], length + size
        rest >>= 1
        if rest:
            h, size = h[:-size] * power + h[size:], size * 2
            power = np.uint64(int(power) ** 2 % (1 << 64))
    return total * FACTOR


@dataclass
class Probes:
    """The q-grams of a block of benchmark items, sorted by hash, and the probes they belong to."""

    hashes: np.ndarray
    probe: np.ndarray
    offset: np.ndarray
    codes: list[np.ndarray]
    item: list[int]
    edits: np.ndarray
    needed: np.ndarray
    seen: np.ndarray
    item_hashes: np.ndarray
    item_of: np.ndarray
    place: np.ndarray
    item_needed: np.ndarray
    longest: int

    @property
    def least(self) -> int:
        """Fewest q-grams that any probe needs."""
        return int(self.needed.min()) if len(self.needed) else 1 << 62

    @classmethod
    def build(cls, items: list[tuple[int, str]]) -> Probes:
        codes, owner, edits, wholes = [], [], [], []
        for number, (_, text) in enumerate(items):
            whole = normalise(text)[0]
            whole = whole[: len(whole) - 1] if len(whole) and whole[-1] == 32 else whole
            if len(whole) < LEAST_CHARS:
                continue
            wholes.append((number, whole))
            for size, step, most in SIZES:
                if len(whole) < size and size > SIZES[-1][0]:
                    continue
                starts = list(range(0, max(len(whole) - size, 0) + 1, step))
                if starts[-1] + size < len(whole):
                    starts.append(len(whole) - size)
                for s in starts:
                    codes.append(whole[s : s + size])
                    owner.append(number)
                    edits.append(most * len(codes[-1]) // size)
        grams = [gram_hashes(c) for c in codes]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        probe = np.repeat(np.arange(len(codes)), [len(g) for g in grams]).astype(np.int64)
        offset = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        m = np.array([len(c) for c in codes], dtype=np.int64)
        edits = np.array(edits, dtype=np.int64)
        seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        seen[hashes >> np.uint64(64 - FILTER_BITS)] = True
        needed = m + 1 - Q - edits * Q
        item_needed = np.full(len(items), 1 << 62, dtype=np.int64)
        np.minimum.at(item_needed, np.array(owner, dtype=np.int64), needed)
        parts = [gram_hashes(w) for _, w in wholes]
        item_hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        item_of = np.repeat([n for n, _ in wholes], [len(x) for x in parts]).astype(np.int64)
        place = np.concatenate([np.arange(len(x)) for x in parts]) if parts else np.zeros(0, np.int64)
        by_hash = np.argsort(item_hashes, kind="stable")
        longest = max((len(w) for _, w in wholes), default=0)
        of_items = item_hashes[by_hash], item_of[by_hash], place[by_hash], item_needed, longest
        return cls(hashes[order], probe[order], offset[order], codes, owner, edits, needed, seen, *of_items)


def _entries(sorted_hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash of ``wanted`` all places where it stands in ``sorted_hashes``: index into wanted, place."""
    low = np.searchsorted(sorted_hashes, wanted, side="left")
    n = np.searchsorted(sorted_hashes, wanted, side="right") - low
    return np.repeat(np.arange(len(wanted)), n), np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())


def _worth(hits: np.ndarray, hashes: np.ndarray, probes: Probes, length: int) -> np.ndarray:
    """The document q-grams that lie, with as many of an item as any of its probes needs, in a band of diagonals.

    Probes of an item share its diagonals, so this is looked at once for each item, in bands as wide as any probe's.
    """
    width = int(probes.edits.max()) + 1
    which, entry = _entries(probes.item_hashes, hashes[hits])
    band = (hits[which] - probes.place[entry] + probes.longest) // width
    bands = (length + probes.longest) // width + 2
    key = probes.item_of[entry] * bands + band
    keys, at, count = np.unique(key, return_inverse=True, return_counts=True)
    beside = np.diff(keys) == 1
    with_next, with_last = count.copy(), count.copy()
    with_next[:-1] += np.where(beside, count[1:], 0)
    with_last[1:] += np.where(beside, count[:-1], 0)
    enough = np.maximum(with_next, with_last) >= probes.item_needed[keys // bands]
    keep = np.zeros(len(hits), dtype=bool)
    keep[which[enough[at]]] = True
    return hits[keep]


def align(doc: np.ndarray, starts: np.ndarray, probes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each whole probe against any stretch of the document inside its band, and where that ends.

    ``starts`` are the first diagonals of the bands, ``width`` diagonals each; ``probes`` has a row for each band.
    One row of the alignment of all bands is computed at a time.
    """
    lanes = np.arange(width)
    length = probes.shape[1]
    far = np.int64(length + width)
    padded = np.concatenate([np.zeros(PROBE + width + 2, doc.dtype), doc, np.zeros(PROBE + width + 2, doc.dtype)])
    first = starts[:, None] + lanes  # document place that lane l compares in row 0
    outside = (first < 0) | (first > len(doc))
    cost = np.where(outside, far, 0)  # row 0: a match may begin on any diagonal
    for i in range(length):
        at = first + i
        equal = padded[np.clip(at + PROBE + width + 2, 0, len(padded) - 1)] == probes[:, i : i + 1]
        outside = (at < 0) | (at >= len(doc))
        step = cost + ~equal  # replace or match
        step[outside] = far
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)  # leave out a probe character
        step -= lanes
        cost = np.minimum.accumulate(step, axis=1) + lanes  # take in document characters
        cost[(at < -1) | (at >= len(doc))] = far
    best = np.argmin(cost, axis=1)
    return cost[np.arange(len(starts)), best], starts + best + length


def _search(doc: np.ndarray, hits: np.ndarray, hashes: np.ndarray, probes: Probes) -> list[tuple[int, int, int, int]]:
    """(probe, from, to, edits) of verified places, given the document q-grams that some probe may have."""
    hits = _worth(hits, hashes, probes, len(doc))
    wanted = hashes[hits]
    low = np.searchsorted(probes.hashes, wanted, side="left")
    high = np.searchsorted(probes.hashes, wanted, side="right")
    some = high > low
    if np.count_nonzero(some) < probes.needed.min():
        return []
    hits, low, n = hits[some], low[some], (high - low)[some]
    entry = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    probe, offset = probes.probe[entry], probes.offset[entry]
    diagonal = np.repeat(hits, n) - offset + PROBE + 1  # never negative
    band = diagonal // (probes.edits[probe] + 1) + 1
    bands = len(doc) + 2 * PROBE + 4
    key = (probe * bands + band) * PROBE + offset
    rows = np.unique(np.concatenate([key, key - PROBE]))  # each diagonal is in its band and in the one before
    group = rows // PROBE
    new = np.flatnonzero(np.concatenate([[True], np.diff(group) != 0]))
    probe, band = group[new] // bands, group[new] % bands - 1
    enough = np.diff(np.append(new, len(rows))) >= probes.needed[probe]
    found = []
    probe, band = probe[enough], band[enough]
    lengths = np.array([len(probes.codes[p]) for p in probe])
    for m in np.unique(lengths):
        these = probe[lengths == m]
        k = int(probes.edits[these[0]])
        starts = band[lengths == m] * (k + 1) - PROBE - 1
        edits, ends = align(doc, starts, np.stack([probes.codes[p] for p in these]), 2 * (k + 1))
        found += [(p, max(end - int(m), 0), end, e) for p, e, end in zip(these.tolist(), edits.tolist(), ends.tolist(), strict=True) if e <= k]
    return found


def find(text: str, probes: Probes) -> list[tuple[int, int, int, int, int]]:
    """(item number, from, to, edits, probes found) per item with a verified place; from and to span all of them."""
    codes, places = normalise(text)
    merged: dict[int, list] = {}
    overlap = 2 * PROBE
    for at in range(0, max(len(codes) - overlap, 1), WINDOW):
        part = codes[at : at + WINDOW + overlap]
        if len(part) < Q:
            break
        hashes = gram_hashes(part)
        hits = np.flatnonzero(probes.seen[hashes >> np.uint64(64 - FILTER_BITS)])
        if len(hits) < probes.least:
            continue
        for p, start, end, edits in _search(part, hits, hashes, probes):
            first, last = int(places[at + start]), int(places[at + end - 1]) + 1
            row = merged.setdefault(probes.item[p], [first, last, edits, set()])
            row[0], row[1], row[2] = min(row[0], first), max(row[1], last), min(row[2], edits)
            row[3].add(p)
    return [(item, r[0], r[1], r[2], len(r[3])) for item, r in sorted(merged.items())]


LEAKS = "array<struct<item_id:long,from:long,to:long,edits:int,probes:int>>"


def _leaks_of(text: Column, items: list[tuple[int, str]]) -> Column:
    probes = Probes.build(items)
    ids = [i for i, _ in items]

    @F.arrow_udf(LEAKS)
    def leaks(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ["item_id", "from", "to", "edits", "probes"]
        one = pa.struct(list(zip(names, [pa.int64()] * 3 + [pa.int32()] * 2, strict=True)))
        for batch in texts:
            found = [find(t.as_py() or "", probes) for t in batch]
            rows = [[dict(zip(names, (ids[r[0]], *r[1:]), strict=True)) for r in f] for f in found]
            yield pa.array(rows, pa.list_(one))

    return leaks.asNondeterministic()(text)


def leaks(text: Column, benchmark: DataFrame) -> Column:
    """All benchmark items found in a text: item, span in the text, least edits and number of probes found.

    ``benchmark`` has item_id and text. It is a query set: its items are read in blocks of at most ``BLOCK_CHARS``
    characters (a longer item is a block of its own), each block is sent to the tasks and searched for in every text,
    and the finds of all blocks are put together. Null texts and texts of fewer than ``LEAST_CHARS`` compared
    characters match nothing, on either side; items without an id are reported with a null id.
    """
    blocks: list[list[tuple[int, str]]] = [[]]
    size = 0
    for item, passage in benchmark.where("text is not null").select("item_id", "text").distinct().toLocalIterator():
        if blocks[-1] and size + len(passage) > BLOCK_CHARS:
            blocks.append([])
            size = 0
        blocks[-1].append((item, passage))
        size += len(passage)
    found = [_leaks_of(text, sorted(b, key=lambda r: (r[0] is None, r))) for b in blocks]
    return found[0] if len(found) == 1 else F.concat(*found)
