"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are grouped so that correlated bits share a partition. Each partition gets its own threshold, the
thresholds adding up to ``max_distance - partitions + 1``: two fingerprints within ``max_distance`` bits then agree
within the threshold on at least one partition. A dynamic programme picks the thresholds, and the number of
partitions, that need the fewest keys and candidates as estimated from bit counts over all fingerprints.

Probing is symmetric: a threshold of t is met by dropping each choice of t bits from the partition and comparing
what is left. Groups of fingerprints that share such a key are compared pairwise up to ``PAIRS_UP_TO`` members. In
larger groups members meet at the fingerprints half-way between them, so the work stays linear in the group and no
link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import free_name, stored
from sediment.llm.components import smallest_reachable

BITS = 64
PAIRS_UP_TO = 64
KEY_COST = 4.0  # of making and shuffling one key, in comparisons of a candidate
SLICE = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """Signed 64-bit SimHash of all shingles of ``width`` words, repeats included; 0 without a word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        starts, ends = [0], [len(joined)]
    else:
        spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
        starts = [0, *(spaces[: len(words) - width] + 1).tolist()]
        ends = [*spaces[width - 1 :].tolist(), len(joined)]
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts, ends)), repeat(42)), np.uint64, len(starts)
    )
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed number."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_column(text: Column, width: int = 3) -> Column:
    @F.arrow_udf("long")
    def simhash(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([fingerprint(x.as_py() or b"", width) for x in batch], pa.int64())

    return simhash(text.cast("binary"))


def _bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, over all of them, how often each two bits are set together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(values), SLICE):
                part = values[at : at + SLICE]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                together += bits.T @ bits
                rows += len(part)
        if rows:
            cells = np.append(together.ravel(), rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    cells = prints.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(BITS * BITS + 1)
    for cell, n in cells:
        table[cell] = n
    return int(table[-1]), table[:-1].reshape(BITS, BITS)


def group_bits(together: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Split the bits into ``parts`` groups of nearly equal size, each grown from a seed by correlation."""
    p = np.diag(together) / max(rows, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(together / max(rows, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(left, key=lambda b: (corr[b, sorted(left)].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def estimated_cost(group: list[int], threshold: int, p: np.ndarray, rows: int) -> float:
    """Keys to make plus candidate pairs to compare for one partition: pairs within the threshold on its bits."""
    if threshold < 0:
        return 0.0
    within = np.zeros(threshold + 1)
    within[0] = 1.0
    for bit in group:  # distribution of the number of differing bits of two fingerprints
        differ = 2 * p[bit] * (1 - p[bit])
        moved = np.concatenate([[0.0], within[:-1]]) * differ
        within = within * (1 - differ) + moved
    return KEY_COST * rows * comb(len(group), threshold) + rows * (rows - 1) / 2 * within.sum()


def plan(together: np.ndarray, rows: int, max_distance: int) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds, of least estimated cost over all numbers of partitions; no rows are planned as one."""
    rows = max(rows, 1)
    p = np.diag(together) / rows
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(1, max_distance + 2):
        groups = group_bits(together, rows, parts)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            after: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in states.items():
                for t in range(-1, min(max_distance, len(group)) + 1):
                    total = cost + estimated_cost(group, t, p, rows)
                    if spent + t not in after or total < after[spent + t][0]:
                        after[spent + t] = (total, [*chosen, t])
            states = after
        cost, chosen = states[max_distance - parts + 1]
        if best is None or cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0])
    return best[1]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def key_masks(parts: list[tuple[list[int], int]]) -> list[int]:
    """For each partition and each choice of dropped bits, the bits that a key keeps."""
    return [
        _signed(sum(1 << b for b in group if b not in dropped))
        for group, threshold in parts
        for dropped in map(set, combinations(group, threshold))
    ]


def _half_way_links(crowded: DataFrame, max_distance: int) -> DataFrame:
    """Exact links within large groups: every member goes to all fingerprints at half the distance.

    Two members within the distance meet at one of them, one at floor(d/2) and one at ceil(d/2) bits at most.
    Whoever meets one that is floor(d/2) away is within the distance of it, so linking to the smallest such is right.
    Only bits outside the key can differ.
    """
    near, far = max_distance // 2, (max_distance + 1) // 2
    # a fingerprint in several crowded keys sets out once, over the bits that any of them leaves open
    once = crowded.groupBy("fp").agg(F.bit_or(F.bitwise_not("mask")).alias("open"))
    free = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.getbit("open", b) == 1)
    points = F.array(F.struct(F.col("fp").alias("at"), F.lit(0).alias("steps"), F.lit(-1).alias("last")))
    rows = once.select("fp", free.alias("free"), F.explode(points).alias("p")).select("fp", "free", "p.*")
    out = rows
    for step in range(1, far + 1):
        bit = F.explode(F.filter("free", lambda b: b > F.col("last")))
        flip = F.expr("at ^ shiftleft(1L, bit)")
        rows = rows.select("fp", "free", "at", "last", bit.alias("bit")).select("fp", "free", flip.alias("at"), F.lit(step).alias("steps"), F.col("bit").alias("last"))
        out = out.unionByName(rows)
    meet = out.select("at", "fp", "steps")
    centre = F.min(F.when(F.col("steps") <= near, F.col("fp")))
    centres = meet.groupBy("at").agg(centre.alias("v"), F.count(F.lit(1)).alias("n")).where("v is not null and n > 1")
    return meet.join(centres, "at").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def keyed_groups(prints: DataFrame, max_distance: int) -> DataFrame:
    """Fingerprints (fp) once for each key they share with others: mask, key, fp, n rows with the key.

    Any two fingerprints within ``max_distance`` bits share at least one key.
    """
    rows, together = _bit_counts(prints)
    masks = key_masks(plan(together, rows, max_distance))
    keyed = prints.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    keyed = keyed.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    groups = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stored(keyed.join(groups, ["mask", "key"]), "simhash-keys")


def links(prints: DataFrame, max_distance: int, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints of ``prints`` (fp) that differ in at most ``max_distance`` bits.

    All such pairs from groups compared pairwise; from larger groups enough of them to connect all that are linked.
    """
    shared = keyed_groups(prints, max_distance)
    few = shared.where(F.col("n") <= pairs_up_to)
    a, b = few.alias("a"), few.alias("b")
    close = F.expr(f"a.mask = b.mask and a.key = b.key and a.fp < b.fp and bit_count(a.fp ^ b.fp) <= {max_distance}")
    pairs = a.join(b, close).select(F.col("b.fp").alias("u"), F.col("a.fp").alias("v"))
    return pairs.unionByName(_half_way_links(shared.where(F.col("n") > pairs_up_to), max_distance)).distinct()


def _classes(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, component_id, keeper) for the rows (fp, first_id): smallest id that is linked to fp, and the fingerprint that has it."""
    roots = stored(smallest_reachable(links(prints, max_distance)), "simhash-roots")
    least = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "fp"))
    first = roots.join(prints, roots.u == prints.fp).groupBy("root").agg(least.alias("least"))
    moved = roots.join(first, "root").select(F.col("u").alias("fp"), "least")
    component = F.when(F.col("least").isNotNull(), F.col("least.first_id")).otherwise(F.col("first_id"))
    classes = prints.join(moved, "fp", "left").select("fp", component.alias("component_id"), F.coalesce("least.fp", "fp").alias("keeper"))
    # stored, so that joins with it meet two plain shuffles and a fingerprint of very many rows can be split
    return stored(classes, "simhash-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_distance: int = 2) -> DataFrame:
    """(id, fp, component_id) for every row: the smallest id reachable over links of at most ``max_distance`` bits.

    Null and empty texts have fingerprint 0 and are linked like any other. Rows of the same id each get a row. A
    null id gets the smallest id of its component, null if there is none. Other columns are not looked at.
    """
    slim = docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), width).alias("fp"))
    slim = stored(slim, "simhash")
    prints = stored(slim.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-distinct")
    return slim.join(_classes(prints, max_distance), "fp").select("id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with one row of each component, of the smallest id in it, with all columns.

    Where rows share that id, one of the least fingerprint stays. Null ids come last. The rules of ``near_duplicates`` hold otherwise.
    """
    fp = free_name(docs, "simhash_fp")
    marked = stored(docs.withColumn(fp, fingerprint_column(F.col(text_col), width)), "simhash-marked")
    prints = stored(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(id_col).alias("first_id")), "simhash-distinct")
    stay = _classes(prints, max_distance).where("fp = keeper").select(F.col("fp").alias("keeper"), "component_id")
    here = F.col(f"d.`{fp}`") == F.col("s.keeper")
    found = marked.alias("d").join(stay.alias("s"), here & F.col(f"d.`{id_col}`").eqNullSafe(F.col("s.component_id"))).select("d.*")
    return found.dropDuplicates([fp]).drop(fp)
