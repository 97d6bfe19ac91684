"""Nearest rows by inner product within score windows, through an inverted multi-index; hard negatives are one use of it.

Vectors are cut in two halves and each half space has its own codebook. A row belongs to the cell of its two nearest
centres. For a query q and a half h, no row whose half is coded by centre c scores more than q.c + |q| * radius(c), the
radius being the largest distance of a row to that centre. The sums of both halves' bounds put the cells in order: the
multi-sequence heap yields them from the largest bound downwards without looking at all pairs of centres.

A search runs in rounds, each a Spark job: every open query takes its next cells from its heap, meets the rows of those
cells block by block, and keeps its best rows. It is closed as soon as its window is certified: the last of the k rows it
needs scores above the bound of every cell to come, or no such cell reaches the window. So results are exact, and the
codebooks, which are fitted to a bounded sample, only decide how early a search ends.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sediment.llm.common import free_name, stored

SCALE = 256
SAMPLE_ROWS = 8192  # the codebooks are fitted to so many rows at most
MOST_CENTRES = 512  # of a half, so that there are at most 2^18 cells
STEPS = 8
BLOCK_ROWS = 1024
PACK = 256  # queries that meet a block together
FIRST_ROWS = 4096  # rows in the cells of a query's first round; each round takes four times as many as the last
MOST_NORM = 1 << 62
EXACT_IN_DOUBLE = 1 << 53
LEAST = -(1 << 63)
SLACK = 1e-6


def integer_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label", scale: int = SCALE) -> DataFrame:
    """(row, id, label, vec) of the rows that take part: floor(scale * x) of each component, as a binary of 64-bit numbers.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Rows equal in id, label and
    vector are one row. Shorter vectors count as filled up with zeros, so the empty vector is all zeros. Vectors so
    large that inner products do not fit 64 bits stop the job when the index is built.
    """
    label = F.col(label) if isinstance(label, str) else label
    used = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    unsound = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    used = used.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~unsound)
    whole = used.select("id", "label", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("x")).distinct()
    return stored(whole.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "label", _packed(F.col("x")).alias("vec")), "rows")


def _packed(x: Column) -> Column:
    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([np.array(v.as_py(), dtype="<i8").tobytes() for v in batch], pa.binary())

    return pack(x)


def matrix(values: Sequence[bytes], dims: int) -> np.ndarray:
    """The vectors as rows, filled up with zeros."""
    out = np.zeros((len(values), dims), dtype=np.int64)
    for k, v in enumerate(values):
        part = np.frombuffer(v, dtype="<i8")
        out[k, : len(part)] = part
    return out


def scores(a: np.ndarray, b: np.ndarray, most_norm: int) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``; ``most_norm`` bounds the squared lengths."""
    if most_norm < EXACT_IN_DOUBLE:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def fit_centres(sample: np.ndarray, k: int) -> np.ndarray:
    """k-means of a half of the sample; the first centres are rows at equal steps of the sample."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    centres = np.unique(sample[np.linspace(0, len(sample) - 1, k).astype(int)], axis=0).astype(np.float64)
    for _ in range(STEPS):
        of, _ = nearest(sample, centres)
        n = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, sample)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the distance to it."""
    near = (rows.astype(np.float64) @ centres.T) * -2 + (centres**2).sum(axis=1)
    of = near.argmin(axis=1)
    return of, np.sqrt(((rows - centres[of]) ** 2).sum(axis=1))


@dataclass(frozen=True)
class Cells:
    """What a search needs to know of the cells, of which there are at most ``MOST_CENTRES`` squared."""

    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]  # of the centres of either half, over all rows
    cells: dict[tuple[int, int], tuple[int, int]]  # number of rows and of blocks
    dims: int
    most_norm: int


@dataclass(frozen=True)
class Index:
    """Blocks of rows (i, j, block, rows, ids, labels, vecs) and the table of their cells."""

    blocks: DataFrame
    cells: Cells


def build(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, centres: int | None = None, block_rows: int = BLOCK_ROWS) -> Index:
    """Index of all ``rows``. Codebooks are fitted to ``sample_rows`` of them, chosen by a hash; they have the fourth root of the
    number of rows as centres if ``centres`` is not given."""
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.octet_length("vec"))).first()
    dims = max((dims or 0) // 8, 2)
    half = dims // 2
    k = centres or max(2, min(MOST_CENTRES, math.ceil(n**0.25)))
    chosen = rows.orderBy(F.xxhash64("row"), "row").limit(sample_rows).collect()
    sample = matrix([r.vec for r in chosen], dims)
    books = (fit_centres(sample[:, :half], k), fit_centres(sample[:, half:], k))

    @F.arrow_udf("i int, j int, d double, e double, norm decimal(38,0)")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from decimal import Decimal

        for batch in batches:
            x = matrix([v.as_py() for v in batch], dims)
            i, d = nearest(x[:, :half], books[0])
            j, e = nearest(x[:, half:], books[1])
            exact = [Decimal(sum(c * c for c in r)) for r in x.tolist()] if len(x) and np.abs(x).max() > 1 << 25 else [Decimal(int(c)) for c in (x * x).sum(axis=1)]
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(d), pa.array(e), pa.array(exact, pa.decimal128(38, 0))]
            yield pa.StructArray.from_arrays(columns, ["i", "j", "d", "e", "norm"])

    coded = stored(rows.withColumn("c", code(F.col("vec"))).select("row", "id", "label", "vec", "c.*"), "coded")
    # the cell statistics, at most MOST_CENTRES squared rows, are what the heap needs
    stats = coded.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d"), F.max("e").alias("e"), F.max("norm").alias("norm")).collect()
    most_norm = max((int(s.norm) for s in stats), default=0)
    if most_norm >= MOST_NORM:
        raise ValueError(f"a vector has the squared length {most_norm}: scores do not fit 64 bits")
    radii = tuple(np.zeros(len(b)) for b in books)
    for s in stats:
        radii[0][s.i] = max(radii[0][s.i], s.d)
        radii[1][s.j] = max(radii[1][s.j], s.e)
    cells = {(s.i, s.j): (s.n, -(-s.n // block_rows)) for s in stats}
    # rows of a cell are dealt to blocks by a hash, so that a cell of very many rows, even equal ones, is no hot group
    # the table of cells has at most MOST_CENTRES squared rows; broadcast, it does not bring the rows of a cell together
    sizes = rows.sparkSession.createDataFrame([(i, j, b) for (i, j), (_, b) in cells.items()] or [(-1, -1, 1)], "i int, j int, blocks int")
    dealt = coded.join(F.broadcast(sizes), ["i", "j"]).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))

    def gather(t: pa.Table) -> pa.Table:
        one = [[t["i"][0].as_py()], [t["j"][0].as_py()], [t["block"][0].as_py()]]
        vecs = matrix(t["vec"].to_pylist(), dims).astype("<i4").tobytes()  # the limit of squared lengths makes them fit
        lists = [t[c].to_pylist() for c in ("row", "id", "label")]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        columns = [pa.array(v, kind) for v, kind in zip([*one, *([x] for x in lists), [vecs]], kinds, strict=True)]
        return pa.Table.from_arrays(columns, ["i", "j", "block", "rows", "ids", "labels", "vecs"])

    schema = "i int, j int, block int, rows array<long>, ids array<long>, labels array<int>, vecs binary"
    packed = dealt.select("i", "j", "block", "row", "id", "label", "vec").groupBy("i", "j", "block").applyInArrow(gather, schema)
    return Index(stored(packed, "blocks"), Cells(books, radii, cells, dims, most_norm))


def cells_in_order(query: np.ndarray, index: Cells) -> Iterator[tuple[float, int, int]]:
    """(bound, i, j) of all pairs of centres by falling bound: the multi-sequence heap over the two sorted half bounds."""
    half = index.dims // 2
    bounds, orders = [], []
    for part, centres, radii in zip((query[:half], query[half:]), index.centres, index.radii, strict=True):
        part = part.astype(np.float64)
        u = centres @ part + np.sqrt((part**2).sum()) * radii
        u = u + np.abs(u) * SLACK + SLACK
        order = np.argsort(-u, kind="stable")
        bounds.append(u[order].tolist())
        orders.append(order.tolist())
    (u, v), (a, b) = bounds, orders
    heap = [(-(u[0] + v[0]), 0, 0)]
    while heap:
        bound, x, y = heapq.heappop(heap)
        yield -bound, a[x], b[y]
        if y + 1 < len(v):
            heapq.heappush(heap, (-(u[x] + v[y + 1]), x, y + 1))
        if y == 0 and x + 1 < len(u):
            heapq.heappush(heap, (-(u[x + 1] + v[0]), x + 1, 0))


def next_cells(query: np.ndarray, index: Cells, visited: int, want_rows: int, reach: float) -> tuple[list[tuple[int, int]], int, float]:
    """The next cells of a query that has taken ``visited`` pairs from its heap: cells with rows, pairs taken now, bound of what is left."""
    found, taken, rows = [], 0, 0
    for n, (bound, i, j) in enumerate(cells_in_order(query, index)):
        if n < visited:
            continue
        if bound < reach:
            return found, taken, -math.inf
        if rows >= want_rows:
            return found, taken, bound
        taken += 1
        if (i, j) in index.cells:
            found.append((i, j))
            rows += index.cells[i, j][0]
    return found, taken, -math.inf


def _probes(index: Cells, want_rows: int):
    """Function for mapInArrow: open queries with their next cells and the state of their heap afterwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries = matrix(batch.column("vec").to_pylist(), index.dims)
            lows, visited = batch.column("lo").to_pylist(), batch.column("visited").to_pylist()
            out: list[list] = [[], [], []]
            for q, lo, done in zip(queries, lows, visited, strict=True):
                cells, taken, frontier = next_cells(q, index, done, want_rows, lo)
                out[0].append([{"i": i, "j": j} for i, j in cells])
                out[1].append(done + taken)
                out[2].append(frontier)
            kinds = [pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32())])), pa.int32(), pa.float64()]
            kept = [batch.column(c) for c in ("query", "row", "label", "vec", "lo", "hi")]
            names = ["query", "row", "label", "vec", "lo", "hi", "cells", "visited", "frontier"]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(v, kind) for v, kind in zip(out, kinds, strict=True))], names)

    schema = "query long, row long, label int, vec binary, lo long, hi long, cells array<struct<i:int,j:int>>, visited int, frontier double"
    return run, schema


def _best(index: Cells, k: int, same_label: bool):
    """Function for mapInArrow over (packs of queries, block): the best k rows of the block for each query, within its window."""
    dims, most_norm = index.dims, index.most_norm

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                r = batch.slice(n, 1).to_pylist()[0]
                vecs = np.frombuffer(r["vecs"], dtype="<i4").reshape(-1, dims).astype(np.int64)
                ids, rows, labels = np.array(r["ids"]), np.array(r["rows"]), np.array(r["labels"])
                anchors = [q["row"] for q in r["pack"]]
                _, at, of = np.unique(anchors, return_index=True, return_inverse=True)
                table = scores(matrix([r["pack"][x]["vec"] for x in at], dims), vecs, most_norm)
                out: list[list] = [[], [], [], []]
                for q, u in zip(r["pack"], of, strict=True):
                    s = table[u]
                    fits = (s >= q["lo"]) & (s <= q["hi"]) & (rows != q["row"])
                    fits &= (labels == q["label"]) if same_label else (labels != q["label"])
                    some = np.flatnonzero(fits)
                    if len(some) > k:
                        least = np.partition(s[some], len(some) - k)[len(some) - k]
                        some = some[s[some] >= least]
                    some = some[np.lexsort((rows[some], ids[some], -s[some]))[:k]]
                    out[0].extend([q["query"]] * len(some))
                    for column, values in zip(out[1:], (s, ids, rows), strict=True):
                        column.extend(values[some].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query", "score", "id", "row"])

    return run, "query long, score long, id long, row long"


def search(queries: DataFrame, index: Index, k: int, same_label: bool, first_rows: int = FIRST_ROWS) -> DataFrame:
    """(query, rank, score, id, row) of the first ``k`` rows of the index for each query, all if there are fewer.

    ``queries`` has a distinct number ``query``, its own ``row`` (never found), ``label``, ``vec`` and a window of scores
    from ``lo`` to ``hi``. Rows are of the same label or of other labels. Higher scores come first, ties by smaller id, then row.
    """
    spark = queries.sparkSession
    open_ = stored(queries.select("query", "row", "label", "vec", "lo", "hi", F.lit(0).alias("visited")), "open")
    best = spark.createDataFrame([], "query long, score long, id long, row long")
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    blocks = {cell: n for cell, (_, n) in index.cells.cells.items()}
    counts = spark.createDataFrame([(i, j, n) for (i, j), n in blocks.items()] or [(-1, -1, 1)], "i int, j int, blocks int")
    want = first_rows
    while not open_.isEmpty():
        run, schema = _probes(index.cells, want)
        probed = stored(open_.mapInArrow(run, schema), "probes")
        pairs = probed.select("query", "row", "label", "vec", "lo", "hi", F.explode("cells").alias("c")).select("*", "c.i", "c.j").drop("c")
        dealt = F.pmod(F.xxhash64("row"), F.lit(1 << 20))
        share = pairs.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))
        packs = pairs.join(share, ["i", "j"]).withColumn("pack", F.pmod(dealt, F.ceil(F.col("n") / PACK)))
        packs = packs.groupBy("i", "j", "pack").agg(F.collect_list(F.struct("query", "row", "label", "vec", "lo", "hi")).alias("pack_"))
        met = packs.join(F.broadcast(counts), ["i", "j"]).select("i", "j", F.col("pack_").alias("pack"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
        met = met.join(index.blocks, ["i", "j", "block"]).select("pack", "rows", "ids", "labels", "vecs")
        run, schema = _best(index.cells, k, same_label)
        found = best.unionByName(met.mapInArrow(run, schema)).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).drop("rank")
        best = stored(found, "best")
        last = best.groupBy("query").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("last"))
        certified = (F.col("frontier") == -math.inf) | (F.coalesce("found", F.lit(0)) >= k) & (F.col("last") > F.col("frontier"))
        open_ = probed.join(last, "query", "left").where(~F.coalesce(certified, F.lit(False)))
        # from now on only rows count that score no less than the last of k known ones
        known = F.when(F.col("found") >= k, F.greatest("lo", "last")).otherwise(F.col("lo"))
        open_ = stored(open_.select("query", "row", "label", "vec", known.alias("lo"), "hi", "visited"), "open")
        want *= 4
    return best.withColumn("rank", F.row_number().over(rank)).select("query", "rank", "score", "id", "row")


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, index: Index | None = None
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``rows`` as ``integer_rows`` gives them.

    Anchors are the rows for which the condition ``anchors`` on id, label and row holds. Their positives are the first
    rows of the same label, and for each of those the negatives are the first rows of other labels with ``least *
    positive_score <= 100 * negative_score <= most * positive_score``. Repeated ids are told apart by their vectors;
    an anchor's own row is never its positive. Without anchors, positives or negatives there are no rows.
    """
    index = index or build(rows)
    asked = rows.where(anchors).select(F.col("row").alias("query"), "row", F.col("id").alias("anchor_id"), "label", "vec")
    asked = stored(asked, "anchors")
    first = search(asked.select("query", "row", "label", "vec", F.lit(LEAST).alias("lo"), F.lit(-(LEAST + 1)).alias("hi")), index, positives, True)
    first = first.select("query", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    number = free_name(asked, "pair")
    pairs = asked.join(first, "query").drop("query").withColumn(number, F.monotonically_increasing_id())
    pairs = stored(pairs, "positives")
    p = F.col("positive_score").cast("decimal(38,0)")
    window = pairs.select(
        F.col(number).alias("query"), "row", "label", "vec", F.ceil(p * least / 100).cast("long").alias("lo"), F.floor(p * most / 100).cast("long").alias("hi")
    )
    found = search(window.where("lo <= hi"), index, negatives, False)
    named = pairs.select(F.col(number).alias("query"), "anchor_id", "positive_id", "positive_score").join(found, "query")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
