"""Order MinHash of whole texts in DataFrame functions only.

A text is a sequence of short pieces of words, and its k-mers are ``WIDTH`` consecutive pieces. Equal k-mers are told
apart by the number of their occurrence. The hashes are parted into ``SKETCHES`` groups; of each group the ``CHOSEN``
smallest are taken (of the next groups where it has too few), put back into text order, and hashed as a tuple. Texts agree in a group only if
they share those k-mers in the same order, so the share of equal groups follows edit distance, not just content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import stored

PIECE = r"[^\s]{1,8}"
WIDTH = 2
SKETCHES = 64
CHOSEN = 2
DIGITS = 4
EMPTY = "-" * DIGITS
SKETCH_BITS = SKETCHES.bit_length() - 1
PLACE_BITS = 29  # no string has more pieces; the 35 bits of a hash that are left tell k-mers apart


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside array functions an expression would run per element."""
    return F.transform(F.array(value), body)[0]


def signature(text: Column) -> Column:
    """array of ``SKETCHES`` strings of ``DIGITS`` hex digits, all ``EMPTY`` for a text without a k-mer.

    A null text counts as empty. A text of fewer than ``WIDTH`` pieces is one k-mer, and its tuples hold that one.
    """
    return _let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0)), _of_pieces)


def _indices(array: Column) -> Column:
    """0 to size - 1."""
    return F.when(F.size(array) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(array) - 1))


def _packed(hashed: Column, at: Column) -> Column:
    """Upper bits of a hash over a place in the text: sorts by hash, in plain 64-bit numbers."""
    return hashed.bitwiseAND(F.lit(-(1 << PLACE_BITS))).bitwiseOR(at.cast("bigint"))


def _of_pieces(pieces: Column) -> Column:
    last = F.greatest(F.size(pieces) - WIDTH, F.lit(0))
    place = F.when(F.size(pieces) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), last))
    kmer = lambda i: F.xxhash64(*(F.get(pieces, i + k) for k in range(WIDTH)))
    return _let(F.sort_array(F.transform(place, lambda i: _packed(kmer(i), i))), _numbered)


def _again(kmers: Column, i: Column) -> Column:
    """The k-mer at i is the one before it once more: their hash bits agree."""
    return (i > 0) & (F.shiftright(kmers[i].bitwiseXOR(F.get(kmers, i - 1)), PLACE_BITS) == 0)


def _numbered(kmers: Column) -> Column:
    """Sorted k-mers with repeats told apart: the first keeps its hash, the j-th gets the hash of k-mer and j.

    Equal k-mers stand together in text order. Only repeats are looked at by run, so texts without any cost one pass.
    """
    repeats = F.filter(kmers, lambda v, i: _again(kmers, i))

    def renumber(repeats: Column) -> Column:
        starts = F.filter(_indices(repeats), lambda i: ~_again(repeats, i))

        def runs(starts: Column) -> Column:
            def run(i: Column, r: Column) -> Column:
                n = F.coalesce(F.get(starts, r + 1), F.size(repeats)) - i
                number = lambda v, j: _packed(F.xxhash64(F.shiftright(v, PLACE_BITS), j + 1), v.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
                return F.transform(F.slice(repeats, i + 1, n), number)

            once = F.filter(kmers, lambda v, i: ~_again(kmers, i))
            return F.sort_array(F.concat(once, F.flatten(F.transform(starts, run))))

        return F.when(F.size(repeats) == 0, kmers).otherwise(_let(starts, runs))

    return _let(_let(repeats, renumber), _by_group)


def _by_group(ranked: Column) -> Column:
    """Tuples of all groups. Hashes are a circle: a group's smallest k-mers are the first from where the group begins.

    A group with too few of its own goes on into the next ones, after the last into the first, so a text of ``CHOSEN``
    k-mers or more has a whole tuple in every group.
    """
    group = lambda v: F.shiftright(v, 64 - SKETCH_BITS)
    place = lambda v: v.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))

    def tuples(circle: Column) -> Column:
        def tuple_at(i: Column) -> Column:
            own = F.slice(circle, i + 1, F.least(F.lit(CHOSEN), F.size(ranked)))
            in_text = F.sort_array(F.transform(own, lambda v: F.struct(place(v).alias("at"), F.shiftright(v, PLACE_BITS).alias("g"))))
            digest = F.lower(F.right(F.hex(F.xxhash64(F.transform(in_text, lambda x: x["g"]))), F.lit(DIGITS)))
            return F.struct(group(ranked[i]).alias("key"), F.lpad(digest, DIGITS, "0").alias("value"))

        firsts = F.filter(_indices(ranked), lambda i: (i == 0) | (group(ranked[i]) != group(F.get(ranked, i - 1))))
        return F.transform(firsts, tuple_at)

    def whole(found: Column) -> Column:
        """The tuple of a group without k-mers is that of the next group that has any."""
        places = F.sequence(F.lit(-(SKETCHES // 2)), F.lit(SKETCHES // 2 - 1))
        ahead = lambda g: F.size(F.filter(found, lambda t: t["key"] < g))
        filled = F.transform(places, lambda g: F.get(found, F.pmod(ahead(g), F.size(found)))["value"])
        full = F.transform(found, lambda t: t["value"])
        none = F.array_repeat(F.lit(EMPTY), SKETCHES)
        return F.when(F.size(found) == 0, none).when(F.size(found) == SKETCHES, full).otherwise(filled)

    return _let(_let(F.concat(ranked, F.slice(ranked, 1, CHOSEN - 1)), tuples), whole)


def likeness(a: Column, b: Column) -> Column:
    """Root of the share of equal groups among those filled in either signature, 1 if none is filled.

    A group agrees if all its ``CHOSEN`` k-mers do, so the root of that degree brings it back to the scale of one k-mer.
    """
    both = F.zip_with(a, b, lambda x, y: F.when((x == EMPTY) & (y == EMPTY), F.lit(None)).when(x == y, 1).otherwise(0))
    used = F.filter(both, lambda e: e.isNotNull())
    equal = F.size(F.filter(used, lambda e: e == 1))
    return F.when(F.size(used) == 0, F.lit(1.0)).otherwise(F.pow(equal / F.size(used), F.lit(1.0 / CHOSEN)))


def following_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id) for every distinct id in ascending order; after the last comes the first.

    Ids are sorted into ranges, each followed by the smallest id of the next range that has any. Null ids come first.
    """
    spark = ids.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.select("id").distinct().repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ids")
    heads = ranged.groupBy("part").agg(F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("head"))
    onward = "over (order by part rows between 1 following and 1 following)"  # one row for each range
    heads = heads.selectExpr("part", f"coalesce(first(head) {onward}, first(head) over (order by part)).id as head")
    inside = ranged.selectExpr("id", "part", "lead(struct(id)) over (partition by part order by id nulls first) as n")
    return inside.join(heads, "part").select("id", F.when(F.col("n").isNotNull(), F.col("n.id")).otherwise(F.col("head")).alias("next_id"))
