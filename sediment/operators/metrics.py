"""Coverage, mean-of-ratios beside ratio-of-sums, cubes, rankings and ordered output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.functions.measures import half_up
from sediment.functions.text import _col
from sediment.session import scratch


def mean_ratio(index: Column | str, digits: int = 2) -> Column:
    """Plain mean of the row indices; rows without an index have no weight."""
    value = _col(index)
    return half_up(F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double")), digits)


def pooled_ratio(
    num: Column | str, den: Column | str, where: Column | str, scale: float = 100.0, digits: int = 2
) -> Column:
    """Ratio of the sums over the eligible rows; NULL for an empty slice."""
    keep = _col(where)
    top = F.sum(F.when(keep, _col(num))).cast("double")
    bottom = F.sum(F.when(keep, _col(den))).cast("double")
    return half_up(F.try_divide(F.lit(float(scale)) * top, bottom), digits)


def summary(
    mart: DataFrame,
    by: Sequence[str],
    index: str,
    num: str,
    den: str,
    eligible: str,
    measured: str | None = None,
    names: Mapping[str, str] | None = None,
    digits: int = 2,
) -> DataFrame:
    """Rows, measured rows, eligible rows, mean index and pooled index per group, in one aggregation."""
    out = {
        "rows": "rows",
        "measured": "measured",
        "eligible": "eligible",
        "mean": "mean_index",
        "pooled": "pooled_index",
        **(names or {}),
    }
    aggs = [F.count(F.lit(1)).alias(out["rows"])]
    if measured:
        aggs.append(F.count_if(F.col(measured)).alias(out["measured"]))
    aggs += [
        F.count(index).alias(out["eligible"]),
        mean_ratio(index, digits).alias(out["mean"]),
        pooled_ratio(num, den, eligible, 100.0, digits).alias(out["pooled"]),
    ]
    return mart.groupBy(*by).agg(*aggs)


PARTIAL = ("rows_n", "measured_n", "index_n", "eligible_n", "index_sum", "num_sum", "den_sum")


def partial_summary(
    mart: DataFrame, by: Sequence[str], index: str, num: str, den: str, eligible: str, measured: str | None = None
) -> DataFrame:
    """Sums from which :func:`merge_summaries` makes the figures of :func:`summary` for any union of the groups.

    Counts, and sums in decimals wide enough to be exact, so the order of rows and merges does not matter. The index is
    taken with its four decimals.
    """
    keep = F.col(eligible)
    exact = lambda c, digits: c.cast(f"decimal(28,{digits})")
    aggs = [
        F.count(F.lit(1)),
        F.count_if(F.col(measured)) if measured else F.lit(0).cast("bigint"),
        F.count(index),
        F.count_if(keep),
        F.sum(exact(F.col(index), 4)),
        F.sum(F.when(keep, exact(F.col(num), 4))),
        F.sum(F.when(keep, exact(F.col(den), 4))),
    ]
    return mart.groupBy(*by).agg(*[a.alias(n) for a, n in zip(aggs, PARTIAL, strict=True)])


def merge_summaries(
    partials: DataFrame, by: Sequence[str], measured: bool = False, names: Mapping[str, str] | None = None, digits: int = 2
) -> DataFrame:
    """The summary by the given columns, from stored partial sums of the same or finer groups."""
    out = {"rows": "rows", "measured": "measured", "eligible": "eligible", "mean": "mean_index", "pooled": "pooled_index", **(names or {})}
    total = {n: F.sum(n).cast("double") for n in PARTIAL}
    aggs = [F.sum("rows_n").alias(out["rows"])]
    if measured:
        aggs.append(F.sum("measured_n").alias(out["measured"]))
    aggs += [
        F.sum("index_n").alias(out["eligible"]),
        half_up(F.try_divide(total["index_sum"], total["index_n"]), digits).alias(out["mean"]),
        half_up(F.try_divide(F.lit(100.0) * total["num_sum"], total["den_sum"]), digits).alias(out["pooled"]),
    ]
    return partials.groupBy(*by).agg(*aggs)


def coverage(df: DataFrame, cols: Mapping[str, str], total: str = "total") -> DataFrame:
    """Row count and non-null count of each column (output name -> column), in one global pass."""
    return df.agg(
        F.count(F.lit(1)).alias(total), *[F.count(c).alias(name) for name, c in cols.items()]
    )


def slice_equal(df: DataFrame, **equal) -> DataFrame:
    """Filter by the given equalities; a value of None leaves that column free."""
    for name, value in equal.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def _partials(num: str, den: str, index: str, eligible: str, measured: str) -> list[Column]:
    keep = F.col(eligible)
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col(measured)).alias("_measured"),
        F.count_if(keep).alias("_eligible"),
        F.sum(F.when(keep, F.col(index))).alias("_index"),
        F.sum(F.when(keep, F.col(num))).alias("_num"),
        F.sum(F.when(keep, F.col(den))).alias("_den"),
    ]


def kpi_cube(
    mart: DataFrame, dims: Sequence[str], num: str, den: str, index: str, eligible: str, measured: str
) -> DataFrame:
    """Six figures for every combination of a value or ALL in each dimension.

    Rows are reduced to the finest groups first, so the cube expands group totals, not input rows.
    ``level`` is the grouping id: a set bit means that dimension stands for ALL.
    """
    finest = mart.groupBy(*dims).agg(*_partials(num, den, index, eligible, measured))
    cubed = finest.cube(*dims).agg(
        F.grouping_id().cast("int").alias("level"),
        *[F.sum(c).alias(c) for c in ("_rows", "_measured", "_eligible", "_index", "_num", "_den")],
    )
    eligible_rows = F.col("_eligible").cast("double")
    return cubed.select(
        *dims,
        "level",
        F.col("_rows").alias("rows"),
        F.col("_measured").alias("measured"),
        F.col("_eligible").alias("eligible"),
        half_up(F.try_divide(F.col("_index").cast("double"), eligible_rows), 2).alias("mean_index"),
        half_up(
            F.try_divide(F.lit(100.0) * F.col("_num").cast("double"), F.col("_den").cast("double")), 2
        ).alias("pooled_index"),
        share(F.col("_eligible"), F.col("_rows"), 1).alias("eligible_pct"),
    )


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage of a total; NULL on an empty slice."""
    return half_up(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits)


def ranked_ratio(mart: DataFrame, by: Sequence[str], num: str, den: str, eligible: str) -> DataFrame:
    """Pooled ratio per group over eligible rows, highest first, group as the tie-break."""
    pooled = (
        mart.filter(F.col(eligible))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("eligible"),
            F.sum(num).cast("double").alias("_num"),
            F.sum(den).cast("double").alias("_den"),
        )
        .withColumn("pooled_index", half_up(F.try_divide(F.lit(100.0) * F.col("_num"), F.col("_den")), 2))
        .drop("_num", "_den")
    )
    return pooled.orderBy(F.col("pooled_index").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in by])


def gap_histogram(mart: DataFrame, gap: Column, name: str = "gap") -> DataFrame:
    """Number of rows per gap label, most frequent first; rows without a gap are not counted."""
    return (
        mart.select(gap.alias(name))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.col("rows").desc(), F.col(name).asc())
    )


def count_distinct_rows(df: DataFrame, keys: Sequence[str], name: str = "combinations") -> DataFrame:
    """Number of distinct key combinations, those with NULL parts included."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias(name))


def maximum(df: DataFrame, col: str, name: str = "maximum") -> DataFrame:
    return df.agg(F.max(col).alias(name))


def key_order(*keys: str) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]


def measure_order(measure: str, tie: str) -> list[Column]:
    return [F.col(measure).desc_nulls_last(), F.col(tie).asc()]


def text_order(col: str, *ties: str, locale: str = "pt") -> list[Column]:
    return [F.collate(F.col(col), locale).asc_nulls_last(), *key_order(*ties)]


def order_by(df: DataFrame, *keys: str) -> DataFrame:
    """Ascending sort on several keys, missing values last.

    End the keys with a unique one when a leading value may be frequent: range partitioning can
    then split that value over many tasks.
    """
    return df.orderBy(*key_order(*keys))


def order_by_measure(df: DataFrame, measure: str, tie: str) -> DataFrame:
    """Highest measure first, missing measures last, ties by key."""
    return df.orderBy(*measure_order(measure, tie))


def order_by_text(df: DataFrame, col: str, *ties: str, locale: str = "pt") -> DataFrame:
    """Sort by the rules of a language instead of by code point."""
    return df.orderBy(*text_order(col, *ties, locale=locale))


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Number the rows from 1 in the given order, which should have no ties.

    Rows are dealt into ranges of the order and stored; each range is numbered by itself and moved up by the size of
    those before it, so no task sees more than one range.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    path = scratch(df.sparkSession, "positions")
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", before.alias("_before"))  # one row for each range
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(offsets, "_range").withColumn(name, F.col("_before") + inside).drop("_range", "_before")


def top_k(df: DataFrame, measure: str, k: int, *ties: str) -> DataFrame:
    """The k rows with the highest measure; each task keeps only its own k rows."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc() for t in ties]).limit(k)


def group_median(df: DataFrame, by: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group without bringing a group into one task.

    Equal values are counted first; the (group, value) counts are range-partitioned and cut into
    chunks of one partition each. Chunk totals locate the chunks that hold the two middle ranks, and
    only those chunks are ranked value by value. The counts are stored in the shared scratch folder.
    """
    keys = list(by)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return _median_of_counts(counts, keys, value, name)


#: Items of a quantile sketch; its rank error is about 0.4 % of the rows.
SKETCH_ITEMS = 800
#: Share of the rows on either side of the middle that stays open after the sketch.
BRACKET = 0.01


def group_median_by_sketch(df: DataFrame, by: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """The same exact median with a small part of the shuffle: a mergeable sketch brackets it, a second pass settles it.

    The first pass leaves one KLL sketch per group, from which a lower and an upper bound of the middle follow. The second
    one counts what lies below, and values one by one only between the bounds; ranks are then found as in
    :func:`group_median`. A group whose middle turns out not to lie between its bounds is counted in full, so the
    result never rests on the sketch. Meant for groups far fewer than rows: their bounds meet every row. Nulls do not
    count and NaN is the largest value, as there.
    """
    keys, spark = list(by), df.sparkSession
    number = F.col(value).cast("double")
    known = df.filter(F.col(value).isNotNull()).select(*keys, value)
    sketch = F.kll_sketch_agg_double(number, SKETCH_ITEMS)
    groups = known.groupBy(*keys).agg(sketch.alias("_sketch"), F.count(F.lit(1)).alias("_total"), F.count_if(~F.isnan(number)).alias("_numbers"))
    bound = lambda rank: F.when(F.col("_numbers") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(rank)))
    groups = groups.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_total", bound(0.5 - BRACKET).alias("_low"), bound(0.5 + BRACKET).alias("_high")
    )
    path = scratch(spark, "median-bounds")
    groups.write.parquet(path)
    groups = spark.read.parquet(path)
    same = [known[k].eqNullSafe(groups[f"_k{i}"]) for i, k in enumerate(keys)] or [F.lit(True)]
    open_rows = known.join(groups, same).filter(~F.coalesce(number > F.col("_high"), F.lit(False)))
    below = F.coalesce(number < F.col("_low"), F.lit(False))
    # what lies below is one null per group, which comes first in order; what lies above is in the total only
    counts = open_rows.withColumn(value, F.when(~below, F.col(value))).groupBy(*keys, value, "_total").agg(F.count(F.lit(1)).alias("_n"))
    path = scratch(spark, "median-settled")
    _median_of_counts(counts, keys, value, name).filter(F.col(name).isNotNull()).write.parquet(path)
    settled = spark.read.parquet(path)
    found = [groups[f"_k{i}"].eqNullSafe(settled[k]) for i, k in enumerate(keys)] or [F.lit(True)]
    missed = groups.join(settled, found, "left_anti")
    if missed.isEmpty():
        return settled
    again = known.join(missed, [known[k].eqNullSafe(missed[f"_k{i}"]) for i, k in enumerate(keys)] or [F.lit(True)], "left_semi")
    return settled.unionByName(group_median(again, keys, value, name))


def _median_of_counts(counts: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Median of (keys, value, ``_n``); ``_total``, where there is one, is the size of the group that ranks refer to."""
    df = counts
    total = F.max("_total").over(Window.partitionBy(*keys)) if "_total" in counts.columns else F.sum("_size").over(Window.partitionBy(*keys))
    # The range bounds come from sampling, so the layout is written down before it is read twice.
    path = scratch(df.sparkSession, "median")
    counts.repartitionByRange(*keys, value).withColumn("_chunk", F.spark_partition_id()).write.parquet(path)
    laid_out = df.sparkSession.read.parquet(path)

    sizes = [F.max("_total").alias("_total")] if "_total" in counts.columns else []
    chunks = laid_out.groupBy(*keys, "_chunk").agg(F.sum("_n").alias("_size"), *sizes)
    ranks = (
        _running(chunks, keys, "_chunk", "_size")
        .withColumn("_total", total)
        .withColumns({"_lo": F.floor((F.col("_total") + 1) / 2), "_hi": F.floor((F.col("_total") + 2) / 2)})
    )
    end = F.col("_before") + F.col("_size")
    holds = [(F.col(r) > F.col("_before")) & (F.col(r) <= end) for r in ("_lo", "_hi")]
    picked = ranks.filter(holds[0] | holds[1]).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_c"),
        F.col("_before").alias("_base"),
        "_lo",
        "_hi",
    )

    on = [laid_out["_chunk"] == picked["_c"]]
    on += [laid_out[k].eqNullSafe(picked[f"_k{i}"]) for i, k in enumerate(keys)]
    inside = laid_out.join(picked, on, "inner")
    start = F.col("_base") + F.col("_before")
    ranked = _running(inside, [*keys, "_chunk"], value, "_n").withColumns(
        {"_start": start, "_end": start + F.col("_n")}
    )
    middle = {r: F.when((F.col(r) > F.col("_start")) & (F.col(r) <= F.col("_end")), F.col(value).cast("double")) for r in ("_lo", "_hi")}
    return ranked.groupBy(*keys).agg(((F.max(middle["_lo"]) + F.max(middle["_hi"])) / 2).alias(name))


def _running(df: DataFrame, keys: Sequence[str], order: str, size: str) -> DataFrame:
    """Add ``_before``: the total of ``size`` over earlier rows of the same keys."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_before", F.coalesce(F.sum(size).over(earlier), F.lit(0)))
