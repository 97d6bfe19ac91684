"""Mixing sources to target weights by hierarchical budgets.

A budget of tokens is handed down a tree of groups by weight. A group gets no more than it can give in the allowed
number of epochs. What it falls short of goes to its siblings by their weights, and only if all of them are full does
it reach the level above. Each leaf then takes a prefix of its seeded epochs: whole epochs, and of the next one the
first documents in an order drawn for that epoch, until the quota is reached.

Budgets are whole tokens: shares are rounded down and what is left goes to the largest remainders. A weight of 0 takes
a node and all below it out of the mixture.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import stored

ROWS_PER_BUCKET = 4096
ORDER_BITS = 60
EXACT = "decimal(38,0)"


def epoch_order(seed: int, epoch: Column, doc: Column) -> Column:
    """Place of a document in an epoch: 60 bits of md5 over seed, epoch and id."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc.cast("string"), F.lit("")))
    return F.conv(F.left(F.md5(text), F.lit(ORDER_BITS // 4)), 16, 10).cast("bigint")


def _weight(levels: list[str], weights: dict[tuple[str, ...], int]) -> Column:
    """Weight of a node by its path, 1 if none is given."""
    weight = F.lit(1)
    for path, w in sorted(weights.items()):
        if len(path) == len(levels):
            same = [F.col(c) == F.lit(v) for c, v in zip(levels, path, strict=True)]
            hit = same[0]
            for s in same[1:]:
                hit = hit & s
            weight = F.when(hit, w).otherwise(weight)
    return weight.cast(EXACT)


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split ``budget`` of each parent over its children (capacity, weight) without passing any capacity: adds ``quota``.

    In order of capacity for weight, children that cannot take their share of what is left are full; the others
    share the rest by weight. Windows run over tree nodes, not over documents.
    """
    order = [F.col("capacity") / F.col("weight"), F.col(name)]
    by = Window.partitionBy(*parent)
    upto = by.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = by.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(upto), F.lit(0).cast(EXACT))
    nodes = children.withColumn("left", left.cast(EXACT)).withColumn("open_weight", F.sum("weight").over(onward).cast(EXACT))
    nodes = nodes.withColumn("full", F.col("capacity") * F.col("open_weight") <= F.col("left") * F.col("weight"))
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0).cast(EXACT))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(by)
    nodes = nodes.withColumn("rest", (F.col("budget") - taken).cast(EXACT)).withColumn("of", open_weight.cast(EXACT))
    product = F.expr(f"cast(rest * weight as {EXACT})")
    nodes = nodes.withColumn("down", F.when(~F.col("full"), F.floor(F.expr(f"cast(rest * weight as {EXACT}) div of")).cast(EXACT)))
    nodes = nodes.withColumn("over", F.when(~F.col("full"), (product - F.col("down") * F.col("of")).cast(EXACT)))
    spare = F.col("rest") - F.coalesce(F.sum("down").over(by), F.lit(0).cast(EXACT))
    place = F.row_number().over(by.orderBy(F.col("full"), F.col("over").desc_nulls_last(), F.col(name)))
    nodes = nodes.withColumn("spare", spare).withColumn("place", place)
    quota = F.when(F.col("full"), F.col("capacity")).otherwise(F.col("down") + (F.col("place") <= F.col("spare")).cast("int"))
    return nodes.withColumn("quota", quota.cast(EXACT))


def budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple[str, ...], int], total: int | None, max_epochs: int) -> DataFrame:
    """Leaves with their ``quota``. ``total`` None stands for as many tokens as there are."""
    leaves = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast(EXACT))
    path = ["root"]
    leaves = leaves.withColumn("root", F.lit(0))
    quotas = None
    for level in levels:
        nodes = leaves.groupBy(*path, level).agg(F.sum("capacity").cast(EXACT).alias("capacity"), F.sum("tokens").alias("tokens"))
        if quotas is None:  # all of the tree is under one root
            all_nodes = Window.partitionBy(*path)
            asked = F.lit(total).cast(EXACT) if total is not None else F.sum("tokens").over(all_nodes).cast(EXACT)
            nodes = nodes.withColumn("budget", F.least(asked, F.sum("capacity").over(all_nodes).cast(EXACT)))
        else:
            nodes = nodes.join(quotas.select(*path, F.col("quota").alias("budget")), path)
        nodes = nodes.withColumn("weight", _weight([*path[1:], level], weights))
        quotas = share_out(nodes, path, level).select(*path, level, "quota")
        path = [*path, level]
    return leaves.join(quotas, path).drop("root", "capacity")


def _reached(sums: DataFrame, keys: list[str], order: list[Column], base: Column) -> DataFrame:
    """Rows of ``sums`` (keys, rest, tokens) in which the running total from ``base`` passes ``rest``: adds ``before``."""
    ahead = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", base + F.coalesce(F.sum("tokens").over(ahead), F.lit(0)))
    return sums.where("before < rest and rest <= before + tokens")


def cuts(docs: DataFrame, leaves: DataFrame, levels: list[str], seed: int) -> DataFrame:
    """Leaves with whole epochs (``full``) and the last place of the next epoch that is taken.

    A place is that of the epoch's order, then id, then tokens (``cut``, ``cut_id``, ``cut_size``); ``cut_tokens`` are
    left for the ``cut_rows`` rows that stand there. Places are dealt into buckets of some thousand documents, and
    buckets into about as many spans as a span has buckets: totals are put in order by span, by bucket of the span
    and by place of the bucket in which the quota is reached, and nowhere else.
    """
    leaves = leaves.withColumn("full", F.floor(F.col("quota") / F.col("tokens")).cast("int"))
    leaves = leaves.withColumn("rest", (F.col("quota") - F.col("full") * F.col("tokens")).cast("bigint"))
    bits = F.least(F.ceil(F.log2(F.greatest(F.col("docs") / ROWS_PER_BUCKET, F.lit(1)))), F.lit(40)).cast("int")
    leaves = leaves.withColumn("shift", F.lit(ORDER_BITS) - bits)
    placed = docs.join(leaves.where("rest > 0").select(*levels, "full", "rest", "shift"), levels)
    placed = placed.withColumn("place", epoch_order(seed, F.col("full"), F.col("id")))
    placed = placed.withColumn("bucket", F.expr("shiftright(place, shift)"))
    placed = placed.withColumn("span", F.expr(f"shiftright(bucket, ({ORDER_BITS} - shift) div 2)"))
    sums = stored(placed.groupBy(*levels, "span", "bucket", "rest").agg(F.sum("tokens").alias("tokens")), "mix-buckets")
    spans = _reached(sums.groupBy(*levels, "span", "rest").agg(F.sum("tokens").alias("tokens")), levels, [F.col("span")], F.lit(0))
    inside = sums.join(spans.select(*levels, "span", F.col("before").alias("base")), [*levels, "span"])
    edge = _reached(inside, levels, [F.col("bucket")], F.col("base")).select(*levels, "bucket", F.col("before").alias("base"))
    rows = placed.join(edge, [*levels, "bucket"]).groupBy(*levels, "place", "id", F.col("tokens").alias("size"), "rest", "base")
    rows = rows.agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("cut_rows"))
    order = [F.col("place"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("id").isNotNull(), F.col("size")]
    last = _reached(rows, levels, order, F.col("base")).select(
        *levels, F.col("place").alias("cut"), F.col("id").alias("cut_id"), F.col("size").alias("cut_size"), "cut_rows",
        (F.col("rest") - F.col("before")).alias("cut_tokens"),
    )
    return leaves.join(last, levels, "left")


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``mix_number`` from 0 within the keys, in the order of the stored rows. No window holds more than a block of them."""
    rows = stored(rows.withColumn("mix_at", F.monotonically_increasing_id()), "mix-cut-rows")
    rows = rows.withColumn("mix_block", F.expr(f"mix_at div {ROWS_PER_BUCKET}"))
    counts = rows.groupBy(*keys, "mix_block").agg(F.count(F.lit(1)).alias("mix_n"))
    ahead = Window.partitionBy(*keys).orderBy("mix_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "mix_block", F.coalesce(F.sum("mix_n").over(ahead), F.lit(0)).alias("mix_before"))
    own = F.row_number().over(Window.partitionBy(*keys, "mix_block").orderBy("mix_at")) - 1
    return rows.withColumn("mix_own", own).join(counts, [*keys, "mix_block"]).withColumn("mix_number", F.col("mix_before") + F.col("mix_own"))


def mix(
    docs: DataFrame,
    levels: list[str],
    id_col: str,
    tokens_col: str,
    weights: dict[tuple[str, ...], int],
    total: int | None = None,
    max_epochs: int = 4,
    seed: int = 17,
) -> DataFrame:
    """Rows of ``docs`` once for each epoch in which they are taken, with columns epoch and prefix_tokens.

    ``levels`` name the columns of the tree from the top; a null there is the group of empty text. ``weights`` gives
    whole weights by path, 1 where none is given; what lies below a weight of 0 is never taken and a negative weight is
    refused. The row that reaches a quota is taken; ``prefix_tokens`` says how many of its tokens belong to the prefix,
    for others all. Rows that share an id (or have none) come one after the other, smaller ones first and equal ones in
    any order, so that quotas hold for repeated ids too. Documents without tokens are never taken. Columns of these two
    names are replaced.
    """
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    node = [f"node_{i}" for i in range(len(levels))]
    while {c.lower() for c in docs.columns} & set(node):
        node = [n + "_" for n in node]
    paths = {n: F.coalesce(F.col(c).cast("string"), F.lit("")) for n, c in zip(node, levels, strict=True)}
    docs = docs.withColumns(paths)
    tokens = F.coalesce(F.col(tokens_col), F.lit(0)).cast("bigint")
    slim = stored(docs.select(*node, F.col(id_col).alias("id"), tokens.alias("tokens")).where("tokens > 0"), "mix-slim")
    outside = [reduce(and_, (F.col(n) == F.lit(v) for n, v in zip(node, path, strict=False))) for path, w in weights.items() if not w]
    leaves = slim.groupBy(*node).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = stored(leaves.where(~reduce(or_, outside, F.lit(False))), "mix-leaves")
    quotas = stored(budgets(leaves, node, weights, total, max_epochs), "mix-quotas")
    cut = F.struct("cut", "cut_id", "cut_size", "cut_rows", "cut_tokens").alias("cut")
    plan = stored(cuts(slim, quotas, node, seed).select(*node, F.struct("full", cut).alias("mix_plan")), "mix-plan")
    d, p = docs.alias("d"), plan.alias("p")
    rule = [F.col(f"d.{n}") == F.col(f"p.{n}") for n in node]
    full, cut = F.col("p.mix_plan.full"), F.col("p.mix_plan.cut")
    place = epoch_order(seed, full, F.col(f"d.{id_col}"))
    size = F.coalesce(F.col(f"d.{tokens_col}"), F.lit(0)).cast("bigint")
    rank = lambda place, id, size: F.struct(
        place.alias("p"), F.coalesce(id.cast("string"), F.lit("")).alias("t"), id.isNotNull().alias("k"), size.alias("s")
    )
    own, last = rank(place, F.col(f"d.{id_col}"), size), rank(cut["cut"], cut["cut_id"], cut["cut_size"])
    ahead = cut["cut"].isNotNull() & (own < last)
    at_cut = cut["cut"].isNotNull() & (own == last)
    columns = [c for c in docs.columns if c not in node and c.lower() not in ("epoch", "prefix_tokens")]
    rows = d.join(p, rule).where(size > 0)
    whole = F.when(full > 0, F.sequence(F.lit(0), full - 1)).otherwise(F.array().cast("array<int>"))
    whole = F.transform(whole, lambda e: F.struct(e.alias("epoch"), size.alias("tokens")))
    alone = at_cut & (cut["cut_rows"] == 1)
    part = F.when(ahead | alone, F.array(F.struct(full.alias("epoch"), F.when(alone, cut["cut_tokens"]).otherwise(size).alias("tokens"))))
    part = F.coalesce(part, F.array().cast("array<struct<epoch:int,tokens:bigint>>"))
    taken = rows.select(*(F.col(f"d.`{c}`") for c in columns), F.explode(F.concat(whole, part)).alias("mix_taken"))
    taken = taken.select(*(F.col(f"`{c}`") for c in columns), F.col("mix_taken.epoch").alias("epoch"), F.col("mix_taken.tokens").alias("prefix_tokens"))
    if plan.where("mix_plan.cut.cut_rows > 1").isEmpty():
        return taken
    # equal rows at a cut share what is left for them: the first ones whole, one in part, the others not in this epoch
    kept = [F.col(f"d.`{c}`").alias(f"mix_c{i}") for i, c in enumerate(columns)]
    equal = rows.where(at_cut & (cut["cut_rows"] > 1)).select(*(F.col(f"d.{n}") for n in node), *kept, F.col("p.mix_plan").alias("mix_plan"), size.alias("mix_size"))
    left = F.least(F.col("mix_size"), F.expr("mix_plan.cut.cut_tokens - mix_number * mix_size"))
    equal = _numbered(equal, node).withColumn("mix_left", left).where("mix_left > 0")
    values = [F.col(f"mix_c{i}").alias(c) for i, c in enumerate(columns)]
    return taken.unionByName(equal.select(*values, F.col("mix_plan.full").alias("epoch"), F.col("mix_left").alias("prefix_tokens")))
