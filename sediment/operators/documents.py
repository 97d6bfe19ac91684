"""Nested JSON collections: open them, nest columns into them, and merge their source tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from sediment.functions.text import _col


def json_text(c: Column | str, path: str) -> Column:
    """Scalar or sub-document at a path as text; a missing path and a JSON null are both NULL."""
    return F.get_json_object(_col(c), path)


def explode_json(
    df: DataFrame, col: str, path: str, out: str, element: str | None = None, strict: bool = True
) -> DataFrame:
    """One row per element of the array at ``path``; no array or an empty one gives no row.

    ``element`` is the DDL type of an element; without it every element is kept as JSON text. A text
    that is not JSON stops the job unless ``strict`` is off, because it would silently lose rows.
    """
    names = path.removeprefix("$").strip(".")
    steps = names.split(".") if names else []
    if not all(re.fullmatch(r"\w+", s) for s in steps):
        raise ValueError(f"only plain field paths are supported: {path}")
    schema = f"array<{element or 'string'}>"
    for step in reversed(steps):
        schema = f"struct<{step}:{schema}>"
    parsed = F.from_json(F.col(col), schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    for step in steps:
        parsed = parsed.getField(step)
    return df.withColumn(out, F.explode(parsed))


def variant_value(c: Column | str, path: str, kind: str = "string") -> Column:
    """Value at a path of a variant as a type; NULL for a missing path, a JSON null and a value that is not of the type."""
    return F.try_variant_get(_col(c), path, kind)


def explode_variant(df: DataFrame, col: str, path: str, out: str, strict: bool = True) -> DataFrame:
    """One row per element of the array or field of the object at ``path``, for documents whose shape is not known.

    ``col`` is a text, which is parsed once a row, or a variant. Adds ``out`` (a variant, see :func:`variant_value`), ``<out>_pos`` from 0 (fields
    of an object in name order) and ``<out>_key``, the name of a field, NULL for elements. No text, no such path, a
    scalar, and an empty array or object give no row. A text that is not JSON stops the job unless ``strict`` is off;
    then it gives no row. Columns of these three names are replaced.
    """
    names = [out, f"{out}_pos", f"{out}_key"]
    parse = F.parse_json if strict else F.try_parse_json
    parsed = F.col(col) if isinstance(df.schema[col].dataType, VariantType) else parse(F.col(col))
    kept = [F.col(f"`{c}`").alias(f"doc_{i}") for i, c in enumerate(df.columns) if c.lower() not in {n.lower() for n in names}]
    rows = df.select(*kept, F.try_variant_get(parsed, path, "variant").alias("doc_part"))
    rows = rows.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("doc_part").outer()))
    columns = [c for c in df.columns if c.lower() not in {n.lower() for n in names}]
    own = [F.col(f"doc_{df.columns.index(c)}").alias(c) for c in columns]
    return rows.select(*own, F.col("value").alias(names[0]), F.col("pos").alias(names[1]), F.col("key").alias(names[2]))


def nest_items(kind: str, value: str, columns: Mapping[str, Column | str]) -> Column:
    """Turn columns into an array of ``{kind, value}`` structs (kind -> column), in the given order."""
    return F.array(
        *[
            F.struct(F.lit(k).alias(kind), _col(c).cast("string").alias(value))
            for k, c in columns.items()
        ]
    )


def nest_collections(
    df: DataFrame, fields: Sequence[str], collections: Mapping[str, Column], out: str = "document"
) -> DataFrame:
    """One JSON document per row: plain fields plus nested collections. Rows keep their own document,
    so nothing is gathered; NULL fields stay visible as JSON null."""
    body = F.struct(*fields, *[c.alias(name) for name, c in collections.items()])
    return df.select(F.to_json(body, {"ignoreNullFields": "false"}).alias(out))


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the highest ordinal of each non-blank key, by an aggregation that combines map-side.

    Ordinals that are text, as landing leaves them, compare as numbers.
    """
    rest = [c for c in df.columns if c != key]
    ordinal = F.col(order).try_cast("bigint") if dict(df.dtypes)[order] == "string" else F.col(order)
    kept = df.withColumn(key, F.trim(key)).filter(F.col(key) != "")
    best = kept.groupBy(key).agg(F.max_by(F.struct(*rest), ordinal).alias("_row"))
    return best.select(key, "_row.*")


def merge_sources(
    a: DataFrame, b: DataFrame, key: str, shared: Sequence[str], order: str, fill: str = ""
) -> DataFrame:
    """Full outer merge of two text tables on a key.

    Blank keys are dropped, the last row of a repeated key wins, a shared column takes the first
    non-empty text of the two sides, and fields a side does not have become ``fill``. Both sides
    are one row per key before the join, so no key can be hot in it.
    """
    left = latest_per_key(a, key, order).drop(order)
    right = latest_per_key(b, key, order).drop(order)
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in shared})
    joined = left.join(right, key, "full")
    text = [
        F.coalesce(F.nullif(F.col(c), F.lit("")), F.nullif(F.col(f"_r_{c}"), F.lit("")), F.lit(fill)).alias(c)
        for c in shared
    ]
    own = [c for c in left.columns if c not in (key, *shared)]
    other = [c for c in right.columns if c != key and not c.startswith("_r_")]
    return joined.select(key, *text, *[F.coalesce(c, F.lit(fill)).alias(c) for c in (*own, *other)])
