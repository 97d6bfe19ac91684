"""Numbers in text, guarded ratios and completeness flags."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import and_, add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.text import _col

# The grammar of quantity texts such as "2 x 7500 + 10000" and the statuses given to them.
QUANTITY_TERM = r"(?:[0-9]+\s*x\s*)?[0-9][0-9.]*"
QUANTITY_FILLER = r"[\s+]|(?<!\p{L})(?:e|litros?|l)(?!\p{L})"
STATUS_UNDECLARED = "SEM_CAPACIDADE_DECLARADA"
STATUS_UNPARSED = "NAO_INTERPRETADO"
STATUS_PARSED = "INTERPRETADO"
# Fixed value: how a missing number is shown.
MISSING_NUMBER = "—"


def parse_decimal(
    c: Column | str, precision: int = 18, scale: int = 2, point: str = ",", group: str = "."
) -> Column:
    """Decimal written with the given point and thousands separator, NULL when it does not parse."""
    plain = F.translate(_col(c), point + group, ".")
    return plain.try_cast(f"decimal({precision},{scale})")


def format_decimal(c: Column | str, digits: int = 2, point: str = ",", group: str = ".") -> Column:
    """Inverse of :func:`parse_decimal`; a missing number is shown as a dash, not as zero."""
    number = _col(c)
    shown = F.translate(F.format_number(F.round(number, digits), digits), ",.", group + point)
    return F.coalesce(shown, F.lit(MISSING_NUMBER))


def ratio(num: Column | str, den: Column | str, scale: float = 1.0, digits: int = 4) -> Column:
    """``scale * num / den`` in double, NULL unless both sides exist and the denominator is positive."""
    n, d = _col(num), _col(den)
    return F.when(
        n.isNotNull() & (d > 0),
        F.round(F.lit(float(scale)) * n.cast("double") / d.cast("double"), digits),
    )


def half_up(x: Column, digits: int) -> Column:
    """Round a double half up on its binary value; the same formula gives the same result in any engine."""
    unit = float(10**digits)
    return F.floor(x * F.lit(unit) + F.lit(0.5)).cast("double") / F.lit(unit)


def scaled(c: Column | str, digits: int = 2) -> Column:
    """A double that holds at most ``digits`` decimals, as an exact integer of its smallest unit.

    Sums of it do not depend on row order and stay on machine integers; an overflow stops the job.
    """
    return F.floor(_col(c) * F.lit(float(10**digits)) + F.lit(0.5)).cast("bigint")


def from_scaled(c: Column | str, digits: int = 2, precision: int = 18) -> Column:
    """The decimal that :func:`scaled` units stand for."""
    unit = Decimal(1).scaleb(-digits)
    return (_col(c).cast("decimal(19,0)") * F.lit(unit)).cast(f"decimal({precision},{digits})")


def ratio_decimal(
    num: Column | str, den: Column | str, scale: float = 1.0, digits: int = 4, precision: int = 18
) -> Column:
    """:func:`ratio` as a decimal, so that sums over it do not depend on the order of rows."""
    n, d = _col(num), _col(den)
    raw = F.lit(float(scale)) * n.cast("double") / d.cast("double")
    return F.when(n.isNotNull() & (d > 0), half_up(raw, digits).cast(f"decimal({precision},{digits})"))


def complete(*cols: Column | str, positive: Column | str | None = None) -> Column:
    """True when every column is present (and the ``positive`` one is above zero); never NULL."""
    flags = [_col(c).isNotNull() for c in cols]
    if positive is not None:
        flags.append(F.coalesce(_col(positive) > 0, F.lit(False)))
    return reduce(and_, flags)


def has(c: Column | str) -> Column:
    """Presence of the other side after a left join."""
    return _col(c).isNotNull()


def default(c: Column | str, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def strict_add(*cols: Column | str) -> Column:
    """Sum that exists only when every part does: SQL addition keeps NULL, nothing is taken as zero."""
    return reduce(add, [_col(c) for c in cols])


def non_negative_violation(*cols: Column | str) -> Column:
    """True when any of the measures is below zero; missing measures do not count."""
    return reduce(lambda a, b: a | b, [F.coalesce(_col(c) < 0, F.lit(False)) for c in cols])


def _term_amount(term: Column) -> Column:
    unit = F.translate(F.substring_index(term, "x", -1), ".", "").try_cast("bigint")
    times = F.when(F.contains(term, F.lit("x")), F.substring_index(term, "x", 1).try_cast("bigint")).otherwise(
        F.lit(1).cast("bigint")
    )
    return F.try_multiply(times, unit)


def with_quantity(
    df: DataFrame,
    col: str,
    terms: str = "terms",
    total: str = "total",
    status: str = "status",
    strict: bool = False,
) -> DataFrame:
    """Add term count, total and reading status of a quantity text, as one narrow row expression.

    A text counts as read when at least one term is found and the total of all terms fits; one that
    does not fit leaves no total. With ``strict`` it must hold nothing but terms, plus signs and unit words.
    """
    text = F.lower(F.col(col))
    found = F.regexp_extract_all(text, F.lit(QUANTITY_TERM), F.lit(0))
    if strict:
        found = F.when(text.rlike(f"^(?:(?>{QUANTITY_TERM})|{QUANTITY_FILLER})*+\\z"), found)
    amounts = F.transform(F.col("_terms"), _term_amount)
    return (
        df.withColumn("_terms", found)
        .withColumn("_amounts", amounts)
        .withColumns(
            {
                terms: F.nullif(F.size("_terms").cast("bigint"), F.lit(0).cast("bigint")),
                total: F.when(
                    F.size("_amounts") > 0,
                    F.aggregate("_amounts", F.lit(0).cast("bigint"), lambda acc, a: F.try_add(acc, a)),
                ),
            }
        )
        .withColumn(status, quantity_status(col, total))
        .drop("_terms", "_amounts")
    )


def quantity_status(raw: Column | str, total: Column | str) -> Column:
    return (
        F.when(_col(raw).isNull(), STATUS_UNDECLARED)
        .when(_col(total).isNull(), STATUS_UNPARSED)
        .otherwise(STATUS_PARSED)
    )


def classify_gap(
    eligible: Column | str,
    measured: Column | str,
    parts: dict[str, str],
    no_measure: str,
    missing_prefix: str,
    joiner: str,
    zero: str,
) -> Column:
    """Why a row is outside the index: NULL for rows that are inside.

    ``parts`` maps a needed column to the words used when it is missing.
    """
    missing = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(words)) for c, words in parts.items()])
    )
    return (
        F.when(_col(eligible), F.lit(None).cast("string"))
        .when(~_col(measured), F.lit(no_measure))
        .when(F.size(missing) > 0, F.concat(F.lit(missing_prefix), F.array_join(missing, joiner)))
        .otherwise(F.lit(zero))
    )
