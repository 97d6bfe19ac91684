"""Safe typing and conforming of text columns: a failed parse is NULL, never fatal and never zero."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a business key after trimming.
KEY_PATTERN = r"^[0-9]+\z"
# Fixed value: the only date layout the typed layers accept.
DATE_PATTERN = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trimmed text, with blank turned into NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def conform(c: Column | str) -> Column:
    """Upper case, so that spellings differing only in case become one value."""
    return F.upper(_col(c))


def valid_key(c: Column | str) -> Column:
    """True for text that is only digits after trimming; NULL counts as invalid."""
    return F.coalesce(F.trim(_col(c)).rlike(KEY_PATTERN), F.lit(False))


def safe_key(c: Column | str, type_name: str = "int") -> Column:
    """The typed key; digits that do not fit the type become NULL."""
    return F.trim(_col(c)).try_cast(type_name)


def safe_int(c: Column | str, type_name: str = "int") -> Column:
    """Numeric text as an integer, fractions rounded half away from zero."""
    return F.round(_col(c).try_cast("decimal(38,6)"), 0).try_cast(type_name)


def safe_bigint(c: Column | str) -> Column:
    return safe_int(c, "bigint")


def safe_date(c: Column | str) -> Column:
    """ISO dates only: partial dates such as '2026' are failures, not the first of January."""
    text = _col(c)
    return F.when(text.rlike(DATE_PATTERN), text.try_cast("date"))


def classify_like(c: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first LIKE pattern that the upper-cased text matches, in rule order."""
    text = conform(c)
    label: Column | None = None
    for pattern, value in rules:
        hit = text.like(pattern)
        label = F.when(hit, value) if label is None else label.when(hit, value)
    return F.lit(default) if label is None else label.otherwise(default)


def map_domain(c: Column | str, domain: Mapping[str, str], default: str) -> Column:
    """Exact-value map on the trimmed lower-cased text; anything else gets the default."""
    text = F.lower(F.trim(_col(c)))
    label: Column | None = None
    for source, target in domain.items():
        hit = text == source
        label = F.when(hit, target) if label is None else label.when(hit, target)
    return F.lit(default) if label is None else label.otherwise(default)
