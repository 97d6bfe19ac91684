"""Surrogate keys. They are pure functions of the natural key, so a fact needs no lookup to get them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sediment.functions.text import _col

# Separator and stand-in for a missing part in composite keys.
KEY_SEPARATOR = "|"
KEY_MISSING = ""


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of one value, or of several joined by the separator with missing parts as empty text."""
    if len(cols) == 1:
        return F.md5(_col(cols[0]).cast("string"))
    pieces: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            pieces.append(F.lit(KEY_SEPARATOR))
        pieces.append(F.coalesce(_col(c).cast("string"), F.lit(KEY_MISSING)))
    return F.md5(F.concat(*pieces))


def date_key(c: Column | str) -> Column:
    """Integer ``yyyymmdd``."""
    d = _col(c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
