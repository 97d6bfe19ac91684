"""What several operators share: stored tables, row names, fold numbers, character tables."""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.session import scratch


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: lineage ends here and a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@lru_cache(maxsize=1)
def character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: lower-case form (where it is one character), is a letter, is a letter or digit."""
    size = sys.maxunicode + 1
    lower = np.arange(size, dtype=np.uint32)
    letter = np.zeros(size, dtype=bool)
    word = np.zeros(size, dtype=bool)
    for block in (range(0xD800), range(0xE000, 0x20000)):
        for c in block:
            ch = chr(c)
            if ch.isalnum():
                word[c] = True
                letter[c] = ch.isalpha()
                low = ch.lower()
                if len(low) == 1:
                    lower[c] = ord(low)
    word[0x20000:0x32000] = letter[0x20000:0x32000] = True  # ideographs of the further planes
    return lower, letter, word
