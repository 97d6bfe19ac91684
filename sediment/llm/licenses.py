"""Licence scan: Aho-Corasick finds phrases and identifier tags, a shunting-yard parser evaluates licence expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases that name a licence, as words, with their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notices that the scan knows, with label and weight of evidence.
NOTICE_PHRASES = {
    "mit license": ("mit", 0.7),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.8),
    "gnu general public license": ("gpl", 0.8),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "bsd 2 clause": ("bsd-2-clause", 0.8),
    "bsd 3 clause": ("bsd-3-clause", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.7),
    "isc license": ("isc", 0.7),
    "cc by": ("cc-by", 0.5),
    "cc by sa": ("cc-by-sa", 0.7),
    "creative commons attribution": ("cc-by", 0.7),
    "cc0 1 0": ("cc0", 0.8),
    "released into the public domain": ("public-domain", 0.7),
    "all rights reserved": ("all-rights-reserved", 0.4),
}
BASE_WEIGHT = 0.9
TAG_WEIGHT = 0.95
TAG_WORDS = "spdx license identifier"

# How much a licence asks of whoever reuses the work, by the start of its identifier.
DUTIES = (
    ("agpl", 4),
    ("lgpl", 2),
    ("gpl", 3),
    ("mpl", 2),
    ("epl", 2),
    ("cc-by-nc", 4),
    ("cc-by-nd", 4),
    ("cc-by-sa", 3),
    ("cc-by", 1),
    ("cc0", 0),
    ("unlicense", 0),
    ("mit", 1),
    ("apache", 1),
    ("bsd", 1),
    ("isc", 1),
)
UNKNOWN_DUTY = 5

_WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9][A-Za-z0-9.\-]*\+?)", re.ASCII)
_BINDS = {"or": 1, "and": 2, "with": 3}


def duty(identifier: str) -> int:
    return next((d for start, d in DUTIES if identifier.startswith(start)), UNKNOWN_DUTY)


def label_of(identifier: str) -> str:
    """Label of a licence identifier: lower case, version and ``-only`` or ``-or-later`` left out."""
    name = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower())
    if name.startswith("apache-2"):
        return "apache-2"
    return re.sub(r"-\d+(\.\d+)*$", "", name) if not name.startswith("bsd-") else name


@dataclass
class Expression:
    """A licence expression in postfix order, and what it comes to."""

    postfix: list[str] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)
    duty: int = UNKNOWN_DUTY


def parse_expression(text: str) -> Expression | None:
    """The longest licence expression at the start of ``text``, by the shunting-yard algorithm; None if there is none.

    WITH binds tighter than AND, AND than OR. The duty of ``a AND b`` is the larger, of ``a OR b`` the smaller;
    ``a WITH exception`` asks one less than a. An operator needs both sides: what does not fit ends the expression.
    """
    tokens, at, operand_next, depth, good = [], 0, True, 0, 0
    while m := _TOKEN.match(text, at):
        token, low = m[1], m[1].lower()
        if low in _BINDS:
            if operand_next:
                break
            operand_next = True
        elif token == "(":
            if not operand_next:
                break
            depth += 1
        elif token == ")":
            if operand_next or not depth:
                break
            depth -= 1
        else:
            if not operand_next:
                break
            operand_next = False
        tokens.append(low if low in _BINDS else token)
        at = m.end()
        if not operand_next and not depth:
            good = len(tokens)
    tokens = tokens[:good]
    if not tokens:
        return None
    output, waiting = [], []
    for token in tokens:
        if token in _BINDS:
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[token]:
                output.append(waiting.pop())
            waiting.append(token)
        elif token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                output.append(waiting.pop())
            waiting.pop()
        else:
            output.append(token)
    output.extend(reversed(waiting))
    values: list[tuple[int, frozenset[str]]] = []
    for token in output:
        if token not in _BINDS:
            values.append((duty(token.lower()), frozenset([label_of(token)])))
            continue
        (b, b_labels), (a, a_labels) = values.pop(), values.pop()
        if token == "with":
            values.append((max(a - 1, 0), a_labels))
        else:
            values.append((max(a, b) if token == "and" else min(a, b), a_labels | b_labels))
    return Expression(output, sorted(values[0][1]), values[0][0])


def as_words(text: bytes) -> list[bytes]:
    """Words of the text: A-Z in lower case, ASCII other than letters and digits separates."""
    return text.translate(_WORD_BYTES).split()


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    phrases = {p: ("base", p, label, BASE_WEIGHT) for p, label in BASE_PHRASES.items()}
    phrases |= {p: ("notice", p, label, weight) for p, (label, weight) in NOTICE_PHRASES.items()}
    phrases[TAG_WORDS] = ("tag", TAG_WORDS, "", 0.0)
    for phrase, what in phrases.items():
        found.add_word(f" {phrase} ", what)
    found.make_automaton()
    return found


def _longest(hits: list[tuple[int, tuple[str, str, str, float]]]) -> list[tuple[int, tuple[str, str, str, float]]]:
    """Hits by place, without notices that lie inside another phrase found there; base phrases all stay."""
    kept, reach = [], -1
    for start, what in sorted(hits, key=lambda h: (h[0], -len(h[1][1]))):
        if what[0] == "base" or start + len(what[1]) > reach:
            kept.append((start, what))
        reach = max(reach, start + len(what[1]))
    return kept


def scan_text(text: bytes) -> tuple[int, list[tuple[str, int, str, float, str | None, int | None]]]:
    """Number of words, and findings in text order: kind, first word, label, weight, expression, duty.

    A tag gives a finding for each label of its expression, at the word where the tag starts.
    """
    words = as_words(text)
    if not words:
        return 0, []
    joined = b" " + b" ".join(words) + b" "
    line = joined.decode("utf-8", "replace")
    hits = _longest([(end - len(what[1]) - 1, what) for end, what in _automaton().iter(line)])
    if not hits:
        return len(words), []
    spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32) == 32)
    findings, tags = [], []
    for (_, (kind, _, label, weight)), word in zip(hits, np.searchsorted(spaces, [h[0] for h in hits]).tolist(), strict=True):
        if kind == "tag":
            tags.append(word)
        else:
            findings.append((kind, word, label, weight, None, None))
    if tags:
        raw = text.decode("utf-8", "replace")
        before, at = 0, 0
        for m in _TAG.finditer(raw):
            before += len(as_words(raw[at : m.start()].encode()))
            at = m.start()
            expression = parse_expression(m[1])
            if expression is not None:
                shown = " ".join(expression.postfix)
                findings += [("tag", before, label, TAG_WEIGHT, shown, expression.duty) for label in expression.labels]
    return len(words), sorted(findings, key=lambda f: (f[1], f[0], f[2]))


FINDINGS = "n_words long, findings array<struct<kind:string,word:long,label:string,weight:double,expression:string,duty:int>>"


def scan(text: Column) -> Column:
    """struct(n_words, findings) of every whole text; null counts as empty and has no findings."""

    @F.arrow_udf(FINDINGS)
    def licences(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = pa.struct(
            [("kind", pa.string()), ("word", pa.int64()), ("label", pa.string()), ("weight", pa.float64()), ("expression", pa.string()), ("duty", pa.int32())]
        )
        names = [f.name for f in one]
        for batch in texts:
            scanned = [scan_text(t.as_py() or b"") for t in batch]
            counts = pa.array([s[0] for s in scanned], pa.int64())
            found = pa.array([[dict(zip(names, f, strict=True)) for f in s[1]] for s in scanned], pa.list_(one))
            yield pa.StructArray.from_arrays([counts, found], ["n_words", "findings"])

    return licences.asNondeterministic()(text.cast("binary"))
