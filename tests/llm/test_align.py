"""Tokenizer alignment against a plain walk over both token lists of whole texts."""

import hashlib
import json
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sediment.llm import align
from sediment.llm.queries import QUERIES
from sediment.llm.tokens import read_vocabulary

TEXTS = [
    "Plain words, and some more of them.", "", None, " two  spaces  and \n lines\n", "🙂 emoji🙂🙂 and é ü ß", "日本語のテキスト and 中文", "▁ a piece mark",
    "<|endoftext|> and <s> </s> <0x41> stay text", "a" * 500, "word " * 900 + "end", "don't can't 12345 -- ..", "\t", "é", "x́ combining", "a b c d", "ﬁ ½ Å",
    "the the the the", "mixed é a é b é c", "tab\tand\rreturn", "\u0000 null",
]


def reference():
    a = Tokenizer.from_file(align.VOCABULARY_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=align.VOCABULARY_B)
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in letters]
    byte = {chr(x): x for x in letters} | {chr(256 + n): x for n, x in enumerate(rest)}
    names = {i: n for n, i in json.load(open(align.VOCABULARY_A, encoding="utf-8"))["model"]["vocab"].items()}
    a_bytes = lambda i: bytes(byte[c] for c in names[i])
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def walk(text):
        if not text:
            return None
        raw = (" " + text).encode()
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ends = [np.cumsum([len(f(i)) for i in ids]).tolist() for f, ids in ((a_bytes, x), (b_bytes, y))]
        if b"".join(map(a_bytes, x)) != raw or b"".join(map(b_bytes, y)) != raw:
            return None
        links, groups, i, j, start = [], [], 0, 0, (0, 0)
        while i < len(x):
            links.append((x[i], y[j]))
            p, q = ends[0][i], ends[1][j]
            i, j = i + (p <= q), j + (q <= p)
            if p == q:
                groups.append((x[start[0] : i], y[start[1] : j]))
                start = (i, j)
        return x, y, groups, links

    return walk


def rows_of(texts):
    walk = reference()
    found = [walk(t) for t in texts]
    documents = Counter()
    for f in found:
        documents.update(set(f[3]) if f else ())
    best = {}
    for (a, _), n in documents.items():
        best[a] = max(best.get(a, 0), n)
    for f in found:
        if f is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            x, y, groups, links = f
            text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
            yield (len(x), len(y), len(groups), len(links), sum(documents[p] == best[p[0]] for p in links), sum(documents[p] for p in links), hashlib.sha256(text.encode()).hexdigest())


def columns(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


@pytest.mark.parametrize("block_chars", [1, 5000, 10**7])
def test_whole_texts_at_any_block_size(spark, block_chars):
    texts = TEXTS + [" ".join(t for t in TEXTS[k : k + 3] if t) for k in range(8)] + TEXTS[:3]
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("block", F.lit("x")).repartition(3)
    found, pairs = align.linked_documents(frame, derive={"groups_sha256": digest}, block_chars=block_chars)
    got = {r.id: columns(r) for r in found.collect()}
    assert [got[k] for k in range(len(texts))] == list(rows_of(texts))
    assert all(r.documents > 0 for r in pairs.collect())


def test_query_on_awkward_rows(spark, tables, doc_rows):
    found = QUERIES["op11_tokenizer_alignment"](spark, tables).collect()
    want = Counter((r[0], *w) for r, w in zip(doc_rows, rows_of([r[1] for r in doc_rows]), strict=True))
    assert Counter((r.doc_id, *columns(r)) for r in found) == want


def test_groups_give_back_the_text(spark):
    vocabularies = read_vocabulary(align.VOCABULARY_A), read_vocabulary(align.VOCABULARY_B)
    both = align.aligner(*vocabularies)
    assert both.cut
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    walk = reference()
    for text, groups in frame.select("text", align.groups(F.col("text"), *vocabularies).alias("g")).collect():
        want = walk(text)
        assert [(g.a, g.b) for g in groups] == (want[2] if want else [])
        for side, parts in (("a", both.a_bytes), ("b", both.b_bytes)):
            for g in groups:
                assert b"".join(parts[i] for i in g[side]) == (" " + text).encode()[g.start : g.end]


def test_memory_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(align, "REMEMBERED", 3)
    memory = align._Memory(align.aligner(read_vocabulary(align.VOCABULARY_A), read_vocabulary(align.VOCABULARY_B)))
    got = []
    for text in TEXTS:
        block = align._Block(0, memory)
        block.add(1, text)
        first = next(block.batches()).to_pylist()[0]
        got.append(tuple(first[c] for c in ("n_a", "n_b", "n_groups", "n_links")))
    assert got == [r[:4] for r in rows_of(TEXTS)]
