"""Licences, tokens, chat, Order MinHash and URL pieces against plain versions."""

import random
import struct

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sediment.llm import chat, licenses, ordermin, tokens, url_lists
from sediment.llm.q_ordermin import op5_order_minhash


@pytest.mark.parametrize(
    "text,postfix,labels,duty",
    [
        ("MIT", ["MIT"], ["mit"], 1),
        ("MIT OR GPL-3.0-only", ["MIT", "GPL-3.0-only", "or"], ["gpl", "mit"], 1),
        ("MIT AND GPL-2.0+", ["MIT", "GPL-2.0+", "and"], ["gpl", "mit"], 3),
        ("MIT or Apache-2.0 and (GPL-2.0 or CC0-1.0)", ["MIT", "Apache-2.0", "GPL-2.0", "CC0-1.0", "or", "and", "or"], ["apache-2", "cc0", "gpl", "mit"], 1),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", ["GPL-2.0-only", "Classpath-exception-2.0", "with", "MIT", "and"], ["gpl", "mit"], 2),
        ("MIT AND */", ["MIT"], ["mit"], 1),
        ("(MIT OR (BSD-3-Clause)) and more words", ["MIT", "BSD-3-Clause", "or", "more", "and"], ["bsd-3-clause", "mit", "more"], 5),
        ("MIT )", ["MIT"], ["mit"], 1),
    ],
)
def test_licence_expressions(text, postfix, labels, duty):
    found = licenses.parse_expression(text)
    assert (found.postfix, found.labels, found.duty) == (postfix, labels, duty)


@pytest.mark.parametrize("text", ["", "OR MIT", "(MIT", "()", "*/"])
def test_no_licence_expression(text):
    assert licenses.parse_expression(text) is None


def test_licence_findings():
    line = "Ünder x. Under the MIT-License; under the mit license. CC BY-NC 4.0\nSPDX-License-Identifier: MIT OR Apache-2.0\n"
    words, found = licenses.scan_text(line.encode())
    assert words == len(licenses.as_words(line.encode())) == 23
    base = [(f[1], f[2]) for f in found if f[0] == "base"]
    assert base == [(2, "mit"), (6, "mit"), (10, "cc-by-nc")]
    assert [(f[1], f[2], f[4]) for f in found if f[0] == "tag"] == [(15, "apache-2", "MIT Apache-2.0 or"), (15, "mit", "MIT Apache-2.0 or")]
    assert not any(f[2] == "cc-by" for f in found)
    assert licenses.scan_text(b"") == (0, [])


TEXTS = ["", "plain words here\nand there", "é日本🙂 x\n\n🙂🙂", "a" * 3000, "\n\n", " lead  and trail \n", "don't we'll 12345 <|endoftext|>"]


@pytest.mark.parametrize("rule", tokens.RULES)
def test_tokens_by_section(spark, rule):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab é日🙂\n,1") for _ in range(200)) for _ in range(20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string")
    vocabulary = tokens.read_vocabulary(tokens.VOCABULARY)
    column = tokens.count_by_section(F.col("t"), tokens.paragraphs(F.col("t")), vocabulary, rule)
    got = {r.i: r.s for r in df.select("i", column.alias("s")).collect()}
    plain = Tokenizer.from_file(tokens.VOCABULARY.replace(".tiktoken", ".json"))
    plain.encode_special_tokens = True
    for i, text in enumerate(texts):
        sizes = [len(part) + 1 for part in text.split("\n")]
        sizes[-1] -= 1
        assert [s.chars for s in got[i]] == sizes
        encoded = plain.encode(text, add_special_tokens=False)
        assert sum(s.tokens for s in got[i]) == pytest.approx(len(encoded.ids))
        if text.isascii():
            want = np.zeros(len(sizes))
            bounds = np.cumsum([0, *sizes])
            for a, b in encoded.offsets:
                parts = [max(0, min(b, bounds[k + 1]) - max(a, bounds[k])) for k in range(len(sizes))]
                if rule == "share":
                    want += np.array(parts) / (b - a)
                else:
                    want[parts.index(max(parts)) if rule == "majority" else next(k for k, p in enumerate(parts) if p)] += 1
            assert [s.tokens for s in got[i]] == pytest.approx(want.tolist())
    assert not got[99]


CONTROL = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/s>", "x", "\n", "é"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(CONTROL, CONTROL), max_size=5), CONTROL)
def test_chat_reads_back(turns, answer):
    turns = [*turns, ("assistant", answer)]
    formatted, spans = chat.render_turns(turns)
    assert chat.read_turns(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_events_fold(spark):
    log = [
        (1, 0, 0, "open", "user", None), (1, 0, 1, "delta", None, "he"), (1, 0, 2, "delta", None, "llo"),
        (1, 1, 0, "open", "assistant", None), (1, 1, 1, "delta", None, "bad"), (1, 1, 2, "regenerate", None, None),
        (1, 1, 3, "delta", None, "go"), (1, 1, 4, "delta", None, "od"), (1, 1, 5, "edit", None, "be"), (1, 1, 6, "delta", None, "st"),
        (2, 0, 5, "delta", None, "b"), (2, 0, 4, "delta", None, "a"), (2, 1, 0, "open", "user", None), (None, None, None, "delta", None, None),
    ]
    events = spark.createDataFrame(log, "conv_id long, message long, seq long, kind string, role string, text string")
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold_messages(events).collect()}
    assert got == {(1, 0): ("user", "hello"), (1, 1): ("assistant", "best"), (2, 0): ("", "ab"), (2, 1): ("user", ""), (None, None): ("", "")}


def spark_hash(parts):
    h = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else struct.pack("<i" if abs(p) < 1 << 20 else "<q", p)
        h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def plain_signature(text):
    """Order MinHash as plain loops."""
    import re

    pieces, low = re.findall(r"[^ \t\n\x0b\f\r]{1,8}", text), (1 << ordermin.PLACE_BITS) - 1
    ranked, seen = [], {}
    for i in range(max(len(pieces) - ordermin.WIDTH, 0) + 1 if pieces else 0):
        v = spark_hash(pieces[i : i + ordermin.WIDTH]) & ~low | i
        h = v >> ordermin.PLACE_BITS
        j = seen.get(h, 0)
        seen[h] = j + 1
        if j:
            long = xxhash.xxh64_intdigest(struct.pack("<i", j), xxhash.xxh64_intdigest(struct.pack("<q", h), 42))
            v = (long - (1 << 64) if long >> 63 else long) & ~low | i
        ranked.append(v)
    out, span = [], 1 << 64 - ordermin.SKETCH_BITS
    for g in range(-ordermin.SKETCHES // 2, ordermin.SKETCHES // 2):
        onward = sorted(ranked, key=lambda v: (v - g * span) % (1 << 64))[: ordermin.CHOSEN]  # round the circle of hashes
        h = 42
        for _, v in sorted((v & low, v >> ordermin.PLACE_BITS) for v in onward):
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
        out.append(f"{h:016x}"[-ordermin.DIGITS :] if ranked else ordermin.EMPTY)
    return out


def plain_likeness(a, b):
    used = [(x, y) for x, y in zip(a, b, strict=True) if x != ordermin.EMPTY or y != ordermin.EMPTY]
    return (sum(x == y for x, y in used) / len(used)) ** (1 / ordermin.CHOSEN) if used else 1.0


def test_order_minhash_of_documents(spark, tables, doc_rows):
    import hashlib

    got = {}
    for r in op5_order_minhash(spark, tables).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(doc_rows)
    text = {i: t or "" for i, t, *_ in doc_rows}
    order = sorted(text, key=lambda i: (i is not None, i))
    for at, i in enumerate(order):
        after = text[order[(at + 1) % len(order)]]
        half = len(text[i]) // 2
        changed = text[i][: len(text[i]) - half] + after[:half]
        own, edited = plain_signature(text[i]), plain_signature(changed)
        for r in got[i]:
            assert (r.n_chars, r.edited_sha256) == (len(text[i]), hashlib.sha256(changed.encode()).hexdigest())
            assert (r.fingerprint, r.edited_fingerprint) == ("".join(own), "".join(edited))
            assert r.near_edited == pytest.approx(plain_likeness(own, edited))
            assert r.near_next == pytest.approx(plain_likeness(own, plain_signature(after)))


def test_order_minhash_sees_order(spark):
    rng = random.Random(8)
    words = [f"word{rng.randrange(9999)}" for _ in range(400)]
    one_edit = [*words[:200], "other", *words[201:]]
    blocks = [words[i : i + 20] for i in range(0, 400, 20)]
    rng.shuffle(blocks)
    texts = [" ".join(words), " ".join(one_edit), " ".join(sum(blocks, []))]
    df = spark.createDataFrame([tuple(texts)], "a string, b string, c string")
    own, near, moved = (ordermin.signature(F.col(c)) for c in "abc")
    row = df.select(ordermin.likeness(own, near), ordermin.likeness(own, moved)).first()
    assert row[0] > 0.9 and row[1] < row[0] - 0.1


def test_order_minhash_is_alike_at_all_lengths(spark):
    """Halves swapped so that the k-mers stay the same: about half of all pairs of them change order, at any length."""
    rng, rows = random.Random(9), []
    for n, texts in ((20, 400), (60, 200), (150, 100), (2000, 40)):
        for _ in range(texts):
            words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            half = n // 2
            rows.append((n, " ".join([*words, words[0]]), " ".join(words[half:] + words[: half + 1])))
    df = spark.createDataFrame(rows, "n int, a string, b string").repartition(8)
    near = ordermin.likeness(ordermin.signature(F.col("a")), ordermin.signature(F.col("b")))
    mean = {r.n: r.near for r in df.groupBy("n").agg(F.sqrt(F.avg(near * near)).alias("near")).collect()}
    assert all(abs(m - 0.5**0.5) < 0.03 for m in mean.values())
    assert max(mean.values()) - min(mean.values()) < 0.03


def test_lines_of_long_texts(spark):
    """A text of very many lines takes time by its length, not by the square of it."""
    df = spark.createDataFrame([(0, "\n".join(["a line of forty characters or thereabouts"] * 60000)), (1, ""), (2, "\n"), (3, None)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", tokens.paragraphs(F.col("t")).alias("s")).collect()}
    assert len(got[0]) == 60000 and got[0][0] == got[0][-1] + 1
    assert (got[1], got[2], got[3]) == ([0], [1, 0], None)


def test_url_pieces(spark):
    urls = [("HTTPS://u:p@A.b.Example.com.:443//x//y/?q=/z#f",), ("http://[::1]:80/a",), ("nothing",), (None,), ("http:///x",), ("ftp://h",)]
    df = spark.createDataFrame(urls, "u string")
    got = [tuple(r) for r in df.select(url_lists.url_host(F.col("u")), url_lists.url_segments(F.col("u"))).collect()]
    assert got == [("a.b.example.com", ["x", "y"]), ("[::1]", ["a"]), (None, []), (None, None), (None, ["x"]), ("h", [])]


def test_url_lists_as_of(spark):
    rng = random.Random(3)
    entries = []
    for name, effect, kind, pattern in [
        ("a", "block", "domain", "example.com"), ("b", "allow", "host", "www.example.com"), ("a", "block", "prefix", "www.example.com/x"),
        ("c", "block", "domain", "com"), ("c", "allow", "prefix", "www.example.com/x/y"), ("d", "block", "host", "example.com"),
    ]:
        entries += [(name, effect, kind, pattern, rng.choice(("add", "remove")), rng.randrange(500)) for _ in range(12)]
    entries += [entries[0], ("z", "block", "domain", None, "add", 5), ("z", "block", "odd", "com", "add", 5), ("z", "block", "domain", "com", "add", None)]
    urls = ["http://www.example.com/x/y/z", "http://example.com", "http://www.example.com/xx", "http://a.net/x", "http://deep.www.example.com/x/y", None]
    captures = [(i, urls[i % 6], rng.randrange(500)) for i in range(200)] + [(7, urls[1], 40), (7, urls[1], 40), (None, urls[1], 40), (8, urls[1], None)]
    closeness = {"domain": 1, "host": 2, "prefix": 3}

    def holds(entry, at):
        events = {}
        for *e, action, t in entries:
            if tuple(e) == entry and t is not None and t <= at:
                events[t] = events.get(t, True) and action == "add"
        return bool(events) and events[max(events)]

    def verdict(url, at):
        host, *path = url.removeprefix("http://").split("/")
        rules = []
        for entry in {tuple(e[:4]) for e in entries if e[3] is not None and e[2] in closeness}:
            _, effect, kind, pattern = entry
            fits = {"domain": host == pattern or host.endswith("." + pattern), "host": host == pattern, "prefix": ("/".join([host, *path]) + "/").startswith(pattern + "/")}[kind]
            if fits and holds(entry, at):
                rules.append((closeness[kind], len(pattern), effect == "allow", pattern, entry[0]))
        best = max(rules, default=None)
        return (False, None, None, 0) if best is None else (not best[2], best[3], best[4], len(rules))

    df = spark.createDataFrame(captures, "id long, url string, at long").repartition(3)
    lists = spark.createDataFrame(entries, "list string, effect string, kind string, pattern string, action string, at long")
    got = sorted((str((r.id, r.url, r.at)), (r.blocked, r.pattern, r.list, r.active)) for r in url_lists.judge(df, lists, period=90).collect())
    want = sorted((str(c), verdict(c[1], c[2]) if c[1] and c[2] is not None else (False, None, None, 0)) for c in captures)
    assert got == want
