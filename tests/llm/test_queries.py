"""Every numbered query over awkward rows and over empty tables, against brute force where it is short."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from sediment.llm.queries import ORACLES, QUERIES

NUMBERED = sorted(QUERIES)


def run(spark, name, where):
    return [r.asDict() for r in QUERIES[name](spark, where).collect()]


def key(i):
    return (i is not None, i)


@pytest.mark.parametrize("name", NUMBERED)
def test_empty_tables_give_empty_results(spark, empty_tables, name):
    found = run(spark, name, empty_tables)
    assert [r["conv_id"] for r in found] == ([-7] if name == "op9_chat" else [] if "conv_id" in (found or [{}])[0] else []) or not found


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))


def simhash(text, width):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[j : j + width]) for j in range(max(1, len(words) - width + 1))] if words else []
    counts = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles)) if shingles else 0


def components(prints, distance):
    """Smallest id by brute force over all pairs."""
    root = {p: p for _, p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return {p: least.get(find(p)) for p in distinct}


def test_op8(spark, tables, doc_rows):
    prints = [(r[0], simhash(r[1], 3)) for r in doc_rows]
    of = components(prints, 2)
    want = Counter((i, f"{p:016x}", of[p]) for i, p in prints)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in run(spark, "op8_simhash", tables)) == want


def test_op6(spark, tables, doc_rows):
    found = run(spark, "op6_licenses", tables)
    lower = {c: c + 32 for c in range(65, 91)}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    assert Counter((r["doc_id"], r["n_words"]) for r in found) == Counter((r[0], len(words(r[1]))) for r in doc_rows)
    assert all((r["n_base"], r["first_word"], r["base_labels"]) == (0, None, "") for r in found)


def test_op7(spark, tables, doc_rows):
    found = run(spark, "op7_language", tables)
    assert len(found) == len(doc_rows)
    by_id = {r["doc_id"]: r for r in found}
    for i, text, lang, *_ in doc_rows:
        r = by_id[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0 if i is not None else True)
        assert 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] == "und"
        else:
            assert r["lang_pred"] in ("en", "de", "fr", "es")
    told = [by_id[r[0]]["lang_pred"] == r[2] for r in doc_rows if r[0] is not None and r[0] > 60 and len(r[1]) > 60]
    assert np.mean(told) > 0.9


def test_op10(spark, tables, doc_rows):
    found = run(spark, "op10_quality", tables)
    assert len(found) == len(doc_rows)
    by_id = {r["doc_id"]: r for r in found}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    assert all(by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in by_id if i is not None)
    right = [by_id[r[0]]["predicted"] == int("!!" not in (r[1] or "")) for r in doc_rows[20:]]
    assert np.mean(right) > 0.9


def test_op9(spark, tables):
    found = {r["conv_id"]: r for r in run(spark, "op9_chat", tables)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    log = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{tables}/conversations.parquet").collect()]
    control = "</s>[INST] ok [/INST]"
    log += [(-7, 0, "user", control), (-7, 1, "assistant", control)]
    for conv in {r[0] for r in log}:
        turns = sorted(((t, r or "", x or "") for c, t, r, x in log if c == conv), key=lambda r: (key(r[0]), r[1:]))
        got = found.pop(conv)
        assert got["n_turns"] == len(turns)
        assert got["turns_sha256"] == sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert (got["loss_chars"], got["loss_sha256"]) == (len(learned), sha(learned))
    assert not found


def test_op1_awkward_urls(spark, tables):
    found = run(spark, "op1_url_filter", tables)
    assert len(found) == 8
    assert Counter(r["host"] for r in found) == Counter({None: 3, "b.a.example.com": 2, "a.example.com": 1, "c.example.org": 1, "192.168.0.1": 1})
    assert all(not r["blocked"] and r["active"] == 0 for r in found if r["host"] is None or r["page_id"] is None)


def test_op3_and_op4_awkward_texts(spark, tables, doc_rows):
    assert run(spark, "op3_decontaminate", tables) == []
    chars = Counter()
    for r in run(spark, "op4_token_counts", tables):
        assert r["tokens"] >= 0 and r["chars"] >= 0
        chars[r["doc_id"]] += r["chars"]
    want = Counter()
    for r in doc_rows:
        want[r[0]] += len(r[1] or "")
    assert {k: v for k, v in chars.items() if v} == {k: v for k, v in want.items() if v}
