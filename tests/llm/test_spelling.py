"""Spelling variants against all pairs and a plain count."""

import os
import random
import re
import zlib
from collections import Counter

import pytest

from foliary.llm import spelling
from foliary.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def slow_near(words):
    """Near words through words with one letter left out: all pairs of one edit share such a form or differ by it."""
    holders = {}
    for w in words:
        for i in range(len(w) + 1):
            holders.setdefault(w[:i] + w[i + 1:], set()).add(w)
    return {w: {x for i in range(len(w) + 1) for x in holders[w[:i] + w[i + 1:]] if one_edit(w, x)} for w in words}


def slow_variants(counts):
    near, forms = slow_near(counts), {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = {}
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (n, len(near[w]), forms[w], counts.get(forms[w]), root)
    return out


def found_by(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def test_scan_equals_all_pairs():
    rng = random.Random(1)
    for t in range(60):
        letters = "ab" if t % 2 else "abcé"
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(120)})
        ends = sorted(w[::-1] for w in words)
        near, shared = slow_near(words), (spelling.common_prefixes(words), spelling.common_prefixes(ends))
        for w in words:
            half = len(w) // 2
            first = {words[p] for p in spelling.near_in(words, shared[0], w)}
            last = {ends[p][::-1] for p in spelling.near_in(ends, shared[1], w[::-1])}
            assert first == {x for x in near[w] if x[:half] == w[:half]} and first | last == near[w]


def test_variants_in_small_blocks_and_crowds(spark, monkeypatch):
    rng = random.Random(2)
    words = {"aaaaa" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 8))) for _ in range(400)}  # one hot prefix
    words |= {"".join(rng.choice("xyzü") for _ in range(rng.randint(5, 8))) for _ in range(400)}
    counts = {w: rng.choice([3, 3, 4, 6, 7, 12, 13, 30, 1000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    want = slow_variants(counts)
    assert max(v[1] for v in want.values()) > 5 and any(v[2] and v[4] != v[2] for v in want.values())
    for block, asking in ((2048, 8192), (16, 10), (10**6, 7)):
        monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
        monkeypatch.setattr(spelling, "ASKING", asking)
        assert found_by(spelling.variants(df)) == want
    assert spelling.variants(df.where("false")).count() == 0


def test_words_of_odd_texts(spark):
    texts = [(5, "Variété Étoile ÉTOILE ×÷ naïve-words words WORDS"), (5, "words words"), (None, "words nothing"), (3, None),
             (4, ""), (6, "x" * 300_000 + " words"), (7, "naïvewords " * 5), (8, "日本words\U0001f600wordsy")]
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in texts], "doc_id long, text string, word string, n int").repartition(2)
    plain = Counter(r.encode().lower().decode() for _, t in texts if t for r in RUN.findall(t))
    got = {r.word: r.n for r in spelling.word_counts(docs, min_count=1).collect()}
    assert got == {w: n for w, n in plain.items() if len(w) >= 5}
    assert spelling.word_counts(docs.where("false")).count() == 0
    assert spelling.typo(5, "abc", every=1) in {"ab", "ac", "bc"}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query(spark):
    counts = Counter()
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        for run in RUN.findall(r.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            counts[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert found_by(QUERIES["op13_spelling"](spark, "/root/testdata/sf0.001")) == slow_variants(counts)
