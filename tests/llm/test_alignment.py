"""Alignment of two tokenizers against the libraries and a plain count over all documents."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliary.llm import alignment
from foliary.llm.queries import QUERIES, tokenizer_file

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def slow(texts):
    """Whole texts through the libraries, every pair of tokens compared by its bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_buffer(tokenizer_file(A)), sentencepiece.SentencePieceProcessor(model_proto=tokenizer_file(B))
    a.encode_special_tokens = True
    letters = alignment.byte_letters()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    rows, links_of = [], []
    for text in texts:
        links, row = [], (0, 0, 0, "")
        if text:
            a_ids = a.encode(" " + text, add_special_tokens=False).ids
            b_ids = b.encode(text)
            one = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
            two = [b_bytes(i) for i in b_ids]
            if b"".join(one) == b"".join(two) == (" " + text).encode():
                ends = [np.cumsum([len(x) for x in side]).tolist() for side in (one, two)]
                both = sorted(set(ends[0]) & set(ends[1]))
                groups, lo = [], (0, 0)
                for end in both:
                    hi = (ends[0].index(end) + 1, ends[1].index(end) + 1)
                    groups.append(",".join(map(str, a_ids[lo[0]:hi[0]])) + "|" + ",".join(map(str, b_ids[lo[1]:hi[1]])))
                    for i in range(lo[0], hi[0]):
                        for j in range(lo[1], hi[1]):
                            if max(ends[0][i] - len(one[i]), ends[1][j] - len(two[j])) < min(ends[0][i], ends[1][j]):
                                links.append((a_ids[i], b_ids[j]))
                    lo = hi
                row = (len(a_ids), len(b_ids), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest())
        rows.append(row)
        links_of.append(links)
    count = Counter(p for links in links_of for p in set(links))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    want = [
        (*row[:3], len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), row[3])
        for row, links in zip(rows, links_of)]
    return want, count, Counter(p for links in links_of for p in links)


def test_bitmaps():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 3000, 65536):
        places = np.sort(rng.choice(65536, n, replace=False)) if n < 65536 else np.arange(n)
        data = alignment.pack(places)
        assert alignment.unpack(data).tolist() == places.tolist() and alignment.popcount(data) == n
        other = np.sort(rng.choice(65536, 100, replace=False))
        assert alignment.unpack(alignment.merge([data, alignment.pack(other)])).tolist() == sorted({*places.tolist(), *other.tolist()})
    assert len(alignment.pack(np.arange(65536))) == 8193 and len(alignment.pack(np.array([65535]))) == 3


def some_texts():
    rng = random.Random(4)
    signs = ["a", "B", "é", "ß", "1", ".", ",", "'s", "\n", " ", " ", " ", "\t", "<|endoftext|>", "<s>", "日本", "́",
             "\r\n", "\xa0", "the", "tokenizer", "Straße", "<0x41>", "😀"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(150)]
    texts += [None, "", " ", "  ", "x ", " x", "a▁b", "▁", "a\u0000b", "word " * 3000, "z" * 5000, "same text here", "same text here"]
    return texts


def test_documents_and_pairs_by_brute_force(spark, monkeypatch):
    texts = some_texts()
    want, documents, links = slow(texts)
    assert sum(row[0] for row in want) > 5000 and sum(t is not None and "▁" in t for t in texts) == 2
    rows = [(i if i % 50 else None, t, f"own{i}", i, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, chunk long, place string").repartition(3)
    got, pairs = alignment.align_documents(docs, tokenizer_file(A), tokenizer_file(B))
    assert got.columns == ["doc_id", "text", "chunk", "place", *COLUMNS]
    found = {r.chunk: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    assert found == dict(enumerate(want))
    assert {(r.a, r.b): (r.n_docs, r.n_links) for r in pairs.collect()} == {p: (documents[p], links[p]) for p in links}
    empty, none = alignment.align_documents(docs.where("false"), tokenizer_file(A), tokenizer_file(B), keep=["doc_id"])
    assert empty.columns == ["doc_id", *COLUMNS] and empty.count() == 0 and none.count() == 0


def test_chunks_in_several_parts_are_merged(spark):
    """A chunk's postings may come in parts; the pair's counts are those of all documents."""
    rng = np.random.default_rng(3)
    n_b, docs = 1000, 700
    links = np.concatenate([rng.integers(0, 40, 60) << 16 | d for d in range(docs)])
    parts = [alignment.postings(links[(links & 65535) // 200 == k].copy(), n_b, 7) for k in range(4)]
    rows = spark.createDataFrame([r for p in parts for r in p.to_pylist()], alignment._POSTING)
    found = alignment.index(rows)
    times = Counter(links.tolist())
    want = {p: (sum(k >> 16 == p for k in times), sum(n for k, n in times.items() if k >> 16 == p)) for p in range(40)}
    assert {r.b: (r.n_docs, r.n_links) for r in found.collect()} == want and found.count() == 40


def test_forgetting_parts_changes_nothing():
    texts = some_texts()
    whole, short = (alignment.Aligner(tokenizer_file(A), tokenizer_file(B)) for _ in range(2))
    rows, places, links = whole.documents(texts)
    for lo in range(0, len(texts), 10):
        short.clear()
        again = short.documents(texts[lo:lo + 10])
        here = (places >= lo) & (places < lo + 10)
        assert again[0] == rows[lo:lo + 10]
        assert (again[1] + lo).tolist() == places[here].tolist() and again[2].tolist() == links[here].tolist()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], slow([r.text for r in docs])[0]))
    got = QUERIES["op12_alignment"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(docs)
