"""The operators against brute force, libraries and round trips, on small and odd inputs."""

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from foliary.llm import (
    chat, crossparse, dealing, pieces, pigeonring, quality, redirects, termprint, tiling, wavelet, words)
from foliary.llm.components import components
from foliary.llm.frames import new_folder
from foliary.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (5, "the cat sat on the mat and the dog ran", "en", "a", 1), (3, None, "en", None, None), (9, "", None, "b", 0),
    (5, "the cat sat on the mat and the dog ran", "en", "a", 1), (None, "no id here, none at all", "en", "a", 2),
    (1, "\u00fc\u4e2d  \n\t x<|endoftext|>y " * 3, "de", "c", 4), (12, "word " * 5000, "fr", "c", 5),
]


def frame(spark, rows=ODD, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- 1: token shards ---------------------------------------------------------------------------

def test_token_columns_equal_the_library():
    from tokenizers import Tokenizer

    model = tokenizer_file("byte_bpe_50k.json")
    coder, whole = wavelet.byte_pair_ids(model), Tokenizer.from_buffer(model)
    assert coder.breaks
    rng = np.random.default_rng(5)
    signs = ["a", "B", "é", "ß", "1", "²", "_", ".", ",", "!", "?", ";", ":", "'s", "\n", "\n", " ", " ", "\t",
             "<|endoftext|>", "日", chr(0x301), "-", "\r\n", chr(0xA0), chr(0x85), "the"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 14))) for _ in range(4000)] + ["Known. known.\nKnown"] * 3
    for coder.known[1].most in (10**6, 5):  # the second time, words are forgotten all the time
        for lo in range(0, len(texts), 500):
            part = texts[lo:lo + 500]
            want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(part, add_special_tokens=False)]
            assert coder.values(pa.array(part)) == want
    assert coder.values(pa.array([None, "", None], pa.string())) == [b"", b"", b""]
    assert coder.values(pa.array([], pa.string())) == []


def test_letters_and_marks_equal_the_library():
    from tokenizers import Tokenizer

    model = tokenizer_file("byte_bpe_50k.json")
    coder, whole = wavelet.byte_pair_ids(model), Tokenizer.from_buffer(model)
    rng = np.random.default_rng(6)
    ends = np.array(sorted(words.ENDS) + list("abcdefghij" * 2000))
    stems = ["".join(rng.choice(ends, rng.integers(1, 12))) for _ in range(1500)]
    marks = ["", "", "", *words.MARKS, "###", "$$$", "&&&.", "***", ".%%%", "'s.", "_", "\n", ".\nAnd", "***\nIn,", "<|endoftext|>."]
    texts = [" ".join(s + m for s, m in zip(rng.choice(stems, 9), rng.choice(marks, 9), strict=True)) for _ in range(500)]
    texts += [" ".join(stems), wavelet.LETTERS, "x " + wavelet.LETTERS * 3, "y" * words.LONGEST_CACHED + " " + "y" * 400 + "."]
    texts += ["\U0001E030. \U0001E030.\n", "#a ## #. .# ...", "a\t. b\t\t, ", ""]
    for most in (10**6, 40):
        coder.known[0].most = coder.known[1].most = most
        for lo in range(0, len(texts), 300):
            part = texts[lo:lo + 300]
            want = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(part, add_special_tokens=False)]
            assert coder.values(pa.array(part)) == want
            assert coder.values(pa.array(["cut off", *part])[1:]) == want
    assert len(coder.known[1].words) == len(coder.known[1].values) == len(coder.known[1].asked) < 6000


def test_a_stem_is_encoded_once_whatever_marks_follow():
    coder, asked = wavelet.byte_pair_ids(tokenizer_file("byte_bpe_50k.json")), []
    heads, tails = coder.encode
    coder.encode = (heads, lambda ws: (asked.extend(ws), tails(ws))[1])
    first = coder.values(pa.array(["x blorft, blorft. blorft### blorft", "y blorft*** \u00dcnorf&&&"]))
    assert sorted(asked) == ["blorft", "x", "y", "\u00dcnorf"]
    assert coder.values(pa.array(["x blorft, blorft. blorft### blorft", "y \u00dcnorf%%%"]))[0] == first[0]
    assert len(asked) == 4
    wide = pa.array(["x blorft, blorft. blorft### blorft"], pa.large_string())
    assert coder.values(wide) == first[:1]


def test_wavelet_matrix():
    rng = random.Random(1)
    for n in (0, 1, 7, 8, 511, 512, 513, 2000):
        ids = np.array([rng.choice([0, 3, 77, 50256, rng.randrange(60000)]) for _ in range(n)], np.int64)
        m = wavelet.WaveletMatrix.build(ids)
        assert m.ids().tolist() == ids.tolist()
        for i in range(0, n, 37):
            assert m.access(i) == ids[i]
        for symbol in (0, 3, 77, 50256, 1):
            where = np.flatnonzero(ids == symbol).tolist()
            assert m.occurrences(symbol) == where and m.count(symbol) == len(where)
            assert m.rank(symbol, n // 2) == sum(i < n // 2 for i in where)
        with pytest.raises(IndexError):
            m.access(n)
        with pytest.raises(IndexError):
            m.select(77, n + 1)


def test_token_shards_hold_the_librarys_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = new_folder(spark, "test")
    wavelet.write_shards(frame(spark), tokenizer_file("byte_bpe_50k.json"), path, shard_tokens=50)
    got = wavelet.read_documents(spark, path).orderBy("start").collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    at, count = 0, 0
    for r, row in zip(got, order):
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at, count = at + len(ids), count + ids.count(262)
    assert wavelet.token_counts(spark, path, [262]).agg(F.sum("n")).first()[0] == count
    assert wavelet.shard_matrices(spark, path).count() > 1
    empty = wavelet.encode_and_read(frame(spark, []), tokenizer_file("byte_bpe_50k.json"))
    assert empty.count() == 0


# --- 2: dealing --------------------------------------------------------------------------------

def test_matrix_has_the_margins_of_both_sides():
    counts, sizes = np.array([5, 0, 17, 8]), dealing.near_equal(30, 7)
    rows = np.array([dealing.matrix_row(counts, sizes, i, 3) for i in range(4)])
    assert rows.sum(axis=1).tolist() == counts.tolist() and rows.sum(axis=0).tolist() == sizes.tolist()
    assert (np.array([dealing.matrix_row(counts, sizes, i, 4) for i in range(4)]) != rows).any()


def test_large_urns():
    rng = np.random.default_rng(1)
    found = [dealing.hypergeometric(rng, 10 ** 10, 3 * 10 ** 10, 10 ** 6) for _ in range(200)]
    assert abs(np.mean(found) - 250_000) < 5 * 433 / 200 ** 0.5 and 300 < np.std(found) < 600
    assert dealing.hypergeometric(rng, 10 ** 10, 0, 5) == 5
    spread = dealing.multivariate(rng, np.array([10 ** 10, 0, 2 * 10 ** 10]), 9)
    assert spread.sum() == 9 and spread[1] == 0


@pytest.mark.parametrize("n,shards,block", [(0, 4, 8), (3, 5, 8), (101, 4, 8), (200, 3, 1000)])
def test_shards_are_exact(spark, n, shards, block):
    docs = spark.range(n, numPartitions=5).selectExpr("id AS doc_id", "'same' AS text", "7 AS shard", "'x' AS slot")
    got = dealing.shuffle_into_shards(docs, shards, seed=1, block_rows=block).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    sizes = [sum(r.shard == s for r in got) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def test_shuffle_is_uniform(spark):
    docs = spark.range(40, numPartitions=4).selectExpr("id AS doc_id")
    first = [next(r.shard for r in dealing.shuffle_into_shards(docs, 4, seed=s, settled=True).collect() if r.doc_id == 0) for s in range(24)]
    assert set(first) == {0, 1, 2, 3}


# --- 3: quality --------------------------------------------------------------------------------

def test_quality_learns_and_rejects(spark):
    rng = random.Random(2)
    words = ["stone", "river", "green", "table", "window", "paper", "light", "north"]
    def prose(): return " ".join(rng.choice(words) for _ in range(30))
    docs, labels = [], []
    for i in range(240):
        good = i % 3 > 0
        docs.append((i, prose() if good else prose().upper().replace(" ", "!! "), "en", "s", 1))
        labels.append((i, int(good), 0))
    docs += [(None, None, None, None, None), (900, "", "en", "s", 0)]
    table = frame(spark, docs).withColumn("Score", F.lit("mine"))
    marks = spark.createDataFrame([*labels, (1, None, None), (None, 1, 0), (7777, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.scored(table, marks).collect()
    assert len(got) == len(docs)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert sum(r.predicted == truth.get(r.doc_id, r.predicted) for r in held) >= 0.95 * len(held)
    kept = quality.keep_good(table, marks)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted}
    assert quality.scored(frame(spark, []), marks).count() == 0
    assert {r.predicted for r in quality.scored(table, marks.where("false")).collect()} == {1}


def test_features_do_not_cross_documents():
    s = quality.Settings()
    texts = ["ab cd", "", "x" * 300, "ab", " \n "]
    together, starts = quality.features(texts, s)
    for i, t in enumerate(texts):
        alone, _ = quality.features([t], s)
        assert sorted(together[starts[i]:starts[i + 1]].tolist()) == sorted(alone.tolist())


# --- 4: near copies ----------------------------------------------------------------------------

def slow_fingerprint(text):
    import xxhash

    words = []
    for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
            {c: " " for c in range(9, 14)}).split(" "):
        if w:
            words.append(w)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ["", None, "One", "A b  c\x0bd", "a\u00a0b c d e \u1e9e Z", "x y " * 200, " ".join(map(str, range(70000)))]:
        got = pigeonring.fingerprint(text)
        if text is None or len(text) < 10_000:
            assert got == slow_fingerprint(text)
    big = " ".join(map(str, range(70000)))
    assert pigeonring.fingerprint(big) == pigeonring.fingerprint(big.replace(" ", "\n"))


def test_links_are_all_pairs_within_the_radius(spark):
    rng = random.Random(3)
    values = set()
    for _ in range(60):
        centre = rng.getrandbits(64)
        for _ in range(6):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 7))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "simhash long")
    for radius in (0, 1, 3, 4):
        got = {tuple(r) for r in pigeonring.links(prints, radius).collect()}
        want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= radius}
        assert got == want


@pytest.mark.parametrize("radius", [0, 1, 4])
def test_groups_of_a_crowd(spark, radius):
    """Every link between groups counts, although a crowd does not meet all of its own."""
    rng = random.Random(radius)
    def around(centre, n, flips):
        return [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(flips + 1))) for _ in range(n)]
    crowd = rng.getrandbits(64)
    values = {crowd, *around(crowd, 300, 3), *around(crowd, 150, 8), *around(crowd, 50, 12), 0, 1, 1 << 63}
    for _ in range(40):
        values.update(around(rng.getrandbits(64), 6, 7))
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    want = {v: v for v in values}
    while True:
        after = {a: min(want[b] for b in values if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= radius) for a in values}
        if after == want:
            break
        want = after
    got = dict(map(tuple, pigeonring.groups(spark.createDataFrame([(v,) for v in values], "p long"), radius).collect()))
    assert got == {v: g for v, g in want.items() if v in got}
    assert set(got) == {v for v in values if sum(w == want[v] for w in want.values()) > 1}
    assert pigeonring.groups(spark.createDataFrame([], "p long"), radius).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 2000 + i) for i in range(100)] + [(None, 3), (4, 4)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {}
    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [*ODD, (20, base, "en", "s", 1), (21, base + " tail", "en", "s", 1), (2, base.replace("w7 ", "w8 "), "en", "s", 1),
            (22, " \n", "en", "s", 1)]
    docs = frame(spark, rows).withColumn("simhash", F.lit("clash"))
    prints = [slow_fingerprint(r[1]) for r in rows]
    ids = list(range(len(rows)))
    for _ in rows:
        ids = [min(ids[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 4) for i in range(len(rows))]
    def smallest(group): return min((r[0] for r, g in zip(rows, ids) if g == group and r[0] is not None), default=None)
    got = pigeonring.near_duplicates(docs).select("doc_id", "simhash", "component_id").collect()
    assert sorted(((r[0], r[1] % 2 ** 64, r[2]) for r in got), key=repr) == sorted(
        ((r[0], p, smallest(g)) for r, p, g in zip(rows, prints, ids)), key=repr)
    kept = pigeonring.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(ids))
    assert {r.doc_id for r in kept.collect()} == {smallest(g) for g in ids}
    assert pigeonring.keep_one(docs.where("false")).count() == 0


# --- 5: language -------------------------------------------------------------------------------

def slow_phrases(text, known):
    at = count = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        at, count = max(at + 1, end - 1), count + 1
    return count


@pytest.mark.parametrize("places", [0, 1_000_000])
def test_phrases_are_longest_matches(places):
    rng = random.Random(5)
    training = {"x": "".join(rng.choice("abc ") for _ in range(200)), "y": "".join(rng.choice("abd ") for _ in range(150))}
    parser = crossparse.Parser(training, crossparse.Settings(window=64, table_places=places))
    for _ in range(200):
        row = parser.symbols("".join(rng.choice("abcdz ,") for _ in range(rng.randrange(1, 150))))
        windows = [row[i:i + 64] for i in range(0, len(row), 64)]
        want = [sum(slow_phrases(bytes(w), bytes(parser.symbols(training[n]))) for w in windows) for n in "xy"]
        assert parser.phrases([row])[0].tolist() == want


def test_languages(spark):
    rng = random.Random(6)
    kinds = {"en": ["the ", "ing ", "th", "and "], "fr": ["eau ", "\u00e9", "les ", "ou"], "de": ["sch", "\u00fcber ", "ung ", "en"]}
    rows = [(i, "".join(rng.choice(kinds[k]) for _ in range(60)), k, "s", 1) for i in range(150) for k in [list(kinds)[i % 3]]]
    odd = [(500, None, "en", None, None), (501, "", "en", None, None), (502, "123 ...!", "de", None, None), (None, "the and the", None, None, 1)]
    docs = frame(spark, rows + odd).withColumn("SCORE", F.lit(1)).withColumn("lang_pred", F.lit("x"))
    got = {r.doc_id: r for r in crossparse.predicted(docs).collect()}
    assert sum(got[r[0]].lang_pred == r[2] for r in rows) >= 149
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (500, 501, 502))
    assert got[None].lang_pred == "en" and not got[None].held_out
    kept = crossparse.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) + 1
    assert crossparse.predicted(docs.where("false")).count() == 0
    assert {r.lang_pred for r in crossparse.predicted(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# --- 6: decontamination ------------------------------------------------------------------------

def slow_tiles(a, b, least):
    least, free_a, free_b, out = min(least, len(a)), [True] * len(a), [True] * len(b), []
    while least:
        best = None
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n >= least and (best is None or (-n, i, j) < best):
                    best = (-n, i, j)
        if best is None:
            break
        n, i, j = -best[0], best[1], best[2]
        out.append((i, j, n))
        free_a[i:i + n], free_b[j:j + n] = [False] * n, [False] * n
    return out


def test_tiles():
    rng = random.Random(7)
    for _ in range(400):
        letters = rng.choice(["a", "ab", "abcd"])
        a = [rng.choice(letters).encode() for _ in range(rng.randrange(14))]
        b = [rng.choice(letters).encode() for _ in range(rng.randrange(25))]
        least = rng.randrange(1, 6)
        assert tiling.tiles(a, b, least) == slow_tiles(a, b, least)


def test_contamination(spark):
    rng = random.Random(8)
    def words(n): return [f"v{rng.randrange(400)}" for _ in range(n)]
    items = {1: words(30), 2: words(50), 3: words(3), 4: words(20)}
    rows = [(i, " ".join(words(120)), "en", "s", 1) for i in range(30)]
    def around(middle): return " ".join(words(40)) + " " + middle + " " + " ".join(words(40))
    turned = items[2][25:] + ["between"] + items[2][:25]
    rows += [(100, around(" ".join(items[1]).upper()), "en", "s", 1), (101, around(", ".join(turned)), "en", "s", 1),
             (102, around(" ".join(items[4][:10])), "en", "s", 1), (103, " ".join(items[3]), "en", "s", 1),
             (103, " ".join(items[3]), "en", "s", 1), (None, " ".join(items[1]), "en", "s", 1), (104, None, None, None, None)]
    bench = spark.createDataFrame([*((i, " ".join(w)) for i, w in items.items()), (5, None), (6, "...")], "item_id long, text string")
    docs = frame(spark, rows).withColumn("seeds", F.lit(1)).withColumn("item", F.lit(1))
    found = tiling.find_items(docs, bench).collect()
    want = []
    for r in rows:
        text = tiling.words_of(r[1])
        for i, w in items.items():
            if sum(n for _, _, n in slow_tiles([x.encode() for x in w], text, 5)) >= 0.8 * len(w):
                want.append((r[0], i))
    assert sorted(((r.id, r.item) for r in found), key=repr) == sorted(want, key=repr) and (101, 2) in want
    clean = tiling.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [*range(30), 102, 104]
    assert tiling.contaminated(docs, bench.where("false")).count() == 0
    assert tiling.contaminated(docs.where("false"), bench).count() == 0


def test_edges_are_few_whatever_the_alphabet():
    rng = random.Random(13)
    training = {}
    for k in range(7):
        letters = [chr(0x4E00 + 3000 * k + i) for i in range(3000)]
        training[f"l{k}"] = " ".join("".join(rng.choices(letters, k=6)) for _ in range(1000))
    parser = crossparse.Parser(training)
    symbols = sum(len(parser.symbols(t)) for t in training.values())
    edges = parser.edges
    used = edges.keys[edges.keys != edges.EMPTY]
    assert len(used) < 3 * symbols and edges.keys.nbytes + edges.to.nbytes + parser.fallback.nbytes < 40_000_000
    assert parser.predict([training["l3"][50:90], training["l6"][:9], "", "?!"])[0] == ["l3", "l6", "und", "und"]


def test_edges_find_what_was_put_in():
    rng = np.random.default_rng(14)
    keys = np.unique(rng.integers(0, 50_000, 9_000))
    to = rng.integers(0, 1 << 20, len(keys))
    asked = rng.integers(0, 50_000, 20_000)
    want = dict(zip(keys.tolist(), to.tolist()))
    assert crossparse.Edges(keys, to).find(asked).tolist() == [want.get(k, -1) for k in asked.tolist()]
    assert crossparse.Edges(keys[:0], to[:0]).find(asked).tolist() == [-1] * len(asked)


def test_training_sample_is_cut_before_the_driver(spark):
    s = crossparse.Settings(languages=2, language_symbols=3_000)
    rows = [(i, "alpha beta " * 100, "aa", "s", 1) for i in range(60)] + [(100 + i, "gamma " * 50, "bb", "s", 1) for i in range(30)]
    rows += [(500, f"many {i} rows of one id " * 20, "bb", "s", 1) for i in range(200)] + [(900 + i, "rare", "cc", "s", 1) for i in range(9)]
    found = crossparse.training_texts(frame(spark, rows), s)
    assert set(found) == {"aa", "bb"} and all(len(t) <= 3_000 for t in found.values())
    assert found["bb"].count("rows of one id") in (0, 20)
    again = crossparse.training_texts(frame(spark, rows[::-1]), s)
    assert again == found


# --- 7: urls -----------------------------------------------------------------------------------

def test_urls(spark):
    rules = redirects.rule_table(spark, [("block", "bad.com/x"), ("allow", "bad.com/x/ok"), ("block", "evil.net/"), ("allow", "fine.org/")])
    link = '<link href="{}" rel="canonical">'.format
    rows = [
        (1, "http://Sub.BAD.com/x1?y", None), (2, "https://bad.com/x/ok/1#z", ""), (3, "http://notbad.com/x", None),
        (4, "http://a.io/1", link("http://a.io/2")), (5, "http://a.io/2", '<meta http-equiv="refresh" content="0; url=//evil.net/q">'),
        (6, "http://a.io/3", link("/1?utm_source=f")), (7, "http://fine.org/p", link("http://a.io/1")), (8, None, link("http://evil.net/")),
        (9, "no scheme", "x"), (9, "no scheme", "x"), (10, "http://b.io/1", "<!-- " + link("http://evil.net/") + " -->"),
        (11, "http://b.io/2", link("http://b.io/1")), (12, "://Host", None), (13, "http://c.io/s", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("clash"))
    moved = spark.createDataFrame([("http://c.io/s", "http://evil.net/t")], "source string, target string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in redirects.judge_pages(pages, rules, moved).collect()), key=repr)
    assert got == sorted([
        (1, "sub.bad.com", "/x1", "bad.com/x", "block"), (2, "bad.com", "/x/ok/1", "bad.com/x/ok", "allow"),
        (3, "notbad.com", "/x", None, "allow"), (4, "a.io", "/1", None, "block"), (5, "a.io", "/2", None, "block"),
        (6, "a.io", "/3", None, "block"), (7, "fine.org", "/p", "fine.org/", "allow"), (8, "", "", None, "allow"),
        (9, "", "", None, "allow"), (9, "", "", None, "allow"), (10, "b.io", "/1", None, "allow"), (11, "b.io", "/2", None, "allow"),
        (12, "host", "", None, "allow"), (13, "c.io", "/s", None, "block")], key=repr)
    assert redirects.judge_pages(pages.where("false"), rules).count() == 0
    own = pages.withColumns({n: F.lit(f"own {n}") for n in ("ruled", "blocked", "__key", "key", "root", "node", "__c0", "HOST")})
    more = redirects.judge_pages(own, rules, moved)
    assert more.columns == [c for c in own.columns if c not in ("verdict", "HOST")] + ["host", "path", "rule", "verdict", "alias_of"]
    again = more.collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in again), key=repr) == got
    assert {(r.ruled, r.blocked, r["__key"], r["__c0"]) for r in again} == {("own ruled", "own blocked", "own __key", "own __c0")}


# --- 8: fingerprints ---------------------------------------------------------------------------

def slow_print(spark, text):
    words = [w for w in (text or "").lower().split() if w]
    hashes = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()] if words else []
    weights = [min(len(w), 8) for w in words]
    value = sum(1 << b for b in range(64) if 2 * sum(n for h, n in zip(hashes, weights) if h >> b & 1) > sum(weights))
    return value - (1 << 64) if value >> 63 else value


def test_edits(spark):
    rng = random.Random(9)
    ids = [rng.randrange(-50, 10 ** 12) for _ in range(40)] + [5]
    rows = [(i, " ".join(rng.choice(["r\u00e9d", "Blue", "x", "\U0001F600 green"]) for _ in range(rng.randrange(9))), "en", "s", 1) for i in ids]
    rows += [(5, None, "en", "s", 1), (None, "last of all", "en", "s", 1)]
    rows = list({r[0]: r for r in rows}.values())
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {r.doc_id: r for r in termprint.compare_edits(frame(spark, rows).withColumn("at", F.lit(1))).collect()}
    assert len(got) == len(rows)
    for r, following in zip(order, [*order[1:], order[0]]):
        text, after = r[1] or "", following[1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got[r[0]].n_chars == len(text)
        assert got[r[0]].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (slow_print(spark, t) for t in (text, edited, after)) if (r[0] or 0) % 5 == 0 else (None,) * 3
        if a is not None:
            assert (got[r[0]].simhash, got[r[0]].edited_simhash) == (a, b)
            assert got[r[0]].near_next == 1 - ((a ^ c) & (2 ** 64 - 1)).bit_count() / 64
    for i, r in got.items():
        near = {o.simhash for o in got.values() if 0 < ((o.simhash ^ r.simhash) & (2 ** 64 - 1)).bit_count() <= 3}
        assert r.n_within == (len(near) if i is not None and i % 20 == 0 else None)
    one = termprint.compare_edits(frame(spark, rows[:1])).first()
    assert one.near_next == 1.0
    assert termprint.compare_edits(frame(spark, [])).count() == 0


def test_order_across_buckets(spark, monkeypatch):
    monkeypatch.setattr(termprint, "BUCKET_ROWS", 3)
    monkeypatch.setattr(termprint, "QUANTILES", 4)
    ids = [i * i for i in range(60)]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = dict((r.id, r.next_text) for r in termprint.in_order(docs).collect())
    assert got == {i: f"t{ids[k - 1]}" for k, i in enumerate(ids)}


def test_one_id_on_half_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(termprint, "QUANTILES", 8)
    rows = [(i, f"t{i}") for i in range(0, 120, 2)] + [(61, f"same {i}") for i in range(60)]
    placed = termprint.in_order(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(placed) == 120
    buckets = {(r.part, r.sub) for r in placed if r.id == 61}
    assert len(buckets) > 40 and not buckets & {(r.part, r.sub) for r in placed if r.id != 61}
    following = {r.text: r.next_text for r in placed}
    at, seen = "t118", []
    while at not in seen:
        seen.append(at)
        at = following[at]
    ids = [61 if t.startswith("same") else int(t[1:]) for t in seen]
    assert at == "t118" and len(seen) == 120 and ids == sorted(ids, reverse=True)


def test_search_counts_near_prints(spark):
    words = [f"word{i:03d}" for i in range(400)]
    rng = random.Random(4)
    rows = []
    for i in range(60):
        own = list(words) if i % 3 else rng.sample(words, 30)
        for _ in range(i % 4):
            own[rng.randrange(len(own))] = f"other{rng.randrange(9)}"
        rows.append((i, " ".join(own), "en", "s", 1))
    got = termprint.compare_edits(frame(spark, rows)).collect()
    for r in got:
        near = {o.simhash for o in got if 0 < ((o.simhash ^ r.simhash) & (2 ** 64 - 1)).bit_count() <= 3}
        assert r.n_within == (None if r.doc_id % 20 else len(near))
    assert any(r.n_within for r in got)


def test_search_within_radius(spark):
    rng = random.Random(10)
    values = []
    for _ in range(40):
        centre = rng.getrandbits(64)
        values += [centre ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (0, 1, 2, 3, 4)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    stored = spark.createDataFrame([(v,) for v in [*signed, signed[0], None]], "f long")
    asked = spark.createDataFrame([(v,) for v in signed[::3]], "f long")
    for radius in (0, 3):
        got = {tuple(r) for r in termprint.within_radius(stored, asked, radius).collect()}
        apart = lambda a, b: ((a ^ b) & (2 ** 64 - 1)).bit_count()
        assert got == {(a, b, apart(a, b)) for a in signed[::3] for b in signed if apart(a, b) <= radius}
    with pytest.raises(ValueError):
        termprint.within_radius(stored, asked, 3, blocks=3)


# --- 9: pieces ---------------------------------------------------------------------------------

def models():
    from sentencepiece import SentencePieceNormalizer, sentencepiece_model_pb2 as pb

    raw = tokenizer_file("piece_bpe_32k.model")
    spec = pb.ModelProto.FromString(SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()).normalizer_spec
    out = [raw]
    for extra in (True, False):
        model = pb.ModelProto.FromString(raw)
        model.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
        model.normalizer_spec.remove_extra_whitespaces = extra
        out.append(model.SerializeToString())
    return out


@pytest.mark.parametrize("which", [0, 1, 2])
def test_pieces_and_spans_are_the_librarys(which):
    encoder = pieces.Encoder(models()[which])
    rng = random.Random(11)
    letters = list(" a\u00e9theU\u0308\u65e5\n\t\u2581,.\U0001F600\u3000\ufb01\u2460\u212b\u00bd\x00") + [" "] * 5
    texts = ["", " ", "  ", "\u2581", "\u2603\u2603 x"] + ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(500)]
    for text, (ids, sizes, decimals) in zip(texts, encoder.encode(texts)):
        want = encoder.library.encode(text, return_type="proto").pieces
        assert np.frombuffer(ids, "<u4").tolist() == [p.id for p in want]
        assert decimals.decode() == " ".join(str(p.id) for p in want)
        assert np.cumsum(np.frombuffer(sizes, "<u4")).tolist() == [p.end for p in want]
        assert encoder.spans(text, [p.id for p in want]).tolist() == [[p.begin, p.end] for p in want]


def test_encoded_documents(spark):
    encoder = pieces.Encoder(tokenizer_file("piece_bpe_32k.model"))
    got = pieces.encode_documents(frame(spark).withColumn("IDS", F.lit(0)), tokenizer_file("piece_bpe_32k.model")).collect()
    assert len(got) == len(ODD)
    for r in got:
        ids = encoder.library.encode(r.text or "", add_eos=True)
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded == encoder.library.decode(ids) and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
        assert r.n_bytes == len((r.text or "").encode())
    assert pieces.encode_documents(frame(spark, []), tokenizer_file("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize("which", [0, 1, 2])
def test_spans_of_documents_through_the_character_map(spark, which):
    model = models()[which]
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_proto=model)
    texts = ["\uff21\uff22c  \u2460 \ufb01ne", "plain words  apart", " a\u0301 \u00bd\t x ", "\U0001F600 \u4e2d\u6587 z", "", None, "\u3000 lead"] + [
        " ".join(random.Random(i).choice(["fine", "\ufb01ne", "\u338f", "na\u00efve", "", "\u00a0"]) for _ in range(i)) for i in range(30)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in pieces.encode_documents(rows, model).collect():
        want = library.encode(r.text or "", return_type="proto").pieces
        assert r.ids == [*(p.id for p in want), library.eos_id()]
        ends = [p.end for p in want]
        assert r.span_ends == ends and r.spans_crc32 == zlib.crc32(np.array(ends, "<u4").tobytes())


# --- 10: chat ----------------------------------------------------------------------------------

def test_chat_round_trip(spark):
    texts = ["a\\b<c", "</turn>\n<turn:x>", "\\l\\b\\g", "", None, "\u00fc\U0001F600", "<image:1>\\"]
    rows = [(c, t, role, texts[(c + t) % 7]) for c in range(5) for t, role in enumerate(["system", "user", "assistant", "us>\\g<er", None, "assistant"])]
    rows += [(9, 0, "user", "same"), (9, 0, "user", "same"), (None, None, "assistant", "lost"), (8, 1, "assistant", "b"), (8, None, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("formatted", F.lit(1))
    made = chat.format_conversations(turns)
    read = made.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"), "formatted", "loss")
    seen = {r.conv_id: r for r in read.collect()}
    assert len(seen) == 8
    for c, r in seen.items():
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(x[2] or "", x[3] or "") for x in own]
        learned = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.learned == learned
        masked = "".join(r.formatted[s["at"]:s["at"] + s["length"]] for s in r.loss)
        assert masked.replace("\\l", "<").replace("\\b", "\\") == learned
    assert chat.digests(chat.format_conversations(turns.where("false"))).count() == 0


def test_chat_parts(spark):
    part = lambda kind, text=None, ref=None, tokens=None: (kind, text, ref, tokens)
    rows = [(1, 0, "user", [part("text", "see <"), part("image", None, "u1"), part("audio", "x", "u2", 7)]),
            (1, 1, "assistant", [part("text", "an"), part("document", None, None, 9), part("strange", "swer"), part(None, None)]),
            (1, 2, "assistant", None), (1, 3, "user", [])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn int, role string, content array<{chat.PART}>")
    r = chat.format_conversations(turns, parts="content", text="role").first()
    assert r.formatted == ("<turn:user>see \\l<image:1><audio:2></turn>\n<turn:assistant>an<document:3>swer</turn>\n"
                           "<turn:assistant></turn>\n<turn:user></turn>\n")
    assert [tuple(a) for a in r.attachments] == [(1, 0, "image", "u1", 256), (2, 0, "audio", "u2", 7), (3, 1, "document", "", 9)]
    assert r.expanded_tokens == 272
    assert "".join(r.formatted[s["at"]:s["at"] + s["length"]] for s in r.loss) == "answer"


# --- queries -----------------------------------------------------------------------------------

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_pipeline_is_its_stages_by_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = quality.learn(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = {i: t for i, t in rows.items() if model.scores([t])[0] >= 0.7 and any(c.isalpha() for c in t)}
    prints = {i: pigeonring.fingerprint(t) for i, t in sorted(kept.items())}
    root = {i: i for i in prints}
    for _ in range(4):
        root = {i: min(root[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 4) for i in prints}
    kept = {i: t for i, t in kept.items() if root[i] == i}
    items = [tiling.words_of(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    def leaks(text):
        words = tiling.words_of(text)
        return any(sum(n for _, _, n in tiling.tiles(w, words)) >= 0.8 * len(w) for w in items)
    want = {i for i, t in kept.items() if not leaks(t)}
    got = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in got.select("doc_id").collect()} == want and got.count() == len(want)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["op7_redirects", "op10_chat"])
def test_queries_with_sql(spark, name):
    import duckdb

    from check import rows_of as plain
    from foliary.llm.queries import ORACLES, QUERIES

    duck = duckdb.connect()
    for table in ("pages", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and plain(got) == plain(want)
