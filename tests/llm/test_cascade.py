"""The rule cascade against plain counts, in every order of its rules."""

import os
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from foliary.llm import cascade

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeat)}


def slow_verdicts(c):
    """Whom each rule rejects, in the order of ``RULES``."""
    n = c["n_words"]
    return [n < 50, 100 * c["n_repeat_words"] > 50 * n, c["word_chars"] < 3 * n or c["word_chars"] > 10 * n,
            10 * c["n_symbols"] > n, 10 * c["n_dup_lines"] > 3 * c["n_lines"]]


BODY = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    None, "", " \t\n", "a", "a b c", "a b c a b c", "x " * 60, BODY, BODY + " # * $", BODY.replace(" ", " | "),
    "\n".join([BODY] + ["same line"] * 3), "same line here\n" * 3 + BODY, " ".join("ab" for _ in range(70)) + BODY,
    BODY + "\r\n" + BODY, "é中\U0001f600 " * 30 + BODY, BODY.replace(" ", " "), "aa bb aa bb aa " + BODY, BODY + " w w w",
    " ".join(f"w{i % 45}" for i in range(400)), " ".join(f"longer{i}" for i in range(200_000)) + " longer1 longer2 longer3",
]


def docs_of(spark):
    rows = [(i if i % 4 else None, t, "k", 0) for i, t in enumerate(TEXTS)] + [(7, BODY, "k", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, N_Words int")


def test_every_order_gives_the_same_verdict(spark):
    docs = docs_of(spark).drop("kept", "N_Words").cache()
    counts = {t: slow_counts(t) for t in TEXTS}
    verdicts = {t: slow_verdicts(c) for t, c in counts.items()}
    assert {k for v in verdicts.values() for k in [tuple(v)]} >= {(False,) * 5} and all(any(v[i] for v in verdicts.values()) for i in range(5))
    orders = list(permutations(range(5)))
    for order in (orders[0], orders[-1], orders[47]):
        judged = cascade.judge(docs, tuple(cascade.RULES[i] for i in order)).collect()
        assert len(judged) == len(TEXTS) + 1
        for r in judged:
            fails = [i for i in order if verdicts[r.text][i]]
            assert r.kept == (not fails) and r.rejected_by == (cascade.RULES[fails[0]].name if fails else None)
            assert r.n_checked == (order.index(fails[0]) + 1 if fails else 5)
            looked = {c for i in order[:r.n_checked] for c in cascade.RULES[i].counts}
            assert {c: r[c] for c in counts[r.text]} == {c: n if c in looked else None for c, n in counts[r.text].items()}


def test_whole_counts_clashing_names_and_empty_tables(spark):
    docs = docs_of(spark)
    judged = cascade.judge(docs, whole=True)
    assert [c for c in judged.columns if c not in cascade.COUNTS] == ["doc_id", "text", "kept", "rejected_by", "n_checked"]
    for r in judged.collect():
        assert {c: r[c] for c in cascade.COUNTS} == slow_counts(r.text)
    assert cascade.judge(docs, keep=["doc_id"]).columns[0] == "doc_id" and "text" not in cascade.judge(docs, keep=["doc_id"]).columns
    kept = cascade.keep_good(docs, sample_rows=5)
    assert kept.columns == docs.columns and sorted(r.text for r in kept.collect()) == sorted(
        t for t in [*TEXTS, BODY] if not any(slow_verdicts(slow_counts(t))))
    empty = docs.where("false")
    assert cascade.measure(empty).rules == cascade.RULES and cascade.judge(empty).count() == 0


def test_order_by_rejections_per_second():
    rules = tuple(cascade.Rule(n, (c,), lambda x: x > 0) for n, c in (("dear", "d"), ("cheap", "c"), ("same", "c"), ("idle", "i")))
    seconds = {"d": 10.0, "c": 1.0, "i": 0.1}
    # "same" rejects only what "cheap" rejects, and its count is made by then: nothing left to gain, nothing to pay
    patterns = {0b0000: 50, 0b0001: 30, 0b0110: 10, 0b0010: 5}
    assert [r.name for r in cascade.in_order(rules, seconds, patterns)] == ["cheap", "dear", "same", "idle"]
    assert [r.name for r in cascade.in_order(rules, seconds, {0b0001: 90, 0b0010: 1})][0] == "dear"
    assert cascade.in_order((), {}, {}) == ()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_query_equals_its_sql(spark):
    import duckdb

    from check import rows_of
    from foliary.llm.queries import ORACLES, QUERIES

    duck = duckdb.connect()
    duck.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got, want = QUERIES["op11_cascade"](spark, "/root/testdata/sf0.001").toPandas(), duck.execute(ORACLES["op11_cascade"]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want) and len(got) > 0
