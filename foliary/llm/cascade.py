"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule looks at counts of a text. What each count costs and whom each rule rejects is measured on a
sample; the rules then run in the order of rejections per second, and a text that one rejects is not counted
any further. The sample decides about the order, and so about time, ``rejected_by`` and ``n_checked``; which
texts are kept does not depend on it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from time import perf_counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliary.functions.once import once
from foliary.llm.frames import column, without, write_and_read

WORD = r"[^\x20\x09-\x0D]"
OTHER_SPACES = "\t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]+"


# --- counts ------------------------------------------------------------------------------------

def _spelled(text: Column, chars: str, by: str) -> Column:
    for c in chars:  # plain replacement: most texts hold one of these or none
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def words(text: Column) -> Column:
    return F.array_remove(F.split(_spelled(text, OTHER_SPACES, " "), " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(_spelled(text, OTHER_SPACES + " ", "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def n_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return once(_lines(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def n_repeat_words(text: Column, window: int = 3) -> Column:
    """Words inside a window of words that is found twice or more, its first place included.

    Windows are compared by 64-bit hashes. Sorted, they tell which are repeated; a few of these are
    looked up, and where there are many, the hashes are sorted with their places.
    """
    def windows(h: Column) -> Column:
        ahead = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, window)]))
        return F.slice(ahead, F.lit(1), F.size(h) - window + 1)

    def places(w: Column, again: Column) -> Column:
        """Places of windows that stand in ``again``."""
        few = F.filter(F.transform(w, lambda h, i: F.when(F.array_contains(again, h), i)), lambda i: i.isNotNull())
        placed = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        many = once(placed, lambda s: F.filter(s, lambda x, i: (
            F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))))
        return F.when(F.size(again) <= 32, few).otherwise(F.sort_array(F.transform(many, lambda x: x["i"])))

    def covered(starts: Column) -> Column:
        return F.aggregate(
            starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last")),
            lambda seen, at: F.struct(
                (seen["n"] + F.least(F.lit(window), at - seen["last"])).alias("n"), at.alias("last")),
            lambda seen: seen["n"])

    def repeated(w: Column) -> Column:
        again = once(F.sort_array(w), lambda s: F.array_distinct(F.filter(s, lambda h, i: F.coalesce(F.get(s, i + 1) == h, F.lit(False)))))
        return once(again, lambda h: F.when(F.size(h) > 0, covered(places(w, h))).otherwise(0))

    def counted(h: Column) -> Column:
        return F.when(F.size(h) > window, once(windows(h), repeated)).otherwise(0)

    return once(F.transform(words(text), lambda word: F.xxhash64(word)), counted).cast("long")


COUNTS: dict[str, Callable[[Column], Column]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)
}


# --- rules -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """``fails(*counts)`` tells from the named counts whether a text is rejected; never null."""

    name: str
    counts: tuple[str, ...]
    fails: Callable[..., Column]


BASE = (
    Rule("few words", ("n_words",), lambda n: n < 50),
    Rule("repeated words", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 50 * n),
)
RULES = (
    *BASE,
    Rule("word length", ("n_words", "word_chars"), lambda n, c: (c < 3 * n) | (c > 10 * n)),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > n),
    Rule("repeated lines", ("n_lines", "n_dup_lines"), lambda n, d: 10 * d > 3 * n),
)


@dataclass(frozen=True)
class Plan:
    """``rules`` in the order to run; ``seconds`` a count takes over the sample; ``rejected`` rows of ``sampled`` by rule."""

    rules: tuple[Rule, ...]
    seconds: dict[str, float]
    rejected: dict[str, int]
    sampled: int


def in_order(rules: tuple[Rule, ...], seconds: dict[str, float], patterns: dict[int, int]) -> tuple[Rule, ...]:
    """Rules by rejections per second, one after another.

    ``patterns``: rows by the set of rules that reject them (bit i for rule i). Each step looks at the rows no chosen
    rule rejects and at the counts no chosen rule has made. Ties go to the cheaper rule, then to the first.
    """
    left, known, order = list(range(len(rules))), set(), []
    alive = dict(patterns)
    while left:
        def worth(i: int) -> tuple[float, float, int]:
            cost = sum(seconds[c] for c in rules[i].counts if c not in known) + 1e-9
            return sum(n for mask, n in alive.items() if mask >> i & 1) / cost, -cost, -i

        best = max(left, key=worth)
        left.remove(best)
        order.append(rules[best])
        known.update(rules[best].counts)
        alive = {mask: n for mask, n in alive.items() if not mask >> best & 1}
    return tuple(order)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 1000, runs: int = 2) -> Plan:
    """Order the rules by what they cost and reject on about ``sample_rows`` random rows.

    The sample is written down and read by one task, so seconds compare. An empty table keeps the order given.
    """
    rows = docs.count()
    if not rows:
        return Plan(tuple(rules), {}, {r.name: 0 for r in rules}, 0)
    names = list(dict.fromkeys(c for rule in rules for c in rule.counts))
    given = F.coalesce(column(docs, text), F.lit("")).alias("text")
    share = min(1.0, sample_rows / max(rows, 1))
    drawn = docs.select(given).sample(share, seed=0) if share < 1 else docs.select(given)
    sample = write_and_read(drawn.repartition(1), "sample")

    def timed(value: Column) -> float:
        best = float("inf")
        for _ in range(runs):
            start = perf_counter()
            sample.agg(F.sum(value)).collect()  # a frame collected again would go on from its shuffle
            best = min(best, perf_counter() - start)
        return best

    idle = timed(F.octet_length("text"))
    seconds = {c: max(timed(COUNTS[c](F.col("text"))) - idle, 1e-4) for c in names}
    counted = sample.select(*[COUNTS[c](F.col("text")).alias(c) for c in names])
    mask = sum((F.when(r.fails(*map(F.col, r.counts)), 1 << i).otherwise(0) for i, r in enumerate(rules)), F.lit(0))
    patterns = {m: n for m, n in counted.groupBy(mask.alias("m")).count().collect()}  # at most 2 ** len(rules) rows
    rejected = {r.name: sum(n for m, n in patterns.items() if m >> i & 1) for i, r in enumerate(rules)}
    return Plan(in_order(rules, seconds, patterns), seconds, rejected, sum(patterns.values()))


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: list[str] | None = None,
    whole: bool = False,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the rules' verdict, the rules run in the order given.

    Adds ``kept``, ``rejected_by`` (the first rule that fails, null if none), ``n_checked`` (rules looked at) and the
    rules' counts, null where an earlier rule had rejected the text; with ``whole`` these are counted
    afterwards, for those rows alone. A null text counts as an empty one. Columns of these names are replaced;
    repeated rows stay; an empty table gives an empty one. One pass, no shuffle.
    """
    names = list(dict.fromkeys(c for rule in rules for c in rule.counts))
    added = [*names, "kept", "rejected_by", "n_checked"]
    own = docs if keep is None else docs.select(*[column(docs, c) for c in keep], *(
        [] if text in keep else [column(docs, text)]))
    body = "__body"
    own = own.withColumn(body, F.coalesce(column(own, text), F.lit("")))
    passed = without(own, *added, *([] if keep is None or text in keep else [text]))
    frame = passed.withColumn("__by", F.lit(-1))
    alive = F.col("__by") < 0
    known: set[str] = set()
    for i, rule in enumerate(rules):
        new = [c for c in rule.counts if c not in known]
        known.update(new)
        frame = frame.withColumns({c: F.when(alive, COUNTS[c](F.col(body))) for c in new})
        fails = alive & rule.fails(*map(F.col, rule.counts))
        frame = frame.withColumn("__by", F.when(fails, i).otherwise(F.col("__by")))
    if whole:
        frame = frame.withColumns({c: F.coalesce(F.col(c), COUNTS[c](F.col(body))) for c in names})
    name = F.get(F.array(*[F.lit(r.name) for r in rules]).cast("array<string>"), F.col("__by"))  # null before the first
    return frame.select(
        *[column(frame, c) for c in passed.columns if c != body], *names,
        (F.col("__by") < 0).alias("kept"), name.alias("rejected_by"),
        F.when(F.col("__by") >= 0, F.col("__by") + 1).otherwise(len(rules)).alias("n_checked"))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 1000) -> DataFrame:
    """The rows that no rule rejects, with their own columns; the order of the rules is measured first."""
    taken = docs.select(*[column(docs, c).alias(f"__c{i}") for i, c in enumerate(docs.columns)])
    plan = measure(docs, rules, text, sample_rows)
    judged = judge(taken, plan.rules, f"__c{docs.columns.index(text)}").where("kept")
    return judged.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)])
