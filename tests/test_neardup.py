"""Near-duplicate join against brute force, on hot groups of copies as well."""

import random

import pytest
from pyspark.sql import functions as F

from foliary.operators import neardup
from foliary.operators.neardup import NearDupSettings, copies_of, near_duplicates, shingle_sets
from foliary.plans.ingest import check_duplicates

WINDOW = 3


def shingles(text, window=WINDOW, max_words=None):
    words = text.split()[:max_words]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + window]) for i in range(max(len(words) - window + 1, 1)))


def similar(a, b, percent=90):
    common = len(a & b)
    return 100 * common >= percent * (len(a) + len(b) - common)


def first_copies(rows, **how):
    """{id: earliest earlier near copy} by comparing everything with everything."""
    sets = {doc: shingles(text, **how) for _, doc, text in rows}
    found = {}
    for seq, doc, _ in rows:
        hits = [(s, d) for s, d, _ in rows if s < seq and sets[d] and sets[doc] and similar(sets[doc], sets[d])]
        if hits:
            found[doc] = min(hits)[1]
    return found


def feed(seed, size):
    """A third exact copies of one text, a third its near copies, the rest random or short."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = rng.choices(vocabulary, k=80)
    rows = []
    for seq in range(size):
        kind = rng.random()
        if kind < 0.33:
            words = base
        elif kind < 0.66:
            words = list(base)
            for _ in range(rng.randint(1, 3)):
                at = rng.choice([0, 1, len(words) - 1, rng.randrange(len(words))])
                words[at] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words = words[: rng.randint(60, 80)]
        elif kind < 0.75:
            words = rng.choices(vocabulary[:3], k=rng.randint(0, 3))
        else:
            words = rng.choices(vocabulary, k=rng.randint(1, 60)) + base[: rng.randint(0, 60)]
        rows.append((seq, f"d{seq}", " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,width", [(1, 16), (2, 1), (3, 2)])
def test_first_copies_match_brute_force(spark, seed, width):
    rows = feed(seed, 150)
    docs = spark.createDataFrame(rows, "seq BIGINT, doc_id STRING, text STRING")
    settings = NearDupSettings(window=WINDOW, max_words=None, width=width)
    got = {r.doc_id: r.first_duplicate for r in near_duplicates(docs, settings).collect()}
    assert got == first_copies(rows)


def test_word_limit(spark):
    same = [f"a{i}" for i in range(20)]
    rows = [(1, "x", " ".join(same + ["p"] * 30)), (2, "y", " " + " \n ".join(same) + " q r s t u v")]
    docs = spark.createDataFrame(rows, "seq BIGINT, doc_id STRING, text STRING")
    limited = near_duplicates(docs, NearDupSettings(window=10, max_words=20)).collect()
    assert [(r.doc_id, r.first_duplicate, str(r.score)) for r in limited] == [("y", "x", "1.00")]
    assert near_duplicates(docs, NearDupSettings(window=10, max_words=None)).count() == 0


def test_growing_list_of_copies(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(i, str(i), text) for i in (1, 2, 3)], "seq BIGINT, doc_id STRING, text STRING")
    asked = docs.select("doc_id")
    lists = {"1": set(), "2": set(), "3": set()}
    for row in copies_of(asked, docs).collect():
        lists[row.doc_id].add(row.duplicate_id)
    assert lists == {"1": set(), "2": {"1"}, "3": {"1", "2"}}


def test_copies_of_matches_brute_force(spark):
    rows = feed(7, 100)
    docs = spark.createDataFrame(rows, "seq BIGINT, doc_id STRING, text STRING")
    asked = spark.createDataFrame([(d,) for _, d, _ in rows[::4]], "doc_id STRING")
    got = {(r.doc_id, r.duplicate_id) for r in copies_of(asked, docs, NearDupSettings(window=WINDOW, max_words=None)).collect()}
    sets = {d: shingles(t) for _, d, t in rows}
    want = {
        (d, e) for s, d, _ in rows[::4] for q, e, _ in rows
        if q < s and sets[d] and sets[e] and similar(sets[d], sets[e])
    }
    assert got == want


def replay(rows, index=()):
    """The rules one event at a time: (NEW ids with seq, {seq: hit})."""
    seen = [(s, d, shingles(t)) for s, d, t in index]
    stored, hits = {}, {}
    for seq, doc, text in sorted(rows):
        if doc in stored or not text.split():
            continue
        own = shingles(text)
        found = [d for _, d, other in seen if similar(own, other) and d != doc]
        seen.append((seq, doc, own))
        if found:
            hits[seq] = found[0]
        else:
            stored[doc] = seq
    return stored, hits


@pytest.mark.parametrize("seed", range(4))
def test_repeated_ids_with_changing_texts(spark, seed):
    rng = random.Random(seed)
    base = [[f"t{k}w{i}" for i in range(40)] for k in range(4)]
    def text():
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.choice([0, 39, rng.randrange(40)])] = f"x{rng.randrange(3)}"
        return "" if rng.random() < 0.05 else " ".join(words)
    def doc():
        return "hot" if rng.random() < 0.33 else f"d{rng.randrange(12)}"
    index = [(s, doc(), text() or "z") for s in range(5)] if seed % 2 else []
    rows = [(100 + s, doc(), text()) for s in range(50)]
    settings = NearDupSettings(window=WINDOW, max_words=None, width=2)
    ddl = "seq BIGINT, doc_id STRING, text STRING"
    index_frame = shingle_sets(spark.createDataFrame(index, ddl), settings) if index else None
    checked = check_duplicates(spark.createDataFrame(rows, ddl), index_frame, settings)
    stored, hits = replay(rows, index)
    assert {r.doc_id: r.new_seq for r in checked.first_new.collect()} == stored
    got = {r.seq: r.hit_id for r in checked.hits.collect()}
    assert {s: got[s] for s in hits} == hits
    assert {r.seq for r in checked.index_rows.collect()} <= set(got)


def test_settings_from_options():
    assert NearDupSettings.from_options({"mode": "noop"}) is None
    assert NearDupSettings.from_options({"max_words": "200", "window": 10}) == NearDupSettings(max_words=200)
    with pytest.raises(NotImplementedError):
        NearDupSettings.from_options({"mode": "rest"})
    with pytest.raises(NotImplementedError):
        NearDupSettings.from_options({"algorithm": "lsh"})
    with pytest.raises(ValueError):
        NearDupSettings.from_options({"mode": "other"})
    with pytest.raises(ValueError):
        NearDupSettings.from_options({"algorithm": "other"})


def test_candidates_come_from_rare_shingles_only(spark):
    """A shingle all texts share must not bring unrelated texts together."""
    rows = [(i, f"d{i}", " ".join(["same", "start", "everywhere"] + [f"u{i}_{j}" for j in range(30)])) for i in range(50)]
    docs = spark.createDataFrame(rows, "seq BIGINT, doc_id STRING, text STRING")
    sets = shingle_sets(docs, NearDupSettings(window=3, max_words=None))
    assert sets.select(F.min("n")).first()[0] == 31
    assert near_duplicates(docs, NearDupSettings(window=3, max_words=None)).count() == 0


def test_a_common_passage_brings_no_pairs(spark):
    """Short and long texts around one passage: they meet on its shingles, and places tell that none is a copy."""
    def candidates(size):
        rows = []
        for i in range(size):
            rows.append((2 * i, 104, [*range(99), *(1000 + 100 * i + j for j in range(5))]))
            rows.append((2 * i + 1, 110, [*range(99), *(1050 + 100 * i + j for j in range(11))]))
        classes = spark.createDataFrame(rows, "cls BIGINT, n INT, shingles ARRAY<BIGINT>")
        tokens = neardup.class_tokens(classes, NearDupSettings()).tokens
        asking = neardup._lanes(tokens.selectExpr("shingle", "cls AS asker", "n AS asker_n", "rest AS asker_rest", "short"), True)
        found = neardup._lanes(tokens, False).drop("short")
        met = asking.drop("short").join(found, ["shingle", "lane"]).where("asker_n <> n").count()
        return met, neardup._candidates(asking.drop("short"), found, 90).where("asker % 2 <> cls % 2").count()
    assert candidates(10) == (200, 0) and candidates(20) == (800, 0)  # each pair asks both ways


def test_stored_index_reads_asked_slots_only(spark, tmp_path):
    """Many batches, merged pieces, and a probe that opens the slots of its own shingles only."""
    from foliary.operators.probe import SLOTS, list_rows
    from foliary.sources import index as stored
    from foliary.sources.store import CorpusStore

    settings = NearDupSettings(window=3)
    store, rng, seen = CorpusStore(spark, str(tmp_path)), random.Random(5), []
    ddl = "seq BIGINT, doc_id STRING, text STRING"
    crowd = [f"c{i}" for i in range(60)]
    for batch in range(10):
        rows = []
        for i in range(30):
            seq, kind = batch * 30 + i, rng.randrange(4)
            if kind == 0:  # a crowd of near copies of each other
                words = [*crowd[:rng.randrange(60)], f"x{seq}", *crowd[rng.randrange(55, 60):]] if i % 2 else list(crowd)
            elif kind == 1 and seen:
                words = shuffled_edit(rng, rng.choice(seen)[2].split())
            else:
                words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([2, 20, 45]))]
            rows.append((seq, f"d{rng.randrange(200)}", " ".join(words)))
        store.number(f"b{batch}")
        checked = check_duplicates(spark.createDataFrame(rows, ddl), store.shingle_index(batch), settings)
        if batch in (0, 7, 8, 9):
            got = {r.seq: r.hit_id for r in checked.hits.collect()}
            assert {s: h for s, h in got.items() if s in first_hits(seen, rows)} == first_hits(seen, rows)
        store.add_to_index(checked.index_rows, batch, settings)
        seen += [(s, d, t) for s, d, t in rows if s in checked_events(seen, rows)]
    index = store.shingle_index(10)
    assert index.pieces == [(0, 7), (8, 8), (9, 9)] and store.shingle_index(7).pieces == [(i, i) for i in range(7)]
    assert len(index.rows().collect()) < len(seen)  # of equal texts two documents
    sets = shingle_sets(spark.createDataFrame([(0, "q", "one two three four five")], ddl), settings)
    slots = [r.slot for r in list_rows(sets, "seq", settings).select("slot").distinct().collect()]
    plan = index.lists(slots, settings)._jdf.queryExecution().executedPlan().toString()
    assert len(slots) < 4 < SLOTS and "PartitionFilters: [isnotnull(slot" in plan or "PartitionFilters: [slot" in plan
    assert {r.slot for r in index.lists(slots, settings).select("slot").distinct().collect()} <= set(slots)
    with pytest.raises(ValueError):
        index.lists([0], NearDupSettings(window=3, threshold=80))
    assert stored.covering([(0, 0), (1, 1), (0, 1), (3, 3)]) == [(0, 1), (3, 3)]


def shuffled_edit(rng, words):
    at = rng.randrange(len(words))
    return [*words[:at], f"e{rng.randrange(50)}", *words[at + 1:]]


def first_hits(seen, rows):
    """The rules one event at a time, for ids and texts seen before: {seq: hit} of the events that have one."""
    return one_by_one(seen, rows)[0]


def checked_events(seen, rows):
    return one_by_one(seen, rows)[1]


def one_by_one(seen, rows):
    known, hits, taken, stored = [(d, frozenset(shingles_of(t))) for _, d, t in seen], {}, set(), set()
    for seq, doc, text in sorted(rows):
        if doc in stored:
            continue
        own = frozenset(shingles_of(text))
        found = [d for d, other in known if d != doc and 10 * len(own & other) >= 9 * len(own | other)]
        known.append((doc, own))
        taken.add(seq)
        if found:
            hits[seq] = found[0]
        else:
            stored.add(doc)
    return hits, taken


def shingles_of(text):
    words = text.split()
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))}


def all_copies(rows):
    sets = {doc: shingles(text) for _, doc, text in rows}
    return {doc: [d for s, d, _ in sorted(rows) if s < seq and sets[d] and similar(sets[doc], sets[d])] for seq, doc, _ in rows if sets[doc]}


def test_whole_lists_of_copies(spark, tmp_path):
    rows = feed(31, 150)
    docs = spark.createDataFrame(rows, "seq long, doc_id string, text string")
    lists = neardup.copy_lists(docs, NearDupSettings(window=WINDOW))
    lists.write(str(tmp_path / "lists"))
    lists = neardup.CopyLists.read(spark, str(tmp_path / "lists"))
    want = {doc: copies for doc, copies in all_copies(rows).items() if copies}
    got = {r.doc_id: r.duplicates for r in lists.lists(docs.select("doc_id")).collect()}
    assert got == want and max(map(len, got.values())) > 50
    asked = docs.where("seq % 20 = 0").select("doc_id")
    assert {r.doc_id: r.duplicates for r in lists.lists(asked).collect()} == {
        d: want[d] for (d,) in asked.collect() if d in want}
    # links are between different texts only, once a pair
    links = [tuple(r) for r in lists.links.collect()]
    assert len(links) == len(set(links)) and all(a > b for a, b in links)


def test_whole_lists_without_rows(spark):
    none = spark.createDataFrame([(0, "a", None), (1, "b", " ")], "seq long, doc_id string, text string")
    lists = neardup.copy_lists(none)
    assert lists.members.count() == 0 and lists.lists(none.select("doc_id")).count() == 0


def test_messages_name_the_whole_list(spark):
    from foliary.operators import outputs

    events = spark.createDataFrame(
        [(0, "a", "NEW", None, None, None, None), (1, "b", "DUPLICATE", "a", None, None, None), (2, "c", "DUPLICATE", "a", "UPDATE", None, None),
         (3, "e", "DUPLICATE", "x", None, "ingestion", "original not stored")],
        "seq long, target_id string, outcome string, duplicate_of string, target_change string, operation string, message string")
    lists = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"])], "seq long, duplicates array<string>")
    said = {r.key: r.value for r in outputs.duplicate_notices(events, lists).collect()}
    assert said == {"b": '{"doc_id":"b","duplicated_docs":["a"]}', "c": '{"doc_id":"c","duplicated_docs":["a","b"]}',
                    "e": '{"doc_id":"e","duplicated_docs":["x"]}'}
    assert '"duplicated_docs":["a"]' in {r.key: r.value for r in outputs.duplicate_notices(events).collect()}["c"]
    rows = outputs.core_status(events, F.lit(5), lists=lists).where("status = 'FAILURE' and stage = 'ingestion'").collect()
    assert {r.doc_id: r.message for r in rows} == {"b": "b duplicates: a", "c": "c duplicates: ab", "e": "e duplicates: x"}


def test_only_prefixes_leave_their_tasks(spark, monkeypatch):
    """Of unrelated texts with copies a tenth of the shingles becomes rows, and no set is moved."""
    docs = spark.createDataFrame(
        [(s, f"d{s}", " ".join(f"u{s % 20}_{j}" for j in range(302))) for s in range(25)], "seq BIGINT, doc_id STRING, text STRING")
    sizes, cut, land = [], neardup.cut, neardup.land

    def counting(written):
        def write(df):
            done = written(df)
            sizes.append((done.columns, done.count()))
            return done
        return write

    monkeypatch.setattr(neardup, "cut", counting(cut))
    monkeypatch.setattr(neardup, "land", counting(land))
    found = {r.doc_id: r.first_duplicate for r in near_duplicates(docs, NearDupSettings(window=3)).collect()}
    assert found == {f"d{s}": f"d{s - 20}" for s in range(20, 25)}
    tokens = [n for columns, n in sizes if "shingle" in columns]
    assert max(tokens) == 20 * 31
    assert [n for columns, n in sizes if "shingles" in columns and n] == [25]  # all sets once


def test_wide_rows_among_and_outside_few_ids(spark):
    from foliary.session import among, outside

    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k BIGINT, v STRING")
    ids = spark.createDataFrame([(1,), (1,), (None,), (9,)], "k BIGINT")
    assert sorted(r.v for r in among(rows, ids, "k").collect()) == ["a", "b"]
    assert sorted(r.v for r in outside(rows, ids, "k").collect()) == ["c", "d", "e"]
    none = ids.where("k = 0")
    assert among(rows, none, "k").count() == 0 and outside(rows, none, "k").count() == 5
    many = spark.range(3000).selectExpr("id * 7 AS k")
    assert among(spark.range(9000).selectExpr("id AS k"), many, "k").count() == 1286


def test_shingles_are_hashed_without_slices(spark):
    texts = ["a b c d e", "a b", "a", " a  b\nc ", "x y z x y z x y", "", None]
    docs = spark.createDataFrame([(i, str(i), t) for i, t in enumerate(texts)], "seq BIGINT, doc_id STRING, text STRING")
    sets = shingle_sets(docs, NearDupSettings(window=WINDOW))
    assert "slice(" not in sets._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for i, t in enumerate(texts):
        if t and t.split():
            w = F.transform(F.array(*[F.lit(x) for x in t.split()]), lambda x: F.xxhash64(x))
            runs = [F.xxhash64(F.slice(w, k, WINDOW)) for k in range(1, max(len(t.split()) - WINDOW + 1, 1) + 1)]
            want[i] = sorted(set(spark.range(1).select(F.array(*runs)).first()[0]))
    assert {r.seq: r.shingles for r in sets.collect()} == want
