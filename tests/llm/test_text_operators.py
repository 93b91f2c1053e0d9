"""Decontamination, near-duplicates, repeats: brute force on small tables and odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontamination, graph, near_duplicates, repeats
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    """A table like ``documents`` with extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns({"n_words": F.lit(1), "class": F.lit("x"), "spans": F.lit(0), "kept": F.lit(False)})


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Texts with copies, near copies, shared passages, odd spacing, other alphabets, empty and null ones."""
    rng = random.Random(4)
    passage = " ".join(words(rng, 60))
    texts = [None, "", "   ", "one", "One", "two words", "Ünïcode ẞ words here " * 9, "a" * 350, "ab" * 300, "é" * 250]
    for _ in range(40):
        texts.append(" ".join(words(rng, rng.randrange(1, 200))))
    for k in range(30):
        base = texts[10 + k % 12].split() if k % 3 else passage.split()
        for _ in range(rng.randrange(0, 5)):
            base[rng.randrange(len(base))] = f"edit{rng.randrange(99)}"
        texts.append(" ".join(base))
    texts += [texts[12]] * 6 + [f"begin {k} {passage} end {k}" for k in range(12)]
    texts.append(" ".join(words(rng, 30_000, 50_000)) + "\n" + passage)
    ids = list(range(3, 3 + 2 * len(texts), 2))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def test_decontamination(spark, corpus):
    longest = max((t for _, t in corpus if t), key=len)
    items = [(1, " ".join(longest.split()[5:40])), (2, "ONE!"), (3, None), (4, "..."), (10, "two words"), (10, "two words")]
    items += [(5, " ".join(longest.upper().split()[30:41])), (None, "ünïcode ẞ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contamination(docs_of(spark, corpus), bench).collect()
    wanted = brute.contamination(corpus, [("null" if i is None else i, t) for i, t in items])
    assert sorted(tuple(r) for r in got) == sorted(wanted)
    kept = decontamination.drop_contaminated(docs_of(spark, corpus), bench)
    assert {r.doc_id for r in kept.collect()} == {w[0] for w in wanted if not w[5]}
    assert kept.schema == docs_of(spark, corpus).schema
    with pytest.raises(ValueError):
        decontamination.find_contamination(docs_of(spark, corpus), bench, most_bytes=3)


def test_decontamination_gives_the_places(spark):
    text = "«Ça» va: one TWO, three-four five; six seven eight nine ten eleven!"
    bench = spark.createDataFrame([(7, "one two three four five six seven eight nine ten")], "item_id long, text string")
    row = decontamination.find_contamination(docs_of(spark, [(1, text)]), bench, spans=True).first()
    assert [text[s.start : s.end] for s in row.spans] == [text[text.index("one") : text.index(" eleven")]]
    assert row.spans[0]["items"] == ["7"]


@pytest.mark.parametrize("width, vocabulary", [(1, 3), (2, 3), (3, 2), (10, 2), (10, 40), (150, 1)])
def test_automaton_finds_every_window(width, vocabulary):
    rng = random.Random(width * 100 + vocabulary)
    items = [(str(i % 9), " ".join(words(rng, rng.randrange(0, 3 * width), vocabulary)).encode()) for i in range(12)]
    machine = decontamination.Automaton(tuple(items), width)
    texts = [" ".join(words(rng, n, vocabulary + 1)) for n in (0, 1, 5, 63, 64, 65, 300, 2000)]
    scan = decontamination.Scan(machine, [t.encode() for t in texts])
    wanted = brute.contamination(list(enumerate(texts)), [(i, t.decode()) for i, t in items]) if width == 10 else None
    of = {}
    for item, text in items:
        line = text.decode().split()
        for i in range(max(1, len(line) - width + 1)) if line else ():
            of.setdefault(tuple(line[i : i + width]), set()).add(item)
    found = scan.occurrences()
    for k, text in enumerate(texts):
        line = text.split()
        places = {(i, i + n, w) for n in {len(w) for w in of} for i in range(len(line) - n + 1) if (w := tuple(line[i : i + n])) in of}
        assert sorted((a, b, sorted(of[w])) for a, b, w in places) == sorted(found.get(k, []))
        assert scan.n_words[k] == len(line)
        assert scan.covered()[k] == len({i for a, b, _ in places for i in range(a, b)})
        if wanted:
            assert wanted[k][1:4] == (scan.n_words[k], scan.covered()[k], len(scan.items().get(k, [])))


def test_long_lines_are_numbered_in_parts():
    machine = decontamination.Automaton((("1", b"a bb ccc"),), 10)
    line = b"a bb  ccc x " * 50
    for at_most in (1, 7, 1 << 20):
        assert machine.numbers(line, at_most).tolist() == [0, 1, 2, -1] * 50


def test_automaton_is_built_once_per_worker(spark, monkeypatch):
    built = []
    plain = decontamination.Automaton.__init__
    monkeypatch.setattr(decontamination.Automaton, "__init__", lambda self, *a: (built.append(1), plain(self, *a))[1])
    bench = spark.createDataFrame([(1, "a b c"), (2, "x " * 30)], "item_id long, text string")
    shared = decontamination.shared_items(bench, 1000)
    machines = {id(decontamination.automaton(shared, 10)) for _ in range(50)}
    assert len(built) == len(machines) == 1
    decontamination.automaton(decontamination.shared_items(bench, 1000), 10)
    assert len(built) == 2


def test_automaton_of_a_large_benchmark():
    rng = np.random.default_rng(3)
    text = [b" ".join(b"w%d" % n for n in rng.zipf(1.3, 400) % 50_000) for _ in range(1000)]  # 2 MB
    items = tuple((str(i), t) for i, t in enumerate(text))
    machine = decontamination.Automaton(items, 10)
    held = sum(a.nbytes for a in vars(machine).values() if isinstance(a, np.ndarray))
    assert held < 40 * sum(map(len, text))
    scan = decontamination.Scan(machine, [text[7], b"before " + b" ".join(text[9].split()[100:109]), b"of " + b" ".join(text[8].split()[50:62])])
    assert (scan.covered() == [400, 0, 12]).all() and "7" in scan.items()[0] and scan.items()[2] == ["8"]


def test_decontamination_without_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(docs_of(spark, []), none).count() == 0
    assert not decontamination.contamination(docs_of(spark, [(1, "a b")]), none).first().contaminated


def test_near_duplicates(spark, corpus):
    wanted = brute.near_duplicates(corpus)
    for block in (near_duplicates.BLOCK, 40):  # the second deals groups over several tasks
        got = near_duplicates.near_duplicates(docs_of(spark, corpus), block=block).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = near_duplicates.drop_near_duplicates(docs_of(spark, corpus))
    assert {r.doc_id for r in kept.collect()} == {d for d, (_, c) in wanted.items() if d == c}
    assert kept.columns == docs_of(spark, corpus).columns


def test_near_duplicates_of_repeated_and_null_ids(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (4, "q r s t u v"), (None, None), (2, "x")]
    got = near_duplicates.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(
        str(x)
        for x in [(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, True), (2, 1, 2, True)]
    )
    assert near_duplicates.near_duplicates(docs_of(spark, [])).count() == 0


def test_one_row_of_each_group_stays(spark):
    a, b, c = "a b c d e f", "q r s t u v", "l m n o p q"
    rows = [(5, a), (3, a), (5, b), (5, b), (5, b.upper()), (7, b), (None, a), (None, c), (None, c), (None, None), (None, ""), (2, " "), (2, " ")]
    left = near_duplicates.drop_near_duplicates(docs_of(spark, rows))
    got = [(r.doc_id, (r.text or "").lower()) for r in left.collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(3, a), (5, b), (None, c), (None, ""), (None, ""), (2, " "), (2, " ")]))
    assert left.columns == docs_of(spark, rows).columns
    twice = near_duplicates.drop_near_duplicates(docs_of(spark, [(1, a), (2, c), (1, a), (2, c)])).collect()
    assert sorted((r.doc_id, r.text) for r in twice) == [(1, a), (2, c)]


def test_signatures_agree_as_often_as_sets(spark):
    rng = random.Random(1)
    a = near_duplicates.shingle_sets(pa.array([" ".join(words(rng, 3000, 10**6))], pa.large_string()))[0]
    b = a.copy()
    b[: len(b) // 5] ^= np.uint64(1 << 50)
    same = (near_duplicates.signature(a) == near_duplicates.signature(b)).mean()
    assert abs(same - 0.8 / 1.2) < 0.12


def test_components(spark):
    edges = [(i, i + 1) for i in range(40, 0, -1)] + [(100, 99), (100, 100), (99, 98)]
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {i: 1 for i in range(1, 42)} | {98: 98, 99: 98, 100: 98}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeats(spark, corpus):
    wanted = brute.removed(corpus)
    for crowd, often in ((repeats.CROWD, repeats.OFTEN), (2, 2)):  # the second takes every gram for a crowded one
        got = repeats.removed_bytes(docs_of(spark, corpus), crowd, often).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == wanted


def test_repeats_with_too_many_crowded_grams_to_send(spark, corpus, monkeypatch):
    monkeypatch.setattr(repeats, "SENT", 0)
    wanted = brute.removed(corpus)
    got = repeats.removed_bytes(docs_of(spark, corpus), 2, 2).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == wanted


def test_repeats_leave_the_columns(spark, corpus):
    wanted = brute.removed(corpus)
    frame = docs_of(spark, corpus)
    left = repeats.remove_repeats(frame)
    assert left.columns == frame.columns
    texts = dict(corpus)
    for row in left.collect():
        if wanted[row.doc_id][1] == 0:
            assert row.text == texts[row.doc_id]
        else:
            size = wanted[row.doc_id][0] - wanted[row.doc_id][1]
            assert size - 6 <= len(row.text.encode()) <= size
            assert row.n_chars == len(row.text)


def test_repeats_of_repeated_and_null_ids(spark):
    rng = random.Random(3)
    text = " ".join(words(rng, 40))
    rows = [(None, text), (5, text), (5, text), (5, text + " more"), (6, None), (6, "")]
    got = sorted((r.doc_id or 0, r.n_removed == r.n_bytes, r.n_removed > 0) for r in repeats.removed_bytes(docs_of(spark, rows)).collect())
    assert got == [(0, False, False), (5, False, True), (5, True, True), (5, True, True), (6, True, False), (6, True, False)]
    equal = repeats.removed_bytes(docs_of(spark, [(5, text)] * 3)).collect()
    assert sorted(r.n_removed > 0 for r in equal) == [False, True, True]
    assert repeats.removed_bytes(docs_of(spark, [])).count() == 0


def test_one_of_equal_rows_keeps_its_text(spark):
    rng = random.Random(6)
    a, b, c = (" ".join(words(rng, 50)) for _ in range(3))
    rows = [(5, a)] * 3 + [(None, b)] * 2 + [(None, c), (7, c), (4, "short"), (4, "short"), (1, None)]
    got = [(r.doc_id, r.text, r.n_chars) for r in repeats.remove_repeats(docs_of(spark, rows)).collect()]
    wanted = [(5, a), (5, ""), (5, ""), (None, b), (None, ""), (None, c), (7, ""), (4, "short"), (4, "short"), (1, None)]
    assert sorted(map(str, got)) == sorted(str((i, t, len(t or ""))) for i, t in wanted)


def test_repeats_of_one_id_are_joined_by_their_texts(spark, monkeypatch):
    rng = random.Random(7)
    passage = " ".join(words(rng, 60))
    texts = [f"{k} {passage} " + " ".join(words(rng, 40)) for k in range(30)]
    frame = docs_of(spark, [(None, t) for t in texts] + [(None, texts[0])] * 5)
    order = [r.text for r in frame.distinct().orderBy(F.xxhash64("text")).collect()]
    wanted = brute.removed(list(enumerate(order)))
    copy = (len(texts[0]), len(texts[0]), 1, brute.hashlib.sha256(b"").hexdigest())
    bucketed = []
    real = repeats._texts
    monkeypatch.setattr(repeats, "_texts", lambda *a: bucketed.append(real(*a)) or bucketed[-1])
    got = repeats.removed_bytes(frame).collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted([*wanted.values(), *[copy] * 5])
    # No list of marks or spans is joined to more than the one text it belongs to.
    assert bucketed[0].count() == bucketed[0].select("dkey", "twin").distinct().count() == 30
    plan = repeats._removed(repeats._rows(frame), repeats._classes(repeats._rows(frame)), False, 50, 9)._jdf.queryExecution().toString()
    joins = [line for line in plan.splitlines() if "ShuffledHashJoin" in line]
    assert joins and all("twin" in line for line in joins)
