"""Similarity join, decontamination and repeated passages against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from fixtures import DDL, documents, frame, text

from docketry.llm import chunk_dedup, jaccard_join, templates
from docketry.llm.components import components
from docketry.llm.queries import op6_decontamination, op7_substring_dedup, op8_jaccard_join

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
CAPITALS = bytes(range(65, 91))
LOWER = bytes.maketrans(CAPITALS, CAPITALS.lower())


def words(value):
    return WORD.findall((value or "").encode().translate(LOWER))


def shingles(value):
    w = words(value)
    if len(w) >= 5:
        return frozenset(b" ".join(w[k : k + 5]) for k in range(len(w) - 4))
    return frozenset([b" ".join(w)] if w else [])


def joined(pairs):
    """Expected (id, set size, component) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in pairs]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            both = len(x & y)
            if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
                parent[root(a)] = root(b)
    smallest = {}
    for k, (i, _) in enumerate(sets):
        smallest[root(k)] = min(i, smallest.get(root(k), i))
    return sorted((i, len(s), smallest[root(k)]) for k, (i, s) in enumerate(sets))


def linked(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked(frame).collect())


def test_join_equals_all_pairs(spark):
    assert linked(frame(spark)) == joined([(i, t) for i, t, *_ in documents()])


def near_copies(seed, groups, members, most):
    """Groups of texts in which some are near the first, some only near each other, and some just too far."""
    chance, rows = random.Random(seed), []
    for _ in range(groups):
        first = text(chance, 60).split()
        for _ in range(members):
            copy = list(first)
            for at in chance.sample(range(len(copy)), chance.randint(0, most)):
                copy[at] = f"w{chance.randrange(10**6)}"
            rows.append(" ".join(copy))
    chance.shuffle(rows)
    return [(i, t, "en", "s", 0) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [4, 1024])
def test_join_finds_links_around_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = near_copies(3, 8, 14, 4)
    assert linked(frame(spark, rows)) == joined([(i, t) for i, t, *_ in rows])


def test_join_on_chains(spark):
    w = [f"w{k}" for k in range(400)]
    rows = [(99 - k, " ".join(w[3 * k : 3 * k + 60]), "", "", 0) for k in range(60)]
    got = linked(frame(spark, rows))
    assert got == joined([(i, t) for i, t, *_ in rows])
    assert {c for *_, c in got} == {40}


def test_join_without_words_or_rows_and_with_clashing_columns(spark):
    rows = [(1, None), (2, " \n"), (3, "a b"), (4, "A  b"), (None, "a b"), (5, "c")]
    data = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n long, component_id string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked(data).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (None, 1, 3), (5, 1, 5)], key=str)
    assert jaccard_join.linked(data.limit(0)).count() == 0


def test_one_of_each_keeps_the_smallest_and_all_columns(spark):
    rows = documents()
    kept = jaccard_join.one_of_each(frame(spark))
    want = {i for i, _, c in joined([(i, t) for i, t, *_ in rows]) if i == c}
    assert kept.columns == frame(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_one_of_each_keeps_every_text_of_an_id(spark):
    """Rows of one id with texts of their own stay, copies do not, and reruns agree."""
    one, other, third = ("some words that are told here number %d and then a few more of them" % n + " end" * n for n in (1, 5, 9))
    rows = [(5, one, "en", "a", 1), (5, other, "en", "b", 2), (5, one.upper(), "en", "c", 3), (5, one, "en", "d", 4), (5, one, "en", "d", 4),
            (3, third, "en", "e", 5), (5, third, "en", "f", 6), (7, other, "en", "g", 7), (7, "", "en", "h", 8), (None, one, "en", "i", 9)]
    kept = jaccard_join.one_of_each(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, (r.text or "").lower()) for r in kept) == sorted(
        [(0, one), (3, third), (5, one), (5, other), (7, "")]
    )
    again = jaccard_join.one_of_each(frame(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, kept))


def test_registered_join_on_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op8_jaccard_join(spark, sf_dir).collect())
    assert got == joined(rows)


def test_bounds_never_lose_a_pair():
    chance = np.random.default_rng(2)
    sets = [np.unique(chance.integers(0, 2**63, n, dtype=np.uint64)) for n in chance.integers(1, 80, 40)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], chance.integers(0, 2**63, 3, dtype=np.uint64)])) for s in sets]
    sizes = np.array([len(s) for s in sets])
    tree = jaccard_join.CountTree(np.array([jaccard_join.count_vector(s) for s in sets]), sizes)
    for k, s in enumerate(sets):
        near = {j for j, o in enumerate(sets) if jaccard_join.enough(len(np.intersect1d(s, o)), len(s), len(o))}
        assert near <= set(tree.candidates(jaccard_join.count_vector(s), int(sizes[k])).tolist())


def test_components_of_loops_repeats_and_long_chains(spark):
    pairs = [(k, k + 1) for k in range(50, 90)] + [(5, 5), (7, 6), (6, 7), (6, 7), (8, 100), (100, 51)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 8 for k in [8, 100, *range(50, 91)]}, 6: 6, 7: 6}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


ITEM = "In the town of Graz {a} bought {n} red apples for {m} dollars, and then {a} gave {n} of them back. How many are left?"


def found(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, id int")
    return {(r.doc_id, r.item_id): (r.n_slots, r.n_changed) for r in templates.contaminated(d, b, **more).collect()}


def test_changed_numbers_and_names_are_found_if_they_agree(spark):
    item = ITEM.format(a="Anna", n="12", m="3")
    docs = [
        (1, "Some words before. " + item + " And some behind."),
        (2, "well " + ITEM.format(a="Bob", n="7", m="5")),
        (3, ITEM.format(a="Bob", n="7", m="5").replace("gave 7", "gave 8")),
        (4, item.upper()),  # a verbatim copy, whatever its capitals
        (5, "nothing of the kind is in here, only words that go on and on for a while."),
        (6, item.replace(" ", "\n")),
        (7, None), (8, ""), (None, item),
        (9, "In the town of Graz nobody bought apples."),
    ]
    got = found(spark, docs, [(0, item), (1, None), (2, ""), (3, "too short")])
    assert set(got) == {(1, 0), (2, 0), (4, 0), (6, 0)}
    assert got[1, 0][1] == 0 and got[2, 0][1] == 4  # a run of names is one value


TWICE = "the train goes {a} km in the first hour of the trip and then {b} km in the first hour of the way home"


def test_each_place_of_an_item_is_judged_by_itself(spark):
    one, other = ITEM.format(a="Anna", n="12", m="3"), ITEM.format(a="Bob", n="7", m="5")
    wrong = other.replace("gave 7", "gave 8")
    train = TWICE.format(a=60, b=80)
    far = " ".join(f"w{k}" for k in range(300))
    docs = [
        (1, train), (2, TWICE.format(a=5, b=9)), (3, TWICE.format(a=60, b=60)),
        (4, f"{one} {other}"), (5, f"{wrong} {one}"), (6, f"{one} {far} bought 9 red apples for 8 dollars, and then"),
        (7, f"{wrong} {far} {wrong}"), (8, f"{other.replace('red', 'very red')} {far} {wrong}"),
    ]
    got = found(spark, docs, [(0, one), (1, other), (2, train)])
    both = {(d, i) for d in (4, 5, 6, 8) for i in (0, 1)}
    assert set(got) == both | {(1, 2), (2, 2)}
    assert got[1, 2] == (4, 0) and got[2, 2] == (4, 2) and got[4, 0][1] == got[4, 1][1] == got[5, 0][1] == 0


def test_every_verbatim_copy_is_found(spark):
    names = ITEM.format(a="Anna", n="12", m="3")
    items = [
        (0, names), (1, "12 + 7 = 19 and 19 + 4 = 23 and 23 + 8 = 31"), (2, "It was Anna Maria Luise Graz Bob Carl Dora Emil"),
        (3, "Name the capital of Peru"), (4, "1 2 1 2 1 2 1 2 1 2"),
    ]
    docs = [
        (1, f"so: {names.lower()} and so on"), (2, names.upper()), (3, names.replace(" ", "\n")),
        *[(10 + i, f"Some words before, {t} some behind.") for i, t in items], *[(20 + i, t.lower()) for i, t in items],
        (30, "12 + 7 = 19 and 19 + 4 = 23 and 23 + 8 = 32"), (31, "Name the capital of Chile"), (32, "1 2 1 2 1 2 1 2 1 3"),
    ]
    want = {(1, 0), (2, 0), (3, 0)} | {(d + i, i) for d in (10, 20) for i in range(5)}
    assert set(found(spark, docs, items)) == want


def test_no_rows(spark):
    assert found(spark, [], [(0, "a b c d e f g h i j")]) == {} and found(spark, [(1, "a b c d e f g h i j")], []) == {}


def plain(value):
    return [x for x in (w.strip(".,;:!?\"'()[]{}").lower() for w in (value or "").split()) if x]


def test_registered_decontamination_finds_every_item(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    grams = defaultdict(set)
    for r in items:
        w = plain(r.text)
        for k in range(len(w) - 7):
            grams[tuple(w[k : k + 8])].add(r.item_id)
    want = set()
    for r in docs:
        w, hits = plain(r.text), defaultdict(set)
        for k in range(len(w) - 7):
            for i in grams.get(tuple(w[k : k + 8]), ()):
                hits[i].add(tuple(w[k : k + 8]))
        want |= {(r.doc_id, i) for i, h in hits.items() if len(h) >= 0.9 * (len(plain(next(x.text for x in items if x.item_id == i))) - 7)}
    got = {(r.doc_id, r.item_id) for r in op6_decontamination(spark, sf_dir).collect()}
    assert want and want <= got
    assert {d for d, _ in got} <= {r.doc_id for r in docs if any(g in set(zip(*[plain(r.text)[k:] for k in range(8)])) for g in grams)}


def test_decontamination_drops_documents_and_keeps_columns(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    hit = {r.doc_id for r in op6_decontamination(spark, sf_dir).collect()}
    left = templates.without_contaminated(docs, items)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - hit


def shared_runs(rows, n):
    """Documents with a run of n words that another one has, too."""
    seen = defaultdict(set)
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - n + 1):
            seen[tuple(w[k : k + n])].add(i)
    return {i for who in seen.values() if len(who) > 1 for i in who}


def test_long_passages_are_found_and_short_ones_are_not(spark):
    chance, rows = random.Random(9), []
    for k in range(40):
        passage = text(chance, 55)
        rows.append((2 * k, text(chance, chance.randint(3, 60)) + " " + passage + " " + text(chance, 30), "", "", 0))
        rows.append((2 * k + 1, text(chance, chance.randint(3, 60)) + "\n" + passage + "  " + text(chance, 9), "", "", 0))
    short = text(chance, 16)
    rows += [(200 + k, text(chance, 60) + " " + " ".join(short.split()[:16]) + " " + text(chance, 60), "", "", 0) for k in range(5)]
    got = {r.doc_id for r in chunk_dedup.repeats(frame(spark, rows)).collect()}
    assert got == set(range(80))


def test_repeats_of_odd_texts_one_document_and_no_rows(spark):
    line = " ".join(f"w{k}" for k in range(70))
    data = [(1, f"{line} {line}"), (2, None), (3, ""), (4, "er " * 90), (5, "x " + "er " * 70), (None, line)]
    rows = spark.createDataFrame([(*r, 1, "y") for r in data], "doc_id long, text string, digest int, at string")
    assert {r.doc_id for r in chunk_dedup.repeats(rows).collect()} == {4, 5}
    assert chunk_dedup.repeats(rows.limit(0)).count() == 0


def test_cutting_repeats_leaves_the_first(spark):
    line = " ".join(f"é{k}" for k in range(80))
    rows = [(2, f"before {line} behind", "", "", 0), (1, line, "", "", 0), (3, None, "", "", 0), (None, line, "", "", 0)]
    got = {r.doc_id: r.text for r in chunk_dedup.without_repeats(frame(spark, rows)).collect()}
    assert got[1] == line and got[3] is None and got[None] == line
    assert got[2].startswith("before") and got[2].endswith("behind") and len(got[2].split()) < 30


def test_registered_repeats_on_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id for r in op7_substring_dedup(spark, sf_dir).collect()}
    assert shared_runs(rows, 51) <= got <= shared_runs(rows, 12)
