import random
import re
import zlib
from collections import Counter

import pytest
from fixtures import documents, frame
from pyspark.sql import functions as F

from docketry.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda v: (-counts[v], v.encode()), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return sorted(out, key=str)


def found(spark, counts, extra=()):
    rows = spark.createDataFrame([*counts.items(), *extra], "word string, n long").withColumn("node", F.lit("x"))
    got = spelling.variants(rows)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("letters,longest", [("ab", 7), ("aé×ÿb", 5), ("abcdefgh", 10)])
def test_near_words_forms_and_roots_equal_brute_force(spark, letters, longest):
    chance = random.Random(len(letters))
    counts = {}
    while len(counts) < 180:
        word = "".join(chance.choice(letters) for _ in range(chance.randint(1, longest)))
        counts[word] = 10 ** chance.randint(0, 5) * chance.randint(1, 3)
        if len(word) > 3:  # and one beside it
            i = chance.randrange(len(word))
            counts[word[:i] + chance.choice(["", *letters]) + word[i + 1 :]] = 10 ** chance.randint(0, 5)
        counts.pop("", None)
    assert found(spark, counts) == brute(counts)


def test_long_words_beginnings_of_words_and_odd_rows(spark):
    long = "".join(random.Random(1).choice("abc") for _ in range(30_000))
    middle = 15_000
    counts = {
        long: 1000, long[:middle] + "x" + long[middle + 1 :]: 3, long[:middle] + long[middle + 1 :]: 2, long + "b": 100, "z" + long: 1,
        "a" * 20: 5, "a" * 21: 60, "a" * 22: 700, "a" * 24: 9, "b": 4, "c": 50, "cb": 3,
    }
    assert found(spark, counts, [(None, 4), ("", 9)]) == brute(counts)


def test_no_words(spark):
    assert found(spark, {}) == []
    assert found(spark, {"single": 3}) == [("single", None, "single", 3, 0, None)]


def by_hand(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_vocabulary_equals_counting_by_hand(spark):
    rows = [*documents(), (None, "Straßenbahnen and straßenbahnen again", "x", "y", 3), (900, "y" * 70_000 + " " + "y" * 70_000, "x", "y", 1)]
    rows += [(1000 + i, "Accommodation ÀCCENTUÉE accommodation", "x", "y", 1) for i in range(200)]
    docs = frame(spark, rows).withColumns({"word": F.lit("w"), "n": F.lit(7), "run": F.lit("r")})
    got = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert got == by_hand(rows) and any(w not in ("accommodation",) and len(w) == 12 for w in got)
    assert spelling.vocabulary(docs.limit(0)).count() == 0
