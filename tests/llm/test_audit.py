from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import re
from fixtures import documents, frame
from pyspark.sql import functions as F

from docketry.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    """All orders and steps, one document after the other."""
    firsts = {}
    for i, t, *_ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    fails = []
    for i, t, lang, *_ in rows:
        t = t or ""
        words = WORD.findall(t)
        found = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > firsts[t],
        }
        fails.append((lang or "", {k for k, v in found.items() if v}, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {f[0] for f in fails}:
        mine = [f[1:] for f in fails if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [f for f in mine if name in f[0] and not f[0] & before]
                out[part, order, step] = (
                    sum(not f[0] & (before | {name}) for f in mine), len(here), sum(name in f[0] and bool(f[0] & before) for f in mine),
                    sum(f[0] == {name} for f in mine), sum(f[1] for f in here), sum(f[2] for f in here),
                )
                shapley[part, name] += len(here)
    return sorted((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items())


LABELS = "doc_id long, quality int, toxic int"


def test_all_orders_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 3000)
    rows = documents()
    rows += [(None, rows[0][1], "en", "s", 0), (None, None, None, "s", 0), (7, rows[0][1], None, None, 0), (500, "$ " * 200, "en", "s", 0),
             (501, "WORD Of Capitals " * 40, "", "s", 0), (502, "\x0b\x1c x", "xx", "s", 0)]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 90, 3)] + [(3, 1, None), (None, 1, 1), (9, None, 1)]
    docs = frame(spark, rows).withColumns({"n_words": F.lit("x"), "mask": F.lit(1), "shard": F.lit(2), "good": F.lit(3)}).repartition(4)
    got = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS).withColumn("part", F.lit("z")))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == brute(rows, labels)


def test_matrix_holds_the_counts_of_all_words(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 2000)
    rows = documents()
    docs = frame(spark, rows).withColumn("row", F.monotonically_increasing_id())
    texts = {r.row: r.text or "" for r in docs.collect()}
    ids, matrix = filter_audit.term_matrix(docs, F.coalesce("text", F.lit("")), {"row": F.col("row"), "words": F.col("lang")})
    names = {r.id: r.word for r in ids.collect()}
    assert sorted(names) == list(range(len(names))) and len(set(names.values())) == len(names)
    shards = matrix.collect()
    assert len(shards) > 3 and len({s.shard for s in shards}) == len(shards)
    found = {}
    for s in shards:
        for k, row in enumerate(s.row):
            cells = slice(s.starts[k], s.starts[k + 1])
            assert list(s.ids[cells]) == sorted(set(s.ids[cells]))
            found[row] = dict(zip((names[i] for i in s.ids[cells]), s.counts[cells], strict=True))
    assert found == {row: dict(Counter(WORD.findall(t))) for row, t in texts.items()}


def test_rows_of_texts_without_words():
    starts, places, counts, words = filter_audit.compressed_rows(pa.array(["", " \t", "b a b", "", "a"]))
    assert starts.tolist() == [0, 0, 0, 2, 2, 3] and counts.tolist() == [2, 1, 1]
    assert [words[i].as_py() for i in places] == ["b", "a", "a"]


def test_no_documents_and_no_labels(spark):
    docs, labels = frame(spark), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    lost = filter_audit.audit(docs, labels).agg(F.sum(F.col("good_lost") + F.col("toxic_lost"))).first()[0]
    assert lost == 0


def test_numbers_are_packed_and_unpacked():
    for numbers in ([], [0], [1, 70_000, 2**31 - 1, 5] * 100):
        assert filter_audit.unpacked(filter_audit.packed(np.array(numbers, np.int64))).tolist() == numbers


def test_words_are_numbered_in_groups(spark, monkeypatch):
    """Small groups in the tasks that number words leave the ids as whole as large ones."""
    monkeypatch.setattr(filter_audit, "FLUSH_ROWS", 7)
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 500)
    docs = frame(spark)
    ids, matrix = filter_audit.term_matrix(docs, F.coalesce("text", F.lit("")), {"doc": F.col("doc_id")})
    names = [r.word for r in ids.orderBy("id").collect()]
    assert sorted(names) == sorted({w for _, t, *_ in documents() for w in WORD.findall(t or "")})
    found = Counter()
    for s in matrix.collect():
        for i, n in zip(s.ids, s.counts, strict=True):
            found[names[i]] += n
    assert found == Counter(w for _, t, *_ in documents() for w in WORD.findall(t or ""))
