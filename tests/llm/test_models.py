"""Search, mixing, and the learnt operators."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import documents, frame, text
from pyspark.sql import functions as F

from docketry.llm import attention, attention_lm, mixing, site_quality, toxicity, vp_search
from docketry.llm.queries import (
    op3_vector_search, op4_site_quality, op5_mixing, op9_lm_scoring, op10_toxicity, tokenizer,
)

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def nearest(rows, k=20):
    """(query, rank, id) by comparing all usable rows."""
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = min(good.get(i, v), v)
    ids = sorted(good)
    x = np.array([good[i] for i in ids], float)
    out = []
    for q in [i for i in ids if i % 20 == 0]:
        score = vp_search.dot(np.repeat(x[[ids.index(q)]], len(ids), axis=0), x)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out += [(q, r + 1, ids[j], score[j]) for r, j in enumerate(order)]
    return out


def vectors(spark, rows, kind="double"):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int, score string")


def test_factor_one_is_exact_on_ties_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vp_search, "SHARD", 64)
    monkeypatch.setattr(vp_search, "BLOCK", 4)
    monkeypatch.setattr(vp_search, "LEAF", 8)
    chance = np.random.default_rng(4)
    rows = [(i, [float(x) for x in chance.integers(-2, 3, 6)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 0, 0, 2.0, 0, 0]) for i in range(120)]
    rows += [(2000, None), (2020, [0.0] * 6), (2040, [1.0, None, 0, 0, 0, 0]), (2060, [float("nan")] * 6), (None, [1.0] * 6)]
    rows += [(2080, [float("inf")] * 6), (40, rows[40][1]), (-20, [3.0] * 6), (2100, [])]
    got = vp_search.search(vectors(spark, rows), "vec_id % 20 = 0", relax=1.0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(nearest(rows))


def test_fewer_candidates_than_wanted_no_rows_and_mixed_lengths(spark):
    got = vp_search.search(vectors(spark, [(0, [1.0, 2.0]), (1, [2.0, 0.0])]), "vec_id % 20 = 0").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2.0)]
    assert vp_search.search(vectors(spark, []), "vec_id % 20 = 0").count() == 0
    assert vp_search.search(vectors(spark, [(1, [1.0])]), "vec_id % 20 = 0").count() == 0
    # Vectors that have not as many components as most take no part, as queries or as candidates.
    mixed = [(0, [1.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0]), (20, [2.0, 1.0]), (40, [5.0, 5.0, 5.0])]
    got = vp_search.search(vectors(spark, mixed), "vec_id % 20 = 0").collect()
    assert sorted(map(tuple, got)) == [(20, 1, 2, 7.0), (20, 2, 1, 4.0)]
    even = vp_search.search(vectors(spark, [(0, [1.0]), (20, [2.0]), (1, [1.0, 2.0]), (40, [1.0, 1.0])]), "vec_id % 20 = 0")
    assert [tuple(r) for r in even.collect()] == [(40, 1, 1, 3.0)]


def test_registered_search_finds_nearly_all(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, got = nearest(rows), op3_vector_search(spark, sf_dir)
    exact = spark.createDataFrame([(a, b, c, float(d)) for a, b, c, d in want], "query_id long, rank int, vec_id long, score double")
    assert vp_search.recall(got, exact) >= 0.97
    mine = {(r.query_id, r.vec_id): r.score for r in got.collect()}
    assert all(abs(mine[q, v] - s) < 1e-12 for q, _, v, s in want if (q, v) in mine)


def filled(sizes, weights, cap):
    """Targets by sharing again and again what is above a cap."""
    total, capped = sum(sizes), set()
    target = [0.0] * len(sizes)
    while True:
        left = total - sum(cap * sizes[k] for k in capped)
        open_ = [k for k in range(len(sizes)) if k not in capped]
        whole = sum(weights[k] for k in open_)
        for k in open_:
            target[k] = left * weights[k] / whole
        over = {k for k in open_ if target[k] > cap * sizes[k]}
        for k in over:
            target[k] = cap * sizes[k]
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 1000, 5, 0, 70], [10], [3, 900, 2, 1, 4, 800, 0]])
def test_targets_are_shared_until_none_is_above(spark, sizes):
    names = [*[f"s{k}" for k in range(len(sizes) - 1)], None]
    rows = spark.createDataFrame([(n, s) for n, s in zip(names, sizes, strict=True)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(rows, (1, 2, 3), 3.0).collect()}
    want = filled(sizes, [(1, 2, 3)[k % 3] for k in range(len(sizes))], 3.0)
    assert [got[n] for n in names] == pytest.approx(want)


def test_flight_keeps_both_totals_and_landing_settles_all():
    chance = np.random.default_rng(0)
    for n in (1, 2, 3, 40, 500):
        pi, size = chance.random(n), chance.integers(0, 5000, n)
        moved = mixing.flight(mixing.spread(pi, size, np.argsort(-size)[:20].tolist(), chance), size, chance)
        assert ((moved > 0) & (moved < 1)).sum() <= 2
        assert moved.sum() == pytest.approx(pi.sum()) and moved @ size == pytest.approx(pi @ size, rel=1e-6)
        assert set(np.unique(mixing.landing(moved, size, chance))) <= {0.0, 1.0}


def test_inclusion_probabilities_hold_on_average():
    size = np.array([900, 10, 20, 30, 40, 50, 5, 8, 70, 1])
    pi, total = np.full(10, 0.3), np.zeros(10)
    for k in range(4000):
        chance = np.random.default_rng(k)
        total += mixing.landing(mixing.flight(mixing.spread(pi, size, range(10), chance), size, chance), size, chance)
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def word_count(value):
    return len(WORD.findall((value or "").encode()))


def test_plan_has_every_row_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "LONGEST", 3)
    rows = [(i, t, l, s, n) for i, t, l, s, n in documents(8, 200)]
    first = sorted(map(tuple, mixing.plan(frame(spark, rows)).collect()), key=str)
    again = sorted(map(tuple, mixing.plan(frame(spark, rows).repartition(5)).collect()), key=str)
    assert first == again
    assert sorted((i, s) for i, s, *_ in first) == sorted((i, word_count(t)) for i, t, *_ in rows)
    sources = {}
    for i, size, source_size, target, taken in first:
        assert taken <= 3 * size and (size == 0 or taken % size == 0)
        sources.setdefault((source_size, target), []).append(taken)
    longest = max(s for _, s, *_ in first if s < 3000)
    assert all(abs(sum(t) - target) <= 2 * longest for (_, target), t in sources.items() if target < 3000)


def test_mix_repeats_whole_rows(spark):
    data = frame(spark, documents(8, 200)).withColumn("taken", F.lit("x")).withColumn("row", F.lit(1))
    out = mixing.mix(data)
    assert out.columns == data.columns
    counts = Counter(tuple(r) for r in out.collect())
    have = Counter(tuple(r) for r in data.collect())
    assert set(counts) <= set(have) and all(n <= 3 * have[r] for r, n in counts.items())
    empty = data.limit(0)
    assert mixing.mix(empty).count() == 0 and mixing.plan(empty).count() == 0


def test_registered_mixing_on_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = op5_mixing(spark, sf_dir).collect()
    assert sorted((r.doc_id, r["size"]) for r in got) == sorted((r.doc_id, word_count(r.text)) for r in rows)
    of = {r.doc_id: r.source for r in rows}
    names = sorted({r.source for r in rows})
    sizes = [sum(word_count(r.text) for r in rows if r.source == n) for n in names]
    want = dict(zip(names, filled(sizes, [(1, 2, 3)[k % 3] for k in range(len(names))], 3.0), strict=True))
    assert all(r.target == pytest.approx(want[of[r.doc_id]]) for r in got)
    # Words and documents of each source come near what its target asks for, and no document is split.
    for name, whole in zip(names, sizes, strict=True):
        mine = [r for r in got if of[r.doc_id] == name]
        share = want[name] / whole
        times = [r.taken / r["size"] for r in mine if r["size"]]
        assert all(t in (math.floor(share), math.ceil(share)) or t == round(share) for t in times)
        assert abs(sum(r.taken for r in mine) - want[name]) <= max(r["size"] for r in mine)
        assert abs(sum(times) - share * len(times)) <= 2


def labelled(spark, rows, column="toxic"):
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t, _ in rows], "doc_id long, text string, score double, held_out int")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], f"doc_id long, {column} int")


def identity_rows(chance, n=600):
    """Insults make a text toxic; in the labelled rows they come mostly with the name of one group."""
    rows = []
    for k in range(n):
        bad = k % 3 == 0
        group = "muslims" if bad and chance.random() < 0.9 else ("christians" if chance.random() < 0.2 else "")
        insult = "filthyvermin" if bad and chance.random() < 0.8 else ""
        rows.append((k, f"{text(chance, 12)} {insult} {group} {text(chance, 12)}", int(bad)))
    return rows


def test_swapped_groups_get_equal_scores(spark):
    import random

    docs, labels = labelled(spark, identity_rows(random.Random(1)))
    base = toxicity.fit(docs, labels, toxicity.Settings(counterfactual=0.0))
    fair = toxicity.fit(docs, labels, toxicity.Settings(counterfactual=5.0))
    mild = "we met some {} at the market"
    gap = {n: m.score(mild.format("muslims")) - m.score(mild.format("hindus")) for n, m in (("base", base), ("fair", fair))}
    assert gap["fair"] < 0.5 * gap["base"] and fair.score("filthyvermin all of them") > 0.5


def test_toxicity_of_odd_rows(spark):
    docs, labels = labelled(spark, [(1, None, 1), (2, "", 0), (None, "x", 1), (4, "y", None)])
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "held_out", "score"] and got.count() == 4
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert 0 < toxicity.fit(docs.limit(0), labels.limit(0)).score("a") < 1
    kept = toxicity.without_toxic(docs, toxicity.Model({"y": (9.0, 0.0)}, -3.0), 0.7)
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "2", "None"]


def test_registered_toxicity_learns_without_the_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = op10_toxicity(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert len(got) == docs and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) >= 0.93
    assert not any(a for a, b in held if b == 0) or sum(a for a, b in held if b == 0) <= 2


def test_sparse_places_are_drawn_towards_the_whole(spark):
    rows = [("big", "p", 3.0)] * 200 + [("bad", "p", -3.0)] * 200 + [("tiny", "p", -3.0), (None, None, 0.0), ("big", "q", 3.0)]
    data = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id long, host string, path string, margin double")
    got = {r.id: r for r in site_quality.posterior(data, 0.5).collect()}
    assert len(got) == len(rows)
    assert got[0].score > 0.95 > 0.05 > got[200].score
    assert 0.3 < got[400].host_mean < 0.7  # its own evidence does not count
    assert got[402].path_mean > 0.6  # a path without others follows its host


def pulled(groups, mean_of, total):
    """Weight of the mean above, from groups of (sum, number)."""
    q = sum(n * (s / n - mean_of[k]) ** 2 / max(mean_of[k] * (1 - mean_of[k]), 1e-6) for k, (s, n) in groups.items())
    if len(groups) < 2 or total <= len(groups):
        return 10.0
    alike = (q - len(groups)) / max(1e-9, total - sum(n * n for _, n in groups.values()) / total)
    alike = min(0.999, max(1e-4, alike))
    return (1 - alike) / alike


def plain_posterior(rows, share):
    """{id: (host_mean, path_mean, score)} by going over all rows for each group."""
    p = {k: 1 / (1 + math.exp(-m)) for k, _, _, m in rows}
    places, hosts = {}, {}
    for k, host, path, _ in rows:
        for groups, name in ((places, (host, path)), (hosts, host)):
            s, n = groups.get(name, (0.0, 0))
            groups[name] = (s + p[k], n + 1)
    mean = (sum(p.values()) + share) / (len(rows) + 1)
    by_host = pulled(hosts, dict.fromkeys(hosts, mean), len(rows))
    host_mean = {k: (s + by_host * mean) / (n + by_host) for k, (s, n) in hosts.items()}
    by_path = pulled(places, {k: host_mean[k[0]] for k in places}, len(rows))
    out = {}
    for k, host, path, margin in rows:
        s, n = hosts[host]
        h = (s - p[k] + by_host * mean) / (n - 1 + by_host)
        s, n = places[host, path]
        q = (s - p[k] + by_path * h) / (n - 1 + by_path)
        kept = min(max(q, 1e-6), 1 - 1e-6)
        logit = margin - math.log(share / (1 - share)) + math.log(kept / (1 - kept))
        out[k] = (h, q, 1 / (1 + math.exp(-logit)))
    return out


@pytest.mark.parametrize("n", [1, 2, 5, 400])
def test_posteriors_are_those_of_plain_sums(spark, n):
    chance = np.random.default_rng(n)
    hosts, paths = [None, "a", "b", "c", "d"], [None, "x", "y"]
    lean = {h: float(chance.normal()) for h in hosts}
    rows = []
    for k in range(n):
        host, path = hosts[min(int(chance.integers(0, 9)), 4)], paths[int(chance.integers(0, 3))]
        rows.append((k, host, path, lean[host] + float(chance.normal())))
    data = spark.createDataFrame(rows, "id long, host string, path string, margin double")
    got = {r.id: (r.host_mean, r.path_mean, r.score) for r in site_quality.posterior(data, 0.3).collect()}
    want = plain_posterior(rows, 0.3)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_quality_of_odd_rows(spark):
    docs, labels = labelled(spark, [(1, None, 1), (2, "", 0), (3, "a | b %%% " * 2000, 1), (None, "x", None)], "quality")
    docs = docs.withColumns({"source": F.lit(None).cast("string"), "lang": F.lit("en"), "s": F.lit(1)})
    model = site_quality.fit(docs, labels)
    got = site_quality.score(docs, model)
    assert got.count() == 4 and all(0 <= r.score <= 1 for r in got.collect())
    assert site_quality.score(docs.limit(0), model).count() == 0


def test_hosts_and_paths_of_addresses(spark):
    urls = spark.createDataFrame([("https://a.org/x/y?z",), ("https://a.org",), ("no address",), (None,)], "url string")
    got = urls.select(*site_quality.host_and_path(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [("a.org", "x"), ("a.org", None), (None, None), (None, None)]


def test_registered_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = op4_site_quality(spark, sf_dir).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count() and sum(held) / len(held) >= 0.97


def counted(rows):
    """Base scores by counting: (id, n_tokens, n_known, N, base)."""
    capitals = bytes(range(65, 91))
    lower = bytes.maketrans(capitals, capitals.lower())
    tokens = [(i, [*WORD.findall((t or "").encode().translate(lower)), None]) for i, t in rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in tokens}
    c = Counter(w for i, x in tokens if not held[i] for w in x)
    n = sum(c.values())
    return [
        (i, held[i], len(x), sum(c[w] > 0 for w in x), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (len(c) + 1))) for w in x))
        for i, x in tokens
    ]


def check_scores(got, rows):
    want = sorted(counted(rows), key=str)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    assert all(g[6] < 0 and math.isfinite(g[6]) for g in got)


def test_base_scores_and_rare_words(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "FREQUENT", 7)
    monkeypatch.setattr(attention_lm, "STEPS", 5)
    rows = documents()
    data = frame(spark).withColumns({"word": F.lit(1), "score": F.lit("x")})
    check_scores(attention_lm.score_documents(data, tokenizer("word_bpe_49k.json")).collect(), [(i, t) for i, t, *_ in rows])


def test_scores_of_null_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "STEPS", 2)
    got = attention_lm.score_documents(frame(spark, [(None, "a b", "", "", 0), (2, None, "", "", 0)]), tokenizer("word_bpe_49k.json"))
    assert sorted((str(r.doc_id), r.n_tokens) for r in got.collect()) == [("2", 1), ("None", 3)]
    assert attention_lm.score_documents(frame(spark, []), tokenizer("word_bpe_49k.json")).count() == 0


def small_model(seed=0):
    chance = np.random.default_rng(seed)
    vocabulary = attention.Vocabulary.from_counts(chance.integers(0, 9, 500).astype(float))
    params = {k: (v + chance.standard_normal(v.shape) * 0.1).astype(np.float32) for k, v in attention.first_params().items()}
    base = attention.neighbour_shares(np.zeros((attention.INPUTS + 1, attention.CLASSES)), np.ones(attention.CLASSES))
    tail = vocabulary.tail_logs(chance.integers(0, 3, (attention.CLASSES + 1) * attention.TAIL))
    return params, base, vocabulary, tail


def test_probabilities_sum_to_one_and_look_back_only():
    model = small_model()
    for before in ([], [3], [3, 499]):
        scores = attention.score(*model, [np.array(before, int), *[np.array([*before, i]) for i in range(500)]])
        assert sum(10 ** (s - scores[0]) for s in scores[1:]) == pytest.approx(1, abs=1e-3)
    ids = np.random.default_rng(1).integers(0, 500, 200)
    whole = attention.score(*model, [ids[:90], ids[:91], ids])
    assert whole[0] > whole[1] > whole[2]


def plain_score(params, base, vocabulary, tail, ids):
    """log10 probability of a list of ids, place by place, with one window a place, from the definitions alone."""
    p = {k: v.astype(float) for k, v in params.items()}
    hop, total = attention.WINDOW - attention.OVERLAP, 0.0
    inputs = [attention.INPUTS, *vocabulary.of_input[ids[:-1]].tolist()]
    for at, token in enumerate(ids.tolist()):
        begin = 0 if at < attention.WINDOW else (at - attention.OVERLAP) // hop * hop
        e = [p["ids"][inputs[begin + j]] + p["places"][j] for j in range(at - begin + 1)]
        keys, values = [y @ p["kv"][:, : attention.WIDTH] for y in e], [y @ p["kv"][:, attention.WIDTH :] for y in e]
        heat = [math.exp(float(e[-1] @ p["q"] @ k) / math.sqrt(attention.WIDTH)) for k in keys]
        r = e[-1] + sum(w * v for w, v in zip(heat, values, strict=True)) / sum(heat) @ p["o"]
        h = r + np.maximum(r @ p["up"] + p["up_bias"], 0) @ p["down"]
        group, member = divmod(int(vocabulary.of_class[token]), attention.MEMBERS)
        known = base[inputs[at]].astype(float)
        groups = known[0] * np.exp(h @ p["groups"] + p["groups_bias"])
        members = known[1 + group] * np.exp(h @ p["members"][group] + p["members_bias"][group])
        total += math.log(groups[group] / groups.sum()) + math.log(members[member] / members.sum())
        place = vocabulary.of_tail[token]
        before = vocabulary.of_class[ids[at - 1]] if at else attention.CLASSES
        total += tail[before * attention.TAIL + place] if place >= 0 else vocabulary.log_share[token]
    return total / math.log(10)


def test_scores_are_those_of_a_plain_loop():
    params, _, vocabulary, tail = small_model(2)
    chance = np.random.default_rng(5)
    seen = chance.integers(0, 4, (attention.INPUTS + 1, attention.CLASSES)).astype(float)
    base = attention.neighbour_shares(seen, seen.sum(axis=0))
    assert base[:, 0].sum(axis=1) == pytest.approx(np.ones(len(base)), rel=1e-5)
    ids = [chance.integers(0, 500, n) for n in (0, 1, 31, 32, 33, 56, 57, 300)]
    want = [plain_score(params, base, vocabulary, tail, y) if len(y) else 0.0 for y in ids]
    assert attention.score(params, base, vocabulary, tail, ids).tolist() == pytest.approx(want, rel=1e-4)


def test_every_id_is_scored_once():
    vocabulary = small_model()[2]
    for n in (1, 4, 5, 23, 24, 25, 44, 45, 64, 65, 200):
        x, y, start, _ = attention.windows_of([np.arange(n) % 500], vocabulary)
        wanted = (y >= 0) & (np.arange(attention.WINDOW) >= start[:, None])
        assert sorted(y[wanted].tolist()) == sorted((np.arange(n) % 500).tolist())


def test_context_behind_an_edge_and_classes_of_their_own():
    vocabulary = small_model()[2]
    *_, start, _ = attention.windows_of([np.arange(200) % 500], vocabulary)
    assert attention.WINDOW >= 32 and start[0] == 0 and (start[1:] >= 8).all()
    assert (np.bincount(vocabulary.of_class) == 1).sum() >= 224


def test_each_training_id_is_stepped_on_once(spark):
    vocabulary, kind = small_model()[2], np.dtype(np.uint16)
    texts = [np.random.default_rng(n).integers(0, 500, n).astype(kind) for n in (1, 31, 32, 33, 700, 20_000)]
    data = spark.createDataFrame([(n, bytearray(y.tobytes())) for n, y in enumerate(texts)], "seed long, ids binary")
    seen, inputs = np.zeros(attention.CLASSES, int), np.zeros(attention.INPUTS + 1, int)
    for parts in (1, 3):
        for number in range(attention_lm.ROUNDS):
            rows = attention_lm._windows(data, kind, parts, number).collect()
            opens = np.array([r.opens for r in rows], bool)
            x, y, wanted = attention_lm._unpacked([bytes(r.window) for r in rows], opens, kind, vocabulary)
            seen += np.bincount(y[wanted > 0], minlength=attention.CLASSES)
            inputs += np.bincount(x[wanted > 0], minlength=attention.INPUTS + 1)
            assert len(rows) > 100 and {r.part for r in rows} == set(range(parts))
    before = np.concatenate([vocabulary.of_input[y[:-1]] for y in texts])
    assert (seen == 2 * np.bincount(vocabulary.of_class[np.concatenate(texts)], minlength=attention.CLASSES)).all()
    assert inputs[attention.INPUTS] == 12 and (inputs[:-1] == 2 * np.bincount(before, minlength=attention.INPUTS)).all()


def test_counts_of_neighbours_and_tail_are_one_pass(spark, monkeypatch):
    sizes, real = [], attention_lm._summed
    monkeypatch.setattr(attention_lm, "_summed", lambda *given: sizes.append(given[-1]) or real(*given))
    monkeypatch.setattr(attention_lm, "_round", lambda windows, params, *rest: params)
    chance, kind = np.random.default_rng(6), np.dtype(np.uint16)
    texts = [chance.integers(0, 400, n).astype(kind) for n in (0, 1, 2, 90, 400)]
    data = spark.createDataFrame([(n, bytearray(y.tobytes())) for n, y in enumerate(texts)], "seed long, ids binary")
    model = attention_lm.train(data, kind, 500)
    assert len(sizes) == 2
    v, seen = model.vocabulary, np.zeros((attention.INPUTS + 1, attention.CLASSES))
    tail = np.zeros((attention.CLASSES + 1, attention.TAIL))
    for y in (y.tolist() for y in texts):
        for before, token in zip([None, *y], y, strict=False):
            seen[attention.INPUTS if before is None else v.of_input[before], v.of_class[token]] += 1
            if v.of_tail[token] >= 0:
                tail[attention.CLASSES if before is None else v.of_class[before], v.of_tail[token]] += 1
    assert np.array_equal(model.base, attention.neighbour_shares(seen, seen.sum(axis=0)))
    assert np.array_equal(model.tail, v.tail_logs(tail.reshape(-1)))


def test_each_part_of_a_round_is_a_task_and_is_not_sorted(spark, monkeypatch):
    kind, frames = np.dtype(np.uint16), []
    real = type(spark.range(1)).toArrow
    monkeypatch.setattr(type(spark.range(1)), "toArrow", lambda frame: frames.append(frame) or real(frame))
    vocabulary, params = small_model()[2], attention.first_params()
    base = attention.neighbour_shares(np.zeros((attention.INPUTS + 1, attention.CLASSES)), np.ones(attention.CLASSES))
    data = spark.createDataFrame([(1, bytearray((np.arange(9000) % 500).astype(kind).tobytes()))], "seed long, ids binary")
    windows = attention_lm._windows(data, kind, 3, 0)
    found = attention_lm._round(windows, params, base, spark.sparkContext.broadcast(vocabulary), kind, 3, 0)
    assert all(found[k].shape == v.shape and np.isfinite(found[k]).all() for k, v in params.items())
    assert any((found[k] != params[k]).any() for k in params)
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan.replace("SortAggregate", "") and "FlatMapGroups" not in plan


def test_windows_are_slices_of_their_texts(spark):
    chance, kind = np.random.default_rng(8), np.dtype(np.uint16)
    texts = [chance.integers(0, 500, n).astype(kind) for n in (0, 1, 32, 0, 33, 64, 1000, 0)]
    seeds = [5, -(2**63), 2**63 - 1, 0, -1, 7, 7, 9]
    rows = [(n, bytearray(y.tobytes())) for n, y in zip(seeds, texts, strict=True)]
    data = spark.createDataFrame(rows, "seed long, ids binary").coalesce(1)
    got = [r for number in range(attention_lm.ROUNDS) for r in attention_lm._windows(data, kind, 2, number).collect()]
    want = [(k == 0, y[max(0, k - 1) : k + 32].tobytes()) for y in texts for k in range(0, len(y), 32)]
    assert sorted((r.opens, bytes(r.window)) for r in got) == sorted(want)
    assert len({r.mark for r in got}) == len(got) and all(r.part == r.mark % 2 for r in got)
    assert attention_lm._windows(data.limit(0), kind, 2, 0).count() == 0


@pytest.mark.parametrize("n", [1, 7, 8, 40])
def test_training_is_adam_over_the_batches(n):
    params, base, *_ = small_model(3)
    chance = np.random.default_rng(n)
    x = chance.integers(0, attention.INPUTS, (n, attention.WINDOW)).astype(np.int32)
    y = chance.integers(0, attention.CLASSES, x.shape).astype(np.int32)
    wanted = (chance.random(x.shape) < 0.9).astype(np.float32)
    got = attention.train(params, base, x, y, wanted, 3, 0.01, 4, 16)
    p, chance = {k: v.astype(float) for k, v in params.items()}, np.random.default_rng(4)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    order, at = chance.permutation(n), 0
    for t in range(1, 4):
        if at >= n:
            order, at = chance.permutation(n), 0
        some, at = order[at : at + 16], at + 16
        _, grad = attention.step(p, base.astype(float), x[some], y[some], wanted[some])
        for k, g in grad.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p[k] -= 0.01 * min(1.0, t / 20) * first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
    assert all(np.abs(got[k] - p[k]).mean() < 2e-5 and np.abs(got[k] - p[k]).max() < 4e-3 for k in p)


def test_gradients():
    params, base, *_ = small_model()
    params = {k: v.astype(np.float64) for k, v in params.items()}
    chance = np.random.default_rng(3)
    x = chance.integers(0, attention.INPUTS, (2, attention.WINDOW))
    y = chance.integers(0, attention.CLASSES, (2, attention.WINDOW))
    wanted = (chance.random(x.shape) < 0.8).astype(float)
    _, grad = attention.step(params, base.astype(float), x, y, wanted)
    for name in params:
        flat = params[name].reshape(-1)
        at = int(np.abs(grad[name].reshape(-1)).argmax())
        kept, h = flat[at], 1e-4
        flat[at] = kept + h
        up = attention.step(params, base.astype(float), x, y, wanted)[0]
        flat[at] = kept - h
        down = attention.step(params, base.astype(float), x, y, wanted)[0]
        flat[at] = kept
        assert (up - down) / (2 * h) == pytest.approx(grad[name].reshape(-1)[at], rel=2e-2, abs=1e-6), name


def test_registered_scores_on_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check_scores(op9_lm_scoring(spark, sf_dir).collect(), rows)
