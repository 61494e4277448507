from datetime import date, datetime
from itertools import permutations
from math import inf

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry import model
from docketry.operators import attribution, balance, ensembles, features, metrics, sampling
from docketry.operators.running import running_totals
from docketry.plans import scoring, training
from docketry.sources.workspace import checkpointed, new_folder, stored


def case(i, year=2012, **changes):
    return {
        "ddl_case_id": f"c{i}", "case_age_days": 100 + i, "filing_year": year, "hearing_span_days": i % 7,
        "delay_category": "Fast", "judge_position": "a", "case_type": "civil", "petitioner_gender": "male",
        "date_of_filing": date(year, 1 + i % 12, 1), "is_resolved": i % 2, **changes,
    }


CASE_DDL = (
    "ddl_case_id string, case_age_days int, filing_year int, hearing_span_days int, delay_category string, "
    "judge_position string, case_type string, petitioner_gender string, date_of_filing date, is_resolved int"
)


def cases(spark, rows):
    return spark.createDataFrame(rows, CASE_DDL)


def test_running_totals_cross_ranges(spark):
    n = 5000
    frame = spark.range(n, numPartitions=7).select((F.col("id") * 37 % n).alias("k"), F.lit(2).alias("v"))
    got = running_totals(frame.withColumn("one", F.lit(1)), ["k"], {"v": "before", "one": "place"})
    assert got.filter("before <> 2 * k OR place <> k").count() == 0 and got.count() == n


def test_running_totals_move_the_rows_once(spark):
    from decimal import Decimal

    frame = spark.range(0, 3000, 1, 5).select(
        (F.col("id") * 7 % 3000).alias("k"), F.when(F.col("id") % 4 > 0, F.col("id").cast("decimal(10,2)")).alias("d"), (F.col("id") / 8).alias("x")
    )
    got = running_totals(frame, ["k"], {"d": "before_d", "x": "before_x"})
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Window" not in text  # the sort before the checkpoint is the only one
    total_d, total_x = Decimal(0), 0.0
    for r in got.orderBy("k").collect():
        assert (r["before_d"], r["before_x"]) == (total_d, total_x)
        total_d, total_x = total_d + (r["d"] or 0), total_x + r["x"]
    assert running_totals(frame.limit(0), ["k"], {"d": "before"}).count() == 0


def test_yearly_cap_counts_and_repeats(spark):
    # Half of one year are copies of one row, and one year has fewer rows than the cap.
    rows = [case(i, 2012) for i in range(300)] + [case(0, 2012)] * 300 + [case(i, 2013) for i in range(20)]
    frame = cases(spark, rows).repartition(5)
    capped = sampling.yearly_cap(frame, 100)
    assert sorted(map(tuple, capped.groupBy("filing_year").count().collect())) == [(2012, 100), (2013, 20)]
    again = sampling.yearly_cap(frame.repartition(3), 100)
    assert sorted(map(str, capped.collect())) == sorted(map(str, again.collect()))
    assert capped.exceptAll(frame).count() == 0
    whole = sampling.yearly_cap(frame, 100_000)
    assert whole.count() == 620 and frame.exceptAll(whole).count() == 0


def test_cap_within_copies(spark):
    rows = [case(0, 2012)] * 50 + [case(0, 2013)] * 5
    capped = sampling.yearly_cap(cases(spark, rows), 10)
    assert sorted(map(tuple, capped.groupBy("filing_year").count().collect())) == [(2012, 10), (2013, 5)]


def test_splits(spark):
    frame = cases(spark, [case(i, 2010 + i % 9) for i in range(900)])
    by_time = sampling.split_cases(frame, 2015, 2017)
    years = {(r[0], r[1]) for r in by_time.select("split", "filing_year").distinct().collect()}
    assert ("train", 2015) in years and ("validation", 2016) in years and ("test", 2018) in years
    # No year after 2017: the same rows are split by hash, none is lost.
    early = frame.filter("filing_year <= 2016")
    by_hash = sampling.split_cases(early, 2015, 2017)
    sizes = {r["split"]: r["count"] for r in by_hash.groupBy("split").count().collect()}
    assert sum(sizes.values()) == early.count() and 0.6 < sizes["train"] / early.count() < 0.8


def test_labels_and_features(spark):
    train = cases(spark, [case(0, judge_position="b"), case(1, judge_position="a"), case(2, judge_position=None)])
    labels = stored(features.fit_labels(train), new_folder(spark, "labels"))
    codes = {(r[0], r[1]): r[2] for r in labels.select("label_column", "label", "code").collect()}
    assert codes == {
        ("judge_position", "a"): 0, ("judge_position", "b"): 1, ("judge_position", "unknown"): 2,
        ("case_type", "civil"): 0}
    new = cases(spark, [
        case(0, judge_position="zz", case_type=None, hearing_span_days=None, delay_category="Stuck",
             petitioner_gender="unknown", date_of_filing=date(2012, 3, 4)),
        case(1, judge_position=None, delay_category="?", petitioner_gender=None),
    ])
    rows = features.add_features(new, features.label_lookups(labels)).orderBy("ddl_case_id").collect()
    assert [rows[0][f] for f in model.FEATURES] == [2012, 3, 6, 0, 3, -1, -1, -1]
    assert [rows[1][f] for f in model.FEATURES][4:] == [0, 0, 2, 0]


def points(spark, n, seed):
    rng = np.random.default_rng(seed)
    vectors = np.unique(rng.integers(0, 9, size=(n, len(balance.SEARCH_ORDER))), axis=0).tolist()
    frame = spark.createDataFrame([tuple(v) for v in vectors], ", ".join(f"{c} int" for c in balance.SEARCH_ORDER))
    return balance.distinct_points(frame.repartition(4)), np.array(vectors)


@pytest.mark.parametrize("n", [3, 40, 900])
def test_neighbours_equal_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(balance, "BLOCK_POINTS", 64)
    frame, vectors = points(spark, n, n)
    got = {(r["point"], r["place"]): r["near"] for r in balance.nearest_points(frame, 5).collect()}
    d = ((vectors[:, None, :] - vectors[None, :, :]) ** 2).sum(axis=2).astype(float)
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    want = {(i, k + 1): order[i, k] for i in range(len(d)) for k in range(min(5, len(d) - 1))}
    assert got == want


def test_no_candidate_lies_behind_the_reach_of_its_point(spark, monkeypatch):
    """What a search writes out is bounded by each point's k-th distance in its own block, not by the blocks it visits."""
    monkeypatch.setattr(balance, "BLOCK_POINTS", 64)
    frame, vectors = points(spark, 900, 1)
    blocks = balance._point_blocks(frame, 5)
    reach = {p: r for b in blocks.collect() for p, r in zip(b["points"], b["reaches"])}
    got = balance._candidates(blocks, 5).collect()
    assert all(r["distance"] <= reach[r["point"]] for r in got)
    d = ((vectors[:, None, :] - vectors[None, :, :]) ** 2).sum(axis=2).astype(float)
    np.fill_diagonal(d, np.inf)
    asked = {}
    for r in got:
        assert r["distance"] == d[r["point"], r["near"]]
        asked.setdefault(r["point"], set()).add(r["near"])
    assert all(set(np.argsort(d[i], kind="stable")[:5]) <= asked[i] for i in range(len(d)))
    assert len(got) < 5 * len(d) * blocks.count() / 2


def test_smote_balances_between_neighbours(spark):
    rows = [
        {"filing_year": 2010 + i % 3, "filing_month": i % 12, "filing_day_of_week": i % 7, "hearing_span_days": i,
         "delay_cat_encoded": 1, "gender_encoded": -1, "judge_encoded": i % 2, "case_type_encoded": 0,
         "is_resolved": int(i < 9)}
        for i in range(61)
    ]
    frame = spark.createDataFrame(rows)
    got = balance.smote_balance(frame).cache()
    counts = {(r[0], r[1]): r[2] for r in got.groupBy("is_resolved", "synthetic").count().collect()}
    assert counts == {(0, 0): 52, (1, 0): 9, (1, 1): 43}
    made = got.filter("synthetic = 1").toPandas()
    assert made["hearing_span_days"].between(0, 8).all() and (made["gender_encoded"] == -1).all()
    whole = made.drop(columns=["hearing_span_days"])
    assert (whole == whole.round()).all().all()
    assert (made["hearing_span_days"] != made["hearing_span_days"].round()).any()
    got.unpersist()


def test_smote_of_copies_and_of_one_row(spark):
    base = {f: 3 for f in model.FEATURES}
    hot = [{**base, "is_resolved": 1}] * 20 + [{**base, "filing_month": i, "is_resolved": 0} for i in range(50)]
    got = balance.smote_balance(spark.createDataFrame(hot))
    assert got.filter("synthetic = 1").distinct().count() == 1  # all neighbours are copies
    assert got.filter("is_resolved = 1").count() == 50
    single = spark.createDataFrame(hot[19:])
    assert balance.smote_balance(single).filter("is_resolved = 1").count() == 50


def test_metrics(spark):
    rows = [(1, 0.9, 1), (0, 0.9, 1), (1, 0.4, 0), (0, 0.1, 0), (0, 0.2, 0)]
    got = metrics.classification_metrics(spark.createDataFrame(rows, "y int, s double, p int"), "y", "s", "p").first()
    assert got.asDict() == {"accuracy": 0.6, "precision": 0.5, "recall": 0.5, "f1_score": 0.5, "roc_auc": 0.75}
    none = spark.createDataFrame([(1, 0.2, 0), (0, 0.1, 0)], "y int, s double, p int")
    got = metrics.classification_metrics(none, "y", "s", "p").first()
    assert (got["precision"], got["recall"], got["f1_score"], got["roc_auc"]) == (0.0, 0.0, 0.0, 1.0)
    reg = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    assert metrics.regression_metrics(reg, "y", "p").first().asDict() == {"mae": 0.67, "rmse": 0.82, "r2_score": 0.75}


def game(x, leaves, inside):
    """The value of a coalition: the leaf values weighted by the steps' factors."""
    total = 0.0
    for value, fs, lows, highs, shares in zip(leaves.value, leaves.feature, leaves.low, leaves.high, leaves.share):
        for f, low, high, share in zip(fs, lows, highs, shares):
            value *= (low < x[f] <= high) if f in inside else share
        total += value
    return total


def test_shapley_equals_permutations():
    leaves = attribution.Leaves(
        value=np.array([1.0, -2.0, 4.0]),
        feature=np.array([[0, 1], [0, 1], [0, 2]]),
        low=np.array([[-inf, -inf], [-inf, 3.0], [5.0, -inf]]),
        high=np.array([[5.0, 3.0], [5.0, inf], [inf, inf]]),
        share=np.array([[0.7, 0.4], [0.7, 0.6], [0.3, 1.0]]),
    )
    x = np.array([[4.0, 2.0, 9.0], [6.0, 3.5, 0.0]])
    got = attribution.shapley_matrix(x, leaves)
    for row, values in zip(x, got):
        want, orders = np.zeros(3), list(permutations(range(3)))
        for order in orders:
            for i, f in enumerate(order):
                want[f] += game(row, leaves, set(order[: i + 1])) - game(row, leaves, set(order[:i]))
        assert values == pytest.approx(want / len(orders))


def test_tables_of_attributions_equal_the_formula():
    rng = np.random.default_rng(2)
    width, games = 4, 60
    feature = np.array([rng.permutation(6)[:width] for _ in range(games)])
    low, high = rng.integers(0, 5, (games, width)).astype(float), rng.integers(5, 9, (games, width)).astype(float)
    share = rng.random((games, width))
    low[rng.random((games, width)) < 0.3], high[rng.random((games, width)) < 0.3] = -inf, inf
    # Some paths are shorter, some have no step at all, and some steps are those of all training rows.
    for short in range(20):
        feature[short, short % 5 :], low[short, short % 5 :], high[short, short % 5 :], share[short, short % 5 :] = 0, -inf, inf, 1.0
    share[20:25, 0] = 1.0
    leaves = attribution.Leaves(rng.normal(size=games), feature, low, high, share)
    x = np.vstack([rng.integers(-1, 11, (200, 6)), rng.random((50, 6)) * 9]).astype(float)
    assert attribution.Explainer(leaves, 6).values(x) == pytest.approx(attribution.shapley_matrix(x, leaves), abs=1e-12)


def test_all_training_rows_fit_the_classifiers(spark):
    n = 100_300  # more than the cap of a year was
    of = {
        "ddl_case_id": F.concat(F.lit("c"), F.col("id")), "case_age_days": F.lit(9), "hearing_span_days": (F.col("id") % 700).cast("int"),
        "filing_year": F.when(F.col("id") < n, 1998).when(F.col("id") == n, 1999).otherwise(2001), "delay_category": F.lit("Fast"),
        "judge_position": F.lit("a"), "case_type": F.lit("civil"), "petitioner_gender": F.lit("male"),
        "date_of_filing": F.lit(date(1998, 1, 5)), "is_resolved": F.lit(1),
    }
    rows = spark.range(n + 2).select(*[c.alias(name) for name, c in of.items()])
    data = training.prepare(rows, new_folder(spark, "whole"), training.Settings(1998, 2000))
    assert data.balanced.count() == data.train.count() == n
    bounded = training.prepare(rows, new_folder(spark, "bounded"), training.Settings(1998, 2000, rows_per_year=50))
    assert bounded.balanced.count() == 50 and bounded.train.count() == n


def test_thresholds_of_the_forest_come_from_all_rows(spark):
    """A threshold that few rows tell, which a sample of Spark's size hardly ever has."""
    n = 70_000
    value = F.when(F.col("id") < 3, 500 + F.col("id")).otherwise(F.col("id") % 2)
    flat = {f: F.lit(0.0).alias(f) for f in model.FEATURES if f != "hearing_span_days"}
    rows = spark.range(0, n, 1, 4).select(
        value.cast("double").alias("hearing_span_days"), *flat.values(), F.when(F.col("id") == 1, 1).otherwise(0).alias("is_resolved")
    )
    learner = training.RandomForestClassifier(
        labelCol="is_resolved", seed=1, maxBins=100, numTrees=5, maxDepth=3, bootstrap=False, featureSubsetStrategy="all"
    )
    scored = training.with_score(training.learned(learner, rows, "is_resolved"), rows)
    high = {r["hearing_span_days"]: r["score"] for r in scored.filter("hearing_span_days >= 500").collect()}
    assert high == {500.0: 0.0, 501.0: 1.0, 502.0: 0.0}


@pytest.fixture(scope="module")
def trained(spark, facts):
    root = new_folder(spark, "small")
    stored(facts, f"{root}/facts")
    settings = training.Settings(1998, 2000, rounds=3, trees=3, explained_rows=25)
    return root, training.train_models(facts, root, settings, datetime(2024, 1, 1))


def test_comparison_has_all_models(trained):
    rows = {r["model_name"]: r for r in trained[1]["model_comparison"].collect()}
    assert len(rows) == 6
    assert rows["Random Forest"]["mae"] is None and rows["Random Forest"]["roc_auc"] is not None
    assert rows["Gradient Boosting (depth 6) (Regression)"]["accuracy"] is None


def test_importance_counts_splits(spark, trained):
    rows = {r["feature"]: r["importance"] for r in trained[1]["feature_importance"].collect()}
    entry = training.latest_model(training.read_registry(spark, trained[0]))
    splits = spark.read.parquet(entry["model_path"]).filter("feature IS NOT NULL").count()
    assert set(rows) == set(model.FEATURES) and sum(rows.values()) == splits


def test_registered_model_is_grown_by_leaves(spark, trained):
    entry = training.latest_model(training.read_registry(spark, trained[0]))
    leaves = spark.read.parquet(entry["model_path"]).filter("feature IS NULL AND tree >= 0").groupBy("tree").count().collect()
    assert len(leaves) == 3 and 16 < max(r["count"] for r in leaves) <= 31


def test_shapley_adds_up_to_the_margin(spark, trained):
    entry = training.latest_model(training.read_registry(spark, trained[0]))
    fitted = ensembles.read_ensemble(spark, entry["model_path"], model.FEATURES)
    leaves = attribution.leaves_of(fitted)
    rows = spark.read.parquet(f"{trained[0]}/models/{entry['model_version']}/features").limit(40)
    scored = training.with_score(fitted, rows).select("ddl_case_id", F.log(F.col("score") / (1 - F.col("score"))))
    want = dict(map(tuple, scored.collect()))
    values = attribution.shapley_values(rows, leaves)
    total = sum((F.col(f"shap_{f}") for f in model.FEATURES), F.lit(leaves.base + fitted.base))
    got = dict(map(tuple, values.select("ddl_case_id", total).collect()))
    assert got == pytest.approx(want, abs=1e-6) and len(got) == 40


def test_summary_of_attributions(trained):
    rows = trained[1]["shap_summary"].collect()
    means = [r["mean_abs_shap"] for r in rows]
    assert len(rows) == len(model.FEATURES) and means == sorted(means, reverse=True)


def test_lineup_and_newest_model(spark, facts, trained):
    root = trained[0]
    registry = training.read_registry(spark, root)
    entry = training.latest_model(registry)
    lineup = scoring.daily_lineup(facts, entry, date(2004, 1, 1)).cache()
    assert lineup.columns == model.LINEUP_COLUMNS
    assert lineup.count() == scoring.pending_candidates(facts).count()
    wrong = "(resolution_probability >= 0.5) <> (predicted_outcome = 'DISPOSE') OR prediction_date <> '2004-01-01'"
    assert lineup.filter(wrong).count() == 0
    counters = scoring.lineup_counters(lineup).first()
    assert counters["total_predictions"] == counters["dispose_count"] + counters["adjourn_count"]
    lineup.unpersist()

    older = registry.withColumns({"trained_on": F.lit(datetime(2023, 1, 1)), "model_version": F.lit("old")})
    assert training.latest_model(registry.unionByName(older))["model_version"] == entry["model_version"]
    with pytest.raises(LookupError):
        training.latest_model(registry.limit(0))


def test_scoring_does_not_move_the_facts(spark, facts, trained):
    entry = training.latest_model(training.read_registry(spark, trained[0]))
    text = scoring.daily_lineup(facts, entry, date(2004, 1, 1))._jdf.queryExecution().executedPlan().toString()
    fact_side = text[: text.index("BroadcastExchange")]
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in fact_side


def test_checkpoints_are_reliable(spark):
    plan = checkpointed(spark.range(10))._jdf.queryExecution().toString()
    assert "ExistingRDD" in plan
    assert spark.sparkContext.getCheckpointDir() is not None
