"""Train, compare, explain and register the models."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from math import inf, isqrt
from uuid import uuid4

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from docketry import model
from docketry.operators import attribution, boosting, features, metrics
from docketry.operators.balance import smote_balance
from docketry.operators.boosting import Boosting
from docketry.operators.ensembles import Ensemble, split_counts
from docketry.operators.sampling import split_cases, yearly_cap
from docketry.sources.sinks import replace_table
from docketry.sources.workspace import side_by_side, stored

DEEP = "Gradient Boosting (depth 6)"
REGISTERED = "Gradient Boosting (31 leaves)"
# Each task of a pass has sums of all nodes, so more tasks are more work.
FOREST_ROWS_OF_A_TASK = 1 << 17

Learner = Estimator | Boosting
Fitted = Model | Ensemble

REGISTRY_DDL = (
    "model_name string, model_version string, trained_on timestamp, f1_score double, roc_auc double, "
    "accuracy double, mae double, rmse double, model_path string, reg_model_path string, encoder_path string"
)
ML_TABLES = ["model_comparison", "feature_importance", "shap_values", "shap_summary"]


@dataclass(frozen=True)
class Settings:
    train_until: int = model.TRAIN_UNTIL
    validate_until: int = model.VALIDATE_UNTIL
    # All training rows fit the classifiers, unless a caller bounds those of a filing year. Nothing else can be capped.
    rows_per_year: int | None = None
    rounds: int = model.BOOSTING_ROUNDS
    trees: int = model.FOREST_TREES
    # The first so many test rows in order of their ids are explained; None for all.
    explained_rows: int | None = None


def by_depth(kind: str, rounds: int) -> Boosting:
    """Trees of bounded depth, with a ridge of 1 and at least curvature 1 on each side."""
    return Boosting(
        kind, rounds, model.BOOSTING_RATE, max_depth=model.BOOSTING_DEPTH, ridge=1.0, least_curvature=1.0, max_bins=256
    )


def by_leaves(kind: str, rounds: int) -> Boosting:
    """Trees of 31 leaves grown best first, with at least 20 rows a leaf; the smaller class weighs as much as the larger one."""
    return Boosting(
        kind, rounds, model.BOOSTING_RATE, max_leaves=model.BOOSTING_LEAVES, least_rows=20, least_curvature=1e-3, max_bins=255,
        balance_classes=kind == "logistic",
    )


def classifiers(balanced_rows: int, settings: Settings) -> dict[str, Learner]:
    """The four classifiers.

    The logistic penalty is one over the row count on unscaled features, which is the usual penalty of strength 1 on the summed
    loss. Trees see up to 256 candidate values per feature.
    """
    return {
        "Logistic Regression": LogisticRegression(
            labelCol="is_resolved", maxIter=model.LOGISTIC_STEPS, regParam=1.0 / balanced_rows, standardization=False
        ),
        "Random Forest": RandomForestClassifier(
            labelCol="is_resolved", seed=model.SEED, maxBins=256, numTrees=settings.trees, maxDepth=model.FOREST_DEPTH
        ),
        DEEP: by_depth("logistic", settings.rounds),
        REGISTERED: by_leaves("logistic", settings.rounds),
    }


def regressors(settings: Settings) -> dict[str, Learner]:
    return {DEEP: by_depth("squares", settings.rounds), REGISTERED: by_leaves("squares", settings.rounds)}


@dataclass(frozen=True)
class TrainingData:
    balanced: DataFrame
    train: DataFrame
    test: DataFrame
    encoder_path: str


def prepare(cases: DataFrame, folder: str, settings: Settings) -> TrainingData:
    """Split, encode and balance; each step is stored, so that a fit reads a fixed table.

    All training rows are balanced. A caller's `rows_per_year` bounds the rows that fit the classifiers; labels, regressors,
    validation and test rows are whole in any case.
    """
    rows = cases.select(*model.TRAINING_COLUMNS)
    parts = split_cases(rows, settings.train_until, settings.validate_until)
    encoder_path = f"{folder}/encoder"
    labels = stored(features.fit_labels(parts.filter("split = 'train'")), encoder_path)
    featured = features.add_features(parts, features.label_lookups(labels))
    featured = stored(featured, f"{folder}/features")
    train, test = (featured.filter(F.col("split") == s) for s in ("train", "test"))
    fitting = train if settings.rows_per_year is None else yearly_cap(train, settings.rows_per_year)
    balanced = stored(smote_balance(fitting), f"{folder}/balanced")
    return TrainingData(balanced, train, test, encoder_path)


def fit_forest(learner: RandomForestClassifier, rows: DataFrame) -> Model:
    """A forest whose thresholds come from all rows.

    Beyond maxBins^2 rows Spark looks for thresholds in a sample of so many. There the features are binned first, by cuts that are found
    from all rows, as boosting does, and maxBins is set to where Spark takes no sample; a feature still has no more than `maxBins` candidates.
    """
    n, bins = rows.count(), learner.getMaxBins()
    if n <= max(bins**2, 10_000):
        return learner.fit(features.with_vector(rows))
    cuts = boosting.collect_cuts(boosting.cut_points(rows, model.FEATURES, bins), model.FEATURES)
    names = [f"{f}_bin" for f in model.FEATURES]
    # A bucket has its lower end, a bin its upper one.
    splits = [[-inf, *np.nextafter(c, inf).tolist(), inf] for c in cuts]
    steps = [
        Bucketizer(splitsArray=splits, inputCols=model.FEATURES, outputCols=names),
        VectorAssembler(inputCols=names, outputCol="bins"),
        learner.copy().setFeaturesCol("bins").setMaxBins(isqrt(n) + 1),
    ]
    # Dealt out anew: the files say nothing about the work, which is much per row.
    return Pipeline(stages=steps).fit(rows.repartition(-(-n // FOREST_ROWS_OF_A_TASK)))


def learned(learner: Learner, rows: DataFrame, label: str) -> Fitted:
    if isinstance(learner, Boosting):
        return boosting.fit(rows, model.FEATURES, label, learner)
    if isinstance(learner, RandomForestClassifier):
        return fit_forest(learner, rows)
    return learner.fit(features.with_vector(rows))


def with_score(fitted: Fitted, rows: DataFrame) -> DataFrame:
    """`score`, the probability of being resolved, and `prediction`, whether it is above one half."""
    if isinstance(fitted, Ensemble):
        score = 1 / (1 + F.exp(-fitted.margin(rows.sparkSession)))
        scored = rows.withColumn("score", score)
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    scored = fitted.transform(features.with_vector(rows))
    return scored.withColumn("score", vector_to_array("probability")[1])


def with_days(fitted: Ensemble, rows: DataFrame, column: str = "prediction") -> DataFrame:
    return rows.withColumn(column, fitted.margin(rows.sparkSession))


def _named(result: DataFrame, name: str) -> DataFrame:
    return result.select(F.lit(name).alias("model_name"), "*")


def comparison(
    classes: dict[str, Fitted], days: dict[str, Ensemble], rows: DataFrame
) -> DataFrame:
    """The metrics of all models on the test rows, one row a model; regressors are held to the resolved rows."""
    resolved = rows.filter("is_resolved = 1")
    found: list[DataFrame] = []
    for name, classifier in classes.items():
        scored = with_score(classifier, rows)
        found.append(_named(metrics.classification_metrics(scored, "is_resolved", "score", "prediction"), name))
    for name, regressor in days.items():
        result = metrics.regression_metrics(with_days(regressor, resolved), "case_age_days", "prediction")
        found.append(_named(result, name))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def fit_all(data: TrainingData, settings: Settings) -> tuple[dict[str, Fitted], dict[str, Ensemble]]:
    """All fitted models.

    Boosting is a long chain of small jobs, so the models are fitted side by side and share the cluster.
    """
    resolved = data.train.filter("is_resolved = 1")
    fits = [(n, e, data.balanced, "is_resolved") for n, e in classifiers(data.balanced.count(), settings).items()]
    fits += [(f"{n} (Regression)", e, resolved, "case_age_days") for n, e in regressors(settings).items()]
    fitted = side_by_side(data.train.sparkSession, lambda fit: (fit[0], learned(*fit[1:])), fits, len(fits))
    days = {n: m for n, m in fitted if n.endswith("(Regression)")}
    return {n: m for n, m in fitted if n not in days}, days


def train_models(
    cases: DataFrame, root: str, settings: Settings, trained_on: datetime | None = None
) -> dict[str, DataFrame]:
    """Train on the cleaned cases and leave models, tables and a registry entry under `root`."""
    spark = cases.sparkSession
    version = uuid4().hex[:12]
    folder = f"{root}/models/{version}"
    data = prepare(cases, folder, settings)
    fitted_classes, fitted_days = fit_all(data, settings)
    compared = replace_table(comparison(fitted_classes, fitted_days, data.test), f"{root}/model_comparison")

    paths = {"model_path": f"{folder}/classifier", "reg_model_path": f"{folder}/regressor"}
    classifier, regressor = fitted_classes[REGISTERED], fitted_days[f"{REGISTERED} (Regression)"]
    nodes = stored(classifier.nodes(spark), paths["model_path"])
    stored(regressor.nodes(spark), paths["reg_model_path"])

    importance = replace_table(split_counts(nodes, model.FEATURES), f"{root}/feature_importance")
    sample = data.test
    if settings.explained_rows is not None:
        sample = sample.orderBy("ddl_case_id").limit(settings.explained_rows)
    values = replace_table(attribution.shapley_values(sample, attribution.leaves_of(classifier)), f"{root}/shap_values")
    summary = replace_table(attribution.shapley_summary(values), f"{root}/shap_summary")

    scores = {r["model_name"]: r for r in compared.collect()}
    entry = {
        "model_name": REGISTERED,
        "model_version": version,
        "trained_on": trained_on or datetime.now(),
        **{m: scores[REGISTERED][m] for m in ("f1_score", "roc_auc", "accuracy")},
        **{m: scores[f"{REGISTERED} (Regression)"][m] for m in ("mae", "rmse")},
        **paths,
        "encoder_path": data.encoder_path,
    }
    # Earlier entries stay; the newest one is the one in use.
    spark.createDataFrame([entry], REGISTRY_DDL).write.mode("append").parquet(f"{root}/model_registry")
    return dict(zip(ML_TABLES, [compared, importance, values, summary]))


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(REGISTRY_DDL).parquet(f"{root}/model_registry")


def newest_entry(registry: DataFrame) -> DataFrame:
    return registry.orderBy(F.desc("trained_on"), F.desc("model_version")).limit(1)


def latest_model(registry: DataFrame) -> Row:
    entry = newest_entry(registry).first()
    if entry is None:
        raise LookupError("no trained model is registered; train one before scoring")
    return entry
