"""The registered queries: each operator applied to the docket view of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from docketry import model
from docketry.operators import attribution, balance, boosting, ensembles, features, lookups, metrics, profile, sampling
from docketry.plans import cleaning, scoring, summaries, training
from docketry.plans.run import run_all
from docketry.sources import files, sinks, testdata
from docketry.sources import messages as msg
from docketry.sources.workspace import new_folder, stored
from docketry.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

# Message files of a micro-batch.
FILES_PER_BATCH = 4

# The columns that name a row of a summary table.
SUMMARY_KEYS = {
    "yearly_summary": ["filing_year"],
    "state_summary": ["state_name"],
    "district_summary": ["state_name", "district_name"],
    "casetype_summary": ["case_type"],
    "delay_summary": ["delay_category"],
    "judge_summary": ["judge_position"],
    "gender_summary": ["petitioner_gender"],
    "time_trends": ["period_type", "period_value"],
    "disposal_summary": ["disposal_type"],
    "hearing_span_summary": ["case_type", "delay_category"],
    "defendant_gender_summary": ["defendant_gender"],
    "oldest_pending_cases": [
        "ddl_case_id", "state_name", "district_name", "court_name", "case_type", "date_of_filing", "delay_category",
    ],
    "casetype_delay_crosstab": ["case_type"],
}


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.typed_cases(testdata.case_messages(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.enriched_cases(typed(spark, sf_dir), testdata.case_keys(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.case_messages(spark, sf_dir)
    return cleaning.cases_cleaned(rows, testdata.case_keys(spark, sf_dir), testdata.AS_OF)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.decode(msg.encode(testdata.case_messages(spark, sf_dir)))


def publish_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "topic")
    msg.publish_to_files(testdata.case_messages(spark, sf_dir), folder)
    return msg.decode(spark.read.text(folder))


def dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys but the court key in one frame; only a district has a state code beside its own."""
    raw = testdata.raw_keys(spark, sf_dir)
    parts = []
    for table, (_, codes, name, _) in model.KEY_TABLES.items():
        if table != "court":
            unique = lookups.dedupe_keys(raw[table], codes, name)
            state = F.col("state_code") if len(codes) > 1 else F.lit(None).cast("int")
            parts.append(
                unique.select(
                    F.lit(table).alias("key_table"), state.alias("state_code"), F.col(codes[-1]).alias("code"),
                    F.col(name).alias("name"),
                )
            )
    return reduce(DataFrame.unionByName, parts)


def court_key_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.court_key_latest(testdata.raw_keys(spark, sf_dir)["court"])


def gender_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(spark, sf_dir).select("ddl_case_id", *model.GENDER_COLUMNS)


def valid_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.valid_cases(enriched(spark, sf_dir))


def derived_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = cleaning.derived_features(cleaning.valid_cases(typed(spark, sf_dir)), testdata.AS_OF)
    return derived.select(
        "ddl_case_id", "is_resolved", "case_age_days", "delay_category", "filing_year", "hearing_span_days"
    )


def data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quality_counts(testdata.case_messages(spark, sf_dir))


def summary(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.summarise(cleaned(spark, sf_dir), name)


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.run_counters(cleaned(spark, sf_dir))


def case_files(spark: SparkSession, sf_dir: str) -> str:
    """The messages as CSV, one folder per year found in the text of the filing date."""
    folder = new_folder(spark, "csv")
    filed = F.col("date_of_filing")
    year = F.coalesce(F.substring(filed, 1, 4).try_cast("int"), F.substring(filed, 7, 4).try_cast("int"))
    rows = testdata.case_messages(spark, sf_dir).withColumn("file_year", year)
    rows.write.partitionBy("file_year").options(**files.CSV).csv(folder)
    return folder


def read_yearly_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = case_files(spark, sf_dir)
    return files.read_yearly_csv(spark, folder, testdata.FILE_YEARS, "file_year={year}")


def published_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.published_per_year(read_yearly_csv(spark, sf_dir))


def ingested(spark: SparkSession, sf_dir: str) -> str:
    """Publish all messages, then drain them in several micro-batches."""
    folder = new_folder(spark, "ingest")
    msg.publish_to_files(testdata.case_messages(spark, sf_dir), f"{folder}/topic")
    stream = ingest.file_messages(spark, f"{folder}/topic", FILES_PER_BATCH)
    keys = lookups.stored_keys(testdata.case_keys(spark, sf_dir), f"{folder}/keys")
    ingest.ingest_run(stream, keys, testdata.AS_OF, folder, "first")
    return folder


def stream_cases_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.read_cleaned(spark, f"{ingested(spark, sf_dir)}/cases_cleaned")


def stream_quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log summed over its batches, whose number depends on the files."""
    log = spark.read.parquet(f"{ingested(spark, sf_dir)}/data_quality_log")
    counters = [c for c in log.columns if c != "batch_id"]
    return log.agg(*[F.sum(c).alias(c) for c in counters])


def troubled(spark: SparkSession, sf_dir: str) -> str:
    """Drain messages of which some come twice and some are cut off, in several micro-batches that are merged on the way."""
    folder = new_folder(spark, "troubled")
    number = F.substring("ddl_case_id", 2, 20).cast("bigint")
    rows = testdata.case_messages(spark, sf_dir)
    rows = rows.unionByName(rows.filter(number % 7 == 0)).withColumn("cut_off", number % 89 == 0)
    sent = msg.encode(rows.filter("NOT cut_off").drop("cut_off"))
    cut_off = msg.encode(rows.filter("cut_off").drop("cut_off")).select(F.substring("value", 1, 40).alias("value"))
    sent.unionByName(cut_off).repartition(8).write.text(f"{folder}/topic")
    stream = ingest.file_messages(spark, f"{folder}/topic", 2)
    keys = lookups.stored_keys(testdata.case_keys(spark, sf_dir), f"{folder}/keys")
    ingest.ingest_run(stream, keys, testdata.AS_OF, folder, "first", most=2)
    return folder


def stream_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The problems and repeated ids summed over the batches."""
    log = spark.read.parquet(f"{troubled(spark, sf_dir)}/batch_problems")
    return log.agg(*[F.sum(c).alias(c) for c in log.columns if c != "batch_id"])


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that are no facts, with the length of their text."""
    bad = spark.read.parquet(f"{troubled(spark, sf_dir)}/quarantine")
    return bad.select("ddl_case_id", "problem", F.when(F.col("problem") == "malformed", F.length("value")).alias("size"))


def stored_summaries(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """All summary tables from one scan, written and read back."""
    folder = new_folder(spark, "summaries")
    facts = f"{folder}/cases_cleaned"
    sinks.write_cleaned(cleaned(spark, sf_dir), facts)
    tables = summaries.all_summaries(sinks.read_cleaned(spark, facts), folder)
    sinks.write_tables(tables, folder)
    return folder, sinks.read_tables(spark, folder, summaries.SUMMARY_TABLES)


def long_form(name: str, frame: DataFrame) -> DataFrame:
    """(table_name, row_key, measure, value): all cells of a table, so that tables of any form go into one frame.

    The key holds the columns of SUMMARY_KEYS as text, null as empty text, as a CSV file has it.
    """
    keys = SUMMARY_KEYS[name]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]
    measures = [c for c in frame.columns if c not in keys]
    cells = [F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").cast("double").alias("value")) for c in measures]
    return frame.select(F.lit(name).alias("table_name"), F.concat_ws("|", *text).alias("row_key"), F.inline(F.array(*cells)))


def all_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored_summaries(spark, sf_dir)[1]
    return reduce(DataFrame.unionByName, [long_form(n, f) for n, f in tables.items()])


def export_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export all tables as CSV and read the files back."""
    folder, tables = stored_summaries(spark, sf_dir)
    sinks.export_summaries(tables, f"{folder}/export", summaries.export_orders())
    read = {n: files.read_csv(spark, f"{folder}/export/{n}.csv") for n in tables}
    return reduce(DataFrame.unionByName, [long_form(n, f) for n, f in read.items()])


def raw_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as a CSV reader gives them to the pools: an empty field is null."""
    rows = testdata.case_messages(spark, sf_dir)
    return rows.withColumn("date_of_decision", F.nullif("date_of_decision", F.lit("")))


def resolved_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.resolved_pool(raw_cases(spark, sf_dir))


def pending_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.pending_pool(raw_cases(spark, sf_dir))


def cleaning_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.cleaning_profile(raw_cases(spark, sf_dir))


def resolved_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.resolved_sample(raw_cases(spark, sf_dir))


def profile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All given tables and the case messages, with their columns, sizes and nulls."""
    frames = {name: testdata.table(spark, sf_dir, name) for name in testdata.TABLES}
    return profile.profile_tables({**frames, "messages": testdata.case_messages(spark, sf_dir)})


def profile_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.first_rows(testdata.case_messages(spark, sf_dir), 1, "ddl_case_id")


def profile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All given tables by their paths, a path with nothing there, and CSV files that are no Parquet; values of texts and whole numbers."""
    paths = {name: f"{sf_dir}/{name}.parquet" for name in testdata.TABLES}
    paths |= {"nothing": f"{sf_dir}/nothing.parquet", "case_files": case_files(spark, sf_dir)}
    found = profile.profile_paths(spark, paths)
    shown = F.when(F.col("column_type").isin("string", "int", "bigint"), F.col("first_value"))
    return found.select(
        "table_name", "status", "row_count", "column_count", "position", "column_name", "nulls", shown.alias("first_value")
    )


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.temporal_split(cleaned(spark, sf_dir), testdata.TRAIN_UNTIL, testdata.VALIDATE_UNTIL)


def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(spark, sf_dir).select("ddl_case_id", "filing_year", "split")


def fallback_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fallback_split(cleaned(spark, sf_dir)).select("ddl_case_id", "split")


def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.distinct_years(cleaned(spark, sf_dir))


def yearly_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap is set to 1,000 rows a year, so that it takes effect on the smaller data too."""
    return sampling.yearly_cap(cleaned(spark, sf_dir).select(*model.TRAINING_COLUMNS), 1000)


def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_distribution(split(spark, sf_dir).filter("split = 'train'"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.fit_labels(split(spark, sf_dir).filter("split = 'train'"))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dated cases with their split and features; labels are fitted on the training part."""
    found = stored(labels(spark, sf_dir), new_folder(spark, "labels"))
    return features.add_features(split(spark, sf_dir), features.label_lookups(found))


def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured(spark, sf_dir).select("ddl_case_id", "split", *model.FEATURES)


def smote_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = featured(spark, sf_dir).filter("split = 'train'").select(*model.FEATURES, "is_resolved")
    return balance.smote_balance(stored(train, new_folder(spark, "train")))


def fixed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with a score and a number of days that are simple functions of the row."""
    rows = features.calendar_features(split(spark, sf_dir)).filter("split = 'test'").fillna(0, model.FEATURES[:6])
    score = (F.col("hearing_span_days") * 7 + F.col("filing_month") * 13) % 101 / 100
    return rows.withColumns(
        {
            "score": score,
            "called": (score >= model.DISPOSE_FROM).cast("int"),
            "days": (F.col("filing_month") * 30 + 900).cast("double"),
        }
    )


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.classification_metrics(fixed_scores(spark, sf_dir), "is_resolved", "score", "called")


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = fixed_scores(spark, sf_dir).filter("is_resolved = 1")
    return metrics.regression_metrics(resolved, "case_age_days", "days")


def pending_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.pending_candidates(cleaned(spark, sf_dir))


def lineup_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome rule on a score that is a simple function of the row."""
    score = F.col("case_age_days") % 101 / 100
    rows = pending_candidates(spark, sf_dir)
    return rows.select("ddl_case_id", score.alias("score"), scoring.outcome(score).alias("predicted_outcome"))


# Few bins, so that features with more values than bins are there on small data too.
FIRST_TREE = boosting.Boosting("logistic", rounds=1, max_leaves=2, ridge=1.0, least_rows=20, max_bins=16, balance_classes=True)


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = featured(spark, sf_dir).filter("split = 'train'").select(*model.FEATURES, "is_resolved")
    return stored(rows, new_folder(spark, "train"))


def boosting_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosting.cut_points(training_rows(spark, sf_dir), model.FEATURES, FIRST_TREE.max_bins)


def boosting_first_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histograms of the first round and the gain behind each bin."""
    found = boosting.first_gains(training_rows(spark, sf_dir), model.FEATURES, "is_resolved", FIRST_TREE)
    return found.withColumns({c: F.round(c, 6) for c in ("gradient", "curvature", "gain")})


def first_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosting.fit(training_rows(spark, sf_dir), model.FEATURES, "is_resolved", FIRST_TREE).nodes(spark)


def boosting_first_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of a fit of one round with two leaves."""
    return first_tree(spark, sf_dir).withColumn("value", F.round("value", 9))


def two_level_tree(features_: list[str], thresholds: list[float], values: list[float], n_rows: list[int]) -> ensembles.Tree:
    """A root and two nodes below it, each with two leaves."""
    at = [model.FEATURES.index(f) for f in features_] + [0] * 4
    return ensembles.Tree(
        np.array(at), np.array([*thresholds, 0.0, 0.0, 0.0, 0.0]), np.array([1, 3, 5, 3, 4, 5, 6]), np.array([2, 4, 6, 3, 4, 5, 6]),
        np.array([0.0, 0.0, 0.0, *values]), np.array(n_rows),
    )


# A small ensemble that is the same for all data, to hold scores, metrics and attributions of the given rows to their statements.
FIXED = ensembles.Ensemble(
    model.FEATURES, 0.25,
    [
        two_level_tree(
            ["hearing_span_days", "delay_cat_encoded", "filing_month"], [60.0, 1.0, 6.0], [-0.5, 0.3, 0.1, 0.7], [100, 40, 60, 25, 15, 36, 24]
        ),
        two_level_tree(
            ["judge_encoded", "gender_encoded", "case_type_encoded"], [2.0, -1.0, 1.0], [0.2, -0.4, 0.6, -0.1], [200, 120, 80, 30, 90, 50, 30]
        ),
    ],
)
FIXED_DAYS = ensembles.Ensemble(
    model.FEATURES, 900.0,
    [two_level_tree(["delay_cat_encoded", "filing_month", "filing_day_of_week"], [1.0, 4.0, 2.0], [-400.0, -150.0, 300.0, 700.0], [10, 5, 5, 2, 3, 1, 4])],
)


def test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(featured(spark, sf_dir).filter("split = 'test'"), new_folder(spark, "test"))


def ensemble_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test rows scored by the fixed ensemble: down its trees, and by joining the intervals of its leaves."""
    rows = test_rows(spark, sf_dir)
    scored = training.with_score(FIXED, rows).withColumn("margin", FIXED.margin(spark))
    joined = ensembles.scored_by_intervals(rows, FIXED.leaves(spark), model.FEATURES, "ddl_case_id")
    joined = joined.select("ddl_case_id", F.round(F.col("margin") + FIXED.base, 9).alias("by_intervals"))
    plain = [F.round(c, 9).alias(c) for c in ("margin", "score")]
    return scored.select("ddl_case_id", *plain, F.col("prediction").cast("int")).join(joined, "ddl_case_id", "left")


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of the fixed ensembles on the test rows, as those of the trained models are found."""
    return training.comparison({"Fixed": FIXED}, {"Fixed (Regression)": FIXED_DAYS}, test_rows(spark, sf_dir))


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensembles.split_counts(first_tree(spark, sf_dir), model.FEATURES)


def shapley_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean attributions of the fixed ensemble over the test rows."""
    values = attribution.shapley_values(test_rows(spark, sf_dir), attribution.leaves_of(FIXED))
    return attribution.shapley_summary(values).withColumn("mean_abs_shap", F.round("mean_abs_shap", 9))


_ROOTS: dict[tuple[str, str, str], str] = {}


def whole_run(spark: SparkSession, sf_dir: str) -> str:
    """The folder of one run over case and key files; done once per session for the same files."""
    mark = (spark.sparkContext.applicationId, sf_dir, testdata.data_state(spark, sf_dir))
    if mark not in _ROOTS:
        root = new_folder(spark, "run")
        for table, frame in testdata.raw_keys(spark, sf_dir).items():
            frame.write.options(**files.CSV).csv(f"{root}/keys/{model.KEY_TABLES[table][0]}")
        run_all(
            spark, case_files(spark, sf_dir), f"{root}/keys", root, testdata.AS_OF, testdata.FILE_YEARS,
            "file_year={year}", training.Settings(testdata.TRAIN_UNTIL, testdata.VALIDATE_UNTIL),
        )
        _ROOTS[mark] = root
    return _ROOTS[mark]


def end_to_end_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells of the tables that a whole run leaves behind; of those that a model makes, the number of rows."""
    root = whole_run(spark, sf_dir)
    made = [*training.ML_TABLES, "model_registry", "daily_lineup"]
    whole = [long_form(n, f) for n, f in sinks.read_tables(spark, root, summaries.SUMMARY_TABLES).items()]
    facts = sinks.read_cleaned(spark, f"{root}/cases_cleaned")
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in facts.columns]
    rows = facts.select(
        F.lit("cases_cleaned").alias("table_name"), F.concat_ws("|", *text).alias("row_key"), F.lit("row").alias("measure"),
        F.lit(1.0).alias("value"),
    )
    sizes = [
        frame.agg(
            F.lit(name).alias("table_name"), F.lit("").alias("row_key"), F.lit("rows").alias("measure"),
            F.count(F.lit(1)).cast("double").alias("value"),
        )
        for name, frame in sinks.read_tables(spark, root, made).items()
    ]
    return reduce(DataFrame.unionByName, [*whole, rows, *sizes])


def learned(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{whole_run(spark, sf_dir)}/{name}")


def entry_of(spark: SparkSession, sf_dir: str) -> Row:
    return training.latest_model(training.read_registry(spark, whole_run(spark, sf_dir)))


def trained_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison of the models that a whole run trains."""
    return learned("model_comparison", spark, sf_dir)


def shapley_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each test row, and by how much its attributions and the base miss the model's log odds."""
    root, entry = whole_run(spark, sf_dir), entry_of(spark, sf_dir)
    classifier = ensembles.read_ensemble(spark, entry["model_path"], model.FEATURES)
    base = attribution.leaves_of(classifier).base + classifier.base
    rows = spark.read.parquet(f"{entry['encoder_path'].rsplit('/', 1)[0]}/features").filter("split = 'test'")
    margins = rows.select("ddl_case_id", classifier.margin(spark).alias("margin"))
    values = spark.read.parquet(f"{root}/shap_values")
    total = reduce(lambda a, b: a + b, [F.col(f"shap_{f}") for f in model.FEATURES])
    missed = F.abs(total + F.lit(base) - F.col("margin"))
    return values.join(margins, "ddl_case_id").select("ddl_case_id", F.round(missed, 6).alias("missed"))


def latest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest of a registry with one entry for each region; two have the same time."""
    regions = testdata.table(spark, sf_dir, "region")
    day = F.make_date(F.lit(2020), F.lit(1), F.least(F.col("r_regionkey") + 1, F.lit(4)).cast("int")).cast("timestamp")
    have = {"model_name": F.col("r_name"), "model_version": F.concat(F.lit("v"), F.col("r_regionkey").cast("string")), "trained_on": day}
    registry = regions.select(
        *[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], training.REGISTRY_DDL).schema]
    )
    return training.newest_entry(registry).select("model_name", "model_version", F.to_date("trained_on").alias("trained_on"))


def lineup(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = sinks.read_cleaned(spark, f"{whole_run(spark, sf_dir)}/cases_cleaned")
    return scoring.daily_lineup(facts, entry_of(spark, sf_dir), testdata.AS_OF)


def fixed_lineup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineup of a registry entry with the fixed ensembles, all columns; labels are those of the training rows."""
    folder = new_folder(spark, "fixed")
    paths = {"model_path": f"{folder}/classifier", "reg_model_path": f"{folder}/regressor", "encoder_path": f"{folder}/encoder"}
    stored(FIXED.nodes(spark), paths["model_path"])
    stored(FIXED_DAYS.nodes(spark), paths["reg_model_path"])
    stored(labels(spark, sf_dir), paths["encoder_path"])
    scored = scoring.daily_lineup(cleaned(spark, sf_dir), Row(**paths), testdata.AS_OF)
    return scored.withColumns({c: F.round(c, 9) for c in ("resolution_probability", "predicted_days_remaining")})


def without_model(rows: DataFrame) -> DataFrame:
    """The columns of a lineup that no model touches, and whether its outcome goes with its probability."""
    probability = F.col("resolution_probability").cast("double")
    agrees = scoring.outcome(probability) == F.col("predicted_outcome")
    plain = [c for c in model.LINEUP_COLUMNS if c not in ("resolution_probability", "predicted_outcome", "predicted_days_remaining")]
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in plain], agrees.alias("outcome_agrees"))


def daily_lineup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_model(lineup(spark, sf_dir))


def lineup_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All predictions of the fixed ensembles, and those with each outcome."""
    return scoring.lineup_counters(fixed_lineup(spark, sf_dir))


def export_lineup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the lineup as CSV parts and read the files back."""
    folder = new_folder(spark, "export")
    sinks.export_lineup(lineup(spark, sf_dir), folder)
    return without_model(files.read_csv(spark, f"{folder}/daily_lineup.csv"))


def queries() -> dict[str, Query]:
    return {
        "read_yearly_csv": read_yearly_csv,
        "published_per_year": published_per_year,
        "json_roundtrip": json_roundtrip,
        "publish_cases": publish_cases,
        "dedupe_keys": dedupe_keys,
        "court_key_latest": court_key_latest,
        "typed_cases": typed,
        "gender_clean": gender_clean,
        "enriched_cases": enriched,
        "valid_cases": valid_cases,
        "derived_features": derived_features,
        "cases_cleaned": cleaned,
        "data_quality": data_quality,
        "run_counters": run_counters,
        **{name: partial(summary, name) for name in summaries.SUMMARY_TABLES},
        "all_summaries": all_summaries,
        "export_summaries": export_summaries,
        "stream_cases_cleaned": stream_cases_cleaned,
        "stream_quality_log": stream_quality_log,
        "stream_problems": stream_problems,
        "stream_quarantine": stream_quarantine,
        "resolved_pool": resolved_pool,
        "pending_pool": pending_pool,
        "cleaning_profile": cleaning_profile,
        "resolved_sample": resolved_sample,
        "profile_tables": profile_tables,
        "profile_first_row": profile_first_row,
        "profile_files": profile_files,
        "temporal_split": temporal_split,
        "fallback_split": fallback_split,
        "distinct_years": distinct_years,
        "yearly_cap": yearly_cap,
        "class_distribution": class_distribution,
        "label_encode": labels,
        "ml_features": ml_features,
        "smote_balance": smote_balance,
        "classification_metrics": classification_metrics,
        "regression_metrics": regression_metrics,
        "pending_candidates": pending_candidates,
        "lineup_outcome": lineup_outcome,
        "boosting_cuts": boosting_cuts,
        "boosting_first_gains": boosting_first_gains,
        "boosting_first_tree": boosting_first_tree,
        "ensemble_scores": ensemble_scores,
        "end_to_end_run": end_to_end_run,
        "trained_models": trained_models,
        "model_comparison": model_comparison,
        "feature_importance": feature_importance,
        "shapley_values": shapley_values,
        "shapley_summary": shapley_summary,
        "latest_model": latest_model,
        "daily_lineup": daily_lineup,
        "fixed_lineup": fixed_lineup,
        "lineup_counters": lineup_counters,
        "export_lineup": export_lineup,
    }
