"""Model features, the same for training and scoring."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import model
from docketry.functions.columns import coded
from docketry.operators.lookups import Lookup, check_sizes, lookup_join
from docketry.operators.running import running_totals


def calendar_features(cases: DataFrame) -> DataFrame:
    """The features that need no fitted labels, nulls still in place."""
    return cases.withColumns(
        {
            "filing_month": F.month("date_of_filing"),
            "filing_day_of_week": F.weekday("date_of_filing"),
            "delay_cat_encoded": coded(F.col("delay_category"), model.DELAY_CODES),
            "gender_encoded": coded(F.col("petitioner_gender"), model.GENDER_CODES),
        }
    )


def _label(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(model.MISSING_LABEL))


def fit_labels(train: DataFrame) -> DataFrame:
    """(label_column, label, code): the distinct training labels of each column, numbered in text order."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("label_column"), _label(c).alias("label")) for c in model.ENCODED_LABELS])
    )
    found = train.select(pairs.alias("p")).select("p.*").distinct().withColumn("one", F.lit(1))
    numbered = running_totals(found, ["label_column", "label"], {"one": "place"})
    # One row for each of the label columns.
    starts = numbered.groupBy("label_column").agg(F.min("place").alias("start"))
    code = (F.col("place") - F.col("start")).cast("int")
    return numbered.join(F.broadcast(starts), "label_column").select("label_column", "label", code.alias("code"))


def label_lookups(labels: DataFrame) -> dict[str, Lookup]:
    """One lookup per label column, from a stored label table; sizes are checked."""
    lookups = {}
    for column, out in model.ENCODED_LABELS.items():
        of_column = labels.filter(F.col("label_column") == column)
        codes = of_column.groupBy(F.col("label").alias(f"_{column}")).agg(F.min("code").alias(out))
        lookups[column] = Lookup(codes, (f"_{column}",))
    return check_sizes(lookups)


def encode_labels(cases: DataFrame, lookups: dict[str, Lookup]) -> DataFrame:
    """Codes of the label columns; a label that training has not seen gets -1."""
    for column, out in model.ENCODED_LABELS.items():
        cases = lookup_join(cases.withColumn(f"_{column}", _label(column)), lookups[column])
        cases = cases.drop(f"_{column}").fillna(model.UNSEEN_CODE, [out])
    return cases


def add_features(cases: DataFrame, lookups: dict[str, Lookup]) -> DataFrame:
    """All model features; what is missing becomes 0."""
    return encode_labels(calendar_features(cases), lookups).fillna(0, model.FEATURES)


def with_vector(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=model.FEATURES, outputCol="features").transform(rows)
