"""From raw case messages to the cleaned fact table.

Pure functions from frame to frame, shared by batch and stream. None of them
moves the fact when the keys are within the broadcast bound.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry import model
from docketry.functions import columns as C
from docketry.operators.lookups import Lookup, lookup_join


def typed_cases(messages: DataFrame) -> DataFrame:
    """Codes to int, dates to date, genders to their three words."""
    rules = (
        [(model.CODE_COLUMNS, C.code_to_int), (model.DATE_COLUMNS, C.strict_date)]
        + [(model.GENDER_COLUMNS, C.gender)]
    )
    return messages.withColumns({c: rule(F.col(c)) for cols, rule in rules for c in cols})


def enriched_cases(typed: DataFrame, keys: dict[str, Lookup]) -> DataFrame:
    """Names for the six codes; a code without a key gets the table's default text."""
    named = reduce(lookup_join, (keys[table] for table in model.KEY_TABLES), typed)
    return named.fillna({name: text for _, _, name, text in model.KEY_TABLES.values()})


def valid_cases(cases: DataFrame) -> DataFrame:
    return cases.filter(C.possible(F.col("date_of_filing"), F.col("date_of_decision")))


def derived_features(valid: DataFrame, as_of: date) -> DataFrame:
    filing, decision = F.col("date_of_filing"), F.col("date_of_decision")
    age = C.age_days(filing, decision, as_of)
    return valid.withColumns(
        {
            "is_resolved": C.is_resolved(decision),
            "case_age_days": age,
            "delay_category": C.delay_category(age),
            "filing_year": F.year(filing),
            "hearing_span_days": C.span_days(F.col("date_first_list"), F.col("date_last_list")),
        }
    )


def problem(filing_text: Column, malformed: Column) -> Column:
    """Why a message is no fact, null if it is one; dates must be typed already, `filing_text` is the filing date as sent."""
    filing = F.col("date_of_filing")
    given = F.coalesce(filing_text, F.lit("")) != ""
    return (
        F.when(malformed, "malformed")
        .when(filing.isNull() & given, "unreadable filing date")
        .when(filing.isNull(), "no filing date")
        .when(~C.possible(filing, F.col("date_of_decision")), "decided before filing")
    )


def judged_cases(checked: DataFrame, keys: dict[str, Lookup], as_of: date) -> DataFrame:
    """All messages in one pass: the 21 columns of a fact, or `problem` and the message as it came.

    `checked` is from `decode_checked`. A message with a problem has its id (but if it is malformed) and the text in `value`; its other columns are null.
    """
    sent = checked.withColumn("_filing", F.col("date_of_filing"))
    judged = typed_cases(sent).withColumn("problem", problem(F.col("_filing"), F.col("malformed")))
    # A bad message is kept out of the joins by null codes, which match nothing.
    codes = {c: F.when(F.col("problem").isNull(), F.col(c)) for c in model.CODE_COLUMNS}
    derived = derived_features(enriched_cases(judged.withColumns(codes), keys), as_of)
    named = derived.withColumnsRenamed(model.RENAMED)
    good = F.col("problem").isNull()
    facts = [F.when(good, F.col(c)).alias(c) for c in model.CLEANED_COLUMNS if c != "ddl_case_id"]
    sure = F.when(F.col("malformed"), F.lit(None)).otherwise(F.col("ddl_case_id")).alias("ddl_case_id")
    return named.select(sure, *facts, "problem", F.when(~good, F.col("value")).alias("value"))


def cases_cleaned(messages: DataFrame, keys: dict[str, Lookup], as_of: date) -> DataFrame:
    """The 21 column fact table. The filter runs before the joins and drops rows early."""
    valid = enriched_cases(valid_cases(typed_cases(messages)), keys)
    derived = derived_features(valid, as_of)
    return derived.withColumnsRenamed(model.RENAMED).select(*model.CLEANED_COLUMNS)


def quality_counts(messages: DataFrame) -> DataFrame:
    """Received and kept rows in one pass; the two constant columns are part of the log's format."""
    kept = C.possible(
        C.strict_date(F.col("date_of_filing")), C.strict_date(F.col("date_of_decision"))
    )
    counted = messages.agg(
        F.count(F.lit(1)).alias("total_received"), F.count_if(kept).alias("valid_records")
    )
    return counted.select(
        "total_received",
        "valid_records",
        F.lit(0).cast("bigint").alias("null_records"),
        F.lit(0).cast("bigint").alias("duplicate_records"),
        (F.col("total_received") - F.col("valid_records")).alias("impossible_dates"),
    )
