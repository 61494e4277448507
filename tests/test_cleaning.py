from datetime import date

import pytest
from pyspark.sql import functions as F

from docketry import model
from docketry.functions import columns as C
from docketry.operators.lookups import build_keys
from docketry.plans import cleaning

AS_OF = date(2020, 1, 1)
BASE = {
    "ddl_case_id": "A", "state_code": "01", "dist_code": "2", "court_no": "3", "judge_position": None,
    "type_name": "7", "purpose_name": "8", "disp_name": "9", "date_of_filing": "2019-01-01",
    "date_of_decision": "", "date_first_list": None, "date_last_list": None, "date_next_list": None,
    "female_petitioner": "1 female", "female_defendant": None,
}


def messages(spark, *changes):
    return spark.createDataFrame([{**BASE, **c} for c in changes], model.MESSAGE_DDL)


@pytest.fixture(scope="module")
def keys(spark):
    def table(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return build_keys(
        {
            "type": table("type_name string, type_name_s string", ("7", "civil"), ("07", "appeal")),
            "disposition": table("disp_name string, disp_name_s string", ("9", "allowed")),
            "purpose": table("purpose_name string, purpose_name_s string", ("8", "hearing")),
            "state": table("state_code string, state_name string", ("1", "North"), ("x", "bad")),
            "district": table("state_code string, dist_code string, district_name string", ("1", "2", "Hill")),
            "court": table(
                "year string, state_code string, dist_code string, court_no string, court_name string",
                ("2012", "1", "2", "3", "Old"), ("2014", "1", "2", "3", "Z"), ("2014", "1", "2", "3", "New"),
                (None, "1", "2", "3", "A"),
            ),
        }
    )


def cleaned(spark, keys, *changes):
    rows = cleaning.cases_cleaned(messages(spark, *changes), keys, AS_OF).collect()
    return {r["ddl_case_id"]: r for r in rows}


@pytest.mark.parametrize(
    "text, code",
    [("3", 3), (" 3 ", 3), ("01", 1), ("3.0", 3), ("3.7", 3), ("-2", -2), ("x", None), ("", None),
     ("1e3", None), ("3.x", None), ("99999999999", None), (None, None)],
)
def test_code_to_int(spark, text, code):
    row = spark.createDataFrame([(text,)], "t string").select(C.code_to_int(F.col("t")).alias("v")).first()
    assert row["v"] == code


@pytest.mark.parametrize(
    "text, day",
    [("2010-02-28", date(2010, 2, 28)), ("2010-02-30", None), ("2010-2-8", None), ("01/02/1999", None),
     ("2010-02-28 10:00", None), ("", None), (None, None)],
)
def test_strict_date(spark, text, day):
    row = spark.createDataFrame([(text,)], "t string").select(C.strict_date(F.col("t")).alias("v")).first()
    assert row["v"] == day


@pytest.mark.parametrize(
    "age, category",
    [(-5, "Fast"), (364, "Fast"), (365, "Medium"), (1094, "Medium"), (1095, "Slow"), (2554, "Slow"),
     (2555, "Stuck")],
)
def test_delay_bounds(spark, age, category):
    assert spark.range(1).select(C.delay_category(F.lit(age)).alias("v")).first()["v"] == category


def test_names_defaults_and_genders(spark, keys):
    rows = cleaned(
        spark, keys, {"ddl_case_id": "full"},
        {"ddl_case_id": "none", "state_code": None, "dist_code": "77", "court_no": "x", "type_name": "5",
         "purpose_name": "", "disp_name": "0", "female_petitioner": "-9998 unclear", "female_defendant": "0 male"},
    )
    full, none = rows["full"], rows["none"]
    # Of two names for one code the first in text order is taken; the court's latest year wins.
    assert [full[c] for c in ("state_name", "district_name", "court_name", "case_type", "purpose", "disposal_type")] == [
        "North", "Hill", "New", "appeal", "hearing", "allowed"]
    assert [none[c] for c in ("state_name", "district_name", "court_name", "case_type", "purpose", "disposal_type")] == [
        "Unknown", "Unknown", "Unknown", "Unknown", "Not Listed", "Pending"]
    assert (full["petitioner_gender"], full["defendant_gender"]) == ("female", "unknown")
    assert (none["petitioner_gender"], none["defendant_gender"]) == ("unknown", "male")
    assert full["judge_position"] is None and none["court_no"] is None


def test_impossible_rows_and_ages(spark, keys):
    rows = cleaned(
        spark, keys,
        {"ddl_case_id": "same day", "date_of_decision": "2019-01-01"},
        {"ddl_case_id": "day before", "date_of_decision": "2018-12-31"},
        {"ddl_case_id": "no filing", "date_of_filing": "2019-02-30"},
        {"ddl_case_id": "bad decision", "date_of_decision": "soon"},
        {"ddl_case_id": "heard", "date_first_list": "2019-03-10", "date_last_list": "2019-03-01"},
    )
    assert set(rows) == {"same day", "bad decision", "heard"}
    assert (rows["same day"]["is_resolved"], rows["same day"]["case_age_days"]) == (1, 0)
    assert (rows["bad decision"]["is_resolved"], rows["bad decision"]["case_age_days"]) == (0, 365)
    assert rows["heard"]["hearing_span_days"] == -9 and rows["same day"]["hearing_span_days"] is None
    assert rows["heard"]["filing_year"] == 2019


def test_quality_counts(spark):
    counts = cleaning.quality_counts(messages(spark, {}, {"date_of_filing": ""}, {"date_of_decision": "2001-01-01"}))
    assert counts.first().asDict() == {
        "total_received": 3, "valid_records": 1, "null_records": 0, "duplicate_records": 0, "impossible_dates": 2}


def test_columns_and_types(spark, keys):
    from docketry.sources.sinks import CLEANED_DDL

    frame = cleaning.cases_cleaned(messages(spark, {}), keys, AS_OF)
    assert ", ".join(f"{n} {t}" for n, t in frame.dtypes) == CLEANED_DDL
    assert frame.columns == model.CLEANED_COLUMNS
