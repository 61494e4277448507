import pytest
from pyspark.sql import functions as F

from docketry.plans import summaries
from docketry.sources.workspace import new_folder


@pytest.fixture(scope="module")
def one_pass(spark, facts):
    return summaries.all_summaries(facts, new_folder(spark, "tables"))


@pytest.mark.parametrize("name", summaries.SUMMARY_TABLES)
def test_one_pass_equals_direct(facts, one_pass, name):
    direct = summaries.summarise(facts, name)
    assert one_pass[name].columns == direct.columns
    assert one_pass[name].dtypes == direct.dtypes
    assert sorted(map(str, one_pass[name].collect())) == sorted(map(str, direct.collect()))


def test_totals_agree(facts, one_pass):
    n = facts.count()
    for name in ["yearly_summary", "state_summary", "district_summary", "casetype_summary", "delay_summary",
                 "judge_summary", "gender_summary", "disposal_summary", "defendant_gender_summary",
                 "casetype_delay_crosstab"]:
        assert one_pass[name].agg(F.sum("total_cases")).first()[0] == n, name
    counters = summaries.run_counters(facts).first()
    assert counters["total_cases"] == n == counters["resolved_cases"] + counters["pending_cases"]


def test_percentages_add_up(one_pass):
    assert one_pass["delay_summary"].agg(F.sum("percentage")).first()[0] == pytest.approx(100, abs=0.02)


def test_orders(one_pass):
    years = [r["filing_year"] for r in one_pass["yearly_summary"].collect()]
    assert years == sorted(years)
    totals = [r["total_cases"] for r in one_pass["district_summary"].collect()]
    assert totals == sorted(totals, reverse=True)


def test_trend_equals_yearly(one_pass):
    trend = one_pass["time_trends"].filter("period_type = 'yearly'")
    pick = ["total_cases", "resolved_cases", "pending_cases", "resolution_rate"]
    got = {r["period_value"]: tuple(r[c] for c in pick) for r in trend.collect()}
    want = {str(r["filing_year"]): tuple(r[c] for c in pick) for r in one_pass["yearly_summary"].collect()}
    assert got == want


def test_empty_average_is_null(spark):
    rows = [("Civil", 0, 10, 5, "Fast")]
    cases = spark.createDataFrame(
        rows, "case_type string, is_resolved int, case_age_days int, hearing_span_days int, delay_category string"
    )
    assert summaries.summarise(cases, "casetype_summary").first()["avg_resolution_days"] is None
    assert summaries.summarise(cases, "casetype_delay_crosstab").first().asDict() == {
        "case_type": "Civil", "Fast": 1, "Medium": 0, "Slow": 0, "Stuck": 0, "total_cases": 1}


def test_one_scan_for_all_groupings(facts):
    groups = summaries.summary_groups(facts)
    text = groups._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
