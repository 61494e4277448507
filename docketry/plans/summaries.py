"""The summary tables of the cleaned cases.

Each table is a grouping, a list of measures and an order. All measures are
finished from the same few sums and counts, which lets `all_summaries` compute
every grouping in one scan of the fact with GROUPING SETS.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry import model
from docketry.sources.workspace import stored


def parts() -> list[Column]:
    """Sums and counts that every measure is made of; all combine before the shuffle."""
    resolved_age = F.when(F.col("is_resolved") == 1, F.col("case_age_days"))
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("is_resolved").alias("resolved"),
        F.sum("case_age_days").alias("age_sum"),
        F.count("case_age_days").alias("age_n"),
        F.sum(resolved_age).alias("resolved_age_sum"),
        F.count(resolved_age).alias("resolved_age_n"),
        F.sum("hearing_span_days").alias("span_sum"),
        F.count("hearing_span_days").alias("span_n"),
        F.max("hearing_span_days").alias("span_max"),
    ]


PARTS = [
    "n", "resolved", "age_sum", "age_n", "resolved_age_sum", "resolved_age_n", "span_sum", "span_n", "span_max",
]


def _mean(total: str, rows: str) -> Column:
    return F.round(F.try_divide(F.col(total), F.col(rows)), 0)


def measures() -> dict[str, Column]:
    return {
        "total_cases": F.col("n"),
        "resolved_cases": F.col("resolved"),
        "pending_cases": F.col("n") - F.col("resolved"),
        "resolution_rate": F.round(F.col("resolved") / F.col("n") * 100, 2),
        "avg_case_age": _mean("age_sum", "age_n"),
        "avg_resolution_days": _mean("resolved_age_sum", "resolved_age_n"),
    }


def _chosen(names: Iterable[str]) -> list[Column]:
    known = measures()
    return [known[name].alias(name) for name in names]


WORKLOAD = ["total_cases", "resolved_cases", "pending_cases", "resolution_rate"]
CLEARANCE = ["total_cases", "resolved_cases", "resolution_rate", "avg_resolution_days"]


@dataclass(frozen=True)
class Summary:
    by: tuple[str, ...]
    measures: tuple[str, ...]
    order: str | None = None


def _spec(by: str, measures: list[str], order: str | None = None) -> Summary:
    return Summary(tuple(by.split()), tuple(measures), order)


SUMMARIES = {
    "yearly_summary": _spec("filing_year", WORKLOAD + ["avg_case_age"], "filing_year"),
    "state_summary": _spec("state_name", WORKLOAD + ["avg_case_age"], "total"),
    "casetype_summary": _spec("case_type", WORKLOAD + ["avg_resolution_days"], "total"),
    "judge_summary": _spec("judge_position", CLEARANCE, "total"),
    "gender_summary": _spec("petitioner_gender", CLEARANCE),
    "district_summary": _spec("state_name district_name", WORKLOAD + ["avg_case_age"], "total"),
    "disposal_summary": _spec(
        "disposal_type", ["total_cases", "avg_case_age", "avg_resolution_days"], "total"
    ),
    "defendant_gender_summary": _spec("defendant_gender", CLEARANCE),
}

# The tables in the order in which they are exported.
SUMMARY_TABLES = [
    "yearly_summary",
    "state_summary",
    "district_summary",
    "casetype_summary",
    "delay_summary",
    "judge_summary",
    "gender_summary",
    "time_trends",
    "disposal_summary",
    "hearing_span_summary",
    "defendant_gender_summary",
    "oldest_pending_cases",
    "casetype_delay_crosstab",
]


def _total_first(frame: DataFrame, by: list[str]) -> DataFrame:
    return frame.orderBy(F.desc("total_cases"), *by)


def export_orders() -> dict[str, list[str | Column]]:
    """The order of each table that has one, for exports of tables that were written and read back."""
    total = F.desc("total_cases")
    orders: dict[str, list[str | Column]] = {
        "hearing_span_summary": [total, "case_type", "delay_category"],
        "casetype_delay_crosstab": [total, "case_type"],
        "oldest_pending_cases": [F.desc("case_age_days"), "ddl_case_id"],
        "time_trends": ["period_type", "period_value"],
    }
    for name, spec in SUMMARIES.items():
        if spec.order == "total":
            orders[name] = [total, *spec.by]
        elif spec.order:
            orders[name] = [spec.order]
    return orders


def finish(grouped: DataFrame, name: str) -> DataFrame:
    """Turn the parts of one grouping into the named summary table."""
    spec = SUMMARIES[name]
    table = grouped.select(*spec.by, *_chosen(spec.measures))
    if spec.order == "total":
        return _total_first(table, list(spec.by))
    return table.orderBy(spec.order) if spec.order else table


def _finish_delay(grouped: DataFrame) -> DataFrame:
    # The window covers the rows of this table, one per delay category.
    whole = F.sum("n").over(Window.partitionBy())
    share = F.round(F.col("n") / whole * 100, 2)
    return grouped.select("delay_category", F.col("n").alias("total_cases"), share.alias("percentage"))


def _period(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("period_type"), value.alias("period_value"))


def _finish_trends(by_year: DataFrame, by_month: DataFrame) -> DataFrame:
    year, month = _period("yearly", F.col("filing_year").cast("string")), _period("monthly", F.col("filing_month"))
    yearly = by_year.select(year.alias("p"), *_chosen(WORKLOAD)).select("p.*", *WORKLOAD)
    return yearly.unionByName(by_month.select(month.alias("p"), *_chosen(WORKLOAD)).select("p.*", *WORKLOAD))


def _finish_hearing_span(grouped: DataFrame) -> DataFrame:
    by = ["case_type", "delay_category"]
    table = grouped.filter("span_n > 0").select(
        *by,
        F.col("span_n").alias("total_cases"),
        _mean("span_sum", "span_n").alias("avg_hearing_span_days"),
        F.col("span_max").alias("max_hearing_span_days"),
    )
    return _total_first(table, by)


def _finish_crosstab(grouped: DataFrame) -> DataFrame:
    wide = grouped.groupBy("case_type").pivot("delay_category", model.DELAY_CATEGORIES)
    table = wide.agg(F.sum("n")).fillna(0, model.DELAY_CATEGORIES)
    total = sum((F.col(c) for c in model.DELAY_CATEGORIES[1:]), F.col(model.DELAY_CATEGORIES[0]))
    return _total_first(table.withColumn("total_cases", total), ["case_type"])


def with_month(cases: DataFrame) -> DataFrame:
    return cases.withColumn("filing_month", F.date_format("date_of_filing", "yyyy-MM"))


def _grouped(cases: DataFrame, *by: str) -> DataFrame:
    return cases.groupBy(*by).agg(*parts())


def summarise(cases: DataFrame, name: str) -> DataFrame:
    """One summary table straight from the cleaned cases."""
    if name in SUMMARIES:
        return finish(_grouped(cases, *SUMMARIES[name].by), name)
    if name == "delay_summary":
        return _finish_delay(_grouped(cases, "delay_category"))
    if name == "time_trends":
        return _time_trends(cases)
    if name == "hearing_span_summary":
        return _finish_hearing_span(_grouped(cases, "case_type", "delay_category"))
    if name == "casetype_delay_crosstab":
        return _finish_crosstab(_grouped(cases, "case_type", "delay_category"))
    if name == "oldest_pending_cases":
        return oldest_pending_cases(cases)
    raise KeyError(name)


def _time_trends(cases: DataFrame) -> DataFrame:
    """Both periods from one scan: the few monthly groups are counted towards their month and year."""
    months = _grouped(with_month(cases), "filing_year", "filing_month")
    period = F.explode(
        F.array(
            _period("yearly", F.col("filing_year").cast("string")), _period("monthly", F.col("filing_month"))
        )
    )
    return (
        months.select(period.alias("p"), "n", "resolved")
        .groupBy("p.period_type", "p.period_value")
        .agg(F.sum("n").alias("n"), F.sum("resolved").alias("resolved"))
        .select("period_type", "period_value", *_chosen(WORKLOAD))
    )


def oldest_pending_cases(cases: DataFrame, rows: int = model.OLDEST_PENDING) -> DataFrame:
    """Top-k report: each task keeps its own k rows, nothing is sorted as a whole."""
    return (
        cases.filter("is_resolved = 0")
        .select(
            "ddl_case_id",
            "state_name",
            "district_name",
            "court_name",
            "case_type",
            "date_of_filing",
            "case_age_days",
            "delay_category",
        )
        .orderBy(F.desc("case_age_days"), "ddl_case_id")
        .limit(rows)
    )


def run_counters(cases: DataFrame) -> DataFrame:
    """Rows, resolved rows and pending rows of the fact."""
    counted = cases.agg(
        F.count(F.lit(1)).alias("total_cases"), F.count_if(F.col("is_resolved") == 1).alias("resolved_cases")
    )
    return counted.withColumn("pending_cases", F.col("total_cases") - F.col("resolved_cases"))


# The groupings that are taken from the fact; all others are rolled up from one of these.
# Genders have three values each, so that going with the months they make few groups.
GROUPINGS = [
    ("filing_year", "filing_month", "petitioner_gender", "defendant_gender"),
    ("state_name", "district_name"),
    ("case_type", "delay_category"),
    ("judge_position",),
    ("disposal_type",),
]
DIMENSIONS = [c for grouping in GROUPINGS for c in grouping]


def grouping_mark(by: tuple[str, ...]) -> int:
    """The grouping_id() of a grouping: a one bit for each dimension left out, first one highest."""
    return int("".join("0" if d in by else "1" for d in DIMENSIONS), 2)


def summary_groups(cases: DataFrame) -> DataFrame:
    """All groupings of the fact in one scan and one shuffle of partial sums."""
    base = with_month(cases)
    sets = [[F.col(c) for c in g] for g in GROUPINGS]
    return base.groupingSets(sets, *DIMENSIONS).agg(F.grouping_id().alias("mark"), *parts())


def roll_up(groups: DataFrame, *by: str) -> DataFrame:
    """The parts of a coarser grouping from those of a finer one."""
    sums = [c for c in PARTS if c != "span_max"]
    return groups.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums], F.max("span_max").alias("span_max"))


def all_summaries(cases: DataFrame, folder: str) -> dict[str, DataFrame]:
    """The 13 tables from two scans of the fact: twelve from one, the oldest pending cases from another.

    The groups, one row per group and grouping, are written under `folder` and
    the twelve tables are rolled up from there.
    """
    groups = stored(summary_groups(cases), f"{folder}/summary_groups", partition_by=["mark"])

    def of(*by: str) -> DataFrame:
        finest = next(g for g in GROUPINGS if set(by) <= set(g))
        return roll_up(groups.filter(F.col("mark") == grouping_mark(finest)), *by)

    tables = {name: finish(of(*spec.by), name) for name, spec in SUMMARIES.items()}
    tables["delay_summary"] = _finish_delay(of("delay_category"))
    tables["time_trends"] = _finish_trends(of("filing_year"), of("filing_month"))
    tables["hearing_span_summary"] = _finish_hearing_span(of("case_type", "delay_category"))
    tables["casetype_delay_crosstab"] = _finish_crosstab(of("case_type", "delay_category"))
    tables["oldest_pending_cases"] = oldest_pending_cases(cases)
    return {name: tables[name] for name in SUMMARY_TABLES}
