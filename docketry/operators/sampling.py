"""Which rows a model learns from: splits by time, splits by hash, a cap per year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry import model
from docketry.functions.columns import unit_hash


def split_of(
    year: Column, train_until: int = model.TRAIN_UNTIL, validate_until: int = model.VALIDATE_UNTIL
) -> Column:
    return F.when(year <= train_until, "train").when(year <= validate_until, "validation").otherwise("test")


def temporal_split(
    cases: DataFrame, train_until: int = model.TRAIN_UNTIL, validate_until: int = model.VALIDATE_UNTIL
) -> DataFrame:
    """All dated cases with their `split`; a label in one scan instead of three frames."""
    dated = cases.filter(F.col("filing_year").isNotNull())
    return dated.withColumn("split", split_of(F.col("filing_year"), train_until, validate_until))


def fallback_split(cases: DataFrame, seed: int = model.SEED) -> DataFrame:
    """About 70/15/15 by a hash of the case id: the same rows on every run and every retry."""
    draw = unit_hash(F.lit(seed), F.col("ddl_case_id"))
    split = F.when(draw < 0.70, "train").when(draw < 0.85, "validation").otherwise("test")
    return cases.withColumn("split", split)


def split_cases(cases: DataFrame, train_until: int, validate_until: int) -> DataFrame:
    """By time, or by hash over all rows where a part of the time split would be empty."""
    parts = temporal_split(cases, train_until, validate_until)
    present = {r["split"] for r in parts.select("split").distinct().collect()}
    return parts if present == {"train", "validation", "test"} else fallback_split(cases)


def row_digest(columns: list[str]) -> Column:
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *text))


def distinct_years(cases: DataFrame) -> DataFrame:
    return cases.select("filing_year").filter("filing_year IS NOT NULL").distinct().orderBy("filing_year")


def yearly_cap(cases: DataFrame, rows: int = model.ROWS_PER_YEAR) -> DataFrame:
    """At most `rows` cases of each filing year: those with the smallest row digests.

    A plain rank per year would sort a whole year in one task. Instead the rows
    are counted by the head of their digest; the counts tell at which head each
    year is full, and only rows up to that head are ranked: `rows` plus one
    bucket of 65,536. Equal rows are ranked as one row with a count, so many
    copies of one row cannot fill a bucket. A filing year has four digits, which
    bounds the broadcast list at 10,000 rows.
    """
    columns = cases.columns
    digest = F.col("_digest")
    dated = cases.filter(F.col("filing_year").isNotNull()).withColumn("_digest", row_digest(columns))
    head = F.substring(digest, 1, 4)
    counts = dated.groupBy("filing_year", head.alias("_head")).agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.partitionBy("filing_year").orderBy("_head")
    full = counts.withColumn("_filled", F.sum("_n").over(up_to)).filter(F.col("_filled") >= rows)
    last = full.groupBy("filing_year").agg(F.min("_head").alias("_last"))

    near = dated.join(F.broadcast(last), "filing_year", "left")
    near = near.filter(F.col("_last").isNull() | (head <= F.col("_last")))
    ranked = near.groupBy(*columns, "_digest").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("filing_year").orderBy("_digest", *columns)
    before = F.sum("_n").over(order) - F.col("_n")
    kept = ranked.withColumn("_kept", F.least(F.col("_n"), F.lit(rows) - before)).filter("_kept > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_kept")))
    return kept.select(*columns, copies.alias("_copy")).drop("_copy")


def class_distribution(rows: DataFrame) -> DataFrame:
    counted = rows.groupBy("is_resolved").agg(F.count(F.lit(1)).alias("cases"))
    return counted.orderBy(F.desc("cases"), "is_resolved")
