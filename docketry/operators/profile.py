"""Table profiles and the two cleaning tracks used to get to know a file."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.columns import code_to_int
from docketry.sources.workspace import hadoop_path, side_by_side

log = logging.getLogger(__name__)


def profile(frame: DataFrame, name: str) -> DataFrame:
    """One row per column: position, name, nulls, and the table's row and column counts. One scan."""
    names = frame.columns
    counted = frame.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)]
    )
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(c).alias("column_name"),
                    (F.col("n") - F.col(f"c{i}")).alias("nulls"),
                )
                for i, c in enumerate(names)
            ]
        )
    )
    return counted.select(
        F.lit(name).alias("table_name"),
        F.col("n").alias("row_count"),
        F.lit(len(names)).alias("column_count"),
        rows,
    )


def profile_tables(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(f, n) for n, f in frames.items()])


PROFILE_DDL = (
    "table_name string, status string, note string, row_count bigint, column_count int, position int, column_name string, "
    "column_type string, nulls bigint, first_value string"
)


def _counts_and_first_row(frame: DataFrame) -> list[tuple]:
    """(rows, columns, position, name, type, nulls, value of the first row) of each column, in one pass.

    The first row is the smallest by its columns in order, the same one on each run.
    """
    names = [f"`{c}`" for c in frame.columns]
    row = frame.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(names)])).alias("first"),
        *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(names)],
    )
    shown = row.select("n", *[f"c{i}" for i in range(len(names))], *[F.col(f"first.v{i}").cast("string").alias(f"f{i}") for i in range(len(names))])
    found = shown.first()
    return [
        (found["n"], len(names), i, f.name, f.dataType.simpleString(), found["n"] - found[f"c{i}"], found[f"f{i}"])
        for i, f in enumerate(frame.schema)
    ]


def profile_paths(spark: SparkSession, paths: dict[str, str], reader: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """The profile of each source by its path: a row per column, or one warning row.

    Sources are read by themselves, several at a time: one that is `missing`, `unreadable` (with the first line of the error in
    `note`) or `empty` of columns does not keep the others from being read. `reader` reads a path, Parquet by default.
    Rows are as many as columns in all sources.
    """
    read = reader or (lambda session, path: session.read.parquet(path))

    def of(name: str) -> list[tuple]:
        place, system = hadoop_path(spark, paths[name])
        if not system.exists(place):
            log.warning("no file for %s: %s", name, paths[name])
            return [(name, "missing", paths[name], *[None] * 7)]
        try:
            columns = _counts_and_first_row(read(spark, paths[name]))
        except Exception as error:  # noqa: BLE001 - whatever a reader raises is what the row reports
            note = str(error).strip().splitlines()[0][:200] if str(error).strip() else type(error).__name__
            log.warning("cannot read %s: %s", name, note)
            return [(name, "unreadable", note, *[None] * 7)]
        return [(name, "ok", None, *c) for c in columns] or [(name, "empty", None, *[None] * 7)]

    rows = side_by_side(spark, of, paths)
    return spark.createDataFrame([r for part in rows for r in part], PROFILE_DDL)


def first_rows(frame: DataFrame, rows: int, *order: str) -> DataFrame:
    """The sample rows of a profile: the first in the given order, the same ones on each run."""
    return frame.orderBy(*order).limit(rows)


def with_parsed_dates(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "filing_date_parsed": F.try_to_date("date_of_filing", "yyyy-MM-dd"),
            "decision_date_parsed": F.try_to_date("date_of_decision", "yyyy-MM-dd"),
        }
    )


def _positive(code: str):
    return F.coalesce(code_to_int(F.col(code)) > 0, F.lit(False))


def _is_resolved():
    return F.coalesce(
        F.datediff("decision_date_parsed", "filing_date_parsed") >= 0, F.lit(False)
    ) & _positive("state_code") & _positive("disp_name")


def _is_pending():
    return (
        F.col("date_of_decision").isNull()
        & F.col("filing_date_parsed").isNotNull()
        & _positive("state_code")
    )


def resolved_pool(raw: DataFrame) -> DataFrame:
    """Decided cases with a possible duration and usable codes. Empty fields must be null in `raw`."""
    pool = with_parsed_dates(raw).filter(_is_resolved())
    return pool.withColumn("duration_days", F.datediff("decision_date_parsed", "filing_date_parsed"))


def pending_pool(raw: DataFrame) -> DataFrame:
    """Cases with no decision date at all; an unreadable one does not make a case pending."""
    return with_parsed_dates(raw).filter(_is_pending())


def cleaning_profile(raw: DataFrame) -> DataFrame:
    """Sizes of the file and of both pools in one pass."""
    return with_parsed_dates(raw).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(_is_resolved()).alias("resolved_rows"),
        F.count_if(_is_pending()).alias("pending_rows"),
    )


def resolved_sample(raw: DataFrame, rows: int = 3) -> DataFrame:
    """What the resolved pool looks like: a few rows with their parsed dates."""
    shown = ["ddl_case_id", "filing_date_parsed", "decision_date_parsed", "duration_days"]
    return first_rows(resolved_pool(raw).select(*shown), rows, "ddl_case_id")
