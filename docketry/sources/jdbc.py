"""Tables in a database over JDBC. Address and login come from the caller only."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession

from docketry import model


def partitioned_reader(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    years: range = model.FILING_YEARS,
    partitions: int = model.JDBC_READ_PARTITIONS,
) -> DataFrameReader:
    """A parallel read split on the filing year.

    The bounds only set the stride: rows of earlier, later or no years are read too.
    """
    return spark.read.format("jdbc").options(
        **(properties or {}),
        url=url,
        dbtable=table,
        fetchsize=model.JDBC_FETCH_SIZE,
        partitionColumn="filing_year",
        lowerBound=years[0],
        upperBound=years[-1],
        numPartitions=partitions,
    )


def writer(
    frame: DataFrame, url: str, table: str, mode: str, properties: dict[str, str] | None = None
) -> DataFrameWriter:
    """A batched write over at most JDBC_WRITERS connections; Spark merges larger inputs to that number."""
    return frame.write.format("jdbc").mode(mode).options(
        **(properties or {}),
        url=url,
        dbtable=table,
        batchsize=model.JDBC_BATCH_SIZE,
        numPartitions=model.JDBC_WRITERS,
        reWriteBatchedInserts="true",
    )
