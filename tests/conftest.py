import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def facts(spark, sf_dir):
    """The cleaned cases of the smallest data, stored once."""
    import registered
    from docketry.sources import sinks
    from docketry.sources.workspace import new_folder

    path = new_folder(spark, "facts")
    sinks.write_cleaned(registered.cleaned(spark, sf_dir), path)
    return sinks.read_cleaned(spark, path)
