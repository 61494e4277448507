"""The docket view of the star-schema test tables.

One case is one order, its hearings are the lineitems, codes come from the
customer's nation. Bad codes, bad dates, missing keys and nulls are built in.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.operators.lookups import Lookup, build_keys, check_sizes, lookup_join
from docketry.sources.workspace import hadoop_path, new_folder, stored

AS_OF = date(2004, 1, 1)
TRAIN_UNTIL, VALIDATE_UNTIL = 1998, 2000
FILE_YEARS = range(1993, 2012)
SEGMENTS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(column: Column, options: dict, otherwise=None) -> Column:
    rule = F
    for value, result in options.items():
        rule = rule.when(column == value, F.lit(result))
    return rule.otherwise(F.lit(otherwise))


def _pick(key: Column, texts: list[str | None]) -> Column:
    """One of the texts by the remainder of the key."""
    return F.get(F.array(*[F.lit(t) for t in texts]), (key % len(texts)).cast("int"))


def _unique(frame: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row per key. Catalyst then knows the key is unique and leaves out a
    left join whose columns a query does not use."""
    return frame.groupBy(key).agg(*[F.min(c).alias(c) for c in columns])


def data_state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the files of a data folder, to tell when it has changed."""
    found = []
    for name in TABLES:
        place, system = hadoop_path(spark, f"{sf_dir}/{name}.parquet")
        if system.exists(place):
            found += [f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in system.listStatus(place)]
    return "\n".join(sorted(found))


_SMALL: dict[tuple[str, str, str], dict[str, bool]] = {}


def _checked(spark: SparkSession, sf_dir: str, sides: dict[str, Lookup]) -> dict[str, Lookup]:
    """The lookups with their sizes, which are measured once per session and state of the folder."""
    mark = (spark.sparkContext.applicationId, sf_dir, data_state(spark, sf_dir))
    if mark not in _SMALL:
        _SMALL[mark] = {name: lookup.small for name, lookup in check_sizes(sides).items()}
    return {name: replace(lookup, small=_SMALL[mark][name]) for name, lookup in sides.items()}


def case_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 text columns of a case message, one row per order.

    Customers and nations are lookups of checked size: broadcast while they fit, and beyond that joined on
    the key and a salt, so that a customer who holds a large share of the orders is spread over many tasks.
    """
    # Codes instead of texts keep this aggregation in the hash table.
    coded = table(spark, sf_dir, "customer").withColumn("segment", _choose(F.col("c_mktsegment"), SEGMENTS))
    customers = _unique(coded.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "segment", "c_nationkey")
    nations = _unique(
        table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "n_regionkey"
    )
    sides = _checked(spark, sf_dir, {"customer": Lookup(customers, ("o_custkey",)), "nation": Lookup(nations, ("c_nationkey",))})
    hearings = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").cast("date").alias("first"), F.max("l_shipdate").cast("date").alias("last")
    )
    # The join with the hearings needs the orders by their key in any case. Doing it
    # here also spreads the work where the hearings are small enough to be broadcast.
    o = (
        table(spark, sf_dir, "orders")
        .repartition("o_orderkey")
        .join(hearings, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    )
    o = lookup_join(lookup_join(o, sides["customer"]), sides["nation"])

    key, status, first, last = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("first"), F.col("last")

    def day(d: Column) -> Column:
        return d.cast("string")

    filing = (
        F.when(key % 101 == 0, "2010-02-30")
        .when(key % 103 == 0, "01/02/1999")
        .otherwise(day(F.col("o_orderdate").cast("date")))
    )
    return o.select(
        F.concat(F.lit("C"), key).alias("ddl_case_id"),
        (F.col("n_regionkey") + 1).cast("string").alias("state_code"),
        (F.col("c_nationkey") + 1).cast("string").alias("dist_code"),
        (F.col("o_custkey") % 7).cast("string").alias("court_no"),
        F.when(key % 11 != 0, F.col("o_orderpriority")).alias("judge_position"),
        F.col("segment").cast("string").alias("type_name"),
        F.substring("o_orderpriority", 1, 1).alias("purpose_name"),
        F.when(key % 97 == 0, "x")
        .otherwise(_choose(status, {"F": "1", "O": "2", "P": "3"}))
        .alias("disp_name"),
        filing.alias("date_of_filing"),
        F.when(status == "F", day(last)).otherwise("").alias("date_of_decision"),
        day(first).alias("date_first_list"),
        day(last).alias("date_last_list"),
        F.when(status == "O", day(F.date_add(last, 30))).alias("date_next_list"),
        _pick(key, ["1 female", "0 male", "0 male", "-9998 unclear", None]).alias("female_petitioner"),
        _pick(key, ["1 female", "0 male", "-9999 missing name", None]).alias("female_defendant"),
    )


def raw_keys(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six raw key tables; their holes make the default texts show."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    place = nation.select(
        (F.col("n_regionkey") + 1).cast("string").alias("state_code"),
        (F.col("n_nationkey") + 1).cast("string").alias("dist_code"),
        F.col("n_name").alias("district_name"),
    )
    courts = place.withColumn("court", F.explode(F.sequence(F.lit(0), F.lit(5)))).withColumn(
        "year", F.explode(F.sequence(F.lit(2016), F.lit(2018)))
    )
    priority = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return {
        "type": spark.sql(
            "SELECT * FROM VALUES ('1', 'AUTOMOBILE'), ('2', 'BUILDING'), ('3', 'FURNITURE'), "
            "('4', 'HOUSEHOLD') AS k(type_name, type_name_s)"
        ),
        "disposition": spark.sql(
            "SELECT * FROM VALUES ('1', 'disposed'), ('2', 'dismissed') AS k(disp_name, disp_name_s)"
        ),
        "purpose": priority.filter("o_orderpriority <> '3-MEDIUM'").select(
            F.substring("o_orderpriority", 1, 1).alias("purpose_name"),
            F.col("o_orderpriority").alias("purpose_name_s"),
        ),
        "state": region.filter("r_regionkey <> 4").select(
            (F.col("r_regionkey") + 1).cast("string").alias("state_code"), F.col("r_name").alias("state_name")
        ),
        "district": place,
        "court": courts.select(
            "year",
            "state_code",
            "dist_code",
            F.col("court").cast("string").alias("court_no"),
            F.format_string("Court %d of %s (%d)", "court", "district_name", "year").alias("court_name"),
        ),
    }


_KEYS: dict[tuple[str, str, str], dict[str, Lookup]] = {}


def case_keys(spark: SparkSession, sf_dir: str) -> dict[str, Lookup]:
    """The unique keys; once per session and state of the folder their sizes are measured.

    The purposes come from the large orders table and are stored, so that a query
    does not look for them again.
    """
    mark = (spark.sparkContext.applicationId, sf_dir, data_state(spark, sf_dir))
    if mark not in _KEYS:
        raw = raw_keys(spark, sf_dir)
        raw["purpose"] = stored(raw["purpose"], new_folder(spark, "purposes"))
        _KEYS[mark] = build_keys(raw)
    return _KEYS[mark]
