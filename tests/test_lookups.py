from dataclasses import replace

from pyspark.sql import functions as F

import registered
from docketry.operators import lookups
from docketry.plans import cleaning, summaries
from docketry.sources import testdata


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_salted_join_equals_broadcast(spark, sf_dir):
    typed = registered.typed(spark, sf_dir)
    keys = testdata.case_keys(spark, sf_dir)
    large = {name: replace(lk, small=False) for name, lk in keys.items()}
    a, b = cleaning.enriched_cases(typed, keys), cleaning.enriched_cases(typed, large)
    assert rows(a) == rows(b.select(*a.columns))
    assert a.count() == typed.count()


def test_heavy_codes_are_found(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, 9).otherwise(F.col("id")).cast("int")
    fact = spark.range(0, 60_000, 1, 6).select(F.when(F.col("id") % 11 > 0, hot).alias("code"))
    hashes = {r[0]: r[1] for r in spark.createDataFrame([(7,), (9,)], "code int").select("code", F.xxhash64("code")).collect()}
    assert set(lookups.heavy_codes(fact, ["code"], 1 / 100)) == set(hashes.values())
    assert lookups.heavy_codes(fact, ["code"], 1 / 10) == [hashes[7]]
    assert lookups.heavy_codes(fact.limit(0), ["code"]) == []
    assert lookups.heavy_codes(fact.select(F.lit(None).cast("int").alias("code")), ["code"]) == []


def test_only_heavy_codes_are_joined_apart_and_the_lookup_is_moved_once(spark):
    """Half of the rows have one code, a tenth has none, the others are spread; nothing is copied, nothing is in one task."""
    code = F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).cast("int")
    fact = spark.range(0, 40_000, 1, 4).select(code.alias("code"), "id")
    names = spark.range(0, 30_000).select(F.col("id").cast("int").alias("code"), F.concat(F.lit("n"), "id").alias("name"))
    key = lookups.Lookup(names, ("code",))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = lookups.lookup_join(fact, key)
        text = plan(joined)
        assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 1 and "Generate" not in text
        sizes = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert sizes < 2 * 40_000 / 8
        got = {r["id"]: r["name"] for r in joined.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(got) == 40_000
    for i, name in got.items():
        code = 1 if i % 2 == 0 else None if i % 10 == 1 else i
        assert name == (f"n{code}" if code is not None and code < 30_000 else None)


def test_sizes_decide(spark):
    key = spark.range(1000).select(F.col("id").cast("int").alias("code"), F.lit("x" * 50).alias("name"))
    given = {"k": lookups.Lookup(key, ("code",))}
    assert lookups.check_sizes(given)["k"].small
    assert not lookups.check_sizes(given, limit=10_000)["k"].small


def test_six_broadcasts_and_no_python(spark, sf_dir):
    text = plan(registered.cleaned(spark, sf_dir))
    assert "SortMergeJoin" not in text and "Python" not in text
    assert text.count("BroadcastHashJoin") == 9  # six keys; customers, nations and hearings of the view


def test_unused_keys_are_not_joined(spark, sf_dir):
    yearly = summaries.summarise(registered.cleaned(spark, sf_dir), "yearly_summary")
    assert plan(yearly).count("BroadcastHashJoin") == 1  # the hearings


def test_facts_are_pruned_and_filtered_at_the_scan(spark, facts):
    text = plan(summaries.summarise(facts.filter("filing_year = 1997"), "gender_summary"))
    scan = text[text.index("FileScan"):]
    assert "PartitionFilters: [isnotnull(filing_year" in scan
    assert "court_name" not in scan and "petitioner_gender" in scan
