import logging
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from docketry import model
from docketry.sources import files, jdbc, messages, sinks


def test_yearly_files_by_header_and_missing_years(spark, tmp_path, caplog):
    (tmp_path / "cases_2010.csv").write_text('ddl_case_id,judge_position,state_code\na,"chief, ""x""",01\nb,,2\n')
    (tmp_path / "cases_2012.csv").write_text("state_code,extra,ddl_case_id\n3,z,c\n")
    (tmp_path / "cases_2013.csv").write_text("ddl_case_id\nx\n")
    with caplog.at_level(logging.WARNING):
        rows = files.read_yearly_csv(spark, str(tmp_path), range(2010, 2013))
    got = {r["ddl_case_id"]: r for r in rows.collect()}
    assert got["a"]["judge_position"] == 'chief, "x"' and got["a"]["state_code"] == "01"
    assert got["b"]["judge_position"] == "" and got["c"]["judge_position"] is None
    assert (got["c"]["state_code"], got["c"]["file_year"]) == ("3", 2012)
    assert rows.columns == model.MESSAGE_COLUMNS + ["file_year"]
    assert "2011" in caplog.text and "cases_2013.csv" in caplog.text
    assert sorted(map(tuple, files.published_per_year(rows).collect())) == [(2010, 2), (2012, 1)]


def test_a_line_break_in_a_field_is_an_error_or_read_right(spark, tmp_path):
    text = 'ddl_case_id,judge_position,state_code\na,"chief\njudge",1\nb,c,2\n'
    (tmp_path / "cases_2010.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_yearly_csv(spark, str(tmp_path), [2010]).collect()
    rows = files.read_yearly_csv(spark, str(tmp_path), [2010], multi_line=True).collect()
    assert {(r["ddl_case_id"], r["judge_position"], r["state_code"]) for r in rows} == {("a", "chief\njudge", "1"), ("b", "c", "2")}


def test_a_record_with_too_few_or_too_many_fields_is_an_error(spark, tmp_path):
    for bad in ("a", "a,b,c"):
        (tmp_path / "cases_2010.csv").write_text(f"ddl_case_id,state_code\nx,1\n{bad}\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            files.read_yearly_csv(spark, str(tmp_path), [2010]).select("ddl_case_id").collect()


def test_two_headers_in_one_folder_are_an_error(spark, tmp_path):
    (tmp_path / "cases_2010").mkdir()
    (tmp_path / "cases_2010" / "a.csv").write_text("ddl_case_id,state_code\nx,1\n")
    (tmp_path / "cases_2010" / "b.csv").write_text("state_code,ddl_case_id\n02,B\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_yearly_csv(spark, str(tmp_path), [2010], "cases_{year}").collect()


def test_publishing_again_replaces(spark, tmp_path):
    row = spark.createDataFrame([dict.fromkeys(model.MESSAGE_COLUMNS)], model.MESSAGE_DDL)
    for _ in range(2):
        messages.publish_to_files(row, str(tmp_path / "topic"))
    assert spark.read.text(str(tmp_path / "topic")).count() == 1


def test_no_file_at_all(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_yearly_csv(spark, str(tmp_path), range(2010, 2012))


def test_key_files(spark, tmp_path):
    for file, codes, name, _ in model.KEY_TABLES.values():
        year = "year," if "court" in file else ""
        (tmp_path / file).write_text(f"{year}{','.join(codes)},{name}\n" + ("2011," if year else "")
                                     + ",".join("1" for _ in codes) + ",n\n")
    keys = files.read_keys(spark, str(tmp_path))
    assert {k: lk.frame.count() for k, lk in keys.items()} == dict.fromkeys(model.KEY_TABLES, 1)
    assert all(lk.small for lk in keys.values())


def test_json_keeps_nulls_and_bad_text_gives_nulls(spark):
    row = spark.createDataFrame([dict.fromkeys(model.MESSAGE_COLUMNS)], model.MESSAGE_DDL)
    text = messages.encode(row).first()["value"]
    assert text.count(":null") == len(model.MESSAGE_COLUMNS)
    raw = spark.createDataFrame([(b"{oops",), (b'{"ddl_case_id": "1"}',)], "value binary")
    assert [r["ddl_case_id"] for r in messages.decode(raw).collect()] == [None, "1"]


def test_json_is_parsed_once(spark, sf_dir):
    from docketry.plans import cleaning
    from docketry.sources import testdata

    raw = spark.createDataFrame([("{}",)], "value string")
    cleaned = cleaning.cases_cleaned(messages.decode(raw), testdata.case_keys(spark, sf_dir), testdata.AS_OF)
    assert cleaned._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_jdbc_options():
    # No database is started here; only the options that Spark is given are checked.
    spark, frame = MagicMock(), MagicMock()
    jdbc.partitioned_reader(spark, "jdbc:x", "cases_cleaned", {"user": "u"})
    spark.read.format.assert_called_with("jdbc")
    assert spark.read.format.return_value.options.call_args.kwargs == {
        "user": "u", "url": "jdbc:x", "dbtable": "cases_cleaned", "fetchsize": 10_000,
        "partitionColumn": "filing_year", "lowerBound": 2010, "upperBound": 2018, "numPartitions": 8}
    jdbc.writer(frame, "jdbc:x", "yearly_summary", "overwrite")
    options = frame.write.format.return_value.mode.return_value.options.call_args.kwargs
    assert options["batchsize"] == 10_000 and options["numPartitions"] == 4


def test_exports(spark, tmp_path):
    frame = spark.range(2500).selectExpr("id", "'a,b' AS t")
    assert sinks.export_csv(frame, str(tmp_path / "one.csv")) == 2500
    assert len(list((tmp_path / "one.csv").glob("part-*"))) == 1
    many = frame.repartition(4)
    assert sinks.export_csv(many, str(tmp_path / "many.csv"), one_file=False) == 2500
    assert len(list((tmp_path / "many.csv").glob("part-*"))) > 1
    sinks.export_csv(many, str(tmp_path / "sorted.csv"), [F.desc("id")])
    (part,) = (tmp_path / "sorted.csv").glob("part-*")
    assert [int(x.split(",")[0]) for x in part.read_text().split("\n")[1:-1]] == list(range(2499, -1, -1))
    sinks.export_lineup(frame.coalesce(1), str(tmp_path), chunk=1000)
    parts = list((tmp_path / "daily_lineup.csv").glob("part-*"))
    assert len(parts) == 3 and all(p.read_text().startswith("id,t") for p in parts)
    assert files.read_csv(spark, str(tmp_path / "daily_lineup.csv")).count() == 2500


def test_a_profile_goes_on_past_missing_and_broken_files(spark, tmp_path, caplog):
    from docketry.operators import profile

    rows = spark.createDataFrame([("b", None, [1]), ("a", 2, None), (None, 3, [2])], "name string, n int, list array<int>")
    rows.write.parquet(f"{tmp_path}/good")
    (tmp_path / "broken.parquet").write_text("this is no parquet file, whatever its name says")
    (tmp_path / "nothing_in_it").mkdir()
    paths = {k: f"{tmp_path}/{v}" for k, v in {"good": "good", "gone": "gone", "broken": "broken.parquet", "bare": "nothing_in_it"}.items()}
    with caplog.at_level(logging.WARNING):
        got = profile.profile_paths(spark, paths).collect()
    assert [(r["column_name"], r["nulls"], r["row_count"], r["first_value"]) for r in got if r["table_name"] == "good"] == [
        ("name", 1, 3, None), ("n", 1, 3, "3"), ("list", 1, 3, "[2]")
    ]
    status = {r["table_name"]: r["status"] for r in got}
    assert status == {"good": "ok", "gone": "missing", "broken": "unreadable", "bare": "unreadable"}
    assert all(r["note"] for r in got if r["status"] != "ok") and "gone" in caplog.text and "broken" in caplog.text
    empty = spark.createDataFrame([], "a int")
    empty.write.parquet(f"{tmp_path}/no_rows")
    none = profile.profile_paths(spark, {"no_rows": f"{tmp_path}/no_rows"}).collect()
    assert [(r["status"], r["row_count"], r["first_value"]) for r in none] == [("ok", 0, None)]


def test_one_bad_record_leaves_the_rest(spark, tmp_path):
    good = "".join(f"c{i},{i % 30}\n" for i in range(2000))
    (tmp_path / "cases_2010.csv").write_text(f"ddl_case_id,state_code\n{good}lonely\n{good}a,b,c\n,\n")
    (tmp_path / "cases_2011.csv").write_text('state_code,extra,ddl_case_id\n3,"z\n4,y,d\n')
    rows = files.read_yearly_checked(spark, str(tmp_path), range(2010, 2012))
    topic = messages.publish_checked_to_files(rows, f"{tmp_path}/topic")
    got = messages.decode(spark.read.text(topic))
    assert got.count() == 4002 and got.filter("ddl_case_id = '' AND state_code = ''").count() == 1
    bad = {(r["file_year"], r["bad_record"], r["file"].rsplit("/", 1)[-1]) for r in messages.bad_records(spark, f"{tmp_path}/topic").collect()}
    assert {b for b in bad if b[0] == 2010} == {(2010, "lonely", "cases_2010.csv"), (2010, "a,b,c", "cases_2010.csv")}
    assert {b for b in bad if b[0] == 2011} == {(2011, "3,\"z", "cases_2011.csv")}
    strict = files.read_yearly_csv(spark, str(tmp_path), [2010])
    with pytest.raises(Exception, match="(?i)malformed"):
        strict.collect()


def test_no_bad_record_and_only_bad_records(spark, tmp_path):
    (tmp_path / "cases_2010.csv").write_text("ddl_case_id,state_code\na,1\n")
    (tmp_path / "cases_2012.csv").write_text("ddl_case_id,state_code\nx\n")
    messages.publish_checked_to_files(files.read_yearly_checked(spark, str(tmp_path), [2010]), f"{tmp_path}/good")
    assert messages.bad_records(spark, f"{tmp_path}/good").count() == 0
    topic = messages.publish_checked_to_files(files.read_yearly_checked(spark, str(tmp_path), [2012]), f"{tmp_path}/bad")
    assert messages.bad_records(spark, f"{tmp_path}/bad").count() == 1 and spark.read.schema("value string").text(topic).count() == 0
