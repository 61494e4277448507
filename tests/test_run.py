from docketry import model
from docketry.plans.run import run_all
from docketry.plans.summaries import SUMMARY_TABLES
from docketry.plans.training import Settings
from docketry.sources import files, testdata


def test_whole_run_over_files(spark, sf_dir, tmp_path, facts):
    """Cases and keys as CSV files in, all tables out; equal to the batch result."""
    rows = testdata.case_messages(spark, sf_dir)
    for year, low, high in [(2010, 0, 500), (2011, 500, 10**9)]:
        number = rows.ddl_case_id.substr(2, 20).cast("bigint")
        part = rows.filter((number >= low) & (number < high)).coalesce(1)
        part.write.options(**files.CSV).csv(f"{tmp_path}/cases/cases_{year}.csv")
    broken = next((tmp_path / "cases" / "cases_2011.csv").glob("part-*.csv"))
    with broken.open("a") as file:
        file.write('"cut off","1"\n')
    (broken.parent / f".{broken.name}.crc").unlink()
    raw = testdata.raw_keys(spark, sf_dir)
    for table, (file, *_) in model.KEY_TABLES.items():
        raw[table].coalesce(1).write.options(**files.CSV).csv(f"{tmp_path}/keys/{file}")

    def run():
        return run_all(
            spark, f"{tmp_path}/cases", f"{tmp_path}/keys", f"{tmp_path}/out", testdata.AS_OF,
            settings=Settings(1998, 2000, rows_per_year=10, rounds=2, trees=2), files_per_batch=1,
        )

    run()
    tables = run()  # a second run over the same folder leaves nothing of the first
    got = tables["cases_cleaned"].fillna("", ["judge_position"])  # a file cannot hold a null text
    assert sorted(map(str, got.collect())) == sorted(map(str, facts.fillna("", ["judge_position"]).collect()))
    assert tables["data_quality_log"].count() == 2
    assert tables["quarantine"].count() == tables["data_quality_log"].agg({"impossible_dates": "sum"}).first()[0]
    bad = tables["bad_records"].collect()
    assert [(r["file_year"], r["bad_record"]) for r in bad] == [(2011, '"cut off","1"')] and broken.name in bad[0]["file"]
    assert len(list((tmp_path / "out" / "_runs").iterdir())) == 1 and not (tmp_path / "out" / "_lease").exists()
    assert set(SUMMARY_TABLES) <= set(tables)
    assert tables["model_comparison"].count() == 6 and tables["model_registry"].count() == 2
    # The cap bounds the rows that fit the classifiers alone: every test row is explained.
    test = facts.filter("filing_year > 2000").count()
    assert tables["shap_values"].count() == test
    pending = facts.filter("is_resolved = 0 AND date_next_list IS NOT NULL").count()
    assert tables["daily_lineup"].count() == pending
    exported = files.read_csv(spark, f"{tmp_path}/out/export/daily_lineup.csv")
    assert exported.count() == pending and exported.columns == model.LINEUP_COLUMNS
