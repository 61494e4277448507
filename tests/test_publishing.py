import threading
import time

import pytest
from pyspark.sql import functions as F

from docketry.sources import sinks, workspace


def values(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).collect())


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.replace_table(spark.range(3), path)
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(broken, path)
    assert values(spark, path) == [0, 1, 2]
    sinks.replace_table(spark.range(1), path)
    assert values(spark, path) == [0]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_readers_see_the_old_table_or_the_new_one(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.replace_table(spark.range(10), path)
    missing = [0.0]
    stop = threading.Event()

    def watch():
        while not stop.is_set():
            if not (tmp_path / "t" / "_SUCCESS").exists():
                start = time.time()
                while not (tmp_path / "t" / "_SUCCESS").exists():
                    time.sleep(0.0005)
                missing.append(time.time() - start)
            time.sleep(0.0005)

    thread = threading.Thread(target=watch)
    thread.start()
    try:
        sinks.replace_table(spark.range(0, 2_000_000, 1, 8).select((F.col("id") * 2).alias("id")), path)
    finally:
        stop.set()
        thread.join()
    assert max(missing) < 0.2  # two renames, not a write
    assert spark.read.parquet(path).count() == 2_000_000


@pytest.mark.parametrize("left,want", [(["new", "old"], [0]), (["old"], [0, 1])])
def test_a_table_is_recovered_if_the_driver_was_lost_between_the_renames(spark, tmp_path, left, want):
    spark.range(1).write.parquet(f"{tmp_path}/_t.new") if "new" in left else None
    spark.range(2).write.parquet(f"{tmp_path}/_t.old")
    workspace.recover(spark, f"{tmp_path}/t")
    assert values(spark, f"{tmp_path}/t") == want


def test_half_a_new_table_is_not_taken(spark, tmp_path):
    (tmp_path / "_t.new").mkdir()
    workspace.recover(spark, f"{tmp_path}/t")
    assert not (tmp_path / "t").exists()


def test_one_run_at_a_time(spark, tmp_path):
    root = str(tmp_path / "root")
    with workspace.Lease(spark, root, "one") as lease:
        lease.renew()
        with pytest.raises(RuntimeError, match="held by run one"), workspace.Lease(spark, root, "two"):
            pass
    with workspace.Lease(spark, root, "two"):
        pass
    with pytest.raises(KeyError), workspace.Lease(spark, root, "three"):
        raise KeyError("a failing run gives the lease back")
    assert not (tmp_path / "root" / "_lease").exists()


def test_the_lease_of_a_lost_run_goes_over(spark, tmp_path):
    lost = workspace.Lease(spark, str(tmp_path), "lost").__enter__()
    time.sleep(0.1)
    with workspace.Lease(spark, str(tmp_path), "next", hours=0.00001):
        with pytest.raises(RuntimeError, match="taken over by run next"):
            lost.renew()
        lost.__exit__()  # does not give back what is not its own
        assert (tmp_path / "_lease").exists()


def test_other_runs_are_deleted(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / name).mkdir()
    workspace.drop_other_folders(spark, str(tmp_path), "b")
    assert [p.name for p in tmp_path.iterdir()] == ["b"]
    workspace.drop_other_folders(spark, str(tmp_path / "nothing"), "b")
