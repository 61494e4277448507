"""Folders for tables between steps, always on storage that all executors see."""

from __future__ import annotations

import tempfile
import time
import zipfile
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool
from pathlib import Path
from typing import TypeVar
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
R = TypeVar("R")


_SHIPPED: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or the checkpoint folder already set, or else one in the warehouse.

    All three are on storage that every executor reaches.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_docketry").rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, for the few operations that Spark's readers and writers do not offer."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder path nobody else uses, under the shared root; it is deleted when the application ends."""
    mine = f"{shared_root(spark)}/docketry/{spark.sparkContext.applicationId}"
    place, system = hadoop_path(spark, mine)
    system.mkdirs(place)
    system.deleteOnExit(place)
    return f"{mine}/{name}-{uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later step reads, if it is there."""
    place, system = hadoop_path(spark, path)
    system.delete(place, True)


def drop_other_folders(spark: SparkSession, path: str, kept: str) -> None:
    """Delete all folders in a folder but one."""
    place, system = hadoop_path(spark, path)
    for found in system.listStatus(place) if system.exists(place) else []:
        if found.getPath().getName() != kept:
            system.delete(found.getPath(), True)


def put_in_place(spark: SparkSession, made: str, path: str) -> None:
    """Let a folder that is written to the end take the place of another one.

    Both are renamed, which a file system does at once: readers see the old files or the new ones. If the driver is lost
    between the two renames, `recover` finds the new folder beside the empty place.
    """
    (new, system), (place, _), (old, _) = (hadoop_path(spark, p) for p in (made, path, f"{_beside(path)}.old"))
    system.delete(old, True)
    if system.exists(place) and not system.rename(place, old):
        raise OSError(f"cannot move {path}")
    system.mkdirs(place.getParent())
    if not system.rename(new, place):
        system.rename(old, place)
        raise OSError(f"cannot put {made} in the place of {path}")
    system.delete(old, True)


def _beside(path: str) -> str:
    """A hidden name in the same folder."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{name}"


def recover(spark: SparkSession, path: str) -> None:
    """Put back what a lost driver left beside an empty place: the new folder if it is whole, else the old one."""
    place, system = hadoop_path(spark, path)
    if system.exists(place):
        return
    for left in (f"{_beside(path)}.new", f"{_beside(path)}.old"):
        folder, _ = hadoop_path(spark, left)
        if system.exists(hadoop_path(spark, f"{left}/_SUCCESS")[0]):
            system.rename(folder, place)
            return


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write a folder beside its place, then swap: a write that fails leaves what was there."""
    recover(spark, path)
    made = f"{_beside(path)}.new"
    drop_folder(spark, made)
    try:
        write(made)
    except Exception:
        drop_folder(spark, made)
        raise
    put_in_place(spark, made, path)


class Lease:
    """A file that one run at a time holds on a folder; `with Lease(...)` takes it or raises, and gives it back.

    The file is created only if it is not there, which the file system decides. A lease whose run has been lost goes over to the next
    run when it has not been renewed for `hours`; each step of a run renews it.
    """

    def __init__(self, spark: SparkSession, root: str, run: str, hours: float = 6.0) -> None:
        self.spark, self.path, self.run, self.hours = spark, f"{root}/_lease", run, hours

    def _holder(self) -> str:
        place, system = hadoop_path(self.spark, self.path)
        stream = system.open(place)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def __enter__(self) -> Lease:
        place, system = hadoop_path(self.spark, self.path)
        system.mkdirs(place.getParent())
        if system.exists(place):
            age = time.time() - system.getFileStatus(place).getModificationTime() / 1000
            if age < self.hours * 3600:
                raise RuntimeError(f"{self.path} is held by run {self._holder()}")
            system.delete(place, False)
        try:
            stream = system.create(place, False)
        except Exception as taken:
            raise RuntimeError(f"{self.path} has just been taken by another run") from taken
        stream.write(bytearray(self.run.encode()))
        stream.close()
        return self

    def renew(self) -> None:
        """Say that the run is alive; an error if another one has taken over."""
        if self._holder() != self.run:
            raise RuntimeError(f"{self.path} has been taken over by run {self._holder()}")
        place, system = hadoop_path(self.spark, self.path)
        system.setTimes(place, int(time.time() * 1000), -1)

    def __exit__(self, *_) -> None:
        place, system = hadoop_path(self.spark, self.path)
        if system.exists(place) and self._holder() == self.run:
            system.delete(place, False)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python workers can import it.

    Operators that run Python on the executors call this; nothing needs to be installed there.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="docketry-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def stored(frame: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame as Parquet and read it back: later steps do not compute it again,
    and a lost executor costs a file read instead of the whole lineage."""
    frame.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def checkpointed(frame: DataFrame) -> DataFrame:
    """A reliable checkpoint: rows and their partitions are fixed from here on."""
    spark = frame.sparkSession
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return frame.checkpoint()


def side_by_side(spark: SparkSession, action: Callable[[T], R], items: Iterable[T], threads: int = 4) -> list[R]:
    """Run an action for each item with several of their jobs in flight, as small jobs do not fill a cluster."""
    with ThreadPool(threads) as pool:
        return pool.map(inheritable_thread_target(spark)(action), list(items), chunksize=1)
