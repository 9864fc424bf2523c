"""The Spark session, and the shared folder for intermediate tables."""

import atexit
import tempfile
import uuid
from functools import lru_cache

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: The day of a trip is a calendar day in this time zone, unless a job is given another.
TIME_ZONE = "UTC"

SETTINGS = {
    "spark.sql.session.timeZone": TIME_ZONE,
    # A hot day, zone or vendor is split at run time from the measured shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    # Every write task opens a file per vendor, so splits should not be small; but a task sorts what it has read, in some ten
    # times the memory that the rows take in a file.
    "spark.sql.files.maxPartitionBytes": "64m",
    # A task keeps the files of so many vendors open at once and does not sort its rows by vendor.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Join state lives on disk and is checkpointed as changes, not as whole snapshots on the heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of the state costs a lookup per write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def get_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """Start or reuse a session under this name; ``settings`` override the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def isolated_session(spark: SparkSession, settings: dict[str, str] | None = None) -> SparkSession:
    """A session on the same cluster whose settings do not leak into the caller's session."""
    session = spark.newSession()
    for key, value in {**SETTINGS, **(settings or {})}.items():
        session.conf.set(key, value)
    return session


def pinned_session(spark: SparkSession, time_zone: str) -> SparkSession:
    """A session for one job: the caller's settings, but for those that would change the job's rows.

    Days are those of ``time_zone``, and a cast that fails is an error, whatever the caller has set. The caller's own
    session stays as it is; a streaming query of the job is found in the ``streams`` of the query's session.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", time_zone)
    session.conf.set("spark.sql.ansi.enabled", "true")
    return session


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="fareloom-")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def _shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    if _is_local(spark):
        return _local_root()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder path under the shared checkpoint folder, removed when the driver exits.

    Where none is set, a local master takes a local temporary folder; on a cluster that is an error.
    """
    path = f"{_shared_root(spark).rstrip('/')}/fareloom/{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whichever file system the path names."""
    file_system, location = _located(spark, path)
    return file_system.exists(location)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a glob pattern, on whichever file system it names."""
    file_system, location = _located(spark, pattern)
    return sorted(status.getPath().toString() for status in file_system.globStatus(location) or [])


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or none if it is not there."""
    file_system, location = _located(spark, path)
    if not file_system.exists(location):
        return None
    stream = file_system.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it appears under its name only when it is whole, in place of one that was there."""
    file_system, location = _located(spark, path)
    begun = location.suffix(f".{uuid.uuid4().hex}.begun")
    hidden = spark._jvm.org.apache.hadoop.fs.Path(begun.getParent(), f".{begun.getName()}")
    stream = file_system.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not file_system.rename(hidden, location):
        file_system.delete(location, False)
        if not file_system.rename(hidden, location):
            raise OSError(f"could not write {path}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that is in it, if it is there."""
    file_system, location = _located(spark, path)
    file_system.delete(location, True)


def set_old_time(spark: SparkSession, folder: str) -> None:
    """Give the file of a folder that was written last a time stamp of many years ago."""
    file_system, location = _located(spark, folder)
    files = [f for f in file_system.listStatus(location) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    newest = max(files, key=lambda f: (f.getModificationTime(), f.getPath().getName()))
    file_system.setTimes(newest.getPath(), 10**12, -1)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        file_system, location = _located(spark, path)
        file_system.delete(location, True)
    except Exception:  # the JVM may already be gone; a left-over scratch folder is harmless
        pass
