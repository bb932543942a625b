"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

from seatwise.sinks.parquet import write_table

# Shuffle partition counts are only an upper bound: adaptive execution merges
# small ones up to the advisory size and splits skewed ones. A join whose build
# partitions all turn out below the map threshold hashes instead of sorting.
SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "seatwise", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with ``SETTINGS``; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting it is a folder in the warehouse. A warehouse on a local disk
    is one machine's own, so it serves a session in local mode only; on a cluster it
    raises. A checkpoint folder is taken as named, as a path without a scheme may well
    be a mounted share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    remote = urlsplit(warehouse).scheme not in ("", "file")
    if not remote and not _one_machine(spark) and resolved(spark, warehouse).startswith("file:"):
        raise ValueError(
            f"set spark.checkpoint.dir: executors may not share the warehouse {warehouse}")
    return f"{warehouse}/.stages"


def _one_machine(spark: SparkSession) -> bool:
    """True in local mode, where driver and tasks are one process."""
    return spark.sparkContext.master.split("[")[0] == "local"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as Hadoop's."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def resolved(spark: SparkSession, path: str) -> str:
    """The path with scheme, without ``..``, and on a local disk without links."""
    files, place = file_system(spark, path)
    uri = files.makeQualified(place).toUri()
    plain = posixpath.normpath(uri.getPath())
    if uri.getScheme() == "file":
        plain = os.path.realpath(plain)
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{plain}"


def require_apart(spark: SparkSession, out: str, inputs: Sequence[str]) -> None:
    """Raise if ``out`` is, contains or lies inside one of the input folders or files."""
    target = resolved(spark, out)
    for path in inputs:
        place = resolved(spark, path)
        if target == place or f"{target}/".startswith(f"{place}/") or (
                f"{place}/".startswith(f"{target}/")):
            raise ValueError(f"the results need a folder apart from the input: {out}, {path}")


def size_shuffles(spark: SparkSession, folder: str, each: int = 128 << 20) -> int:
    """Start shuffles with partitions of about ``each`` bytes of the tables in ``folder``.

    Adaptive execution merges small partitions, so more than needed do no harm.
    """
    files, place = file_system(spark, folder)
    wanted = -(-files.getContentSummary(place).getLength() // each)
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(number))
    return number


@contextmanager
def temporary_store(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A ``table_store`` whose tables are deleted at the end, after an error too."""
    base = f"{shared_folder(spark)}/seatwise-{uuid.uuid4().hex}"
    try:
        yield table_store(spark, base)
    finally:
        files, place = file_system(spark, base)
        files.delete(place, True)


def table_store(spark: SparkSession, folder: str | None = None) -> Callable[..., DataFrame]:
    """A function that writes a DataFrame once and hands back the written table.

    Later steps read the files, so nothing upstream is computed again and a lost
    executor costs a file scan rather than the whole lineage.
    """
    base = folder or f"{shared_folder(spark)}/seatwise-{uuid.uuid4().hex}"

    def store(rows: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        path = f"{base}/{name}"
        write_table(rows, path, partition_by)
        return spark.read.schema(rows.schema).parquet(path)

    return store
