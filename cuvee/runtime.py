"""Session settings and the shared folder that holds intermediate tables."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT = "spark.checkpoint.dir"
_shipped_to: set[str] = set()
_shipping = threading.Lock()
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping: dict[str, tuple[int, SparkSession, str | None]] = {}
_dropping_lock = threading.Lock()


def local_session(name: str = "cuvee", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and bench.py; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session without it is an error, since
    a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get(_CHECKPOINT, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {_CHECKPOINT} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="cuvee-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query begun within has shuffled is deleted when it ends, not when the driver's garbage collector comes upon it. The session's own
    setting is put back when the last thread leaves."""
    application = spark.sparkContext.applicationId
    with _dropping_lock:
        inside, session, before = _dropping.get(application) or (0, spark, spark.conf.get(_DROP_SHUFFLES, None))
        _dropping[application] = (inside + 1, session, before)
        session.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            inside, session, before = _dropping.pop(application)
            if inside > 1:
                _dropping[application] = (inside - 1, session, before)
            elif before is None:
                session.conf.unset(_DROP_SHUFFLES)
            else:
                session.conf.set(_DROP_SHUFFLES, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of an executor, and gives later plans a measured size. What the write shuffled is deleted, and
    hand-overs are compressed well, since many of them stand beside each other.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path, compression="zstd")
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once nothing reads them any more; others are left alone."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            sc = df.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers; once per application."""
    application = spark.sparkContext.applicationId
    with _shipping:
        if application not in _shipped_to:
            package = Path(__file__).parent
            target = os.path.join(tempfile.mkdtemp(prefix="cuvee-zip-"), package.name)
            spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", package.parent, package.name))
            _shipped_to.add(application)
