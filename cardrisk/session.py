"""Session settings and the shared scratch folder every job writes through."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Temporary folders of local sessions, by application.
_own_dirs: dict[str, str] = {}


def build_session(app: str = "cardrisk", master: str | None = None, **conf) -> SparkSession:
    """UTC, ANSI and adaptive execution on; cluster sizing is left to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def observing_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings for plans that are observed.

    A session object that has served an observation can't be serialised any more, and MLlib's
    fitted models hold the session they were fitted in through their training summaries: models
    fitted in such a session could not be sent to tasks.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and other.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="cardrisk-")
    return _own_dirs[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/cardrisk/{label}-{uuid.uuid4().hex}"


#: Whether Spark deletes a query's shuffle files as soon as it has ended, not when the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts the lineage for steps that re-read it, outlives lost executors, and tells the
    planner its size. The shuffle files that went into it are deleted once it is written.
    """
    spark = df.sparkSession
    path = scratch(spark, "table")
    with setting(spark, RELEASE, "true"):
        df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    key = id(written)
    _written[key] = (weakref.ref(written, lambda gone: _forget(key, gone)), path)
    return written


# Tables that materialise has written and discard may delete, with their folders. They are known as long as somebody
# else holds them, so that the driver does not keep the plan and file listing of every table ever written.
_written: dict[int, tuple[weakref.ref, str]] = {}


def _forget(key: int, gone: weakref.ref) -> None:
    if _written.get(key, (None,))[0] is gone:
        del _written[key]


def discard(*frames: DataFrame) -> None:
    """Deletes the folders of written tables.

    Only once everything that was read from them is itself written: a lost task that needs
    them again would fail. Frames that ``materialise`` has not returned are left alone.
    """
    for frame in frames:
        known, path = _written.get(id(frame), (None, ""))
        if known is None or known() is not frame:
            continue
        del _written[id(frame)]
        context = frame.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
