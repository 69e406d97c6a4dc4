"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager
from types import MappingProxyType

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # The JVM never compiles methods above 8000 bytes of bytecode; a stage whose
    # fused code is longer runs several times faster unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording a Python stack per column call costs more than planning small queries.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

SESSION_KEY = "spark.arrears.scratch.session"


def build_session(app: str = "arrears", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is tuned for; keyword values win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, unless that lies on the
    driver's own disk and executors run elsewhere: that is an error, as other
    machines would not see what one of them writes.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        refuse_own_disk(configured, _scheme(spark, configured), spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def _scheme(spark: SparkSession, path: str) -> str:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()


def refuse_own_disk(path: str, scheme: str, master: str) -> None:
    """Raise where ``path`` lies on one machine's disk and the executors do not."""
    if scheme == "file" and not master.startswith("local"):
        raise RuntimeError(f"{path} is not shared by the executors of {master}; set spark.checkpoint.dir to a folder that is")


def session_dir(spark: SparkSession) -> str:
    """This session's own folder below the shared one; removed when the driver's Python ends."""
    known = spark.conf.get(SESSION_KEY, None)
    if not known:
        known = f"{shared_dir(spark)}/arrears/{uuid.uuid4().hex}"
        spark.conf.set(SESSION_KEY, known)
        atexit.register(_drop_at_exit, spark, known)
    return known


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nothing else uses, below the session's folder."""
    return f"{session_dir(spark)}/{uuid.uuid4().hex}/{name}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a stage that nothing reads any more."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        drop_path(spark, path)


def materialise(df: DataFrame, name: str = "stage", options: Mapping[str, str] = MappingProxyType({})) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor, so several
    branches of a plan see exactly the same rows. ``options`` go to the writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame on the executors while it is read repeatedly.

    Lost blocks are recomputed from lineage, and what does not fit in memory
    goes to disk.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside use no fused code that the JVM would leave uncompiled, however the session was built.

    A smaller limit that the session has already stays.
    """
    kind = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(kind)
    spark.conf.set(kind, str(min(int(before), int(SETTINGS[kind]))))
    try:
        yield
    finally:
        spark.conf.set(kind, before)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Jobs run inside are planned with these settings of the session; those before come back afterwards."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def _bounded(spark: SparkSession, kind: str, most: int) -> Iterator[None]:
    """A setting in bytes is ``most`` inside; a smaller bound that the session has already stays."""
    known = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(kind))
    with settings(spark, {kind: str(min(most, known) if known > 0 else most)}):
        yield


def batch_bytes(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """Bound the bytes that a Python worker is handed at once by jobs run inside; rows of matrices need it."""
    return _bounded(spark, "spark.sql.execution.arrow.maxBytesPerBatch", most)


def scan_bytes(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """Bound the bytes of files that a task of jobs run inside reads; what it makes of them may be many times as much."""
    return _bounded(spark, "spark.sql.files.maxPartitionBytes", most)
