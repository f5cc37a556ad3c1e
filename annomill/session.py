"""Sessions for tests and benchmarks, and where intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_TO_REMOVE: list[list[str]] = []


def local_session(cpus: int | str = 8, name: str = "annomill", **conf: str) -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    A machine-local folder is used only on a local master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="annomill-")
    return _LOCAL_ROOTS[context.applicationId]


def new_scratch(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _TO_REMOVE:
        _TO_REMOVE[-1].append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Takes away what is stored within, for jobs whose result lies elsewhere."""
    _TO_REMOVE.append([])
    try:
        yield
    finally:
        for path in _TO_REMOVE.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Within, the session's setting ``name`` is ``value``."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def files_open_together(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes begun within keep a file open for each partition value of a task, up to ``most``.

    Rows are then written as they come; otherwise a task first sorts all its rows, with
    their texts, by the partition columns.  A task that meets more values sorts the rest.
    """
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most)):
        yield


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Computes a frame once: writes it to the shared folder and reads it back.

    Later steps start from the files, so a lost executor costs no recomputation
    and Spark knows the table's real size when it plans joins with it.
    """
    spark = frame.sparkSession
    path = new_scratch(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
