"""What several corpus operators share: shared-folder tables, worker memory, word classes and small column helpers."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: the characters between words in every operator's contract.
SPACE = " \t\n\x0b\f\r"
SPACE_RE = r"[ \t\n\x0B\f\r]+"
#: Bytes of an Arrow batch that go to a Python worker at once, where the session has no setting of its own.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8388608b")
#: Shuffle files go when the write that needed them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_dirs: dict[str, str] = {}
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where it is unset, a session whose tasks run in the driver's own process gets a temporary one; on a cluster that
    is an error, as executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    told = sc.getConf().get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir: set it to a folder that driver and executors share")
    return _own_dirs.setdefault(sc.applicationId, "file://" + tempfile.mkdtemp(prefix="quillfold-"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillfold-{name}-{os.getpid()}-{uuid.uuid4().hex}"
    small_batches(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def small_batches(spark: SparkSession) -> None:
    """Long texts reach Python workers some megabytes at a time, unless the session has its own limit."""
    key, default, own = ARROW_BYTES
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, own)


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        _written.remove(t._stored_at)
        delete(t.sparkSession, [t._stored_at])


def shrink_heaps(spark: SparkSession) -> None:
    """Each executor's JVM collects its garbage and gives the heap that it does not need back to the system.

    A JVM's heap grows to its limit whatever little of it is in use, and stays so; what native code and Python workers
    take in later steps comes on top. A task for each executor, which idle ones get one each; results do not depend on it.
    """
    n = max(1, spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1)  # one of these is the driver
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """All tables that are stored within go at the end."""
    mark = len(_written)
    try:
        yield
    finally:
        delete(spark, _written[mark:])
        del _written[mark:]


def frugal(body: Callable) -> Callable:
    """A function over Arrow batches that gives its worker's free memory back to the system when a task ends.

    Workers are reused by later tasks and stages; without this each keeps the most that any task of it ever held.
    """

    @functools.wraps(body)
    def run(*args, **how):
        import pyarrow as pa

        try:
            yield from body(*args, **how)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body's lambdas use it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def words(text: Column) -> Column:
    """The array of words: maximal runs of other characters than ASCII white space."""
    return let(trimmed(text), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RE)))


def n_words(text: Column) -> Column:
    return let(trimmed(text), lambda t: F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE_RE)))).cast("long")
