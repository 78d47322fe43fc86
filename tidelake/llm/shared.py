"""Where operators keep what must outlive a lost executor, and how tasks reach it.

Written tables and files go to the folder named by ``spark.checkpoint.dir``.  Only a
local session that names none (tests, a laptop) gets a temporary folder of its own; a
cluster without one is an error.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}
#: Scratch paths of the open scratch spaces, innermost last.
_SPACES: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as the session names it."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tidelake-")
        found = _LOCAL[context.applicationId]
    return found.rstrip("/")


def product(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for files that are a result and stay."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it goes with the scratch space it was made in, if any."""
    path = product(spark, name)
    if _SPACES:
        _SPACES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch tables made inside at the end.

    What operators return is lazy and reads them, so write or collect it inside.  Without a
    space they stay in the shared folder.
    """
    _SPACES.append([])
    try:
        yield
    finally:
        for path in _SPACES.pop():
            drop_path(spark, path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have yet, made of name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends here."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a path that no later plan reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def make_dir(spark: SparkSession, path: str) -> None:
    """Creates a folder through Hadoop's file systems."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)


def open_fs(uri: str):
    """(file system, path) of a URI, for tasks that write or range-read files."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


#: Bytes of an Arrow batch of texts, in the JVM and in a Python worker.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, so that long texts don't add up in a worker.

    A batch has one row at least; a lower bound that is already set stays.
    """
    held = spark.conf.get(_BATCH, None)
    if held is None or not held.rstrip("bB").isdigit() or not 0 < int(held.rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


#: What empties a worker's caches; each is for consecutive tasks of one operator.
CACHES: list[Callable[[], None]] = []


def give_back(keep_caches: bool = False) -> None:
    """Returns memory that a task has freed to the system, at its end.

    Workers outlive tasks, and what their allocators and another operator's caches keep
    would add up beside the JVM's heap.
    """
    import pyarrow

    for empty in [] if keep_caches else CACHES:
        empty()

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
