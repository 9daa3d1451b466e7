"""Helpers the operators share: staged tables, byte-bounded batches, guarded broadcasts."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids (8 bytes each) up to which a key set is broadcast; larger sets go by shuffle.
BROADCAST_KEYS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is ``spark.checkpoint.dir`` of the session. Only a local master, where
    every task runs on this machine, may fall back to a temporary folder.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="segweave-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


#: Paths that this thread's calls made and didn't remove.
_MADE = threading.local()


def fresh_path(spark: SparkSession, name: str) -> str:
    made = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.paths = [*made_paths(), made]
    return made


def made_paths() -> list[str]:
    return getattr(_MADE, "paths", [])


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _MADE.paths = [p for p in made_paths() if p not in paths]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and return it reread, with its lineage cut."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_files(uri: str) -> tuple:
    """A pyarrow filesystem and path for a shared-folder URI, for files of our own format."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def spread(df: DataFrame, column: str, count: int) -> list[int]:
    """count - 1 bounds (none of an empty table) that cut a long column into ranges of about equal rows; a value with many rows is a bound more than once."""
    steps = [i / count for i in range(1, count)]
    found = df.agg(F.percentile_approx(column, steps, 100 * count).alias("at")).first()["at"] if steps else None
    return sorted(found or [])


def ranges(bounds: np.ndarray, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The range of each value; a value that is a bound several times is dealt over its ranges by row number."""
    low, high = np.searchsorted(bounds, values, "left"), np.searchsorted(bounds, values, "right")
    return np.where(high > low + 1, low + 1 + rows % np.maximum(high - low, 1), high)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; for numbers faster than numpy's unique, which hashes first."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


#: What empties each cache that Python workers keep between tasks, by the name of its user.
CACHES: dict[str, Callable[[], None]] = {}


def give_back() -> None:
    """Return memory that this worker has freed to the machine: the next task may run in another process."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


#: Whose caches this Python worker holds.
_HELD = [""]


def steady(batches: Iterator, user: str = "") -> Iterator:
    """The batches, with the cycle collector at rest: it would walk the workers' large caches again and again.

    Workers serve one operator after another; when the user changes, the caches
    of others are emptied and their memory is given back.
    """
    import gc

    if user != _HELD[0]:
        for name, clear in CACHES.items():
            if name != user:
                clear()
        give_back()
        _HELD[0] = user
    gc.disable()
    try:
        yield from batches
    finally:
        gc.enable()
        give_back()


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about `limit` bytes of `column`, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(column))), 0).to_pylist()
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size + 64
        if first < batch.num_rows:
            yield batch.slice(first)


def text_map(docs: DataFrame, columns: list[str], step: Callable[[list, list], pa.RecordBatch], schema: str, user: str = "") -> DataFrame:
    """mapInArrow over `columns` and text; `step` gets the other columns' lists and the texts (null: empty)."""

    def run(batches):
        for batch in small_batches(steady(batches, user)):
            yield step([batch.column(i).to_pylist() for i in range(len(columns))], [t or "" for t in batch.column(len(columns)).to_pylist()])

    return docs.select(*columns, "text").mapInArrow(run, schema)


def rows_with(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of df whose `column` is in `keys`; the keys are broadcast only if counted and small."""
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return df.join(keys, column, "left_semi")
