"""Reading tables, intermediate tables in the shared folder, and Arrow text buffers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_ROOT = str(Path(__file__).resolve().parents[2])


def task(func: Callable, *args) -> Callable:
    """func(batches, *args) for mapInArrow; a worker that was started elsewhere finds the package by its folder."""
    module, name, root = func.__module__, func.__name__, _ROOT

    def run(batches):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(batches, *args)

    return run


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a folder of this process where it is unset and the session is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


class Scratch:
    """Intermediate tables of one operator run.

    They are Parquet in the shared folder: a later stage reads only the columns it needs and does not depend on
    executors that may be lost. `done` stores the result and deletes the other tables.
    """

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{operator}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, **options) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Let Spark delete the shuffle files of plans that nothing refers to any more; it does so when the driver collects."""
        gc.collect()
        self.spark.sparkContext._jvm.java.lang.System.gc()

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def done(self, df: DataFrame, *used: str) -> DataFrame:
        result = self.keep(df, "result")
        self.drop(*used)
        return result


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Python workers get batches of about `size` bytes from what runs inside: by default a batch grows to 10,000 rows of any size."""
    given = {_BATCH: spark.conf.get(_BATCH)}
    spark.conf.set(_BATCH, str(size))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, given[_BATCH])


def lower_ascii(text):
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of an Arrow column in one array, and the offset of each text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    n, first = len(column), column.offset
    at = np.frombuffer(offsets, np.int64, first + n + 1)[first:] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def runs_of(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of up to `limit` bytes each, or of one longer document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
