"""Helpers shared by the training-data operators: private column names,
word splitting, hash fractions and tables written once to the shared folder."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.session import materialize

# Words are runs of anything but the six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of words of ``text``; NULL or blank text gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def unit_hash(*cols: Column | str, seed: str = "") -> Column:
    """A number in [0, 1) fixed by the values and the seed (32 bits of md5).
    NULL counts as a value of its own, so equal rows always agree."""
    parts = [F.lit(seed)] + [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                                        F.lit("\x00")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def documents(spark, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write once under the shared checkpoint folder and read back: lineage is
    cut, and the planner knows the size, so it alone decides on a broadcast.
    ``batch_rows`` bounds the rows of an Arrow batch during this write only,
    for rows that carry large values."""
    spark = df.sparkSession
    if batch_rows is None:
        return materialize(spark, df, name)
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(batch_rows))
    try:
        return materialize(spark, df, name)
    finally:
        spark.conf.set(BATCH_ROWS, before)


SLICE_ROWS = 512        # rows with texts that a Python worker unpacks at a time


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of few rows, so that little is unpacked at a
    time; at the end of the task freed memory goes back to the system, since
    Spark keeps the worker for later tasks."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]):
    """A model that a Python worker keeps from task to task.  Only the last one
    asked for is kept, so stages that follow one another do not add up."""
    if key not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[key] = make()
    return _KEPT[key]
