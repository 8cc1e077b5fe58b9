"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed value: a word is a run of characters other than blank, tab, LF, VT, FF and CR
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
BATCH_ROWS = 1_024
#: Bytes of text a step takes at once.
PORTION = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str):
    """``step`` over the Arrow batches of every partition, BATCH_ROWS rows at a time to bound a worker's memory.

    What a task freed goes back to the system: a worker stays alive, idle, beside the next stages.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield batch.slice(at, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(pieces(batches))
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Let the session's jobs send at most BATCH_ROWS rows a batch to Python.

    Steps take that many at a time, but Spark fills a batch of 10,000 texts before: in vectors that
    double, and again as bytes on their way. The setting stays, as jobs of a stage run later.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back() -> None:
    """Freed memory of this process to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's
    if trim is not None:
        trim(0)


def sent(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast ``value``; the result, called in a task, gives it there.

    A plain broadcast names its classes by module, which executors need not have.
    """
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def portions(batch: pa.RecordBatch, most: int = PORTION, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most so many bytes of text, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null counts as empty.

    On bytes, ``lower()`` changes A-Z only and ``split()`` cuts at exactly the six blanks of
    ``BLANK``, which is how words are defined here.
    """
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def count_words(text: Column) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_RECORDS: list[list[str]] = []


def stored(df: DataFrame) -> DataFrame:
    """Write the table to the shared folder and read it back; survives lost executors."""
    from staffflow.session import written

    table, path = written(df)
    for paths in _RECORDS:
        paths.append(path)
    return table


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Add the places of all tables ``stored`` meanwhile to ``paths``."""
    _RECORDS.append(paths)
    try:
        yield
    finally:
        _RECORDS.remove(paths)


def drop_tables(paths: list[str], docs: DataFrame) -> None:
    """Delete the tables at ``paths`` that ``docs`` does not read, and take them off the list."""
    from staffflow.session import remove

    read = " ".join(docs.inputFiles())
    for path in paths[:]:
        if path.rpartition("/")[2] not in read:
            remove(docs.sparkSession, path)
            paths.remove(path)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus
