"""Feature rows packed into blocks, and sums over what tasks make of blocks.

Training reads its table many times. A block holds the features of many rows as one binary
matrix, so a pass costs NumPy work and not one Python object a value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a block. A matrix of 100 features is 4 MB.
BLOCK_ROWS = 10_000
#: Parts that are summed by one task before all are.
PARTS = 64
#: Rows a task packs, about: several blocks where those are smaller.
TASK_ROWS = 50_000


def matrix_of(column: pa.Array) -> np.ndarray:
    """Rows of an array<double> column as one matrix; null elements become NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def packed(matrix: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(matrix, kind).tobytes()


def unpacked(data: bytes, kind, rows: int) -> np.ndarray:
    flat = np.frombuffer(data, kind)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 0)


def summed(parts: DataFrame, keys: list[str], value: str = "sums", order: str | None = None) -> DataFrame:
    """Element-wise sums of the packed float64 arrays ``value`` per ``keys``.

    Two levels of sums: no task adds up more than a PARTS-th of all arrays, or one an array of the
    first level. With a column ``order`` of whole numbers arrays are added in its order, so the
    sums are the same to the last bit however the table is read.
    """
    place = F.col(order) if order else F.spark_partition_id()
    dealt = parts.select(*keys, value, F.pmod(place.cast("long"), F.lit(PARTS)).alias("_part"), place.cast("long").alias("_order"))
    kinds = ", ".join(f"{k} {parts.schema[k].dataType.simpleString()}" for k in keys)

    def add(table: pa.Table, sort: str) -> pa.Table:
        arrays = [np.frombuffer(x, "<f8") for x in table.sort_by(sort).column(value).to_pylist()]
        out = {k: table.column(k).slice(0, 1) for k in (*keys, "_part")}
        return pa.table(out | {value: pa.array([np.sum(arrays, axis=0).tobytes()], pa.binary())})

    schema = f"{kinds}, _part long, {value} binary"
    first = dealt.groupBy(*keys, "_part").applyInArrow(lambda t: add(t, "_order"), schema)
    return first.groupBy(*keys).applyInArrow(lambda t: add(t, "_part"), schema).drop("_part")


def shards(
    rows: DataFrame, features: Column, extra: dict[str, Column], order: Column, n_rows: int, shard_rows: int, kind: str = "<f4"
) -> DataFrame:
    """(shard, n, features, extra...) with about ``shard_rows`` rows a shard, packed, in the order of ``order``.

    A row's shard is a hash of ``order``, so a shard holds the same rows in the same order
    however the table was read; what is computed from single shards does not depend on the layout.
    Where many rows share one value of ``order``, a shard is cut at twice ``shard_rows``.
    """
    count = max(1, -(-n_rows // shard_rows))
    tasks = min(count, max(1, -(-n_rows // TASK_ROWS)))
    limit = 2 * shard_rows
    shard = F.pmod(F.xxhash64(order), F.lit(count)).alias("shard")
    names = list(extra)
    dealt = rows.select(shard, features.alias("features"), *[x.cast("double").alias(c) for c, x in extra.items()], order.alias("_order"))
    dealt = dealt.repartition(tasks, "shard").sortWithinPartitions("shard", "_order", *names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = cut = 0

        def pack() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            number = table.column("shard")[0].as_py() + cut * count
            out = {"shard": pa.array([number], pa.int64()), "n": pa.array([table.num_rows], pa.int64())}
            out["features"] = pa.array([packed(matrix_of(table.column("features")), kind)], pa.binary())
            for c in names:
                out[c] = pa.array([packed(table.column(c).to_numpy(), "<f8")], pa.binary())
            return pa.RecordBatch.from_arrays(list(out.values()), list(out))

        for batch in batches:
            keys = batch.column("shard").to_numpy()
            a = 0
            while a < len(keys):
                if held and held[0].column("shard")[0].as_py() != keys[a]:
                    yield pack()
                    held, rows, cut = [], 0, 0
                elif rows == limit:
                    yield pack()
                    held, rows, cut = [], 0, cut + 1
                b = int(np.searchsorted(keys, keys[a], "right")) - a  # a partition is sorted by shard
                part = batch.slice(a, min(b, limit - rows))
                held.append(part)
                rows += part.num_rows
                a += part.num_rows
        if held:
            yield pack()

    kinds = "".join(f", {c} binary" for c in names)
    return dealt.mapInArrow(step, f"shard long, n long, features binary{kinds}")


@contextmanager
def one_by_one(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside send every block to Python as a batch of its own.

    Else Spark fills a batch up to 64 MB, and a task holds that several times: as vectors that
    double when they grow, as bytes on their way and in the worker. For jobs over blocks only, as
    rows of a plain table would travel singly too. The session's setting comes back afterwards.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def per_block(blocks: DataFrame, columns: list[str], make: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``make`` over the blocks of every task, as dicts; what it yields are rows of ``schema``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield {c: batch.column(c)[k].as_py() for c in columns}

        for row in make(rows()):
            arrays = [x if isinstance(x, (pa.Array, list)) else [x] for x in row.values()]
            yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, list) else x for x in arrays], list(row))

    return blocks.select(*columns).mapInArrow(step, schema)
