"""Token ids of a corpus in rANS files, and the way back.

Documents are dealt by ranges of doc_id, sorted, encoded with a public tokenizer and coded into
files of the layout in ``rans``, in one pass: the frequency table of a file is counted over all
of its ids and shared by its blocks. A file is one row of a Parquet table, so that Spark commits
and replaces it whole and any store that Spark writes to will do; its bytes stand alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffflow.llm import rans
from staffflow.llm.chunks import process_encoder
from staffflow.llm.common import PORTION, give_back, map_batches, portions, stored

END = 0
FILE_IDS = 4_000_000
BLOCK_IDS = 65_536

_FILES = "part long, file long, first_id long, n_docs long, n_ids long, doc_ids array<{kind}>, content binary"
_DOCUMENTS = "part long, doc_id {kind}, first_id long, n_tokens long, ids_crc32 long"


def write_ids(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """Files of token ids over ``docs`` (doc_id, text), as a table (part, file, ..., content).

    ``path`` is the vocabulary file; ``end`` closes every document. Ascending by doc_id, null
    first, rows that repeat an id by text; a null text is empty. A file closes with the document
    that brings it to FILE_IDS.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    names = ["part", "file", "first_id", "n_docs", "n_ids", "doc_ids", "content"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = process_encoder(path), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        doc_ids: list = []
        size = first = number = 0

        def file() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in held], np.int64)
            content = rans.pack_file(sizes, np.concatenate(held), BLOCK_IDS)
            columns = [[part], [number], [first], [len(held)], [size]]
            columns = [pa.array(c, pa.int64()) for c in columns]
            columns += [pa.array([doc_ids], pa.list_(arrow)), pa.array([content], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        for doc_id, ids in _encoded(batches, encoder):
            held.append(np.append(ids, np.uint32(end)))
            doc_ids.append(doc_id)
            size += len(held[-1])
            if size >= FILE_IDS:
                yield file()
                first, number = first + size, number + 1
                held, doc_ids, size = [], [], 0
        if held:
            yield file()

    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return map_batches(dealt, step, _FILES.format(kind=kind))


def _encoded(batches: Iterator[pa.RecordBatch], encoder) -> Iterator[tuple]:
    """(doc_id, ids) of every row; new chunks of PORTION bytes of text are learnt together."""
    for held in _together(batches):
        texts = pa.concat_arrays([pc.fill_null(part.column("text").cast(pa.string()), "") for part in held])
        doc_ids = chain.from_iterable(part.column("doc_id").to_pylist() for part in held)
        yield from zip(doc_ids, encoder.encode_all(texts), strict=True)
        give_back()


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """All rows in pieces of about PORTION bytes of text."""
    held, size = [], 0
    for batch in batches:
        for part in portions(batch):
            held.append(part)
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if size > PORTION // 2:
                yield held
                held, size = [], 0
    if held:
        yield held


def read_ids(files: DataFrame) -> Iterator[tuple]:
    """Decode files: a table (part, doc_id, first_id in the part, ids) of every document."""
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, doc_ids, starts, pieces in _decoded(batches):
            columns = [pa.array([part] * len(pieces), pa.int64()), pa.array(doc_ids), pa.array(starts, pa.int64())]
            ids = pa.array([p.astype(np.int64) for p in pieces], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*columns, ids], ["part", "doc_id", "first_id", "ids"])

    return map_batches(
        files.select("part", "first_id", "doc_ids", "content"), step,
        f"part long, doc_id {kind}, first_id long, ids array<long>",
    )


def _decoded(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part, first, doc_ids, content in zip(*(batch.column(c) for c in ("part", "first_id", "doc_ids", "content")), strict=True):
            sizes, ids = rans.unpack_file(content.as_py())
            ends = np.cumsum(sizes)
            pieces = [ids[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
            yield part.as_py(), doc_ids.values, first.as_py() + ends - sizes, pieces


def digest(files: DataFrame) -> DataFrame:
    """What the files hold, read back: doc_id, start, n_tokens, ids_crc32 of every document."""
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, doc_ids, starts, pieces in _decoded(batches):
            sums = [zlib.crc32(p.astype("<u4").tobytes()) for p in pieces]
            columns = [pa.array([part] * len(pieces), pa.int64()), doc_ids, pa.array(starts, pa.int64())]
            columns += [pa.array([len(p) for p in pieces], pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "first_id", "n_tokens", "ids_crc32"])

    found = map_batches(files.select("part", "first_id", "doc_ids", "content"), step, _DOCUMENTS.format(kind=kind))
    # one row per partition of the writing job, whatever the number of documents
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    placed = found.join(F.broadcast(parts), "part")
    return placed.select("doc_id", (F.col("offset") + F.col("first_id")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """``write_ids`` into the shared folder; the table reads the written files."""
    return stored(write_ids(docs, path, end))
