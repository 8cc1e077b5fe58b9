"""Benchmark decontamination by latent semantic retrieval.

Items and documents are cut into passages of words. A passage is a TF-IDF vector over hashed
words, document frequencies counted over the whole corpus. A randomised SVD, run as Spark jobs
over all passages of all documents and items, gives the latent space. Every
passage of every document is folded in and compared with all item passages, a given set, in
blocks by one matrix product. A short item is a small part of its window and its cosine is low, so
windows are also counted in words: those that hold enough of an item passage's rarer words for
the word check are taken whatever their cosine, and no passage the check accepts is missed. What
is near in either way is checked in the words themselves: the longest common subsequence with the
item, and whether the item's end, its answer, is there too. So a paraphrase with some words
changed is found and a passage that shares only a topic is not. A passage whose phrases stand in
another order has no long common subsequence: there the cosine decides, and words in any order, a
shorter subsequence and the answer confirm it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffflow.functions.packed import one_by_one
from staffflow.llm.common import give_back, map_batches, portions, sent, stored

TERMS = 1 << 16
RANK, OVERSAMPLE, POWER_STEPS = 64, 8, 2
#: Words of a block. Windows are whole blocks, a new one at each block, and one block longer than the item passage.
BLOCK = 16
#: Words of an item passage at most.
PASSAGE = 48
#: Words of the corpus that a task multiplies at least where all cores have one, and terms whose sums make a row.
TASK_WORDS, SLICE = 32_000_000, 512
#: Words of passages in a row of the table, which Parquet buffers a hundred of, and words that are multiplied
#: at once: the more, the fewer additions a term takes.
STORED, PACKED = 1 << 15, 1 << 18
#: Cosine from which a window that may match comes before those with fewer of it: of equal matches the first counts.
NEAR = 0.5
#: Share of an item passage that is a common subsequence: alone, and with its answer present.
VERBATIM, PARAPHRASE, ANSWERED = 0.9, 0.6, 0.5
ANSWER = 8
#: Cosine from which a window may hold a rewritten passage: one whose words are there in another order. Such a
#: window needs these shares of the passage's words, in any order, and of a common subsequence, and the answer.
#: Passages of fewer than WORDY words are not told from chance that way: their words may be common ones.
LATENT, HELD, REORDERED, WORDY = 0.75, 0.7, 0.3, 24
#: Share of an item passage that its rarer words must give at least; its most frequent words are not counted.
RARER = 0.2
#: Entries of a first look-up of counted words, and words counted at once.
MARKS, AT_ONCE = 1 << 20, 50_000
#: Windows in one matrix product, blocks summed at once, and bytes of text that are made words at once.
ROWS, SUMMED, BYTES = 2_048, 512, 1 << 20

_EDGES = ".,;:!?\"'()[]"


class _Words:
    """Words as numbers, 31-bit hashes; punctuation at the edges does not count, a bare mark is 0.

    The number modulo TERMS is the word's term.
    """

    def of(self, text: bytes) -> np.ndarray:
        return self.of_all(pa.array([text.decode()], pa.string()))[0]

    @staticmethod
    def of_all(texts: pa.Array) -> list[np.ndarray]:
        """The numbers of each text of a string array, each distinct word hashed once; a null text has none."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
        coded, ends = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()
        bare = pc.ascii_trim(coded.dictionary, characters=_EDGES)
        hashes = map(zlib.crc32, bare.cast(pa.binary()).to_numpy(zero_copy_only=False))
        numbers = 1 + np.fromiter(hashes, np.int64, len(bare)) % 0x7FFFFFFE
        numbers[pc.binary_length(bare).to_numpy() == 0] = 0
        # white space at the ends of a text leaves empty words there
        numbers[pc.binary_length(coded.dictionary).to_numpy() == 0] = -1
        values = numbers.astype(np.int32)[coded.indices.to_numpy()]
        real = values >= 0
        ends = np.concatenate(([0], np.cumsum(real)))[ends - ends[0]].tolist()
        values = values[real]
        return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def passages(numbers: np.ndarray) -> list[list[int]]:
    """A benchmark item as passages of PASSAGE words at most, of even length, bare marks left out."""
    words = numbers[numbers > 0]
    parts = -(-len(words) // PASSAGE)
    return [p.tolist() for p in np.array_split(words, parts)] if parts else []


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one long integer of a bit per word of ``a``."""
    places: dict[int, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        match = row & places.get(word, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


@dataclass
class Counted:
    """The words by which windows are counted, and how many of them a passage needs.

    ``least`` words of a passage must be common for the check. Its most frequent words, ``c`` of
    its places, are left out, so a window the check accepts holds ``least - c`` of the others.
    The passages ``passages[starts[i] : starts[i + 1]]`` count the word ``words[i]``.
    """

    words: np.ndarray
    starts: np.ndarray
    passages: np.ndarray
    needs: np.ndarray
    marks: np.ndarray

    @classmethod
    def of(cls, parts: list[list[int]], frequency: np.ndarray) -> Counted:
        pairs, needs = [], []
        for k, part in enumerate(parts):
            least = math.ceil(PARAPHRASE * len(part) - 1e-9)
            spare = least - math.ceil(RARER * len(part))
            needs.append(least)
            places = Counter(part)
            for word in sorted(places, key=lambda w: (-frequency[w % TERMS], w)):
                if places[word] <= spare:
                    spare, needs[k] = spare - places[word], needs[k] - places[word]
                else:
                    pairs.append((word, k))
        pairs.sort()
        of_pair, passages = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else np.empty((2, 0), np.int64)
        words, first = np.unique(of_pair, return_index=True)
        marks = np.zeros(MARKS, bool)
        marks[words % MARKS] = True
        return cls(words, np.append(first, len(of_pair)), passages, np.array(needs, np.int64), marks)


def _repeated(first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each entry, so many times."""
    return np.arange(times.sum()) + np.repeat(first - np.cumsum(times) + times, times)


@dataclass
class Index:
    """The latent space and the item passages in it.

    ``row_of`` gives each term its row of ``vectors`` (idf included); the last row, zeros, is that
    of the terms the space does not know.
    """

    row_of: np.ndarray
    vectors: np.ndarray
    items: np.ndarray
    item_ids: list
    passages: list[list[int]]
    members: list[frozenset[int]]
    widths: np.ndarray
    counted: Counted

    @property
    def sizes(self) -> np.ndarray:
        """Words of each item passage."""
        if not hasattr(self, "_sizes"):
            self._sizes = np.array([len(p) for p in self.passages], np.int64)
        return self._sizes

    def blocks(self, numbers: np.ndarray) -> np.ndarray:
        """Sum of the vectors of each block of a text."""
        return self.blocks_of([numbers], 0)[0]

    def blocks_of(self, texts: list[np.ndarray], gap: int) -> tuple[np.ndarray, np.ndarray]:
        """``blocks`` of many texts one below the other, ``gap`` rows of zeros behind each, and where each text starts."""
        sizes = np.array([len(t) for t in texts], np.int64)
        blocks = -(-sizes // BLOCK)
        ends = np.cumsum(blocks + gap)
        bases = np.concatenate(([0], ends[:-1]))
        sums = np.zeros((int(ends[-1]), self.vectors.shape[1]), np.float32)
        place, last = _repeated(bases, blocks), np.cumsum(blocks)[blocks > 0] - 1
        words = np.full(len(place), BLOCK)
        words[last] = (sizes - (blocks - 1) * BLOCK)[blocks > 0]
        sums[place] = _group_sums(self.vectors, self.row_of[np.concatenate(texts) % TERMS], words, BLOCK)
        return sums, bases


def _running(sums: np.ndarray, blocks: int) -> np.ndarray:
    """Sums of so many neighbouring rows; of all rows if there are fewer."""
    if len(sums) <= blocks:
        return sums.sum(axis=0, keepdims=True)
    out = sums[: len(sums) - blocks + 1].copy()
    for k in range(1, blocks):
        out += sums[k : len(sums) - blocks + 1 + k]
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, words): the words of every text as numbers of four bytes, end to end; a null text has none."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, BYTES):
                found = _Words.of_all(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _packed(found)], ["doc_id", "words"])

    return map_batches(docs.select("doc_id", "text"), step, f"doc_id {kind}, words binary")


def _packed(rows: list[np.ndarray]) -> pa.Array:
    """Numbers as binary rows: an array of whole numbers costs Spark far more to write and to read."""
    ends = np.cumsum([0, *map(len, rows)]) * 4
    data = np.concatenate([np.empty(0, "<i4"), *rows]).astype("<i4", copy=False)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _numbers_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    rows = batch.column("words")
    lengths = pc.binary_length(rows).to_numpy() // 4
    ends = np.cumsum(np.append(0, lengths))
    data = rows.buffers()[2]
    first = np.frombuffer(rows.buffers()[1], np.int32, 1, 4 * rows.offset)[0] // 4 if len(rows) else 0
    values = np.frombuffer(data, "<i4")[first : first + ends[-1]] if data is not None else np.empty(0, "<i4")
    return [values[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]


def document_frequencies(coded: DataFrame) -> tuple[np.ndarray, int, int]:
    """In how many documents each term occurs, over all documents, how many there are, and their words."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n, words = np.zeros(TERMS + 2, np.int64), 0, 0
        last = np.empty(TERMS, np.int64)
        for batch in batches:
            for numbers in _numbers_of(batch):
                found, n, words = numbers % TERMS, n + 1, words + len(numbers)
                # each term of a text once: where its last occurrence is
                place = np.arange(len(found))
                last[found] = place
                counts[found[last[found] == place]] += 1
        counts[TERMS:] = n, words
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["term", "n"])

    sums = map_batches(coded.select("words"), step, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(TERMS + 2, np.int64)
    counts[sums.column("term").to_numpy()] = sums.column("n").to_numpy()
    return counts[:TERMS], int(counts[TERMS]), int(counts[TERMS + 1])


def passage_blocks(coded: DataFrame, idf: np.ndarray) -> DataFrame:
    """(terms, sizes, scales): all passages of all texts, packed, those of about STORED words in a row.

    A text is cut into passages of PASSAGE words at most and of even length, none is left out.
    ``terms`` are 16 bits a word; the scale of a passage is 1 over its squared TF-IDF norm, 0 if that is 0.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (t for batch in batches for t in _numbers_of(batch) if len(t))
        for held in _together(texts, STORED):
            lengths = np.array([len(t) for t in held], np.int64)
            parts = -(-lengths // PASSAGE)
            sizes = np.repeat(lengths // parts, parts) + (_repeated(np.zeros(len(held), np.int64), parts) < np.repeat(lengths % parts, parts))
            terms = np.concatenate(held) % TERMS
            keys = np.sort(np.repeat(np.arange(len(sizes)) * TERMS, sizes) + terms)
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            value = np.diff(np.append(first, len(keys))) * idf[keys[first] % TERMS]
            square = np.bincount(keys[first] // TERMS, value * value, len(sizes))
            scales = np.divide(1, square, out=np.zeros(len(sizes)), where=square > 0)
            data = [terms.astype("<u2"), sizes.astype("<i4"), scales.astype("<f4")]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in data], ["terms", "sizes", "scales"])

    return map_batches(coded.select("words"), step, "terms binary, sizes binary, scales binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Terms, sizes and scales of the rows of ``passage_blocks``, those of PACKED words and the row more together."""
    kinds = {"terms": "<u2", "sizes": "<i4", "scales": "<f4"}
    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c) for c in kinds), strict=True):
            held.append([np.frombuffer(x.as_py(), kind) for x, kind in zip(row, kinds.values(), strict=True)])
            size += len(held[-1][0])
            if size >= PACKED:
                yield [np.concatenate(x) for x in zip(*held, strict=True)]
                held, size = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _group_sums(rows: np.ndarray, source: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """Sums of ``rows[source]`` over groups of so many neighbours, ``most`` of them at once; the last of ``rows`` are zeros."""
    out, group = np.empty((len(sizes), rows.shape[1]), np.float32), np.arange(len(sizes))
    held = np.empty((SUMMED, rows.shape[1]), np.float32)
    while len(group):
        parts = -(-sizes // most)
        ends = np.cumsum(parts)
        places = np.full(ends[-1] * most, len(rows) - 1)
        places[_repeated((ends - parts) * most, sizes)] = source
        places = places.reshape(-1, most)
        sums = np.zeros((ends[-1] + 1, rows.shape[1]), np.float32)
        for at in range(0, ends[-1], SUMMED):
            some = np.ascontiguousarray(places[at : at + SUMMED].T)
            total, one = sums[at : at + some.shape[1]], held[: some.shape[1]]
            for at_once in some:
                total += rows.take(at_once, axis=0, mode="clip", out=one)
        whole = parts == 1
        out[group[whole]] = sums[(ends - parts)[whole]]
        # what was summed in several parts is summed again
        group, sizes, source, rows = group[~whole], parts[~whole], _repeated((ends - parts)[~whole], parts[~whole]), sums
    return out


def _projected(terms: np.ndarray, sizes: np.ndarray, scales: np.ndarray, thin: np.ndarray) -> np.ndarray:
    """Of each passage the sum of the rows ``thin`` of its terms times its scale; the last row is zeros and of no term."""
    return _group_sums(thin, terms, sizes, PASSAGE) * scales[:, None]


def _added(terms: np.ndarray, sizes: np.ndarray, scales: np.ndarray, thin: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` the passages' AᵀA times ``thin``; the idf of Aᵀ is left to the caller."""
    rows = np.concatenate([_projected(terms, sizes, scales, thin), np.zeros((1, thin.shape[1]), np.float32)])
    order = np.argsort(terms, kind="stable")
    found = terms[order]
    first = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    passage = np.repeat(np.arange(len(sizes)), sizes)[order]
    total[found[first]] += _group_sums(rows, passage, np.diff(np.append(first, len(found))), 8)


def fit_space(blocks: DataFrame, idf: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Right singular vectors over singular values of the TF-IDF matrix A of the passages in ``blocks``, by randomised SVD.

    A row for each of the terms ``active``, at most TERMS: those that occur. Each step multiplies
    the row-partitioned matrix by a thin one in the tasks, which sum by term, and adds the tasks'
    sums; only matrices of a row per term and RANK columns meet on the driver.
    """
    spark, width = blocks.sparkSession, RANK + OVERSAMPLE
    weight = idf[active, None]
    place = np.zeros(TERMS, np.uint16)
    place[active] = np.arange(len(active))

    def summed(basis: np.ndarray, shape: tuple[int, int], add: Callable) -> np.ndarray:
        """Over all tasks, the sum of what ``add`` adds to an array of this shape for rows of ``blocks``."""
        rows = np.zeros((len(active) + 1, width), np.float32)
        np.multiply(weight, basis, out=rows[:-1], casting="same_kind")
        thin = spark.sparkContext.broadcast((place, rows))
        cuts = list(range(0, shape[0], SLICE))

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (place_of, q), total, some = thin.value, np.zeros(shape, "<f4"), False
            for terms, sizes, scales in _unpacked(batches):
                add(place_of[terms], sizes, scales, q, total)
                some = True
            for at in cuts if some else []:
                sums = total[at : at + SLICE].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([sums], pa.binary())], ["at", "sums"])

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                for at, sums in zip(batch.column("at").to_pylist(), batch.column("sums"), strict=True):
                    held[at] = held.get(at, 0.0) + np.frombuffer(sums.as_buffer(), "<f4").astype(np.float64)
            for at, sums in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["at", "sums"])

        parts = map_batches(blocks, step, "at int, sums binary").withColumn("task", F.spark_partition_id())
        parts = parts.repartition(min(len(cuts), spark.sparkContext.defaultParallelism), "at").sortWithinPartitions("at", "task")
        out = np.zeros(shape)
        with one_by_one(spark):
            for row in map_batches(parts.drop("task"), merge, "at int, sums binary").toLocalIterator():
                out[row["at"] : row["at"] + SLICE] = np.frombuffer(row["sums"], "<f8").reshape(-1, width)
        thin.destroy()
        return out

    def squared(terms: np.ndarray, sizes: np.ndarray, scales: np.ndarray, thin: np.ndarray, total: np.ndarray) -> None:
        rows = _projected(terms, sizes, np.sqrt(scales), thin)
        total += rows.T @ rows

    basis = np.random.default_rng(5).standard_normal((len(active), width))
    for _ in range(POWER_STEPS):
        basis, _ = np.linalg.qr(weight * summed(basis, basis.shape, _added))
    # the basis' square under AᵀA needs A times the basis only
    values, turn = np.linalg.eigh(summed(basis, (basis.shape[1], width), squared))
    best = np.argsort(-values)[:RANK]
    # vectors are folded in by the inverse singular values, else the few topics of a corpus hide all else
    return basis @ turn[:, best] / np.sqrt(np.maximum(values[best], 1e-9))


def build_index(coded: DataFrame, benchmark: DataFrame) -> Index:
    """The latent space over ``coded`` (see ``numbered``) and the items, and the passages of ``benchmark`` in it.

    The benchmark (item_id, text) is the stated set of queries: it is held on the driver and sent
    to the tasks.
    """
    frequency, n, words_in_all = document_frequencies(coded)
    idf = np.log((n + 1) / (frequency + 1))
    idf[0] = 0
    item_ids, parts, words = [], [], _Words()
    for row in sorted(benchmark.filter("item_id is not null").select("item_id", "text").collect(), key=lambda r: r.item_id):
        for part in passages(words.of((row.text or "").encode())):
            item_ids.append(row.item_id), parts.append(part)
    if not parts:
        none = np.zeros((0, RANK), np.float32)
        return Index(np.zeros(TERMS, np.int32), np.zeros((1, RANK), np.float32), none, [], [], [], np.zeros(0, np.int64), Counted.of([], frequency))
    terms = [[w % TERMS for w in part] for part in parts]
    spark = coded.sparkSession
    own = spark.createDataFrame([(np.array(p, "<i4").tobytes(),) for p in parts], "words binary").coalesce(1)
    # a task returns a matrix of a row per term: tasks of TASK_WORDS words, but one for every core
    tasks = max(spark.sparkContext.defaultParallelism, -(-words_in_all // TASK_WORDS))
    blocks = stored(passage_blocks(coded.select("words").coalesce(tasks).union(own), idf))
    active = np.unique(np.concatenate([np.flatnonzero(frequency), *terms]))
    active = active[np.argsort(-frequency[active], kind="stable")]  # what is read most lies together
    space = fit_space(blocks, idf, active)
    vectors = np.vstack([space * idf[active, None], np.zeros((1, space.shape[1]))]).astype(np.float32)
    row_of = np.full(TERMS, len(active), np.int32)
    row_of[active] = np.arange(len(active))
    items = _unit(np.stack([vectors[row_of[t]].sum(axis=0) for t in terms]))
    widths = np.array([-(-len(p) // BLOCK) + 1 for p in parts])
    return Index(row_of, vectors, items, item_ids, parts, [frozenset(p) for p in parts], widths, Counted.of(parts, frequency))


def _together(texts: Iterable[np.ndarray], words: int | None = None) -> Iterator[list[np.ndarray]]:
    """Neighbouring texts of AT_ONCE words (of ``words``) or the text more that brings them there."""
    held, size = [], 0
    for numbers in texts:
        held.append(numbers)
        size += len(numbers)
        if size >= (words or AT_ONCE):
            yield held
            held, size = [], 0
    if held:
        yield held


def _worded(texts: list[np.ndarray], index: Index) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the windows, and the item passages, whose counted words allow a match."""
    for held in _together(texts):
        yield from _worded_at_once(held, index)


def _worded_at_once(texts: list[np.ndarray], index: Index) -> list[tuple[np.ndarray, np.ndarray]]:
    c, sizes = index.counted, np.array([len(t) for t in texts])
    ends, blocks = np.cumsum([0, *sizes]), -(-sizes // BLOCK)
    bases, total = np.cumsum([0, *blocks]), max(1, int(blocks.sum()))
    values = np.concatenate(texts)
    at = np.flatnonzero(c.marks[values % MARKS])
    place = np.searchsorted(c.words, values[at])
    exact = c.words[np.minimum(place, len(c.words) - 1)] == values[at] if len(c.words) else np.zeros(0, bool)
    at, place = at[exact], place[exact]
    text = np.searchsorted(ends, at, side="right") - 1
    block = bases[text] + (at - ends[text]) // BLOCK
    times = c.starts[place + 1] - c.starts[place]
    passage = c.passages[_repeated(c.starts[place], times)]
    keys, words = np.unique(passage * total + np.repeat(block, times), return_counts=True)
    passage, block = keys // total, keys % total
    text = np.searchsorted(bases, block, side="right") - 1
    # the words of a block count in every window whose region, a block more at each side, holds it
    width, base = index.widths[passage], bases[text]
    low = np.maximum(base, block - width)
    high = np.minimum(base + np.maximum(blocks[text] - width, 0), block + 1)
    times = high - low + 1
    windows, where = np.unique(np.repeat(passage, times) * total + _repeated(low, times), return_inverse=True)
    passage, window = windows // total, windows % total
    enough = np.bincount(where, np.repeat(words, times), len(windows)) >= c.needs[passage]
    passage, window = passage[enough], window[enough]
    order = np.argsort(window, kind="stable")
    passage, window = passage[order], window[order]
    cuts = np.searchsorted(window, bases)
    return [(window[a:b] - base, passage[a:b]) for a, b, base in zip(cuts, cuts[1:], bases, strict=False)]


def _matches(numbers: np.ndarray, index: Index, worded: tuple[np.ndarray, np.ndarray]) -> dict:
    """``_matches_at_once`` of one text."""
    return _matches_at_once([numbers], index, [worded])[0]


def _all_matches(texts: list[np.ndarray], index: Index) -> Iterator[dict]:
    """``_matches_at_once`` of any number of texts."""
    for held in _together(texts):
        yield from _matches_at_once(held, index, _worded_at_once(held, index))


def _matches_at_once(texts: list[np.ndarray], index: Index, worded: list[tuple[np.ndarray, np.ndarray]]) -> list[dict]:
    """Of each text, item_id -> (cosine, common share, answer share) of its best matching passage.

    ``worded``: the windows and passages whose counted words allow a match (see ``_worded``).
    """
    found: list[dict] = [{} for _ in texts]
    if not len(index.items):
        return found
    # behind a text are so many empty blocks that no window reaches into the next
    sums, bases = index.blocks_of(texts, int(index.widths.max()) - 1)
    blocks = np.array([-(-len(t) // BLOCK) for t in texts])
    by_words = np.concatenate([w + base for (w, _), base in zip(worded, bases, strict=True)])
    members = np.concatenate([k for _, k in worded])
    for width in np.unique(index.widths):
        rows = _unit(_running(sums, width))
        own = index.widths[members] == width
        at, passage = by_words[own], members[own]
        late = np.einsum("ij,ij->i", rows[at], index.items[passage]) < NEAR
        # below LATENT the check accepts only what the counted words allow
        near, others, cosine = _latent(rows, index, np.flatnonzero((index.widths == width) & (index.sizes >= WORDY)))
        text = np.searchsorted(bases, near, side="right") - 1
        real = (blocks[text] > 0) & (near - bases[text] <= np.maximum(blocks[text] - width, 0))
        near, others, cosine = near[real], others[real], cosine[real]
        n = len(at)
        at, passage, late = np.append(at, near), np.append(passage, others), np.append(late, np.zeros(len(near), bool))
        # what is near in both ways is there once, as counted in words
        once = np.unique(at * len(index.items) + passage, return_index=True)[1]
        text = np.searchsorted(bases, at, side="right") - 1
        once = once[np.lexsort((passage[once], at[once], late[once], text[once]))]
        last, region = -1, []
        for t, row, k, j in zip(text[once].tolist(), at[once].tolist(), passage[once].tolist(), once.tolist(), strict=True):
            if row != last:
                start = (row - int(bases[t])) * BLOCK
                last, region = row, texts[t][max(0, start - BLOCK) : start + int(width + 1) * BLOCK].tolist()
                words = frozenset(region)
            part, item = index.passages[k], index.item_ids[k]
            # no subsequence holds a word that the region lacks
            if len(part) - len(index.members[k].difference(words)) < min(PARAPHRASE, HELD) * len(part):
                continue
            share, near_by = common_length(part, region) / len(part), float(rows[row] @ index.items[k] if j < n else cosine[j - n])
            if share < PARAPHRASE:
                if near_by < LATENT or share < REORDERED or len(part) < WORDY or _held(part, region) < HELD:
                    continue
            answer = part[-ANSWER:]
            answered = common_length(answer, region) / len(answer)
            if (share >= VERBATIM or answered >= ANSWERED) and share > found[t].get(item, (0, 0, 0))[1]:
                found[t][item] = (near_by, share, answered)
    return found


def _latent(rows: np.ndarray, index: Index, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and passages of ``group`` at a cosine of LATENT and more, and the cosine."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))]
    items = index.items[group].T
    for at in range(0, len(rows) if len(group) else 0, ROWS):
        cosine = rows[at : at + ROWS] @ items
        row, k = np.divmod(np.flatnonzero(cosine >= max(NEAR, LATENT)), len(group))
        found.append((row + at, group[k], cosine[row, k]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _held(part: list[int], region: list[int]) -> float:
    """Share of a passage's words that a region holds, in any order, as often as the passage does."""
    return (Counter(part) & Counter(region)).total() / len(part)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Which benchmark items a document holds, word for word or paraphrased.

    Output, one row per input row and item found: doc_id, item_id, cosine, common_share,
    answer_share, those of the best matching passage. Null and empty texts hold nothing, items
    that are null, empty or without an id are not looked for, repeated items are found each. Texts
    of any length are searched whole, of equally good passages the first counts, rows that repeat
    are searched each, an empty table or benchmark gives no rows, further columns are ignored.
    """
    coded = stored(numbered(docs))
    held = sent(docs.sparkSession, build_index(coded, benchmark))
    doc_kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (benchmark, "item_id")))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held()
        for batch in batches:
            rows, hits = [], []
            for k, found in enumerate(_all_matches(_numbers_of(batch), index)):
                for item, measures in found.items():
                    rows.append(k), hits.append((item, *measures))
            if hits:
                columns = [batch.column("doc_id").take(pa.array(rows)), *(pa.array(c) for c in zip(*hits, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "cosine", "common_share", "answer_share"])

    schema = f"doc_id {doc_kind}, item_id {item_kind}, cosine double, common_share double, answer_share double"
    return map_batches(coded, step, schema)


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item (see ``contaminated``), all of their columns.

    Null and empty texts stay, rows that repeat go or stay together, an empty benchmark keeps all.
    """
    held = sent(docs.sparkSession, build_index(stored(numbered(docs)), benchmark))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held()
        for batch in batches:
            for part in portions(batch, BYTES):
                clean = [not found for found in _all_matches(_Words.of_all(part.column("text")), index)]
                yield part.filter(pa.array(clean, pa.bool_()))
                give_back()

    return map_batches(docs, step, docs.schema)
