"""Alignment of the tokens of two tokenizers over the same bytes, by merge-path partitioning.

Both tokenizers cut a text at each blank that follows another character, so a text is a sequence
of pieces of text, here units, that can be encoded and aligned alone; a text in which blanks
follow other white space is one unit. Every distinct unit is aligned once per worker and then
looked up.

To align, the token ends of both sides over many units are laid on one byte line. Binary searches
along evenly spaced diagonals of the merge of both lists divide it into pieces of equal work,
whatever the units' lengths. A piece merges its part of the two lists and reports the offsets
where both sides end; an offset whose two ends fell into neighbouring pieces is stitched from the
last end of one and the first end of the next. These offsets cut the tokens into groups.

How many documents hold a pair of token ids linked is counted over the corpus; the counts come
back to the documents in slices of bounded size, so neither they nor the documents have to fit a
task or the driver.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffflow.llm.chunks import BYTE_CHARACTERS, ids_of_chunks, opening_tokens, stands_alone
from staffflow.llm.common import map_batches, sent, stored, texts_of

#: Token ends, of both sides together, in a piece of a merge.
PIECE = 16_384
#: Units kept by a worker, in two generations of this size.
KEPT = 250_000
#: Distinct pairs of ids whose counts go to the tasks at once: 24 bytes each.
SLICE = 2_000_000
SPACE = "▁"


# merge path


def diagonals(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending lists is cut into pieces of ``piece`` entries.

    Gives the numbers of entries of ``a`` and of ``b`` before each cut, both ends of the merge
    included. On each diagonal i + j = d a binary search finds the least i such that a[i] is not
    before b[j - 1]; all diagonals are searched at once. Of equal entries, a's comes first.
    """
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (low < high).any():
        i = (low + high) >> 1
        open_ = low < high
        # a[i] belongs before the cut if it is not after b[d - i - 1]
        before = np.zeros(len(d), bool)
        before[open_] = a[i[open_]] <= b[d[open_] - i[open_] - 1]
        low = np.where(open_ & before, i + 1, low)
        high = np.where(open_ & ~before, i, high)
    return low, d - low


def piece_overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entries that both parts of a piece hold."""
    if len(a) == 0 or len(b) == 0:
        return a[:0]
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return a[b[at] == a]


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """Offsets where tokens of both sides end, in ascending order, merged piece by piece."""
    i, j = diagonals(a, b, piece)
    found: list[np.ndarray] = []
    for k in range(len(i) - 1):
        mine, theirs = a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]
        # equal ends on both sides of a cut: a's closes the piece before, b's opens this one
        if i[k] and len(theirs) and a[i[k] - 1] == theirs[0]:
            found.append(theirs[:1])
        found.append(piece_overlaps(mine, theirs))
    return np.concatenate(found) if found else a[:0]


# encoding


class TwoTokenizers:
    """Ids and byte sizes of texts by a byte-level BPE (A) and a sentencepiece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.opens = opening_tokens(self.a)
        byte_of = {c: v for v, c in BYTE_CHARACTERS.items()}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.bytes_a[number] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        size = self.b.get_piece_size()
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode()
            for k, p in ((k, self.b.id_to_piece(k)) for k in range(size))
        ]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in p], np.int64) for p in (self.bytes_a, self.bytes_b))
        self.names = pa.array([str(k) for k in range(max(len(self.bytes_a), size))])
        #: id pairs are numbers a * stride + b below span
        self.stride, self.span = size, len(self.bytes_a) * size
        self.kind = "<u4" if self.span <= 1 << 32 else "<i8"
        plain = [self.b.id_to_piece(k) for k in range(size) if not (self.b.is_byte(k) or self.b.is_control(k) or self.b.is_unknown(k))]
        #: whether no piece of B goes on after a blank, so that texts may be cut before blanks
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in plain)

    def encode(self, units: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Per side the ids of all units end to end and how many each has; B adds the blank that A gets in the text."""
        alone = [stands_alone(u) and " " not in u for u in units]
        flat, sizes = ids_of_chunks(self.a, self.opens, [u for u, yes in zip(units, alone, strict=True) if yes])
        if not all(alone):
            whole = self.a.encode_batch_fast([f" {u}" for u, yes in zip(units, alone, strict=True) if not yes], add_special_tokens=False)
            parts, others = iter(np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []), iter(whole)
            both = [next(parts) if yes else np.array(next(others).ids, np.uint32) for yes in alone]
            flat, sizes = np.concatenate(both), np.array([len(x) for x in both], np.int64)
        ids_b = self.b.encode(units, num_threads=1)
        n_b = np.fromiter(map(len, ids_b), np.int64, len(ids_b))
        return (flat.astype(np.int64), sizes), (np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum())), n_b)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places starts[k], starts[k] + 1, ... for each of sizes[k]."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)


@dataclass
class Aligned:
    """Alignments of units as columns. ``groups``: ``a1,a2|b1;a3|b2``; ``whole`` is false if a side does not give the text's bytes.

    ``pairs`` and ``times`` hold the links of all units end to end, ``n_pairs`` how many entries a unit has.
    """

    groups: list[str]
    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_pairs: np.ndarray
    pairs: np.ndarray
    times: np.ndarray

    @classmethod
    def none(cls) -> Aligned:
        return cls([], np.empty(0, bool), *(np.empty(0, np.int64) for _ in range(6)))

    def take(self, at: np.ndarray) -> Aligned:
        first = np.cumsum(self.n_pairs) - self.n_pairs
        inner = _spread(first[at], self.n_pairs[at])
        columns = (x[at] for x in (self.whole, self.n_a, self.n_b, self.n_groups, self.n_pairs))
        return Aligned([self.groups[k] for k in at.tolist()], *columns, self.pairs[inner], self.times[inner])

    def and_then(self, other: Aligned) -> Aligned:
        mine, theirs = list(vars(self).values()), list(vars(other).values())
        return Aligned(mine[0] + theirs[0], *(np.concatenate(x) for x in zip(mine[1:], theirs[1:], strict=True)))


def _whole(texts: list[bytes], flat: np.ndarray, sizes: np.ndarray, pieces: list[bytes]) -> np.ndarray:
    """Whether the pieces of each text join to it."""
    parts = [pieces[x] for x in flat.tolist()]
    ends = np.cumsum(sizes)
    long = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(x) for x in parts], out=long[1:])
    same = long[ends] - long[ends - sizes] == [len(t) for t in texts]
    if same.all() and b"".join(parts) == b"".join(texts):
        return same
    return np.array([b"".join(parts[e - n : e]) == t for t, e, n in zip(texts, ends.tolist(), sizes.tolist(), strict=True)])


def align(units: list[str], tokenizers: TwoTokenizers, piece: int | None = None) -> Aligned:
    """Groups and links of every unit; all units are merged as one line of bytes."""
    (a, n_a), (b, n_b) = tokenizers.encode(units)
    texts = [b" " + u.encode() for u in units]
    whole = _whole(texts, a, n_a, tokenizers.bytes_a) & _whole(texts, b, n_b, tokenizers.bytes_b)
    a, b = a[np.repeat(whole, n_a)], b[np.repeat(whole, n_b)]
    n_a, n_b = n_a * whole, n_b * whole
    ends_a, ends_b = np.cumsum(tokenizers.sizes_a[a]), np.cumsum(tokenizers.sizes_b[b])
    cuts = common_ends(ends_a, ends_b, piece or PIECE)
    # tokens up to each cut; a unit's end is a cut, so groups end with their unit
    upto_a, upto_b = np.searchsorted(ends_a, cuts, "right"), np.searchsorted(ends_b, cuts, "right")
    upto_group = np.searchsorted(upto_a, np.cumsum(n_a), "right")
    group_a, group_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    pairs, times, links = _links(a, b, upto_a, upto_b, group_a, group_b, tokenizers.stride)
    upto_pair = np.concatenate(([0], np.cumsum(links)))[upto_group]
    sides = [_joined(tokenizers.names.take(pa.array(x)), upto, ",") for x, upto in ((a, upto_a), (b, upto_b))]
    texts_of_groups = pc.binary_join_element_wise(*sides, "|")
    groups = _joined(texts_of_groups, upto_group, ";").to_pylist()
    n_groups, n_pairs = np.diff(upto_group, prepend=0), np.diff(upto_pair, prepend=0)
    return Aligned(groups, whole, n_a, n_b, n_groups, n_pairs, pairs, times)


def _joined(texts: pa.Array, upto: np.ndarray, mark: str) -> pa.Array:
    """Texts joined by ``mark``, one for each of the parts that end at ``upto``."""
    offsets = pa.array(np.concatenate(([0], upto)).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, texts), mark)


#: Links of a group that are listed; more are counted by distinct ids.
LISTED = 4_096


def _links(a, b, upto_a, upto_b, group_a, group_b, stride) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of all groups, every token of one side with every one of the other: pairs, times, entries a group has."""
    n = group_a * group_b
    long = np.flatnonzero(n > LISTED)
    found = {}
    for g in long.tolist():
        ids_a, times_a = np.unique(a[upto_a[g] - group_a[g] : upto_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[upto_b[g] - group_b[g] : upto_b[g]], return_counts=True)
        found[g] = (ids_a[:, None] * stride + ids_b).ravel(), np.outer(times_a, times_b).ravel()
        n[g] = len(found[g][0])
    first = np.cumsum(n) - n
    within = np.arange(int(n.sum())) - np.repeat(first, n)
    width = np.repeat(group_b, n)
    if len(long):
        within[np.repeat(np.isin(np.arange(len(n)), long), n)] = 0  # filled below
    pairs = a[np.repeat(upto_a - group_a, n) + within // width] * stride + b[np.repeat(upto_b - group_b, n) + within % width]
    times = np.ones(len(pairs), np.int64)
    for g, (ids, counts) in found.items():
        pairs[first[g] : first[g] + n[g]], times[first[g] : first[g] + n[g]] = ids, counts
    return pairs, times, n


class Units:
    """Units seen lately by a worker, in two generations: the older one goes when the newer is full."""

    def __init__(self, tokenizers: TwoTokenizers, kept: int = KEPT):
        self.tokenizers, self.kept = tokenizers, kept
        self.place: dict[str, int] = {}
        self.old_place: dict[str, int] = {}
        self.known = self.old = Aligned.none()

    def split(self, text: str) -> list[str]:
        """Parts that can be encoded alone, each without the blank before it."""
        parts = text.split(" ")
        return parts if self.tokenizers.cuts and all(map(stands_alone, parts)) else [text]

    def learn(self, parts: list[str]) -> np.ndarray:
        """Places of the parts in ``known``; what is not there yet is aligned."""
        wanted = set(parts)
        if len(self.place) + len(wanted) > self.kept:
            self.old_place, self.old, self.place, self.known = self.place, self.known, {}, Aligned.none()
        lacking = wanted.difference(self.place)
        again = sorted(lacking.intersection(self.old_place))
        fresh = sorted(lacking.difference(self.old_place))
        if again:
            self._add(again, self.old.take(np.array([self.old_place[p] for p in again])))
        for at in range(0, len(fresh), 20_000):
            some = fresh[at : at + 20_000]
            self._add(some, align(some, self.tokenizers))
        return np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))

    def _add(self, parts: list[str], aligned: Aligned) -> None:
        self.known = self.known.and_then(aligned)
        for p in parts:
            self.place[p] = len(self.place)


# documents


def _worker_units(path_a: str, path_b: str) -> Units:
    """The units of this Python worker, kept from task to task."""
    import sentencepiece

    held = sentencepiece.__dict__.setdefault("_aligned_units", {})
    if (path_a, path_b) not in held:
        held[path_a, path_b] = Units(TwoTokenizers(path_a, path_b))
    return held[path_a, path_b]


def texts_aligned(texts: list[str], units: Units):
    """(n_a, n_b, n_groups, groups as text or None, pairs, times) of every text; pairs are ascending and distinct."""
    parts = [units.split(t) if t else [] for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    at = units.learn([p for text in parts for p in text])
    known, row = units.known, np.repeat(np.arange(len(texts)), sizes)
    broken = np.bincount(row[~known.whole[at]], minlength=len(texts)) > 0
    keep = ~broken[row]
    at, row = at[keep], row[keep]
    sums = [np.bincount(row, x[at], len(texts)).astype(np.int64) for x in (known.n_a, known.n_b, known.n_groups)]
    n_pairs = known.n_pairs[at]
    inner = _spread((np.cumsum(known.n_pairs) - known.n_pairs)[at], n_pairs)
    span = units.tokenizers.span
    keys, times = np.repeat(row, n_pairs) * span + known.pairs[inner], known.times[inner]
    if (times == 1).all():
        keys, times = np.unique(keys, return_counts=True)
    else:
        keys, place = np.unique(keys, return_inverse=True)
        times = np.bincount(place, times, len(keys)).astype(np.int64)
    cuts = np.searchsorted(keys, np.arange(len(texts) + 1) * span)
    starts = np.cumsum(~broken * sizes) - ~broken * sizes
    groups, places = known.groups, at.tolist()
    for k in range(len(texts)):
        mine = slice(cuts[k], cuts[k + 1])
        text = None
        if sizes[k] and not broken[k]:
            text = ";".join([groups[x] for x in places[starts[k] : starts[k] + sizes[k]]])
        yield *(int(x[k]) for x in sums), text, keys[mine] - k * span, times[mine]


#: Rows of a batch whose units are learnt together.
ROWS = 128

_ROWS = "doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Alignment of every row of ``docs`` (doc_id, text) by the vocabularies at ``path_a`` and ``path_b``.

    Output: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the linked id pairs
    (``pairs``: distinct a * stride + b as little-endian integers, ``times``: links of each as
    unsigned 32-bit ones). Texts that are null, empty, or whose tokens on either side do not join to
    the blank and the text, have no tokens.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _worker_units(path_a, path_b)
        kept = units.tokenizers.kind
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                columns: list[list] = [[], [], [], [], [], [], []]
                for n_a, n_b, n_groups, groups, pairs, times in texts_aligned(texts_of(batch), units):
                    digest = "" if groups is None else hashlib.sha256(groups.encode()).hexdigest()
                    row = n_a, n_b, n_groups, int(times.sum()), digest, pairs.astype(kept).tobytes(), times.astype("<u4").tobytes()
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], [x.split()[0] for x in _ROWS.split(", ")])

    return map_batches(docs.select("doc_id", "text"), step, _ROWS.format(kind=kind))


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a binary column end to end, and how many each row has."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind), np.array([len(p) for p in parts], np.int64) // np.dtype(kind).itemsize


def pair_counts(rows: DataFrame, stride: int, kind: str) -> DataFrame:
    """(pair, n_docs, is_best): documents that hold a pair, and whether no pair of the same A id has more."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        counts = (np.empty(0, np.int64), np.empty(0, np.int64))

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pairs = np.concatenate([counts[0], *held])
            n = np.concatenate([counts[1], np.ones(len(pairs) - len(counts[0]), np.int64)])
            distinct, at = np.unique(pairs, return_inverse=True)
            return distinct, np.bincount(at, n, len(distinct)).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(counts[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000]) for c in counts], ["pair", "n_docs"])

        for batch in batches:
            held.append(_flat(batch.column("pairs"), kind)[0].astype(np.int64))
            size += len(held[-1])
            if size > 4_000_000:
                counts, held, size = merged(), [], 0
                if len(counts[0]) > 4_000_000:  # sums of parts are sums as well
                    yield from out()
                    counts = (counts[0][:0], counts[1][:0])
        counts = merged()
        yield from out()

    found = map_batches(rows.select("pairs"), step, "pair long, n_docs long")
    sums = stored(found.groupBy("pair").agg(F.sum("n_docs").alias("n_docs")))
    a = F.expr(f"pair div {stride}")
    most = sums.groupBy(a.alias("a")).agg(F.max("n_docs").alias("most"))
    both = sums.withColumn("a", a).join(most, "a")
    return both.select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def alignment(docs: DataFrame, path_a: str, path_b: str, slice_pairs: int = SLICE) -> DataFrame:
    """Alignment of every document, and how usual its links are in the corpus.

    Output, one row per row of ``docs`` (doc_id, text; further columns are ignored): doc_id, n_a,
    n_b, n_groups, n_links, n_best (links whose id pair is held by as many documents as any pair
    of its A id), count_sum (documents that hold a link's pair, over the links), groups_sha256.
    Rows that repeat are documents of their own, a text of any length is aligned whole, an empty
    table gives no rows. Without tokens (null and empty texts, and those that a tokenizer does not
    give back byte by byte) all numbers are 0 and the digest is empty.
    """
    spark = docs.sparkSession
    rows = stored(aligned(docs, path_a, path_b).withColumn("row_id", F.monotonically_increasing_id()))
    tokenizers = TwoTokenizers(path_a, path_b)
    stride, kind = tokenizers.stride, tokenizers.kind
    counts = stored(pair_counts(rows, stride, kind))
    slices = max(1, -(-counts.count() // slice_pairs))
    parts = []
    for number in range(slices):
        # about slice_pairs pairs; all of them are at most the product of the two vocabularies
        some = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(slices)) == number).toArrow().sort_by("pair")
        held = sent(spark, tuple(some.column(c).to_numpy() for c in ("pair", "n_docs", "is_best")))
        parts.append(_sums(rows, held, kind) if slices == 1 else stored(_sums(rows, held, kind)))
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    total = [F.sum(c).alias(c) for c in ("n_best", "count_sum")]
    by_row = sums.groupBy("row_id").agg(*total)
    return rows.drop("pairs", "times").join(by_row, "row_id").select(*shown, "n_best", "count_sum", "groups_sha256")


def _sums(rows: DataFrame, held: Callable[[], tuple], kind: str) -> DataFrame:
    """(row_id, n_best, count_sum) over the pairs of one slice."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n_docs, is_best = held()
        for batch in batches:
            mine, sizes = _flat(batch.column("pairs"), kind)
            times = _flat(batch.column("times"), "<u4")[0].astype(np.int64)
            at = np.searchsorted(pairs, mine)
            at[at == len(pairs)] = 0
            there = pairs[at] == mine if len(pairs) else np.zeros(len(mine), bool)
            row = np.repeat(np.arange(batch.num_rows), sizes)[there]
            at, times = at[there], times[there]
            best, total = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            np.add.at(best, row, times * is_best[at])
            np.add.at(total, row, times * n_docs[at])
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), pa.array(best), pa.array(total)], ["row_id", "n_best", "count_sum"])

    return map_batches(rows.select("row_id", "pairs", "times"), step, "row_id long, n_best long, count_sum long")
