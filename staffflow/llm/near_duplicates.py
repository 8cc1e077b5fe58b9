"""Near-duplicate groups: one-permutation MinHash, optimal densification, bands and stars.

A document is its set of distinct five-word shingles. Documents with one and the same set are
one class. One hash function deals a set's shingles to ``BINS`` bins and keeps the least hash of
each; an empty bin borrows from a full one chosen by a fixed random sequence (optimal
densification). ``BANDS`` bands of ``ROWS`` bins give buckets: a pair at similarity 0.75 misses
all of them with probability (1 - 0.75^4)^32 < 6e-6 if its bins are independent. In a small set
they are not, as one shingle fills many bins, so a set of at most ``SMALL`` shingles is also in
the buckets of its least shingles, as many as it takes that two similar sets share one: no pair
is missed there. Signatures are compared before the sets only where both sets have ``SURE``
shingles or more.

A bucket proposes a star, its smallest member with every other one, not all pairs. A proposal is
confirmed on the full shingle sets. A star only proves links through its hub, so buckets whose
members are still in several components are compared once more inside tasks, block against
block, and only a spanning forest of the links found there is emitted: no link is lost to the
stars, and no pair of members becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffflow.llm.common import bytes_of, map_batches, stored

SHINGLE = 5
BINS, BANDS = 128, 32
ROWS = BINS // BANDS
PERCENT = 75
#: Of BINS, how many must agree before sets are fetched: 0.75 less five standard deviations. Smaller sets are fetched at once.
AGREE, SURE = 71, 2 * BINS
#: Shingles of a set that has buckets of its least shingles too.
SMALL = 32
#: Members, and shingles, of a block of a bucket that is compared inside one task.
BLOCK_MEMBERS, BLOCK_SHINGLES = 4_096, 300_000
#: Sets of a block that are compared shingle by shingle: two blocks give a table of 64 MB.
BLOCK_SETS = 2_048
FILTER_BITS = 1 << 26

_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BORROW = np.random.default_rng(11).integers(0, BINS, (BINS, 64 * BINS // 8))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; A-Z in either case are equal."""
    words = text.lower().split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, SHINGLE)
    count = n - width + 1
    mixed = np.full(count, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashes[k : k + count]) * _MULTIPLIERS[k]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MULTIPLIERS[0]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin, empty bins densified; ``hashes`` sorted and not empty."""
    shift = np.uint64(64 - (BINS.bit_length() - 1))
    bins = (hashes >> shift).astype(np.int64)
    first = np.concatenate(([True], bins[1:] != bins[:-1]))
    full = np.zeros(BINS, bool)
    least = np.zeros(BINS, np.uint64)
    full[bins[first]] = True
    least[bins[first]] = hashes[first]
    if not full.all():
        filled = np.flatnonzero(full)
        for empty in np.flatnonzero(~full):
            tries = _BORROW[empty]
            found = tries[full[tries]]
            # a text of very few shingles may exhaust the sequence: then a fixed full bin serves
            source = found[0] if len(found) else filled[empty % len(filled)]
            least[empty] = least[source]
    return least


def band_hashes(least: np.ndarray) -> np.ndarray:
    """One signed 64-bit hash per band of the signature."""
    rows = least.reshape(BANDS, ROWS)
    mixed = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        mixed = (mixed ^ rows[:, k]) * _MULTIPLIERS[k]
        mixed ^= mixed >> np.uint64(31)
    return mixed.view(np.int64)


def least_shingles(hashes: np.ndarray) -> np.ndarray:
    """Shingles of which a small set shares one with every small set at the similarity; none of a larger set.

    A set shares at least PERCENT of its shingles with a similar one, so the least of the shared
    ones is among this many least of each.
    """
    n = len(hashes)
    return hashes[: n - -(-PERCENT * n // 100) + 1 if n <= SMALL else 0].view(np.int64)


def class_key(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands, firsts, marks = [], [], [], [], []
        for text in bytes_of(batch):
            hashes = shingle_set(text)
            sizes.append(len(hashes))
            if len(hashes) == 0:
                keys.append(None), bands.append(None), firsts.append(None), marks.append(None)
                continue
            least = signature(hashes)
            keys.append(class_key(hashes))
            bands.append(band_hashes(least))
            firsts.append(least_shingles(hashes))
            marks.append((least & np.uint64(255)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row_id"), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(firsts, pa.list_(pa.int64())),
                pa.array(marks, pa.binary()),
            ],
            ["row_id", "doc_id", "n_shingles", "class", "bands", "firsts", "marks"],
        )


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with a small set, or whose signatures agree in at least AGREE bins (one byte of each is compared)."""
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("marks_a", "marks_b")
        )
        keep = pa.array(((left == right).sum(axis=1) >= AGREE) | (batch.column("n").to_numpy() < SURE))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _positions(key: str) -> list:
    """Four places of a class key in the membership filter, from its own 128 bits."""
    return [F.conv(F.hex(F.substring(key, 4 * i + 1, 4)), 16, 10).cast("long").bitwiseAND(FILTER_BITS - 1) for i in range(4)]


def _membership(keys: DataFrame) -> bytes:
    """Bits of a Bloom filter over class keys: at most FILTER_BITS / 8 bytes whatever the input.

    With very many keys it lets more through; it never loses one.
    """
    bits = (
        keys.select(F.explode(F.array(*_positions("class"))).alias("at"))
        .groupBy(F.shiftrightunsigned("at", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[bits.column("word").to_numpy()] = bits.column("bits").to_numpy()
    return words.tobytes()


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, shingles) of the wanted classes, computed again from the texts.

    Only a membership filter of bounded size goes to the tasks, so texts are never shuffled.
    """
    member = docs.sparkSession.sparkContext.broadcast(_membership(wanted))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(member.value, np.uint64)
        seen: set[bytes] = set()
        for batch in batches:
            keys, sets = [], []
            for text in bytes_of(batch):
                hashes = shingle_set(text)
                if len(hashes) == 0:
                    continue
                key = class_key(hashes)
                at = np.frombuffer(key, ">u4").astype(np.uint64) & np.uint64(FILTER_BITS - 1)
                if key in seen or not ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all():
                    continue
                seen.add(key)
                keys.append(key), sets.append(hashes.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["class", "shingles"]
            )

    found = map_batches(docs.select("text"), step, "class binary, shingles array<long>")
    return found.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def components(links: DataFrame) -> DataFrame:
    """(class, component) of every class with a link; the component is its smallest class key.

    Alternates large-star and small-star steps until every component is a star around its least
    class. A step is a partial aggregate and a join; the edge table is written after each pair.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _all_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: neighbours above u hang on the least of u and its neighbours
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its neighbours below hang on the least of those
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        edges = stored(small.distinct())
    tops = edges.select(F.col("v").alias("class"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("class"), F.col("v").alias("component")).union(tops)


def _all_stars(edges: DataFrame) -> bool:
    """Whether each u has one v only and no v hangs on another."""
    ends = edges.select(F.col("u").alias("end"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("end").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that reach the similarity on their full sets, with the size of the intersection."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("set_a", "set_b")).alias("shared")
    sized = both.select("a", "b", shared, (F.size("set_a") + F.size("set_b")).alias("total"))
    return sized.filter(100 * F.col("shared") >= PERCENT * (F.col("total") - F.col("shared"))).select("a", "b")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The ``is_first`` rows of ``near_duplicates`` of ``docs``, all of their columns: one of each component.

    Rows are joined on a number given before the search, so the input is written once with it.
    """
    number = "near_duplicates_row"
    while number in docs.columns:
        number += "_"
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()))
    gone = near_duplicates(numbered, number).filter("not is_first").select(F.col("row_id").alias(number))
    return numbered.join(gone, number, "left_anti").drop(number)


def near_duplicates(docs: DataFrame, number: str | None = None) -> DataFrame:
    """Groups of near-duplicate documents.

    Input: columns ``doc_id`` and ``text``; others are ignored. Output, one row per input row:
    ``row_id`` (the column ``number``, else its place in this run), ``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id
    reachable over links, itself included), ``kept`` (doc_id is component_id; both null counts as
    equal), ``is_first`` (true for one row of each component, of rows that repeat its id too).
    Texts that are null, empty or blank have an empty set and no links. A null doc_id links like
    any other but never names a component while another id is there.
    """
    row_id = F.col(number) if number else F.monotonically_increasing_id()
    source = docs.select("doc_id", "text", row_id.alias("row_id"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = stored(
        map_batches(
            source, _sketch,
            f"row_id long, doc_id {kind}, n_shingles long, class binary, bands array<long>, firsts array<long>, marks binary",
        )
    )
    full = rows.filter("n_shingles > 0")
    classes = full.groupBy("class").agg(
        F.max("n_shingles").alias("n"), F.any_value("bands").alias("bands"), F.any_value("firsts").alias("firsts"),
        F.any_value("marks").alias("marks"),
    )
    classes = stored(classes)
    placed = rows.select("row_id", "doc_id", "n_shingles", "class")
    found = _linked(docs, classes)
    placed = placed.withColumn("component", F.lit(None).cast("binary")) if found is None else placed.join(found, "class", "left")
    # a row without shingles is a component of its own
    alone = F.col("row_id").cast("string").cast("binary")
    placed = placed.withColumn("component", F.coalesce("component", "class", alone))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id")
    heads = placed.groupBy("component").agg(F.min(order).alias("head"))
    return placed.join(heads, "component").select(
        "row_id", "doc_id", "n_shingles",
        F.col("head.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("head.doc_id")).alias("kept"),
        (F.col("head.row_id") == F.col("row_id")).alias("is_first"),
    )


def _linked(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(class, component) of every class with a confirmed link; None without any candidate."""
    banded = classes.select("class", "n", F.explode(F.concat("bands", "firsts")).alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min("class").alias("hub")).filter("members > 1")
    buckets = stored(banded.join(shared, "band").select("band", "class", "n", "hub"))
    marks = classes.select("class", "n", "marks")
    stars = buckets.filter(F.col("class") != F.col("hub")).select(F.col("hub").alias("a"), F.col("class").alias("b"))
    tested = stored(_promising(stars.distinct(), marks))
    ends = tested.select(F.col("a").alias("class")).union(tested.select(F.col("b").alias("class"))).distinct()
    sets = stored(_sets_of(docs, ends))
    links = stored(_confirmed(tested, sets))
    found = components(links)
    more = stored(_residual(docs, buckets, classes, sets, found))
    if more.isEmpty():
        return found
    return components(links.unionByName(more))


def _promising(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the similarity."""
    left = marks.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("marks").alias("marks_a"))
    right = marks.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("marks").alias("marks_b"))
    near = pairs.join(left, "a").join(right, "b").filter(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    least = F.least("n_a", "n_b").alias("n")
    return map_batches(near.select("a", "b", least, "marks_a", "marks_b"), _agreement, "a binary, b binary")


def _residual(docs: DataFrame, buckets: DataFrame, classes: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """Links (a, b) that the stars could not show, between members of one bucket in several components.

    Such buckets are compared inside tasks, in pairs of blocks of bounded size: first signatures,
    then the full sets of the members whose signatures allow a link. Only links leave a task, and
    of those a spanning forest, so rows stay in proportion to the members, not to their pairs.
    """
    member = buckets.select("band", "class", "n").join(found, "class", "left")
    member = member.withColumn("component", F.coalesce("component", "class"))
    member = stored(_of_mixed(member))
    signed = member.join(classes.select("class", "bands", "marks"), "class")
    columns = ["class", "component", "n", "bands", "marks"]
    flagged = _by_blocks(signed, F.count(F.lit(1)), BLOCK_MEMBERS, columns, _allowed_members, "band long, class binary")
    flagged = stored(member.join(flagged.distinct(), ["band", "class"], "left_semi"))
    lacking = flagged.select("class").distinct().join(sets.select("class"), "class", "left_anti")
    extra = _sets_of(docs, stored(lacking))
    with_sets = flagged.join(stored(sets.unionByName(extra)), "class")
    columns = ["class", "component", "n", "shingles"]
    # small sets weigh as many shingles as keep a block's members, and so its table of intersections, bounded
    weight = F.greatest(F.sum("n"), F.count(F.lit(1)) * (BLOCK_SHINGLES // BLOCK_SETS))
    return _by_blocks(with_sets, weight, BLOCK_SHINGLES, columns, _spanning_links, "a binary, b binary").distinct()


def _of_mixed(member: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    mixed = member.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return member.join(mixed.select("band"), "band", "left_semi")


def _by_blocks(member: DataFrame, weight, limit: int, columns: list[str], compare, schema: str) -> DataFrame:
    """``compare`` on every pair of blocks of every bucket; a block weighs about ``limit``."""
    spread = member.groupBy("band").agg(F.ceil(weight / limit).cast("int").alias("blocks"))
    dealt = member.join(spread, "band").withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select(group.alias("group"), "band", *columns).repartition("group").sortWithinPartitions("group", "class")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = batch.column("group").to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                if held and held[-1].column("group")[0] != part.column("group")[0]:
                    yield compare(pa.Table.from_batches(held))
                    held = []
                held.append(part)
        if held:
            yield compare(pa.Table.from_batches(held))

    return map_batches(dealt, step, schema)


def _outside_first(components_of: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers, and the members outside the largest one: one of each unequal pair is there."""
    _, number, size = np.unique(np.array(components_of, object), return_inverse=True, return_counts=True)
    return number, np.flatnonzero(number != size.argmax())


def _allowed_members(rows: pa.Table) -> pa.RecordBatch:
    """Members with a partner in another component whose signature allows a link.

    A pair that shares several bands is looked at in the bucket of the first of them, and in those of least shingles.
    """
    keys = rows.column("class").to_pylist()
    number, outside = _outside_first(rows.column("component").to_pylist())
    sizes = rows.column("n").to_numpy()
    marks = np.frombuffer(b"".join(rows.column("marks").to_pylist()), np.uint8).reshape(-1, BINS)
    bands = np.array(rows.column("bands").to_pylist(), np.int64)
    band = rows.column("band")[0].as_py()
    place = int(np.argmax(bands[0] == band))
    hit = np.zeros(len(keys), bool)
    for at in range(0, len(outside), 32):
        these = outside[at : at + 32]
        fits = (number[these, None] != number) & (100 * np.minimum(sizes[these, None], sizes) >= PERCENT * np.maximum(sizes[these, None], sizes))
        i, j = np.nonzero(fits)
        near = (marks[these[i]] == marks[j]).sum(axis=1) >= AGREE
        near |= np.minimum(sizes[these[i]], sizes[j]) < SURE
        i, j = i[near], j[near]
        if place and len(i):
            new = ~(bands[these[i], :place] == bands[j, :place]).any(axis=1)
            i, j = i[new], j[new]
        hit[these[i]] = hit[j] = True
    kept = [k for k, h in zip(keys, hit.tolist(), strict=True) if h]
    return pa.RecordBatch.from_arrays([pa.array([band] * len(kept), pa.int64()), pa.array(kept, pa.binary())], ["band", "class"])


def _spanning_links(rows: pa.Table) -> pa.RecordBatch:
    """Links between components by the exact sizes of all intersections, as few as span them."""
    keys = rows.column("class").to_pylist()
    number, outside = _outside_first(rows.column("component").to_pylist())
    sets = [np.asarray(x.values) for x in rows.column("shingles")]
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    # a shingle of one member only is in no intersection
    useful = count > 1
    column_of = np.cumsum(useful) - 1
    keep = useful[column]
    owner, column = owner[keep], column_of[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    inter = np.zeros((len(outside), len(keys)), np.float32)
    width = 2_048
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, [first, first + width]))
        dense = np.zeros((len(keys), width), np.float32)
        dense[owner[part], column[part] - first] = 1
        inter += dense[outside] @ dense.T
    root = list(range(int(number.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    left, right = [], []
    for first in range(0, len(outside), 256):
        some = outside[first : first + 256]
        # 100 * shared >= PERCENT * union, with the union as the sum of the sizes less the shared ones
        least = -(-PERCENT * (sizes[some][:, None] + sizes) // (100 + PERCENT))
        linked = (inter[first : first + 256] >= least) & (number[some][:, None] != number)
        for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
            a, b = find(int(number[some[i]])), find(int(number[j]))
            if a != b:
                root[a] = b
                left.append(keys[some[i]]), right.append(keys[j])
    return pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])
