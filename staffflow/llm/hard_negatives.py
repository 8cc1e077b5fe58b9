"""Hard negatives of anchors, found through bounds along a spanning tree of the anchors.

The score of a row is its integer inner product with the anchor. Anchors of one group are joined
by a minimum spanning tree. A row's score at an anchor lies within the score at the anchor's
parent in the tree plus or minus the length of the edge times the row's norm (Cauchy-Schwarz on
the difference of the two anchors). Only rows whose bounds overlap one of the anchor's score
windows are scored again; the others pass their bounds on to the anchor's children. A window is
what a positive allows, and it narrows to the best rows found so far.

Anchors are a stated query set against all rows: groups of bounded size go to the tasks one after
another, rows are never shuffled, and a task gives a few rows for each anchor whatever it reads.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffflow.llm.common import sent, stored

#: Anchors that go to the tasks at once; their vectors and windows are all that is broadcast.
GROUP = 2_048
#: Rows scored at a time in a task.
BLOCK = 4_096
POSITIVES, NEGATIVES = 5, 3
LEAST_PERCENT, MOST_PERCENT = 50, 95
SCALE = 256

_NONE = np.iinfo(np.int64).min


@dataclass
class Anchors:
    """A group of anchors in the order of their ids, and their spanning tree as steps from the root.

    A step is (anchor, parent, length of the edge, whether the parent is needed no more).
    """

    row_id: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    steps: list[tuple[int, int, float, bool]]


@dataclass
class Windows:
    """Positives of each anchor of a group: ids, scores, and the scores their negatives may have."""

    ids: list[list[int]]
    scores: list[list[int]]
    low: list[list[int]]
    high: list[list[int]]


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float, bool]]:
    """Minimum spanning tree by distance as steps, parents first, the largest branch of an anchor last."""
    n = len(vectors)
    if n == 0:
        return []
    vectors = vectors.astype(np.float64)
    parent, gap = np.zeros(n, np.int64), np.full(n, np.inf)
    inside = np.zeros(n, bool)
    order, length = [], np.zeros(n)
    at = 0
    for _ in range(n):
        inside[at] = True
        order.append(at)
        length[at] = gap[at]
        step = vectors - vectors[at]
        new = np.sqrt(np.einsum("ij,ij->i", step, step))
        closer = ~inside & (new < gap)
        gap[closer], parent[closer] = new[closer], at
        open_gap = np.where(inside, np.inf, gap)
        at = int(open_gap.argmin())
        if inside[at]:  # the others are infinitely far: hang them on the root
            left = np.flatnonzero(~inside)
            if len(left) == 0:
                break
            at = int(left[0])
            parent[at] = order[0]
    size = np.ones(n, np.int64)
    for a in reversed(order[1:]):
        size[parent[a]] += size[a]
    children: list[list[int]] = [[] for _ in range(n)]
    for a in order[1:]:
        children[parent[a]].append(a)
    steps, stack = [], [(order[0], -1, 0.0, False)]
    while stack:
        step = stack.pop()
        steps.append(step)
        below = sorted(children[step[0]], key=lambda a: (-size[a], a))
        # the largest branch is pushed first and so walked last: few bounds are held at a time
        stack += [(a, step[0], float(length[a]), k == 0) for k, a in enumerate(below)]
    return steps


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as one matrix; shorter vectors end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) == 0:
        return np.empty((0, 0))
    width = int(sizes.max())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), place] = flat
    return out


def _padded(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def norms(x: np.ndarray) -> np.ndarray:
    most = float(np.abs(x).max(initial=0)) or 1.0
    return most * np.sqrt(((x / most) ** 2).sum(axis=1))


class Products:
    """Exact inner products of integer vectors, in the narrowest floats that hold every partial sum."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        width = max(rows.shape[1], anchors.shape[1])
        rows, anchors = _padded(rows, width), _padded(anchors, width)
        self.norms = norms(rows)
        bound = float(self.norms.max(initial=0)) * float(norms(anchors).max(initial=0))
        self.wide = not bound < 2.0**52
        if self.wide:  # beyond doubles: whole numbers of any size, cut to 64 bits at the end
            self.rows, self.anchors = (np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape) for x in (rows, anchors))
        else:
            kind = np.float32 if bound < 2.0**23 else np.float64
            self.rows, self.anchors = rows.astype(kind), anchors.astype(kind)
        self.slack = 1e-9 * bound + 1e-3

    def _whole(self, x: np.ndarray) -> np.ndarray:
        if not self.wide:
            return x.astype(np.int64)
        cut = [max(_NONE + 1, min(-_NONE - 1, int(v))) for v in x.ravel()]
        return np.array(cut, np.int64).reshape(x.shape)

    def one(self, anchor: int, at: np.ndarray | None = None) -> np.ndarray:
        rows = self.rows if at is None or 2 * len(at) > len(self.rows) else self.rows[at]
        out = self._whole(rows @ self.anchors[anchor])
        return out if at is None or rows is not self.rows else out[at]

    def many(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self._whole(self.anchors[anchors] @ self.rows[rows].T)


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(row_id, vec_id, label, matrix) in blocks of at most BLOCK rows, in the order of the ids."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = pa.Table.from_batches([batch.slice(at, BLOCK)]).sort_by([("vec_id", "ascending"), ("row_id", "ascending")])
            columns = [part.column(c).to_numpy() for c in ("row_id", "vec_id", "label")]
            yield *columns, matrix(part.column("vector").combine_chunks())


def _best(scores: np.ndarray, vec: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Places of the n best of each line: higher scores first, ties by id."""
    return np.lexsort((row, vec, ~scores), axis=-1)[..., :n]


class TopPositives:
    """The best rows of the own label of every anchor, over the blocks of a task."""

    def __init__(self, anchors: Anchors, n: int):
        self.anchors, self.n = anchors, n
        shape = (len(anchors.row_id), n)
        self.score, self.vec, self.row = np.full(shape, _NONE), np.zeros(shape, np.int64), np.full(shape, -1)

    def add(self, row_id: np.ndarray, vec_id: np.ndarray, label: np.ndarray, vectors: np.ndarray) -> None:
        products = Products(vectors, self.anchors.vectors)
        for value in np.intersect1d(label, self.anchors.label):
            mine, theirs = np.flatnonzero(self.anchors.label == value), np.flatnonzero(label == value)
            scores = products.many(mine, theirs)
            scores[self.anchors.row_id[mine][:, None] == row_id[theirs]] = _NONE
            first = np.argsort(~scores, axis=1, kind="stable")[:, : self.n]  # a block is in the order of ids
            found = theirs[first]
            row = row_id[found]
            scores = np.take_along_axis(scores, first, 1)
            row[scores == _NONE] = -1
            both = [np.concatenate(x, axis=1) for x in ((self.score[mine], scores), (self.vec[mine], vec_id[found]), (self.row[mine], row))]
            keep = _best(*both, self.n)
            self.score[mine], self.vec[mine], self.row[mine] = (np.take_along_axis(x, keep, 1) for x in both)

    def rows(self) -> pa.RecordBatch:
        anchor, place = np.nonzero(self.row >= 0)
        arrays = [pa.array(x) for x in (anchor, self.score[anchor, place], self.vec[anchor, place], self.row[anchor, place])]
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "score", "vec_id", "row_id"])


class TopNegatives:
    """The best rows of another label in every window of every anchor, over the blocks of a task."""

    def __init__(self, anchors: Anchors, windows: Windows, n: int):
        self.anchors, self.windows, self.n = anchors, windows, n
        self.found: list[list[list[tuple[int, int, int]]]] = [[[] for _ in x] for x in windows.scores]
        #: rows looked at and rows scored again, to tell what the bounds save
        self.seen = self.scored = 0

    def add(self, row_id: np.ndarray, vec_id: np.ndarray, label: np.ndarray, vectors: np.ndarray) -> None:
        products = Products(vectors, self.anchors.vectors)
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        every = np.arange(len(row_id))
        for anchor, parent, length, last in self.anchors.steps:
            spans = self._spans(anchor)
            if parent < 0 or products.wide:
                at, scores = every, products.one(anchor)
                low = high = scores.astype(np.float64)
            else:
                low, high = held.pop(parent) if last else held[parent]
                reach = length * products.norms * (1 + 1e-9) + products.slack
                low, high = low - reach, high + reach
                near = np.zeros(len(every), bool)
                for _, least, most in spans:
                    near |= (high >= least) & (low <= most)
                at = np.flatnonzero(near)
                scores = products.one(anchor, at)
                low[at] = high[at] = scores
            held[anchor] = (low, high)
            self.seen += len(every)
            self.scored += len(at)
            if spans:
                self._take(anchor, spans, scores, at, row_id, vec_id, label)

    def _spans(self, anchor: int) -> list[tuple[int, int, int]]:
        """(positive, least, most score) of the windows that are not empty, narrowed to what may still win."""
        out = []
        for k, (least, most) in enumerate(zip(self.windows.low[anchor], self.windows.high[anchor], strict=True)):
            found = self.found[anchor][k]
            if len(found) == self.n:
                least = max(least, -found[-1][0])
            if least <= most:
                out.append((k, least, most))
        return out

    def _take(self, anchor, spans, scores, at, row_id, vec_id, label) -> None:
        least, most = min(s[1] for s in spans), max(s[2] for s in spans)
        fits = (scores >= least) & (scores <= most) & (label[at] != self.anchors.label[anchor])
        scores, at = scores[fits], at[fits]
        if len(at) == 0:
            return
        order = np.argsort(~scores, kind="stable")  # the block is in the order of ids
        scores, at = scores[order], at[order]
        falling = -scores
        for k, least, most in spans:
            first, end = np.searchsorted(falling, -most, "left"), np.searchsorted(falling, -least, "right")
            new = slice(first, min(end, first + self.n))
            rows = zip(falling[new].tolist(), vec_id[at[new]].tolist(), row_id[at[new]].tolist(), strict=True)
            self.found[anchor][k] = sorted([*self.found[anchor][k], *rows])[: self.n]

    def rows(self) -> pa.RecordBatch:
        out = [
            (int(self.anchors.row_id[a]), int(self.anchors.vec_id[a]), k, self.windows.ids[a][k], self.windows.scores[a][k], -s, vec, row)
            for a, lists in enumerate(self.found) for k, found in enumerate(lists) for s, vec, row in found
        ]
        columns = zip(*out, strict=True) if out else [[]] * len(_NEGATIVE_COLUMNS)
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], _NEGATIVE_COLUMNS)


_NEGATIVE_COLUMNS = [
    "anchor_row", "anchor_id", "place", "positive_id", "positive_score", "negative_score", "negative_id", "negative_row",
]


def _gathered(rows: DataFrame, held, make, schema: str) -> DataFrame:
    """One small table a task: ``make(held value)`` takes all blocks of the partition."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = make(held())
        for block in _blocks(batches):
            top.add(*block)
        yield top.rows()

    return rows.select("row_id", "vec_id", "label", "vector").mapInArrow(step, schema)


def _top(found: DataFrame, by: list[str], score: str, ids: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), *ids)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT, group: int = GROUP,
) -> DataFrame:
    """Hard negatives of every anchor and positive.

    ``rows``: ``vec_id``, ``label`` and ``vector``, an array of whole numbers as doubles; further
    columns are ignored. Rows with a null in any of the three take no part, nor do vectors with a
    null or non-finite component. Shorter vectors count as padded with zeros. A row that repeats
    another one is a row of its own: only the anchor's own row is left out of its positives.
    Scores beyond 64 bits are cut to their range.

    An anchor's positives are its first ``positives`` other rows of the same label, higher scores
    first, ties by smaller vec_id. Per anchor and positive the result has the first ``negatives``
    rows of another label with least_percent * positive_score <= 100 * negative_score <=
    most_percent * positive_score: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score. No row without a positive or without a negative; none for an empty table.
    """
    spark = rows.sparkSession
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = rows.select("vec_id", "label", "vector", F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    whole = whole.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    whole = whole.withColumns({"vec_id": F.col("vec_id").cast("long"), "label": F.col("label").cast("long")})
    whole = stored(whole.withColumn("row_id", F.monotonically_increasing_id()))
    n_anchors = whole.filter("anchor").count()
    groups = -(-n_anchors // group)
    parts = []
    for number in range(groups):
        of_group = F.pmod(F.xxhash64("row_id"), F.lit(groups)) == number
        picked = whole.filter(F.col("anchor") & of_group).select("row_id", "vec_id", "label", "vector")
        anchors = _anchors(picked.toArrow())  # about ``group`` rows
        if len(anchors.row_id):
            parts.append(stored(_negatives_of(whole, anchors, positives, negatives, least_percent, most_percent)))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = spark.createDataFrame([], schema) if not parts else parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _anchors(table: pa.Table) -> Anchors:
    table = table.sort_by([("vec_id", "ascending"), ("row_id", "ascending")])
    columns = [table.column(c).to_numpy() for c in ("row_id", "vec_id", "label")]
    vectors = matrix(table.column("vector").combine_chunks())
    return Anchors(*columns, vectors, spanning_tree(vectors))


def _negatives_of(rows: DataFrame, anchors: Anchors, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    spark = rows.sparkSession
    found = _gathered(
        rows, sent(spark, anchors), lambda held: TopPositives(held, positives), "anchor long, score long, vec_id long, row_id long"
    )
    best = _top(found, ["anchor"], "score", ["vec_id", "row_id"], positives)
    known: list[list[tuple[int, int]]] = [[] for _ in anchors.row_id]
    # ``positives`` rows an anchor of this group
    for anchor, vec, score in zip(*best.orderBy("anchor", "rank").select("anchor", "vec_id", "score").toArrow().to_pydict().values(), strict=True):
        known[anchor].append((vec, score))
    windows = Windows(
        [[v for v, _ in x] for x in known], [[s for _, s in x] for x in known],
        [[-(-least * s // 100) for _, s in x] for x in known], [[most * s // 100 for _, s in x] for x in known],
    )
    schema = ", ".join(f"{c} long" for c in _NEGATIVE_COLUMNS)
    found = _gathered(rows, sent(spark, (anchors, windows)), lambda held: TopNegatives(*held, negatives), schema)
    ranked = _top(found, ["anchor_row", "place"], "negative_score", ["negative_id", "negative_row"], negatives)
    return ranked.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def mined(embeddings: DataFrame, every: int = 50) -> DataFrame:
    """``hard_negatives`` of a table (vec_id, embedding, label): components become floor(256 * x).

    Labels of ids divisible by 7 move on by one modulo 10; ids divisible by ``every`` are anchors.
    """
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # a component beyond doubles after scaling stays the largest double of its sign
    most = 1.7976931348623157e308
    scaled = F.transform("embedding", lambda x: _floored(x.cast("double"), most))
    rows = embeddings.select("vec_id", moved.alias("label"), scaled.alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % every == 0)


def _floored(x: Column, most: float) -> Column:
    """floor(SCALE * x) as double. Doubles of 2^52 and more are whole already, and floor() would cut them to 64 bits."""
    y = x * SCALE
    kept = F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(F.greatest(F.least(y, F.lit(most)), F.lit(-most)))
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(kept)


_SCORED = """
WITH moved AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM moved a JOIN moved b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
"""

HARD_SQL = _SCORED + """
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
