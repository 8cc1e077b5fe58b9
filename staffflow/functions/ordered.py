"""Order-dependent building blocks that never put one group into one task.

A running total or an exact percentile over a whole table is computed in two
levels: equal values collapse first (map-side), the distinct values are cut into
value buckets of bounded size, each bucket is summed on its own, and the bucket
totals give the offsets.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffflow.session import cut_lineage

#: Distinct values of a bucket, and buckets at most: beyond them buckets grow.
BUCKET_ROWS, BUCKETS = 100_000, 10_000


def bucket_edges(cells: DataFrame, value: str, rows: int = BUCKET_ROWS, most: int = BUCKETS) -> list[float]:
    """Ascending values that cut ``cells`` into pieces of about ``rows`` rows, or of one value.

    Refinement by place value: the range of a piece with too many rows is divided evenly, one
    aggregate counts the rows of all parts of all such pieces, and only parts that still have too
    many are divided again. A part's range shrinks to the values it holds, so any distribution is
    cut after a few rounds. Dividing keeps the order of doubles, so the cut is exact. What reaches
    the driver is a few numbers a piece, ``most`` pieces and their parts.
    """
    cells = cells.filter(F.abs(value) < float("inf"))  # infinite values go with the outermost pieces
    whole = cells.agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    bound = max(rows, -(-whole["n"] // most))
    edges: list[float] = []
    open_ = [tuple(whole)] if whole["n"] > bound and whole["lo"] < whole["hi"] else []
    while open_:
        open_.sort(key=lambda piece: piece[1])
        table = [
            F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(min(256, max(2, 2 * n // bound))).alias("parts"))
            for n, lo, hi in open_
        ]
        # pieces do not overlap: the last one that starts at or below a value is the only one that can hold it
        number = _bucket_of(cells, value, [lo for _, lo, _ in open_], "_piece")
        piece = F.get(F.array(*table), F.col("_piece") - 1)
        placed = number.filter(F.col("_piece") > 0).withColumn("_p", piece).filter(F.col(value) <= F.col("_p.hi"))
        part = F.floor((F.col(value) / 2 - F.col("_p.lo") / 2) / (F.col("_p.hi") / 2 - F.col("_p.lo") / 2) * F.col("_p.parts"))
        part = F.least(part, F.col("_p.parts") - 1)
        counted = placed.groupBy("_piece", part.alias("_part")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
        found = counted.select("n", "lo", "hi").collect()
        edges += [r["lo"] for r in found]
        before = set(open_)
        # a piece of neighbouring doubles that did not get smaller stays as it is
        open_ = [p for p in map(tuple, found) if p[0] > bound and p[1] < p[2] and p not in before]
    return sorted(set(edges) - {whole["lo"]})


def _bucket_of(df: DataFrame, value: str, edges: list[float], name: str) -> DataFrame:
    """Add the number of edges at or below the value."""
    if not edges:
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf"), *edges, float("inf")]
    marked = Bucketizer(splits=splits, inputCol=value, outputCol=name, handleInvalid="keep").transform(df)
    return marked.withColumn(name, F.col(name).cast("int"))


def value_buckets(cells: DataFrame, value: str, rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``_bucket``, ascending with the value, of about ``rows`` rows each."""
    return _bucket_of(cells, value, bucket_edges(cells, value, rows), "_bucket")


def join_groups(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Attach one row per group; rows without a group are left out, as grouping leaves them out."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # a single row of totals
    return left.join(right, keys)


def cumulative(df: DataFrame, by: list[str], value: str, sums: dict[str, Column], rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per (by, value): each sum, its inclusive running total ``cum_*`` in
    ascending value order and its group total ``all_*``.

    The offsets join on (by, bucket) and the window runs on the same partitioning.
    """
    clean = df.withColumn(value, F.col(value).cast("double")).filter(F.col(value).isNotNull())
    cells = clean.groupBy(*by, value).agg(*[expr.alias(name) for name, expr in sums.items()])
    # the distinct values are looked at several times
    cells = value_buckets(cut_lineage(cells), value, rows)
    # at most one row per bucket and group
    per_bucket = cells.groupBy(*by, "_bucket").agg(*[F.sum(n).alias(n) for n in sums])
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    offsets = per_bucket.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in sums],
        *[F.sum(n).over(group).alias(f"all_{n}") for n in sums],
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return cells.join(offsets, [*by, "_bucket"]).select(
        *by,
        value,
        *sums,
        *[(F.sum(n).over(inside) + F.col(f"_off_{n}")).alias(f"cum_{n}") for n in sums],
        *[f"all_{n}" for n in sums],
    )


def quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact percentiles per group with linear interpolation; nulls skipped."""
    ranked = cumulative(df, by, value, {"n": F.count(F.lit(1))})
    position = {name: F.lit(p) * (F.col("all_n") - 1) for name, p in probs.items()}

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("cum_n") > index) & (F.col("cum_n") - F.col("n") <= index), F.col(value)))

    parts = []
    for name, pos in position.items():
        parts += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}")]
    got = ranked.groupBy(*by).agg(F.max("all_n").alias("_n"), *parts)
    out = []
    for name, p in probs.items():
        pos = F.lit(p) * (F.col("_n") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return got.select(*by, *out)


def hash_rank(
    df: DataFrame, by: list[str], keys: list[str], name: str, size: str = "_size", digits: int = 4
) -> DataFrame:
    """Add the dense 1-based rank of each row within its group in md5 order of its keys, and the group's size.

    The first hex digits spread a group of any size evenly over 16**digits buckets.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    hashed = df.withColumn("_h", F.md5(text)).withColumn("_bucket", F.substring("_h", 1, digits))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(*by, "_bucket")
        .agg(F.count(F.lit(1)).alias("_c"))
        .select(
            *by,
            "_bucket",
            F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
            F.sum("_c").over(Window.partitionBy(*by)).alias(size),
        )
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy("_h", *keys)
    out = hashed.join(offsets, [*by, "_bucket"]).withColumn(name, F.row_number().over(inside) + F.col("_off"))
    return out.select(*df.columns, name, size)


def previous_row(df: DataFrame, key: str, chunk: str, order: list[str], columns: list[str]) -> DataFrame:
    """Add ``prev_*``: the columns of the preceding row of the same key.

    Rows are compared inside (key, chunk) first; the first row of a chunk takes
    the last row of the preceding non-empty chunk. With the year as chunk a key
    has at most one chunk row per year, so a hot key is still spread.
    """
    inside = Window.partitionBy(key, chunk).orderBy(*order)
    packed = F.struct(*columns)
    rows = df.withColumn("_rn", F.row_number().over(inside)).withColumn("_prev", F.lag(packed).over(inside))
    ends = df.groupBy(key, chunk).agg(F.max(F.struct(*order, *columns)).alias("_last"))
    along = Window.partitionBy(key).orderBy(chunk)
    carried = ends.select(
        F.col(key).alias("_k"),
        F.col(chunk).alias("_c"),
        F.lag("_last").over(along).alias("_carry"),
    )
    joined = rows.join(carried, (F.col(key) == F.col("_k")) & (F.col(chunk) == F.col("_c")), "left")
    first = F.col("_rn") == 1
    out = [
        F.when(first, F.col(f"_carry.{c}")).otherwise(F.col(f"_prev.{c}")).alias(f"prev_{c}") for c in columns
    ]
    return joined.select(*df.columns, *out)
