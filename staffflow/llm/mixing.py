"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share a budget of words by weight; no source is asked for more than ``LIMIT`` times its
own words, the excess goes to the others by weight. A source first gives whole epochs; what is
left of its target is filled with documents in the order of u^(1/w), the largest first, u
uniform from the document's id and w its quality weight. Their sizes are summed in that order
until the target; the last document is cut there.

The order is never sorted as a whole: keys fall into even buckets, bucket sums find the bucket in
which a source's target lies, and only that bucket's documents are sorted. What comes out is one
row per source, so documents are decided where they are, without moving a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffflow.llm.common import BLANK, count_words, stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
LIMIT = 2.0
#: Documents a bucket of sampling keys holds on average, in the largest source.
BUCKET_ROWS = 10_000
#: Quality weight of documents labelled good, labelled poor, and without a label.
GOOD, POOR, UNKNOWN = 2.0, 0.5, 1.0


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from the md5 of the id's text; the same on every run."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def with_weight(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the column ``weight`` from the labels; of several labels the best counts."""
    best = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("best"))
    weight = F.when(F.col("best") > 0, GOOD).when(F.col("best") <= 0, POOR).otherwise(UNKNOWN)
    joined = docs.join(best, F.col("doc_id") == F.col("label_id"), "left")
    return joined.withColumn("weight", weight).drop("label_id", "best")


def targets(
    totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """``totals`` (source, source_size: one row per source) with ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn. The targets are the fixed
    point of capping and resharing: sorted by cap over weight, a source is capped if its cap is
    within the share that all before it, capped, leave per weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    named = totals.withColumn("share_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    named = named.withColumn("cap", F.col("source_size") * float(limit))
    by_ratio = Window.orderBy(F.col("cap") / F.col("share_weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = named.withColumn("left", left).withColumn("open", F.sum("share_weight").over(after))
    level = level.withColumn("capped", F.col("cap") * F.col("open") <= F.col("share_weight") * F.col("left"))
    # the first source that is not capped fixes the level for itself and all behind it
    first = F.first(F.when(~F.col("capped"), F.struct("left", "open")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, 0)
    )
    level = level.withColumn("level", first)
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(
        F.col("share_weight") * F.col("level.left") / F.col("level.open")
    )
    return level.select("source", "source_size", target.alias("target"))


def _plan(sized: DataFrame, **rules) -> DataFrame:
    """One row per source: its target, whole epochs, and where in the sampling order it ends.

    ``sized``: source, doc_id, size, key. Documents with a larger key than ``end_key`` (or the
    same and a smaller ``end_id``) are taken once more; the one at the end gives ``cut`` of its
    ``unit`` words.
    """
    groups = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups)
    most = groups.agg(F.max("n")).first()[0] or 0
    buckets = max(16, -(-most // BUCKET_ROWS))
    goal = targets(groups.select("source", "source_size"), **rules)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("epochs", epochs.cast("long"))
    goal = stored(goal.withColumn("rest", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size")))
    bucket = F.least(F.floor((1 - F.col("key")) * buckets), F.lit(buckets - 1)).cast("int")
    dealt = sized.withColumn("bucket", bucket)
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("words").over(running))
    ends = goal.alias("g").join(sums.alias("s"), F.col("g.source").eqNullSafe(F.col("s.source")))
    ends = ends.filter("upto > rest").groupBy("g.source").agg(
        F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "rest")).alias("end")
    )
    ends = ends.select(F.col("source").alias("end_source"), "end.*")
    inside = dealt.withColumnRenamed("bucket", "doc_bucket").join(
        ends, F.col("source").eqNullSafe(F.col("end_source")) & (F.col("doc_bucket") == F.col("bucket"))
    )
    units = inside.groupBy("end_source", "before", "rest", "key", "doc_id").agg(F.sum("size").alias("unit"))
    order = Window.partitionBy("end_source").orderBy(F.col("key").desc(), F.col("doc_id").asc_nulls_last())
    units = units.withColumn("upto", F.col("before") + F.sum("unit").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct((-F.col("key")).alias("minus"), F.col("doc_id").isNull().alias("no_id"), "doc_id")
    last = units.filter("upto > rest").groupBy("end_source").agg(
        F.min_by(F.struct("key", "doc_id", "unit", (F.col("rest") - F.col("upto") + F.col("unit")).alias("cut")), place).alias("e")
    )
    last = last.select(
        "end_source", F.col("e.key").alias("end_key"), F.col("e.doc_id").alias("end_id"),
        F.col("e.unit").alias("unit"), F.col("e.cut").alias("cut"),
    )
    plan = goal.join(last, F.col("source").eqNullSafe(F.col("end_source")), "left").drop("end_source", "rest")
    return stored(plan.withColumnRenamed("source", "plan_source"))


def _keyed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with weight and key beside their own columns."""
    return with_weight(docs, labels).withColumn("key", F.pow(uniform(F.col("doc_id")), 1 / F.col("weight")))


def _sized(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, source, size, key; labels are joined when the texts are gone."""
    sizes = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"))
    return stored(_keyed(sizes, labels).select("doc_id", "source", "size", "key"))


def _decided(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with source_size, target, epochs and ``extra``, the words taken beyond whole epochs."""
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source")), "left").drop("plan_source")
    key, end, doc, end_id = F.col("key"), F.col("end_key"), F.col("doc_id"), F.col("end_id")
    same_id = doc.eqNullSafe(end_id)
    earlier_id = (doc.isNotNull() & end_id.isNull()) | F.coalesce(doc < end_id, F.lit(False))
    extra = (
        F.when(end.isNull(), F.col("size"))
        .when((key > end) | ((key == end) & earlier_id), F.col("size"))
        .when((key == end) & same_id, F.floor(F.try_divide(F.col("size") * F.col("cut"), F.col("unit"))))
        .otherwise(0)
    )
    return joined.withColumn("extra", F.coalesce(extra, F.lit(0)).cast("long"))


def mix(docs: DataFrame, labels: DataFrame, **rules) -> DataFrame:
    """How many words of each document the mix takes.

    ``docs``: doc_id, text, source; ``labels``: doc_id, quality. One output row per input row:
    doc_id, size, source_size, target, taken. A null source is a source, null and empty texts
    have size 0 and give nothing, a source without words has target 0. Rows that repeat a doc_id
    share one draw; where the target ends in them, each gives the same part, rounded down. Equal
    draws come in the order of the ids, a text of any length counts whole, an empty table gives no
    rows, further columns are ignored.
    """
    sized = _sized(docs, labels)
    done = _decided(sized, _plan(sized, **rules))
    taken = F.col("size") * F.col("epochs") + F.col("extra")
    return done.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_texts(docs: DataFrame, labels: DataFrame, **rules) -> DataFrame:
    """The mixed corpus: each document once per whole epoch and once more if sampled.

    Input as for ``mix``; the output has the columns of ``docs``. The document at the end of a
    source's sample keeps its first words, set apart by one blank.
    """
    columns = docs.columns
    plan = _plan(_sized(docs, labels), **rules)
    own = docs.select(*[F.col(f"`{c}`").alias(f"own_{c}") for c in columns], "doc_id", "text", "source")
    sized = own.withColumn("size", count_words(F.col("text")))
    done = _decided(_keyed(sized, labels), plan)
    # 0 marks the sampled copy, 1 and up are the epochs
    first = F.when(F.col("extra") > 0, 0).otherwise(1).cast("long")
    copies = done.filter((F.col("extra") > 0) | (F.col("epochs") > 0)).filter("size > 0")
    copies = copies.withColumn("copy", F.explode(F.sequence(first, F.col("epochs"))))
    words = F.filter(F.split("text", BLANK), lambda w: w != "")
    part = F.array_join(F.slice(words, 1, F.col("extra").cast("int")), " ")
    cut = (F.col("copy") == 0) & (F.col("extra") < F.col("size"))
    out = {"text": F.when(cut, part).otherwise(F.col("text"))}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(cut, F.length(part).cast(kind)).otherwise(F.col("own_n_chars"))
    return copies.select(*[out.get(c, F.col(f"`own_{c}`")).alias(c) for c in columns])


MIX_SQL = f"""
WITH best AS (SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, CAST(coalesce(len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    pow((CAST(CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS DOUBLE) + 0.5e0)
        / 281474976710656e0,
      1e0 / CASE WHEN q > 0 THEN {GOOD}e0 WHEN q <= 0 THEN {POOR}e0 ELSE {UNKNOWN}e0 END) AS key
  FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
named AS (
  SELECT *, [3e0, 1e0, 2e0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
    source_size * {LIMIT}e0 AS cap FROM totals),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE}e0 - coalesce(sum(cap) OVER (
      ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM named),
marked AS (SELECT *, cap * open <= w * rest AS capped FROM levels),
goal AS (
  SELECT source, source_size, CASE WHEN lvl IS NULL THEN cap ELSE w * lvl.rest / lvl.open END AS target
  FROM (SELECT *, first_value(CASE WHEN NOT capped THEN {{'rest': rest, 'open': open}} END IGNORE NULLS) OVER (
      ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lvl FROM marked)),
asked AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM goal),
placed AS (
  SELECT s.*, g.source_size, g.target, g.epochs, CAST(floor(g.target) AS BIGINT) - g.epochs * g.source_size AS rest,
    CAST(sum(size) OVER (PARTITION BY s.source ORDER BY key DESC, doc_id NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM sized s JOIN asked g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  CAST(size * epochs + greatest(0, least(size, rest - (upto - size))) AS BIGINT) AS taken
FROM placed
"""
