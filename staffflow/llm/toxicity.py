"""Toxicity of texts: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the character n-grams of lower-case words with their edges marked, as presence per
document. Document counts of every n-gram per class give the log-count ratio r; n-grams whose
ratio stands out of its own sampling error are kept. A logistic regression is fitted on presence
times r. Scoring looks up distinct words, so the cost follows the text, not the n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffflow.llm.common import LOWER, UPPER, id_remainder, map_batches, sent, stored, texts_of

SHORTEST, LONGEST = 3, 5
#: Labelled rows at most that the classifier is fitted on; which ones, a hash of the id decides.
SAMPLE = 8_000
#: Features at most, the ones whose ratio stands out most.
FEATURES = 20_000
#: Document counts added to each class, and how many standard errors a ratio must be off zero.
SMOOTHING, ERRORS = 0.5, 2.5
LEAST_DOCUMENTS = 4
RIDGE = 1e-3
CUT = 0.7
#: Words a task keeps the n-grams of: about 30 MB.
KNOWN = 100_000

_FOLD = str.maketrans(UPPER, LOWER)


def ngrams(word: str) -> list[str]:
    """Character n-grams of a word between edge marks, each once."""
    marked = f"\x02{word}\x03"
    n = len(marked)
    return list({marked[i : i + k] for k in range(SHORTEST, LONGEST + 1) for i in range(n - k + 1)}) or [marked]


def words_of(text: str) -> set[str]:
    return set(text.translate(_FOLD).split())


@dataclass
class Model:
    """n-gram to weight (the classifier's weight times the ratio), and the intercept."""

    weights: dict[str, float]
    intercept: float

    def __post_init__(self) -> None:
        self.names = {g: g for g in self.weights}

    def score(self, texts: list[str], known: dict[str, tuple[str, ...]]) -> list[float]:
        """Probability of label 1; ``known`` keeps the n-grams with a weight of words seen so far."""
        weights, names, out = self.weights, self.names, []
        for text in texts:
            words = words_of(text)
            for word in words.difference(known):
                # the model's own strings: words that are kept do not hold a copy each
                known[word] = tuple(names[g] for g in ngrams(word) if g in names)
            present = {g for word in words for g in known[word]}
            # sorted, so that the sum does not depend on the order of a set
            margin = self.intercept + sum(sorted(weights[g] for g in present))
            out.append(float(1 / (1 + np.exp(-np.clip(margin, -500, 500)))))
        return out


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how many documents of each label hold an n-gram."""
    from collections import Counter

    counts = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(texts_of(batch), batch.column("label").to_pylist(), strict=True):
            grams: set[str] = set()
            for word in words_of(text):
                grams.update(ngrams(word))
            counts[label].update(grams)
    for label in (0, 1):
        # an n-gram seen once in a task is still needed: other tasks may have seen it
        grams = list(counts[label])
        for start in range(0, len(grams), 200_000):
            part = grams[start : start + 200_000]
            number = pa.array([counts[label][g] for g in part], pa.int64())
            zero = pa.array([0] * len(part), pa.int64())
            pair = [zero, number] if label else [number, zero]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *pair], ["gram", "clean", "toxic"])


def _fit_logistic(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights on presence times ratio by ridge logistic regression, full-batch accelerated gradient steps."""
    n, d = len(rows), len(ratio)
    sizes = np.array([len(r) for r in rows])
    at = np.concatenate(rows) if n else np.empty(0, np.int64)
    doc = np.repeat(np.arange(n), sizes)
    value = ratio[at] / max(1.0, float(np.abs(ratio).max(initial=0)))
    positive = max(1, int(labels.sum()))
    # both classes weigh the same
    weight = np.where(labels == 1, n / (2 * positive), n / (2 * max(1, n - positive))) / max(1, n)
    w, b = np.zeros(d), 0.0
    moved_w, moved_b, momentum = w.copy(), b, 1.0
    norms = np.bincount(doc, value**2, minlength=n) + 1
    rate = 4.0 / float(max((weight * norms).sum(), 1e-12))
    for _ in range(400):
        margin = np.bincount(doc, value * moved_w[at], minlength=n) + moved_b
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels)
        grad = np.bincount(at, value * error[doc], minlength=d) + RIDGE * moved_w
        new_w, new_b = moved_w - rate * grad, moved_b - rate * float(error.sum())
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        moved_w, moved_b = (new_w + (momentum - 1) / following * (new_w - w), new_b + (momentum - 1) / following * (new_b - b))
        w, b, momentum = new_w, new_b, following
    return w * ratio / max(1.0, float(np.abs(ratio).max(initial=0))), b


def fit(labelled: DataFrame) -> Model:
    """Model from ``labelled`` (doc_id, text, label 0 or 1), at most SAMPLE rows of it.

    Without rows of both labels the score is the share of label 1, 0.5 without any row.
    """
    spark = labelled.sparkSession
    sample = stored(labelled.select("doc_id", "text", F.col("label").cast("int").alias("label")))
    share = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    if share.toxic in (0, share.n):
        p = (share.toxic + 0.5) / (share.n + 1)
        return Model({}, float(np.log(p / (1 - p))))
    clean, toxic = share.n - share.toxic, share.toxic
    counted = map_batches(sample.select("text", "label"), _gram_counts, "gram string, clean long, toxic long")
    sums = counted.groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    up, down = F.col("toxic") + SMOOTHING, F.col("clean") + SMOOTHING
    ratio = F.log(up / (toxic + 2 * SMOOTHING)) - F.log(down / (clean + 2 * SMOOTHING))
    off = F.abs(ratio) / F.sqrt(1 / up + 1 / down)
    kept = sums.filter(F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS).select("gram", ratio.alias("ratio"), off.alias("off"))
    features = kept.filter(F.col("off") >= ERRORS).orderBy(F.desc("off"), "gram").limit(FEATURES).toArrow()
    grams, ratios = features.column("gram").to_pylist(), features.column("ratio").to_numpy()
    place = spark.sparkContext.broadcast({g: k for k, g in enumerate(grams)})

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in texts_of(batch):
                grams_here: set[str] = set()
                for word in words_of(text):
                    grams_here.update(ngrams(word))
                found.append(sorted(place.value[g] for g in grams_here.intersection(place.value)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.string()), batch.column("label"), pa.array(found, pa.list_(pa.int32()))],
                ["doc_id", "label", "at"],
            )

    rows = map_batches(sample, present, "doc_id string, label int, at array<int>").toArrow().sort_by("doc_id")
    at = [np.array(x, np.int64) for x in rows.column("at").to_pylist()]
    weights, intercept = _fit_logistic(at, rows.column("label").to_numpy().astype(float), ratios)
    return Model(dict(zip(grams, weights.tolist(), strict=True)), float(intercept))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label) of at most SAMPLE labelled documents; folds are the caller's.

    Labels without an id or a value are left out, of several labels of one id the largest counts.
    The few labels wanted are picked first, so that texts are only filtered, not shuffled, while
    the picked ids fit Spark's own limit for broadcasting.
    """
    given = labels.filter("doc_id is not null and toxic is not null")
    one = given.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    picked = one.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(SAMPLE)
    return docs.select("doc_id", "text").join(stored(picked), "doc_id")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from CUT on) of every row; a null text is empty."""
    held = sent(docs.sparkSession, model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, known = held(), {}
        for batch in batches:
            found = judge.score(texts_of(batch), known)
            if len(known) > KNOWN:
                known.clear()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = map_batches(docs.select("doc_id", "text"), step, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of every document by a model of the labelled ones whose remainder modulo 3 is not 1.

    Output, one row per input row: doc_id, held_out, score, predicted. Only the text makes the
    score; empty and null texts score the intercept.
    """
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = fit(training_rows(docs.select("doc_id", "text"), labels.filter(~held_out)))
    return score(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all of their columns.

    Null and empty texts score the intercept, a text of any length is scored whole, a score of CUT
    is toxic. Rows that repeat go or stay together, an empty table gives no rows. Without labels of
    both kinds the score is their share, 0.5 without any.
    """
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = fit(training_rows(docs.select("doc_id", "text"), labels.filter(~held_out)))
    held = sent(docs.sparkSession, model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, known = held(), {}
        for batch in batches:
            found = np.array(judge.score(texts_of(batch), known))
            if len(known) > KNOWN:
                known.clear()
            yield batch.filter(pa.array(found < CUT))

    return map_batches(docs, step, docs.schema)
