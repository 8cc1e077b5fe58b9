"""Log-bilinear language model trained by noise-contrastive estimation, and corpus scores.

Units of the model are the most frequent words, the end of a text, and classes of all other
words by their last two bytes; a word of a class has its add-one share of the class, so the
probabilities of all words sum to one. The context of two units gives a vector, the sum of their
vectors scaled by position; a unit scores its product with its own vector plus a bias.

Training starts from a fit on a bounded sample, then every partition of the corpus goes on from
there over all of its tokens, and the parameters are averaged by tokens (parameter mixing).
Noise comes from the unit frequencies and is shared by a batch, so scores are matrix products.
The exact normaliser of every context of two units is tabulated once, by matrix products in the
tasks; scoring a token is then four look-ups.

Counts of frequent words go to the tasks, at most ``HEAD`` words by construction; the rest of the
words meet their counts in a join in which no word has more than 1/HEAD of all tokens.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffflow.llm.common import bytes_of, id_remainder, map_batches, sent, stored

#: A word is frequent if it is more than 1/HEAD of the training tokens.
HEAD = 1 << 16
UNITS, CLASSES = 1024, 64
DIM = 32
NOISE, BATCH, RATE = 32, 4096, 0.15
#: Documents of the first fit, about, and its passes over them.
SAMPLE, PASSES = 1_000, 4
END = b""


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def tokens_of(text: bytes) -> list[bytes]:
    """Lower-case words, then the end."""
    words = text.lower().split()
    words.append(END)
    return words


@dataclass
class Vocabulary:
    """Frequent words with their counts, most frequent first; the model's words come first, END among them."""

    words: list[bytes]
    counts: np.ndarray
    n_units: int
    n_tokens: int
    n_words: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def n_model_words(self) -> int:
        return self.n_units - CLASSES

    def codes(self) -> _Codes:
        return _Codes(self.words)

    def unit_of_code(self) -> np.ndarray:
        """Model unit of a code: of frequent words, then of classes."""
        m = self.n_model_words
        rest = [m + class_of(w) for w in self.words[m:]]
        return np.array([*range(min(m, len(self.words))), *rest, *range(m, m + CLASSES)], np.int64)

    def unit_counts(self) -> np.ndarray:
        m = self.n_model_words
        return np.concatenate((self.counts[:m], self.class_tokens)).astype(np.float64)


class _Codes(dict):
    """Word to code: its place among the frequent words, else their number plus its class."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words)), strict=True))
        self.head = len(words)

    def __missing__(self, word: bytes) -> int:
        self[word] = code = self.head + class_of(word)
        return code

    def of(self, tokens: list[bytes]) -> np.ndarray:
        if len(self) > 300_000:
            for word in [w for w, code in self.items() if code >= self.head]:
                del self[word]
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


@dataclass
class Parameters:
    """Context vectors, unit vectors, biases, and the two position scales."""

    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    scale: np.ndarray

    @classmethod
    def start(cls, unit_counts: np.ndarray) -> Parameters:
        rng = np.random.default_rng(3)
        share = (unit_counts + 0.5) / (unit_counts + 0.5).sum()
        shape = (len(unit_counts), DIM)
        return cls(
            rng.normal(0, 0.1, shape).astype(np.float32), rng.normal(0, 0.1, shape).astype(np.float32),
            np.log(share).astype(np.float32), np.ones((2, DIM), np.float32),
        )

    def rows(self) -> np.ndarray:
        """All parameters as rows of DIM + 1 numbers."""
        zero = np.zeros((len(self.context), 1), np.float32)
        return np.vstack(
            [np.hstack([self.context, zero]), np.hstack([self.target, self.bias[:, None]]), np.hstack([self.scale, zero[:2]])]
        )

    @classmethod
    def of_rows(cls, rows: np.ndarray) -> Parameters:
        n = (len(rows) - 2) // 2
        rows = rows.astype(np.float32)
        return cls(rows[:n, :DIM].copy(), rows[n : 2 * n, :DIM].copy(), rows[n : 2 * n, DIM].copy(), rows[2 * n :, :DIM].copy())


def _scatter(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add rows to ``into`` at places that may repeat."""
    order = np.argsort(at, kind="stable")
    ordered = at[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    into[ordered[first]] += np.add.reduceat(rows[order], first, axis=0)


class Trainer:
    """Noise-contrastive steps with Adagrad on shared noise."""

    def __init__(self, start: Parameters, unit_counts: np.ndarray, seed: int, rate: float = RATE):
        self.p, self.rate, self.rng = start, rate, np.random.default_rng(seed)
        share = (unit_counts + 0.5) / (unit_counts + 0.5).sum()
        self.noise_sum = np.cumsum(share)
        # a unit's score less the log of its expected noise draws decides data or noise
        self.offset = np.log(share * NOISE).astype(np.float32)
        self.seen = [np.full(a.shape, 0.1, np.float32) for a in (start.context, start.target, start.bias, start.scale)]
        self.held: list[np.ndarray] = []
        self.n = 0

    def feed(self, units: np.ndarray) -> None:
        """The units of a text, its end included."""
        ahead = np.concatenate(([units[-1], units[-1]], units))  # the end also stands before a text
        self.held.append(np.stack([ahead[:-2], ahead[1:-1], units]))
        self.n += len(units)
        if sum(h.shape[1] for h in self.held) >= BATCH:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        both = np.concatenate(self.held, axis=1)
        self.held = []
        for at in range(0, both.shape[1], BATCH):
            self._step(*both[:, at : at + BATCH])

    def _step(self, far: np.ndarray, near: np.ndarray, unit: np.ndarray) -> None:
        p, n = self.p, len(unit)
        noise = np.searchsorted(self.noise_sum, self.rng.random(NOISE) * self.noise_sum[-1])
        noise = np.minimum(noise, len(self.offset) - 1)
        rows_far, rows_near = p.context[far], p.context[near]
        h = rows_far * p.scale[0] + rows_near * p.scale[1]
        target = p.target[unit]
        s_data = np.einsum("ij,ij->i", h, target) + p.bias[unit] - self.offset[unit]
        s_noise = h @ p.target[noise].T + (p.bias[noise] - self.offset[noise])
        g_data = 1 / (1 + np.exp(np.clip(s_data, -30, 30)))  # ascent: 1 - probability of data
        g_noise = -1 / (1 + np.exp(-np.clip(s_noise, -30, 30)))
        g_h = g_data[:, None] * target + g_noise @ p.target[noise]
        grads = [np.zeros_like(a) for a in (p.context, p.target, p.bias, p.scale)]
        _scatter(grads[1], unit, g_data[:, None] * h)
        np.add.at(grads[1], noise, g_noise.T @ h)
        grads[2] += np.bincount(unit, g_data, len(p.bias)).astype(np.float32)
        np.add.at(grads[2], noise, g_noise.sum(axis=0))
        _scatter(grads[0], np.concatenate((far, near)), np.concatenate((g_h * p.scale[0], g_h * p.scale[1])))
        grads[3][0], grads[3][1] = (g_h * rows_far).sum(axis=0), (g_h * rows_near).sum(axis=0)
        scale = np.float32(1 / np.sqrt(n))
        for value, grad, seen in zip((p.context, p.target, p.bias, p.scale), grads, self.seen, strict=True):
            grad *= scale
            seen += grad * grad
            value += np.float32(self.rate) * grad / np.sqrt(seen)


def log_normaliser(p: Parameters, far: int) -> np.ndarray:
    """ln of the normaliser for one far unit and every near unit."""
    h = p.context[far] * p.scale[0] + p.context * p.scale[1]
    s = h @ p.target.T + p.bias
    most = s.max(axis=1)
    return most + np.log(np.exp(s - most[:, None]).sum(axis=1))


class Scorer:
    """ln probability of units, from tables of all pairs of units."""

    def __init__(self, p: Parameters, normaliser: np.ndarray):
        self.far = (p.context * p.scale[0]) @ p.target.T
        self.near = (p.context * p.scale[1]) @ p.target.T + p.bias
        self.normaliser = normaliser

    def logs(self, units: np.ndarray) -> np.ndarray:
        ahead = np.concatenate(([units[-1], units[-1]], units))
        far, near = ahead[:-2], ahead[1:-1]
        return self.far[far, units] + self.near[near, units] - self.normaliser[far, near]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, the end of each as the empty word."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            words, n = list(counts), list(counts.values())
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], ["word", "n"])

        for batch in batches:
            for text in bytes_of(batch):
                counts.update(tokens_of(text))
                if len(counts) > 250_000:
                    yield flushed()
        yield flushed()

    return map_batches(docs.select("text"), step, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame) -> Vocabulary | None:
    """None without any token."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    if not total.n:
        return None
    # at most HEAD words can each be more than 1/HEAD of all
    head = counts.filter((F.col("n") * HEAD > total.n) | (F.col("word") == F.lit(END))).toArrow()
    pairs = sorted(zip(head.column("word").to_pylist(), head.column("n").to_pylist(), strict=True), key=lambda x: (x[0] != END, -x[1], x[0]))
    words, n = [w for w, _ in pairs], np.array([c for _, c in pairs], np.int64)
    units = min(UNITS, len(words) + CLASSES)
    model = counts.sparkSession.createDataFrame([(w,) for w in words[: units - CLASSES]], "word binary")
    rest = counts.join(F.broadcast(model), "word", "left_anti")
    kind = (F.crc32(F.substring("word", -2, 2)) % CLASSES).alias("class")
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in rest.groupBy(kind).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        tokens[row["class"]], kinds[row["class"]] = row.n, row.v
    return Vocabulary(words, n, units, total.n, total.v, tokens, kinds)


def train(docs: DataFrame, vocabulary: Vocabulary) -> Parameters:
    """Parameters after the first fit on a sample and one mixed pass over all of ``docs``."""
    spark = docs.sparkSession
    counts, unit_of = vocabulary.unit_counts(), vocabulary.unit_of_code()
    start = Parameters.start(counts)

    def passed(rows: DataFrame, held, passes: int, rate: float) -> Parameters:
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            given, words, places, unit_counts = held()
            codes = words.codes()
            p = Parameters(*(a.copy() for a in (given.context, given.target, given.bias, given.scale)))
            trainer = Trainer(p, unit_counts, 1, rate)
            kept: list[np.ndarray] = []
            for batch in batches:
                for text in bytes_of(batch):
                    units = places[codes.of(tokens_of(text))]
                    trainer.feed(units)
                    if passes > 1:
                        kept.append(units)
            for _ in range(passes - 1):
                for units in kept:
                    trainer.feed(units)
            trainer.flush()
            if not trainer.n:
                return
            out = p.rows().astype(np.float64) * trainer.n
            names, columns = ["row", "n", "v"], [pa.array(range(len(out)), pa.int32()), pa.array([trainer.n] * len(out), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(out), pa.list_(pa.float64()))], names)

        parts = map_batches(rows.select("text"), step, "row int, n long, v array<double>")
        sums = [(F.sum(F.col("v")[k]) / F.sum("n")).alias(f"s{k}") for k in range(DIM + 1)]
        found = parts.groupBy("row").agg(*sums).toArrow().sort_by("row")
        if not found.num_rows:
            return held()[0]
        return Parameters.of_rows(np.stack([found.column(f"s{k}").to_numpy() for k in range(DIM + 1)], axis=1))

    # about SAMPLE documents by hash; there is one end for each
    share = min(1.0, SAMPLE / max(1, int(vocabulary.counts[vocabulary.words.index(END)])))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    sample = docs.filter(draw < int(share * (1 << 30))).repartition(1)
    first = passed(sample, sent(spark, (start, vocabulary, unit_of, counts)), PASSES, RATE)
    return passed(docs, sent(spark, (first, vocabulary, unit_of, counts)), 1, RATE / 3)


def normaliser_of(spark, p: Parameters) -> np.ndarray:
    """ln normaliser of every (far, near) pair of units, one row of the table per input row."""
    held, n = sent(spark, p), len(p.bias)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = held()
        for batch in batches:
            far = batch.column("id").to_pylist()
            rows = [log_normaliser(given, k).astype(np.float32) for k in far]
            yield pa.RecordBatch.from_arrays([pa.array(far, pa.int64()), pa.array(rows, pa.list_(pa.float32()))], ["far", "z"])

    rows = map_batches(spark.range(0, n, 1, 16), step, "far long, z array<float>").toArrow().sort_by("far")
    return np.stack([z.values.to_numpy() for z in rows.column("z")])


def language_model_scores(docs: DataFrame) -> DataFrame:
    """log10 probability of every text under the model and under add-one unigrams.

    ``docs``: doc_id, text. Learns from rows whose crc32 of the id's text modulo 7 is not 2.
    One output row per input row: doc_id, held_out, n_tokens (words and the end), n_known (of
    them seen in training), train_tokens, base_score, score. A null text is empty, a null id
    counts as empty text. Without training rows both scores are those of one unseen word.
    """
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    learn = docs.filter(~held_out).select("doc_id", "text")
    counts = stored(word_counts(learn))
    words = vocabulary_of(counts)
    if words is None:
        size = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")) + 1
        zero, none = F.lit(0.0), F.lit(0).cast("long")
        return docs.select(
            "doc_id", held_out.alias("held_out"), size.cast("long").alias("n_tokens"), none.alias("n_known"),
            none.alias("train_tokens"), zero.alias("base_score"), zero.alias("score"),
        )
    p = train(learn, words)
    spark = docs.sparkSession
    model = sent(spark, (p, normaliser_of(spark, p), words))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, z, vocabulary = model()
        scorer, codes, places = Scorer(given, z), vocabulary.codes(), vocabulary.unit_of_code()
        head, m = codes.head, vocabulary.n_model_words
        count_log = np.concatenate((np.log10(vocabulary.counts + 1.0), np.zeros(CLASSES)))
        within = np.log10(vocabulary.class_tokens + vocabulary.class_words + 1)
        # log10 of what a token's share of its class adds, but for a rare word's own count
        share = np.concatenate((np.zeros(m), -within))[places]
        share[m:head] += count_log[m:head]
        for batch in batches:
            sizes, known, base, score, rare, times = [], [], [], [], [], []
            for text in bytes_of(batch):
                tokens = tokens_of(text)
                code = codes.of(tokens)
                seldom = np.flatnonzero(code >= head)
                sizes.append(len(tokens)), known.append(len(tokens) - len(seldom))
                base.append(float(count_log[code].sum()))
                logs = scorer.logs(places[code]).sum(dtype=np.float64) / np.log(10)
                score.append(float(logs + share[code].sum()))
                counted = Counter([tokens[i] for i in seldom.tolist()])
                rare.append(list(counted)), times.append(list(counted.values()))
            columns = [pa.array(x, t) for x, t in ((sizes, pa.int64()), (known, pa.int64()), (base, pa.float64()), (score, pa.float64()))]
            columns += [pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int32()))]
            names = ["row_id", "doc_id", "n_tokens", "head", "base", "lm", "rare", "times"]
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("doc_id"), *columns], names)

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    parts = f"row_id long, doc_id {kind}, n_tokens long, head long, base double, lm double, rare array<binary>, times array<int>"
    scored = stored(map_batches(rows, step, parts))
    pairs = scored.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("p")).select(
        "row_id", F.col("p.rare").alias("word"), F.col("p.times").alias("times")
    )
    rare = pairs.join(counts.filter(F.col("n") * HEAD <= words.n_tokens), "word").groupBy("row_id").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs")
    )
    tail, seen = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    unit = float(np.log10(words.n_tokens + words.n_words + 1))
    return scored.drop("rare", "times").join(rare, "row_id", "left").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("head") + seen).alias("n_known"),
        F.lit(words.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + tail - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("lm") + tail).alias("score"),
    )
