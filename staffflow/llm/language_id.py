"""Language of texts by unigrams of pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word, with a mark
before it, has the sum of the products of its pieces' probabilities over all ways to cut it into
pieces, which a forward pass gives without listing them; a text has the product over its words.
Training starts from equal probabilities and repeats: a forward and a backward pass give how often
each piece is expected in the words of a language, and shares of these sums are the next
probabilities.

Words are the runs of letters of the lower-cased text. A letter that is no piece by itself can
still be passed, at one small probability for all languages.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffflow.llm.common import id_remainder, map_batches, sent, stored, texts_of

#: Training texts of a language, about, picked by a hash; the probabilities are fitted on their words.
SAMPLE = 1_000
ROUNDS = 4
#: Parts of a language's probabilities that come from all languages alike, and from no language: a piece
#: that is new to several languages weighs the same in them, however much text each has.
SHARED, EVEN = 0.02, 0.001
#: Probability of a letter that is no piece.
UNKNOWN = 1e-7
#: Letters of a word at most in training; longer ones are cut there. Scored are words of any length.
LONGEST = 64
#: Words kept by a task, in two generations of this size.
KEPT = 200_000
#: Words whose segmentations are summed at a time.
BLOCK = 20_000
MARK = "▁"
UNDECIDED = "und"

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def vocabulary_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece vocabulary that lower-cased words can hold: letters, a mark before them or alone."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_byte, model.is_control, model.is_unknown)
    pieces = (model.id_to_piece(k) for k in range(model.get_piece_size()) if not any(f(k) for f in special))
    kept = {p for p in pieces if (p.removeprefix(MARK) == "" and p) or _WORDS.fullmatch(p.removeprefix(MARK))}
    return sorted(p for p in kept if p == p.lower())


class Lattice:
    """All pieces inside words, and sums over the ways to cut the words into them."""

    def __init__(self, pieces: list[str]):
        self.place = {p: k for k, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        #: numbers of an edge that is no piece, and of a single letter that is none
        self.none, self.unknown = len(pieces), len(pieces) + 1

    def log_likelihoods(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """Log probability of every word [word, language], over all of its segmentations.

        ``table`` holds [piece, language] probabilities, rows ``none`` (0) and ``unknown``
        included. Only the sums of the last beginnings are held, whatever the length of a word.
        """
        out = np.empty((len(words), table.shape[1]))
        for at in _by_length(words):
            marked = [MARK + words[k] for k in at]
            # logs of the sums over the segmentations of the beginnings, the last one last
            logs = deque([np.zeros((len(at), table.shape[1]))], maxlen=self.longest)
            for e in range(1, len(marked[0]) + 1):
                held = logs[-1]
                total = table[self._numbers(marked, e, 1)]
                for k in range(2, len(logs) + 1):
                    piece = self._numbers(marked, e, k)
                    if (piece != self.none).any():
                        total += table[piece] * np.exp(logs[-k] - held)
                logs.append(held + np.log(total))
            out[at] = logs[-1]
        return out

    def _numbers(self, marked: list[str], end: int, length: int) -> np.ndarray:
        get, a, other = self.place.get, end - length, self.unknown if length == 1 else self.none
        return np.fromiter([get(w[a:end], other) for w in marked], np.int64, len(marked))

    def expected(self, words: list[str], counts: np.ndarray, table: np.ndarray) -> np.ndarray:
        """How often each piece is expected in words of one language that occur ``counts`` times."""
        out = np.zeros(len(table))
        with np.errstate(divide="ignore"):
            logs = np.log(table)
        for at in _by_length(words):
            marked = [MARK + words[k] for k in at]
            n, m = len(marked[0]), len(marked)
            spans = [(e, k) for e in range(1, n + 1) for k in range(1, min(e, self.longest) + 1)]
            edges = {span: self._numbers(marked, *span) for span in spans}
            begin, rest = np.full((n + 1, m), -np.inf), np.full((n + 1, m), -np.inf)
            begin[0] = rest[n] = 0
            for e, k in spans:
                begin[e] = np.logaddexp(begin[e], logs[edges[e, k]] + begin[e - k])
            for e, k in reversed(spans):
                rest[e - k] = np.logaddexp(rest[e - k], logs[edges[e, k]] + rest[e])
            for (e, k), piece in edges.items():
                share = np.exp(begin[e - k] + logs[piece] + rest[e] - begin[n])
                out += np.bincount(piece, share * counts[at], len(table))
        return out


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words of one length, in blocks of bounded size."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, cuts):
        if len(group):
            limit = max(1, BLOCK * 8 // (int(sizes[group[0]]) + 1))
            for at in range(0, len(group), limit):
                yield group[at : at + limit]


@dataclass
class Model:
    """Languages in ascending order, their shares of the training documents, and probabilities [piece, language]."""

    pieces: list[str]
    languages: list[str]
    prior: np.ndarray
    table: np.ndarray


class Scorer:
    """Predictions of a model; log probabilities of words are kept in two generations."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.logs = np.empty((0, len(model.languages)))
        self.old_logs = self.logs

    def _learn(self, words: set[str]) -> None:
        if len(self.new) + len(words) > KEPT:
            self.old, self.old_logs, self.new, self.logs = self.new, self.logs, {}, self.logs[:0]
        lacking = words.difference(self.new)
        again = sorted(lacking.intersection(self.old))
        fresh = sorted(lacking.difference(self.old))
        parts = [self.logs]
        if again:
            parts.append(self.old_logs[[self.old[w] for w in again]])
        if fresh:
            parts.append(self.lattice.log_likelihoods(fresh, self.model.table))
        self.logs = np.concatenate(parts)
        for w in (*again, *fresh):
            self.new[w] = len(self.new)

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and its probability given the text; ``und`` and 0 without a letter or without a model."""
        found = [words_of(t) for t in texts]
        self._learn({w for words in found for w in words})
        out = []
        for words in found:
            if not self.model.languages or not any(c.isalpha() for w in words for c in w):
                out.append((UNDECIDED, 0.0))
                continue
            at = np.fromiter(map(self.new.__getitem__, words), np.int64, len(words))
            logs = self.logs[at].sum(axis=0) + self.model.prior
            best = int(logs.argmax())
            out.append((self.model.languages[best], float(1 / np.exp(logs - logs[best]).sum())))
        return out


def training_texts(docs: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """(lang, text) of about ``per_language`` distinct rows (doc_id, text) of every language, all of a rarer one.

    A row is taken if its hash lies in the share that its language needs: one number a language
    goes through the driver, and the texts are only filtered.
    """
    key = F.md5(F.concat_ws("\0", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").cast("binary"))
    keyed = docs.filter("lang is not null and text is not null").select("lang", "text", key.alias("key"))
    sizes = keyed.select("lang", "key").distinct().groupBy("lang").count().orderBy("lang").collect()
    if not sizes:
        return keyed.select("lang", "text").limit(0)
    shares = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], per_language / r["count"])])
    place = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / float(16**13)
    return keyed.filter(place < shares[F.col("lang")]).dropDuplicates(["lang", "key"]).select("lang", "text")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch), strict=True):
            for w in words_of(text):
                # what is fitted are words; a longer run of letters counts in parts
                counts.update((lang, w[at : at + LONGEST]) for at in range(0, len(w), LONGEST))
        langs, words = ([k[i] for k in counts] for i in (0, 1))
        arrays = [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["lang", "word", "n"])


def fit(docs: DataFrame, path: str, per_language: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Model of the rows (doc_id, text, lang) with a language and a text.

    Shares of the languages are counted over all rows, probabilities of pieces over the words of
    ``training_texts``. What is sent is one probability per piece and language.
    """
    spark = docs.sparkSession
    pieces = vocabulary_pieces(path)
    rows = docs.filter("lang is not null and text is not null").groupBy("lang").count().orderBy("lang").collect()
    languages = [r["lang"] for r in rows]
    total = sum(r["count"] for r in rows)
    prior = np.log(np.array([r["count"] / total for r in rows])) if rows else np.empty(0)
    size = len(pieces) + 2
    table = np.zeros((size, len(languages)))
    table[:-2] = 1 / len(pieces)
    table[-1] = UNKNOWN
    if languages:
        counted = map_batches(training_texts(docs, per_language), _word_counts, "lang string, word string, n long")
        words = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).repartition("word"))
        for _ in range(rounds):
            table = _next_table(words, pieces, languages, table)
    return Model(pieces, languages, prior, table)


def _next_table(words: DataFrame, pieces: list[str], languages: list[str], table: np.ndarray) -> np.ndarray:
    held = sent(words.sparkSession, (pieces, languages, table))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, languages, table = held()
        lattice = Lattice(pieces)
        sums = np.zeros((len(languages), len(table)))
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts, n = np.array(batch.column("word").to_pylist(), object), batch.column("n").to_numpy()
            for k, language in enumerate(languages):
                own = langs == language
                if own.any():
                    sums[k] += lattice.expected(texts[own].tolist(), n[own], table[:, k])
        lang, piece = np.nonzero(sums[:, : len(pieces)])
        arrays = [pa.array(lang), pa.array(piece), pa.array(sums[lang, piece])]
        yield pa.RecordBatch.from_arrays(arrays, ["lang", "piece", "n"])

    found = map_batches(words, step, "lang long, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(pieces), len(languages)))
    got = found.toArrow()  # at most one row per piece and language
    counts[got.column("piece").to_numpy(), got.column("lang").to_numpy()] = got.column("n").to_numpy()
    sums = counts.sum(axis=0)
    own = np.where(sums > 0, counts / np.maximum(sums, 1e-300), 1 / len(pieces))
    out = np.zeros_like(table)
    out[:-2] = (1 - SHARED - EVEN) * own + SHARED * own.mean(axis=1, keepdims=True) + EVEN / len(pieces)
    out[-1] = UNKNOWN
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text)."""
    held = sent(docs.sparkSession, model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held())
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                found = scorer.predict(texts_of(batch))
                arrays = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", "text"), step, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 3) == 1


def languages(docs: DataFrame, path: str) -> DataFrame:
    """Predicted language of every row, learnt from the rows whose crc32(doc_id) modulo 3 is not 1.

    ``docs``: doc_id, text, lang; further columns are ignored. Output, one row per input row:
    doc_id, held_out, lang_pred, score. Texts that are null or hold no letter are ``und`` with
    score 0, and so is every text where nothing can be learnt. Letters outside the vocabulary
    weigh the same in all languages. Of equally likely languages the first in code point order is taken. Repeated rows are scored
    each and whole, whatever their length; copies of a training row count once in the sample. An
    empty table gives no rows.
    """
    source = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    model = fit(source.filter(~held_out(F.col("doc_id"))), path)
    scored = predict(source, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
