"""Benchmark passages whose phrases stand in another order: only the latent space finds them."""

import random

import pytest

from staffflow.llm import decontamination
from tests.conftest import SMALL


def rewritten(words, rnd, phrase=4):
    """Phrases of a passage shuffled; its last words, the answer, stay at the end."""
    body, answer = words[: -decontamination.ANSWER], words[-decontamination.ANSWER :]
    phrases = [body[i : i + phrase] for i in range(0, len(body), phrase)]
    while True:
        rnd.shuffle(phrases)
        out = [w for p in phrases for w in p] + answer
        common = decontamination.common_length([hash(w) for w in words], [hash(w) for w in out])
        if common < 0.55 * len(words):
            return out


@pytest.fixture(scope="module")
def planted(spark):
    """Documents with one rewritten item each, and which."""
    rnd = random.Random(7)
    docs = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if len((r.text or "").split()) >= 150]
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [r for r in benchmark.collect() if 30 <= len(r.text.split()) <= decontamination.PASSAGE]
    rows, want = [], set()
    for k, r in enumerate(docs):
        words = r.text.split()
        if k < 2 * len(items):
            item = items[k % len(items)]
            at = rnd.randrange(len(words))
            words[at:at] = rewritten(item.text.split(), rnd)
            want.add((10_000 + k, item.item_id))
        rows.append((10_000 + k, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string"), benchmark, want


def pairs(docs, benchmark):
    return {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, benchmark).collect()}


def test_the_cosine_finds_what_words_in_order_cannot(planted, monkeypatch):
    docs, benchmark, want = planted
    found = pairs(docs, benchmark)
    monkeypatch.setattr(decontamination, "LATENT", 9.0)
    by_words = pairs(docs, benchmark)
    assert by_words <= found and len(want) >= 20
    assert len(want & found) >= 0.9 * len(want)
    assert len(want & by_words) <= 0.3 * len(want)
    # nothing else comes in by the cosine
    assert found - by_words <= want


def test_only_windows_that_may_match_are_checked_in_words(planted, spark, monkeypatch):
    docs, benchmark, _ = planted
    index = decontamination.build_index(decontamination.stored(decontamination.numbered(docs)), benchmark)
    words, looked = decontamination._Words(), []
    texts = [words.of(r.text.encode()) for r in docs.limit(60).collect()]
    common = decontamination.common_length
    monkeypatch.setattr(decontamination, "common_length", lambda part, region: looked.append(1) or common(part, region))

    class Members(frozenset):
        def difference(self, region):
            looked.append(0)
            return frozenset(self).difference(region)

    index.members = [Members(m) for m in index.members]
    allowed = 0
    for numbers, worded in zip(texts, decontamination._worded(texts, index), strict=True):
        allowed += len(worded[0])
        # windows at a cosine of 0.5 whose words allow no match were looked at one by one before
        sums, near = index.blocks(numbers), 0
        for width in set(index.widths.tolist()):
            group = [k for k, w in enumerate(index.widths.tolist()) if w == width and len(index.passages[k]) >= decontamination.WORDY]
            cosine = decontamination._unit(decontamination._running(sums, width)) @ index.items[group].T
            near += int((cosine >= decontamination.LATENT).sum())
        allowed += near
        decontamination._matches(numbers, index, worded)
    assert 0 < looked.count(0) <= allowed
