"""The latent space is fitted on every passage of every text."""

import random

import numpy as np

from staffflow.llm import decontamination


def corpus(spark, n=120):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(600)]
    texts = [None, "", "...", *(" ".join(rnd.choices(words, k=rnd.choice((1, 47, 48, 49, 200, 700)))) for _ in range(n))]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_the_space_sees_all_words_of_all_texts(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "STORED", 1_000)
    coded = decontamination.stored(decontamination.numbered(corpus(spark)))
    texts = [np.frombuffer(r.words, "<i4") % decontamination.TERMS for r in coded.collect()]
    blocks = decontamination.passage_blocks(coded, np.ones(decontamination.TERMS)).collect()
    assert len(blocks) > 10
    terms = np.concatenate([np.frombuffer(b.terms, "<u2") for b in blocks])
    sizes = np.concatenate([np.frombuffer(b.sizes, "<i4") for b in blocks])
    assert sorted(terms.tolist()) == sorted(np.concatenate(texts).tolist())
    assert sizes.max() <= decontamination.PASSAGE and len(sizes) == sum(-(-len(t) // decontamination.PASSAGE) for t in texts)
    of_text = sorted(sorted(p.tolist()) for t in texts if len(t) for p in np.array_split(t, -(-len(t) // decontamination.PASSAGE)))
    assert sorted(sorted(p.tolist()) for p in np.split(terms, np.cumsum(sizes)[:-1])) == of_text


def test_the_space_is_that_of_the_whole_matrix(spark, monkeypatch):
    for name, value in {"STORED": 500, "PACKED": 3_000, "SLICE": 100, "RANK": 12}.items():
        monkeypatch.setattr(decontamination, name, value)
    coded = decontamination.stored(decontamination.numbered(corpus(spark)))
    frequency, n, words = decontamination.document_frequencies(coded)
    assert n == 123 and words == sum(len(r.words) for r in coded.collect()) // 4
    idf = np.log((n + 1) / (frequency + 1))
    idf[0] = 0
    active = np.flatnonzero(frequency)
    space = decontamination.fit_space(decontamination.stored(decontamination.passage_blocks(coded, idf)), idf, active)

    texts = [np.frombuffer(r.words, "<i4") % decontamination.TERMS for r in coded.collect() if r.words]
    parts = [p for t in texts for p in np.array_split(t, -(-len(t) // decontamination.PASSAGE))]
    matrix = np.zeros((len(parts), len(active)))
    for row, part in zip(matrix, parts, strict=True):
        np.add.at(row, np.searchsorted(active, part), 1)
    matrix *= idf[active]
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix /= np.where(norm > 0, norm, 1)
    basis = np.random.default_rng(5).standard_normal((len(active), 12 + decontamination.OVERSAMPLE))
    for _ in range(decontamination.POWER_STEPS):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    values, turn = np.linalg.eigh(basis.T @ matrix.T @ matrix @ basis)
    want = basis @ turn[:, ::-1][:, :12] / np.sqrt(values[::-1][:12])
    # signs of the vectors are free
    assert np.allclose(space @ space.T, want @ want.T, atol=1e-4 * np.abs(want @ want.T).max())
