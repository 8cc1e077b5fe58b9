"""Windows of many texts are searched at once and give what they give text by text."""

import random
import zlib

import numpy as np
import pyarrow as pa

from staffflow.llm import decontamination


def test_words_are_those_of_bytes():
    rnd = random.Random(1)
    letters = " \t\n\v\f\r\x1c\x85 aAZÉ.,;\"'()[]!?:x<\U0001f600"
    texts = [None, "", " ", "...", *("".join(rnd.choice(letters) for _ in range(rnd.randrange(30))) for _ in range(500))]

    def number(word: bytes) -> int:
        bare = word.strip(b".,;:!?\"'()[]")
        return 1 + zlib.crc32(bare) % 0x7FFFFFFE if bare else 0

    got = decontamination._Words.of_all(pa.array(texts).slice(1))
    assert [x.tolist() for x in got] == [[number(w) for w in t.encode().lower().split()] for t in texts[1:]]
    assert [x.tolist() for x in decontamination._Words.of_all(pa.array(texts[:1], pa.string()))] == [[]]


def test_texts_are_searched_together(spark, monkeypatch):
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rnd.choices(words, k=n))) for k, n in enumerate((5, 15, 16, 17, 30, 47, 48, 70, 0))]
    docs = []
    for k in range(150):
        text = rnd.choices(words, k=rnd.choice((0, 3, 16, 60, 300)))
        if k % 3 == 0:
            held = items[k // 3 % len(items)][1].split()
            if k % 2:
                held = held[len(held) // 2 :] + held[: len(held) // 2]
            at = rnd.randrange(len(text) + 1)
            text[at:at] = held
        docs.append((k, " ".join(text)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    coded = decontamination.stored(decontamination.numbered(spark.createDataFrame(docs, "doc_id long, text string")))
    index = decontamination.build_index(coded, benchmark)
    texts = decontamination._Words.of_all(pa.array([t for _, t in docs]))
    single = [decontamination._matches(t, index, w) for t, w in zip(texts, decontamination._worded(texts, index), strict=True)]
    unit, calls = decontamination._unit, []
    monkeypatch.setattr(decontamination, "_unit", lambda rows: calls.append(1) or unit(rows))
    together = list(decontamination._all_matches(texts, index))
    assert len(calls) <= len(np.unique(index.widths))
    assert [[(item, *m[1:]) for item, m in x.items()] for x in together] == [[(item, *m[1:]) for item, m in x.items()] for x in single]
    assert all(abs(x[i][0] - y[i][0]) < 1e-6 for x, y in zip(together, single, strict=True) for i in x)
    assert sum(map(len, single)) >= 20
