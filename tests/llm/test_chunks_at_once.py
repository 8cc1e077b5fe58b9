"""Chunks are encoded many texts at once, and parts that they share are merged once."""

import random

import pyarrow as pa
import pytest

from staffflow.llm import chunks, token_ids
from staffflow.llm.common import PORTION, portions

PATH = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return chunks.load(chunks.vocabulary(PATH))


def test_parts_of_chunks_are_merged_once(library):
    encoder, merged = chunks.ChunkEncoder(library), []
    merge = encoder.merge
    encoder.merge = lambda part: merged.append(part) or merge(part)
    texts = ["x zorblat zorblat. zorblat, zorblat;*** Éthon.\nzorblat zorblat.\nÉthon. blit.\nblit,"] * 3
    ids = encoder.encode_all(pa.array(texts))
    assert [x.tolist() for x in ids] == [library.encode(t).ids for t in texts]
    # each word with a blank before it and without, each run of marks and the line end
    assert len(merged) == len(set(merged)) <= 4 + 3 + 3 + 1
    encoder.encode_all(pa.array(["y zorblat.*** blit;***", "Éthon,"]))
    assert len(merged) == len(set(merged)) <= 5 + 3 + 4 + 1


def test_chunks_equal_the_library_when_generations_change(library, monkeypatch):
    monkeypatch.setattr(chunks.ChunkEncoder, "LIMIT", 40)
    rnd, encoder = random.Random(2), chunks.ChunkEncoder(library)
    pieces = ["ab", "Zé", "ñu", "×", "µ", "ª", "Ⅷ", "²", "3", "'s", "'", ".", ",", "!", "***", "&#", "<|endoftext|>", "\n", "\n\n", "\t", "\r", " ", "  ", " ", "好", "_", "\U0001f600"]
    for _ in range(60):
        texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(14))) for _ in range(40)]
        assert [x.tolist() for x in encoder.encode_all(pa.array(texts))] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_are_encoded_in_portions_whatever_the_batches(library):
    rows = [(k, t) for k, t in enumerate([None, "", "a b", "c " * PORTION, "d", "e f.\ng"])]
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows]), pa.array([t for _, t in rows])], ["doc_id", "text"])
    assert [x.num_rows for x in portions(batch)] == [3, 1, 2]
    assert sum(x.num_rows for x in portions(batch.slice(1, 4))) == 4 and not list(portions(batch.slice(0, 0)))
    encoder, calls = chunks.ChunkEncoder(library), []
    whole = encoder.encode_all
    encoder.encode_all = lambda texts: calls.append(len(texts)) or whole(texts)
    small = batch.filter(pa.array([k != 3 for k, _ in rows]))
    got = list(token_ids._encoded((small.slice(k, 1) for k in range(5)), encoder))
    assert calls == [5]
    assert [(k, x.tolist()) for k, x in got] == [(k, library.encode(t or "").ids) for k, t in rows if k != 3]
