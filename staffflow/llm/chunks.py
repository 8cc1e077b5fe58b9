"""Encoding with a public tokenizer, each distinct blank-delimited chunk once per worker."""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()


BLANK_MARK = BYTE_CHARACTERS[32]
_LINE_END = BYTE_CHARACTERS[10]
#: A blank stays, as the mark of a part without one.
_SPELLING = {b: c for b, c in BYTE_CHARACTERS.items() if b != 32}


def opening_tokens(tokenizer) -> np.ndarray:
    """By id, whether a token of a byte-level vocabulary starts with a blank."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[number for entry, number in vocabulary.items() if entry.startswith(BLANK_MARK)]] = True
    return out


def stands_alone(chunk: str) -> bool:
    """Whether a chunk between two blanks is encoded alike wherever it stands."""
    return chunk != "" and not chunk[-1].isspace()


def ids_of_chunks(tokenizer, opens: np.ndarray, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a blank and each chunk end to end, and how many each has, for chunks that stand alone.

    They are encoded as one text: a chunk's first token is the only one in it that starts with a
    blank, so the ids can be cut apart again.
    """
    if not chunks:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    text = " " + " ".join(chunks)
    ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
    starts = np.flatnonzero(opens[ids])
    if len(starts) != len(chunks):
        raise ValueError("chunks cannot be told apart in this vocabulary")
    return ids, np.diff(starts, append=len(ids))


def _end_to_end(lists) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


class _Generation:
    """Distinct chunks and their ids end to end."""

    def __init__(self):
        self.chunks = pa.array([], pa.string())
        self.flat = np.empty(0, np.uint32)
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, chunks: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Chunks that are not there yet; returns their places."""
        first = len(self.chunks)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, ids])
        self.chunks = pa.concat_arrays([self.chunks, chunks])
        return np.arange(first, len(self.chunks))

    def places(self, chunks: pa.Array) -> np.ndarray:
        """Place of each of the distinct chunks, -1 where it is not there."""
        # the table is made of the few looked for
        found = pc.fill_null(pc.index_in(self.chunks, value_set=chunks), -1).to_numpy()
        out, there = np.full(len(chunks), -1, np.int64), np.flatnonzero(found >= 0)
        out[found[there]] = there
        return out

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks at these places end to end, and how many each has."""
        sizes = self.sizes[at]
        inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - self.starts[at], sizes)
        return self.flat[inner], sizes


# letters up to U+024F, and marks that are no letters, digits, apostrophes or part of a special token's string
_WORD, _MARKS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+", "[.,!?;:#$%&*]+"
#: Chunks that the tokenizer cuts into words, runs of marks and line ends, and these parts.
_SIMPLE = f"{_WORD}(?:{_MARKS})?(?:\n{_WORD}(?:{_MARKS})?)*"
_PARTS = re.compile(f"{_WORD}|{_MARKS}|\n")


class ChunkEncoder:
    """Ids of whole texts of a byte-level BPE whose words may start with one blank.

    Such a tokenizer cuts a text before each blank that follows a non-blank, whatever stands
    around, so the parts can be encoded alone and looked up. A text in which a blank follows
    other white space is encoded whole, since runs of white space are cut differently. The
    library does every merge; a word with marks or a line end behind it is put together from its
    parts, which are merged once. Chunks are kept in two generations: when the newer one is full,
    the older one goes, so frequent chunks stay.
    """

    #: Chunks of a generation, and bytes of their text.
    LIMIT, BYTES = 500_000, 16 << 20

    def __init__(self, tokenizer):
        self.tokenizer, self.merge, self.opens = tokenizer, tokenizer.model.tokenize, opening_tokens(tokenizer)
        self.new, self.old = _Generation(), _Generation()

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """Places of distinct chunks in the newer generation; what is not there yet is learnt."""
        if len(self.new.chunks) + len(chunks) > self.LIMIT or self.new.chunks.nbytes + chunks.nbytes > self.BYTES:
            self.old, self.new = self.new, _Generation()
        at = self._known(chunks)
        lacking = np.flatnonzero(at < 0)
        if len(lacking):
            at[lacking] = self._learn(chunks.take(pa.array(lacking)))
        return at

    def _known(self, chunks: pa.Array) -> np.ndarray:
        """Places of distinct chunks in the newer generation, which gets those of the older one; -1 for others."""
        at = self.new.places(chunks)
        lacking = np.flatnonzero(at < 0)
        before = self.old.places(chunks.take(pa.array(lacking)))
        lacking, before = lacking[before >= 0], before[before >= 0]
        at[lacking] = self.new.add(chunks.take(pa.array(lacking)), *self.old.ids(before))
        return at

    def _learn(self, fresh: pa.Array) -> np.ndarray:
        """Places of new chunks in the newer generation."""
        out = np.full(len(fresh), -1, np.int64)
        words, simple = (pc.match_substring_regex(fresh, f"^{x}$").to_numpy(zero_copy_only=False) for x in (_WORD, _SIMPLE))
        chunks = fresh.to_numpy(zero_copy_only=False)
        words, joined, others = (np.flatnonzero(x) for x in (words, simple & ~words, ~simple))
        # a part without the blank before it is kept with one, which no chunk holds
        parts = [[first, *[" " + x for x in rest]] for first, *rest in map(_PARTS.findall, chunks[joined].tolist())]
        plain = chunks[words].tolist()
        place = dict(zip(plain, self._merge(plain).tolist(), strict=True))
        out[words] = list(place.values())
        further = list(set(chain.from_iterable(parts)).difference(place))
        at = self._known(pa.array(further, pa.string()))
        lacking = np.flatnonzero(at < 0)
        at[lacking] = self._merge([further[k] for k in lacking.tolist()])
        place.update(zip(further, at.tolist(), strict=True))
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        ids, sizes = self.new.ids(np.fromiter(map(place.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum())))
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
        out[joined] = self.new.add(fresh.take(pa.array(joined)), ids, np.diff(ends))
        alone = others[np.array([stands_alone(c) for c in chunks[others].tolist()], bool)]
        for k in range(0, len(alone), 20_000):
            some = alone[k : k + 20_000]
            out[some] = self.new.add(fresh.take(pa.array(some)), *ids_of_chunks(self.tokenizer, self.opens, chunks[some].tolist()))
        bound = np.flatnonzero(out < 0)  # no ids: such a chunk's text is encoded whole
        out[bound] = self.new.add(fresh.take(pa.array(bound)), np.empty(0, np.uint32), np.zeros(len(bound), np.int64))
        return out

    def _merge(self, parts: list[str]) -> np.ndarray:
        """Places of new words and other parts, by the model."""
        merge = self.merge
        # as the characters that stand for their bytes
        spelt = [c if c.isascii() else c.encode().decode("latin-1").translate(_SPELLING) for c in parts]
        ids = [[t.id for t in merge(_LINE_END if c == " \n" else c[1:] if c[0] == " " else BLANK_MARK + c)] for c in spelt]
        return self.new.add(pa.array(parts, pa.string()), *_end_to_end(ids))

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids if text else [], np.uint32)

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string array without nulls, as unsigned 32-bit integers."""
        lists = pc.split_pattern(texts, " ")
        chunks, offsets = lists.flatten(), lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        coded = chunks.dictionary_encode()
        at = self._places(coded.dictionary)[coded.indices.to_numpy()]
        # the first chunk of a text has no blank before it
        heads = chunks.take(pa.array(offsets[:-1])).to_pylist()
        at = np.delete(at, offsets[:-1])
        ends = offsets[1:] - np.arange(1, len(texts) + 1)
        ids, sizes = self.new.ids(at)
        upto = np.concatenate(([0], np.cumsum(sizes)))
        bound = np.concatenate(([0], np.cumsum(sizes == 0)))
        out, start = [], 0
        for k, (head, end) in enumerate(zip(heads, ends.tolist(), strict=True)):
            if start == end or bound[end] > bound[start] or not stands_alone(head):
                out.append(self._whole(texts[k].as_py()))
            else:
                out.append(np.concatenate([self._whole(head), ids[upto[start] : upto[end]]]))
            start = end
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()))[0]


def process_encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker, kept from task to task."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_chunk_encoders", {})
    if path not in held:
        held[path] = ChunkEncoder(load(path))
    return held[path]
