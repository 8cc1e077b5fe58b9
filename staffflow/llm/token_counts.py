"""Token counts of a word BPE by the whole-token shortcut.

Before any text is read, every vocabulary string that may end a word is encoded alone; the ones
that give exactly their own token are proven whole. A pre-token among them counts 1 without any
merge. The rest is merged by the library's model, each distinct blank-delimited chunk once per
task. White space separates words for this tokenizer and gives no tokens, so chunks are safe.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffflow.llm.chunks import BYTE_CHARACTERS, load
from staffflow.llm.common import map_batches, texts_of

WORD_END = "</w>"
LIMIT = 2048
KNOWN = 1_000_000


def whole_tokens(tokenizer) -> frozenset[str]:
    """Strings that are proven to be one pre-token and one token, in the tokenizer's own byte characters."""
    bytes_for = {c: b for b, c in BYTE_CHARACTERS.items()}
    proven = set()
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        body = entry.removesuffix(WORD_END)
        if body == entry or not body or any(c not in bytes_for for c in body):
            continue
        try:
            text = bytes(bytes_for[c] for c in body).decode()
        except UnicodeDecodeError:
            continue
        if tokenizer.encode(text, add_special_tokens=False).ids == [number]:
            if [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)] == [body]:
                proven.add(body)
    return frozenset(proven)


class ChunkCounts(dict):
    """Chunk without blanks to its number of tokens."""

    def __init__(self, tokenizer, whole: frozenset[str]):
        super().__init__()
        self.tokenizer, self.whole = tokenizer, whole

    def _piece(self, piece: str) -> int:
        return 1 if piece in self.whole else len(self.tokenizer.model.tokenize(piece))

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = self._count(chunk)
        return n

    def _count(self, chunk: str) -> int:
        word, mark = (chunk[:-1], chunk[-1]) if chunk[-1:] in (".", ",") else (chunk, "")
        if word.isalpha() and max(word) < "Ā":
            n = self._piece(word.lower().encode().decode("latin-1").translate(BYTE_CHARACTERS))
            return n + self._piece(mark) if mark else n
        if "<|" in chunk:  # may hold a special token's string
            return len(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(chunk))
        return sum(self._piece(p) for p, _ in pieces)

    def count(self, text: str) -> int:
        # LF and blank are the same to this tokenizer
        return sum(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text); a null text is empty.

    ``path`` is the vocabulary file of a word BPE whose words end with a mark. A text of any length
    is counted whole, rows that repeat are counted each, an empty table gives no rows, further
    columns are ignored.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(load(path)))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ChunkCounts(load(path), whole.value)
        for batch in batches:
            found = []
            for text in texts_of(batch):
                found.append(known.count(text))
                if len(known) > KNOWN:
                    known.clear()
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), size, pa.array(found, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    counted = map_batches(docs.select("doc_id", "text"), step, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
