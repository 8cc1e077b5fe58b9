"""Static range asymmetric numeral system over token ids, many lanes at a time in numpy.

A file is bytes: header, frequency table, document index, blocks. The table is shared by all
blocks of its file. A block holds whole documents and is coded on its own: symbol i belongs to
lane i mod ``LANES``; each lane is a 64-bit rANS state that spills 32-bit words into the block's
one stream. Every ``STRIDE`` steps a checkpoint keeps the lane states and the stream position, so
the parts between checkpoints are decoded side by side. Blocks carry a checksum of their bytes
and one of their ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"RTOK0001"
LANES = 128
STRIDE = 512
SCALE = 20
LOW = np.uint64(1 << 31)
_SHIFT, _WORD, _MASK32 = np.uint64(SCALE), np.uint64(32), np.uint64(0xFFFFFFFF)
_SLOT = np.uint64((1 << SCALE) - 1)


class CorruptFile(ValueError):
    """A file or block whose checksum or layout does not hold."""


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2^SCALE, at least 1 for every symbol that occurs."""
    total, seen = int(counts.sum()), np.flatnonzero(counts)
    if len(seen) > 1 << SCALE:
        raise ValueError("more symbols than slots")
    out = np.zeros(len(counts), np.int64)
    if total == 0:
        return out
    out[seen] = np.maximum(1, counts[seen].astype(np.float64) * ((1 << SCALE) / total)).astype(np.int64)
    excess = int(out.sum()) - (1 << SCALE)
    order = seen[np.argsort(-out[seen], kind="stable")]
    if excess < 0:
        out[order[0]] -= excess
    while excess > 0:  # take from the most frequent, which lose least by it
        for s in order:
            cut = min(excess, int(out[s]) // 2 if out[s] > 1 else 0)
            out[s] -= cut
            excess -= cut
            if excess == 0:
                break
    return out


class Table:
    """Frequencies with their running sums and the symbol of each slot."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64) if len(freq) else self.freq
        self.limit = self.freq << np.uint64(31 - SCALE + 32)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def dump(self) -> bytes:
        seen = np.flatnonzero(self.freq)
        gaps = np.diff(seen, prepend=0).astype("<u4")
        return zlib.compress(gaps.tobytes() + self.freq[seen].astype("<u4").tobytes(), 6)

    @classmethod
    def load(cls, data: bytes) -> Table:
        both = np.frombuffer(zlib.decompress(data), "<u4").reshape(2, -1)
        freq = np.zeros(int(both[0].sum()) + 1 if both.shape[1] else 0, np.int64)
        freq[np.cumsum(both[0].astype(np.int64))] = both[1]
        return cls(freq)


def encode_blocks(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """Each block's ids as bytes; all blocks advance together, one step of every lane at a time."""
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    steps = [-(-len(blocks[k]) // LANES) for k in order]
    most, n = (steps[0] if steps else 0), len(order)
    ids = np.zeros((most, n * LANES), np.uint32)
    for at, k in enumerate(order):
        pad = np.full(steps[at] * LANES, blocks[k][0] if len(blocks[k]) else 0, np.uint32)
        pad[: len(blocks[k])] = blocks[k]
        ids[: steps[at], at * LANES : (at + 1) * LANES] = pad.reshape(-1, LANES)
    state = np.full(n * LANES, LOW, np.uint64)
    spilled = np.zeros(ids.shape, np.uint32)
    spills = np.zeros(ids.shape, bool)
    marks: list[list[np.ndarray]] = [[] for _ in order]
    live, step = 0, np.array(steps)
    for t in range(most - 1, -1, -1):
        while live < n and step[live] > t:
            live += 1
        x, s = state[: live * LANES], ids[t, : live * LANES]
        f = table.freq[s]
        over = x >= table.limit[s]
        spilled[t, : live * LANES] = x  # the low 32 bits
        spills[t, : live * LANES] = over
        x = np.where(over, x >> _WORD, x)
        q = x // f
        state[: live * LANES] = (q << _SHIFT) + (x - q * f) + table.start[s]
        if t % STRIDE == 0:
            for at in range(live):
                marks[at].append(state[at * LANES : (at + 1) * LANES].copy())
    out: list[bytes] = [b""] * n
    for at, k in enumerate(order):
        part = slice(at * LANES, (at + 1) * LANES)
        over = spills[: steps[at], part]
        words = spilled[: steps[at], part][over]
        per_step = np.concatenate(([0], np.cumsum(over.sum(axis=1))))
        offsets = per_step[:-1][::STRIDE].astype("<u4")
        states = np.stack(marks[at][::-1]).astype("<u8") if marks[at] else np.empty((0, LANES), "<u8")
        body = struct.pack("<III", len(blocks[k]), len(offsets), len(words))
        body += struct.pack("<I", zlib.crc32(blocks[k].astype("<u4").tobytes()))
        body += offsets.tobytes() + states.tobytes() + words.astype("<u4").tobytes()
        out[k] = struct.pack("<II", len(body), zlib.crc32(body)) + body
    return out


def decode_blocks(data: bytes, table: Table) -> list[np.ndarray]:
    """Ids of the blocks that follow one another in ``data``; all parts between checkpoints advance together."""
    view, heads, at = memoryview(data), [], 0
    while at < len(view):
        size, check = struct.unpack_from("<II", view, at)
        body = view[at + 8 : at + 8 + size]
        if len(body) != size or zlib.crc32(body) != check:
            raise CorruptFile("block bytes")
        heads.append((*struct.unpack_from("<IIII", body, 0), body))
        at += 8 + size
    if not heads:
        return []
    states, offsets, words, steps, base = [], [], [], [], 0
    for n, parts, n_words, _, body in heads:
        offset = np.frombuffer(body, "<u4", parts, 16).astype(np.int64)
        offsets.append(offset + base)
        states.append(np.frombuffer(body, "<u8", parts * LANES, 16 + 4 * parts))
        words.append(np.frombuffer(body, "<u4", n_words, 16 + 4 * parts + 8 * LANES * parts))
        total = -(-n // LANES)
        steps += [min(STRIDE, total - k * STRIDE) for k in range(parts)]
        base += n_words
    steps = np.array(steps, np.int64)
    order = np.argsort(-steps, kind="stable")
    state = np.concatenate(states).astype(np.uint64).reshape(-1, LANES)[order]
    place = np.concatenate(offsets)[order]
    stream = np.append(np.concatenate(words), np.zeros(1, np.uint32)).astype(np.uint64)
    by_size = steps[order]
    out = np.zeros((len(order), STRIDE, LANES), np.uint32)
    for t in range(int(by_size[0]) if len(by_size) else 0):
        live = int(np.searchsorted(-by_size, -t, side="left"))
        x = state[:live]
        slot = x & _SLOT
        s = table.symbol[slot.astype(np.int64)]
        out[:live, t] = s
        x = table.freq[s] * (x >> _SHIFT) + slot - table.start[s]
        low = x < LOW
        rank = np.cumsum(low, axis=1)
        need = place[:live, None] + rank - 1
        state[:live] = np.where(low, (x << _WORD) | stream[np.where(low, need, len(stream) - 1)], x)
        place[:live] += rank[:, -1]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    result, first = [], 0
    for n, parts, _, check, _ in heads:
        rows = out[back[first : first + parts]].reshape(-1)[:n]
        if zlib.crc32(rows.astype("<u4").tobytes()) != check:
            raise CorruptFile("block ids")
        result.append(rows)
        first += parts
    return result


def pack_file(doc_sizes: np.ndarray, ids: np.ndarray, block_ids: int) -> bytes:
    """A file of documents: ``doc_sizes`` ids each, one after the other in ``ids``.

    A block ends with the document that brings it to ``block_ids``.
    """
    table = Table(scaled_frequencies(np.bincount(ids) if len(ids) else np.zeros(0, np.int64)))
    ends = np.cumsum(doc_sizes)
    cuts, last = [0], 0
    for end in ends.tolist():
        if end - last >= block_ids:
            cuts.append(end)
            last = end
    if cuts[-1] < len(ids):
        cuts.append(len(ids))
    blocks = [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    freq, index = table.dump(), zlib.compress(doc_sizes.astype("<u8").tobytes(), 6)
    head = struct.pack("<QQII", len(doc_sizes), len(ids), len(freq), len(index)) + freq + index
    return MAGIC + struct.pack("<II", len(head), zlib.crc32(head)) + head + b"".join(encode_blocks(blocks, table))


def unpack_file(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(doc_sizes, ids) of a file; raises CorruptFile where a checksum fails."""
    if data[:8] != MAGIC:
        raise CorruptFile("magic")
    size, check = struct.unpack_from("<II", data, 8)
    head = data[16 : 16 + size]
    if len(head) != size or zlib.crc32(head) != check:
        raise CorruptFile("header")
    n_docs, n_ids, n_freq, n_index = struct.unpack_from("<QQII", head, 0)
    table = Table.load(head[24 : 24 + n_freq])
    sizes = np.frombuffer(zlib.decompress(head[24 + n_freq : 24 + n_freq + n_index]), "<u8").astype(np.int64)
    parts = decode_blocks(data[16 + size :], table)
    ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    if len(sizes) != n_docs or len(ids) != n_ids or int(sizes.sum()) != n_ids:
        raise CorruptFile("sizes")
    return sizes, ids
