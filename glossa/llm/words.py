"""Vectorised word splitting and hashing shared by the text operators.

Texts arrive as Arrow batches and are worked on in chunks of a few MB, so memory follows the
chunk (or the longest single text), never the partition. A word's identity is a 64-bit hash of
its UTF-8 bytes; an n-gram's is made from those of its words, pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Keys of the identities: of a word, of a step that joins two neighbours, of a length.
_WORD, _JOIN, _SIZE = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)
#: Spans beyond so many bytes are hashed one by one; spans that are hashed at a time.
LONG, SLICE = 64, 1 << 18
CHUNK_BYTES = 2 << 20

#: Bytes that belong to a word, by class. "space": everything but space and \t to \r.
#: "alnum": ASCII letters and digits and everything beyond ASCII.
SPACE = np.ones(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: The low 0 to 8 bytes of a block.
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U(32))
    h *= U(0xBEA225F9EB34556D)
    h ^= h >> U(29)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(32)
    return h


class Chunk:
    """Words of some consecutive texts.

    ``first``/``last``: index of the rows in the batch. ``starts``/``ends``: byte offsets of the
    words in ``data``. ``bounds``: for each text, where its words begin in ``starts`` (one more
    entry at the end). ``hashes``: the words' 64-bit identities.
    """

    __slots__ = ("first", "last", "data", "starts", "ends", "bounds", "hashes", "offsets")

    def __init__(self, first, last, data, starts, ends, bounds, hashes, offsets):
        self.first, self.last, self.data = first, last, data
        self.starts, self.ends, self.bounds, self.hashes, self.offsets = starts, ends, bounds, hashes, offsets

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keyed 64-bit identity of the bytes of each span.

    Eight bytes a step enter a state that a bijective, non-linear step turns over each time, so no
    pair of spans collides for every key, as sums of powers do. Long spans take BLAKE2b.
    """
    out = np.empty(len(starts), U)
    blocks = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    for i in range(0, len(starts), SLICE):
        _hash_slice(data, blocks, starts[i : i + SLICE], ends[i : i + SLICE], out[i : i + SLICE])
    return out


def _hash_slice(data: np.ndarray, blocks: np.ndarray, starts: np.ndarray, ends: np.ndarray, out: np.ndarray) -> None:
    size = ends - starts
    out[:] = mix((size.astype(U) + _WORD) * _SIZE ^ (blocks[starts] & _BYTES[np.minimum(size, 8)]))
    live = np.flatnonzero((size > 8) & (size <= LONG))
    done = 8
    while len(live):
        out[live] = mix(out[live] * _JOIN ^ (blocks[starts[live] + done] & _BYTES[np.minimum(size[live] - done, 8)]))
        done += 8
        live = live[size[live] > done]
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = int.from_bytes(blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=b"words").digest(), "little")


def chunks(texts: pa.Array, is_word: np.ndarray = SPACE, lower: bool = True, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Splits a batch's texts (null: no words) into chunks of about ``most`` bytes, whole texts each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    total = np.cumsum(sizes)
    first, n = 0, len(sizes)
    while first < n:
        before = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + most, "right")))
        raw = (" " + " ".join(texts[first:last].to_pylist()) + " ").encode("utf-8", "surrogatepass")
        data = np.frombuffer(raw, np.uint8)
        if lower:
            data = _LOWER[data]
        inside = is_word[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[0::2], edges[1::2]
        offsets = np.empty(last - first + 1, np.int64)
        offsets[0] = 1
        offsets[1:] = total[first:last] - before + 1
        bounds = np.searchsorted(starts, offsets)
        yield Chunk(first, last, data, starts, ends, bounds, hash_spans(data, starts, ends), offsets)
        first = last


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identity of a sequence from those of its two parts; not symmetric, and not linear in the parts."""
    return mix((a ^ (a >> U(29))) * _JOIN + b)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Identity of every k consecutive words, by first word; the caller drops those that cross texts."""
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, U)
    level, size, at, out = words, 1, 0, None
    while True:  # spans of 1, 2, 4, ... words, of which k is made
        if k & size:
            piece = level[at : at + n]
            out = piece if out is None else joined(out, piece)
            at += size
        if 2 * size > k:
            return mix(out + U((k * int(_SIZE)) & 0xFFFFFFFFFFFFFFFF))
        level = joined(level[:-size], level[size:])
        size *= 2


def inner_starts(bounds: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first words of all k-word windows that lie inside one text."""
    n = int(bounds[-1])
    ok = np.zeros(n + 1, np.int32)
    counts = np.diff(bounds)
    long = counts >= k
    np.add.at(ok, bounds[:-1][long], 1)
    np.add.at(ok, bounds[1:][long] - k + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:n]) > 0)


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), pa.int32()), pa.array(values, kind))
