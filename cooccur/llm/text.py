"""Words of whole texts as numbers: the kernel shared by the Python tasks of this subpackage.

Spark hands a task Arrow batches of texts. They are cut into chunks of whole texts of about
``CHUNK_BYTES`` (a longer text is a chunk of its own), so a task's memory follows the longest
text, not the batch. A chunk's words come out as arrays: where they start and end, which text
they are in, and a 64-bit hash each.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
RATIO = 0x9E3779B97F4A7C15 | 5
U64 = np.uint64


class Alphabet(NamedTuple):
    """Which bytes belong to words, and the number that stands for each byte."""

    member: np.ndarray
    value: np.ndarray


def alphabet(member: np.ndarray, fold: bool = True, seed: int = 1) -> Alphabet:
    value = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
    if fold:
        value[ord("A"): ord("Z") + 1] = value[ord("a"): ord("z") + 1]
    return Alphabet(member, value)


def _members(*spans: tuple[int, int]) -> np.ndarray:
    member = np.zeros(256, bool)
    for low, high in spans:
        member[low: high + 1] = True
    return member


#: Bytes with A-Z folded.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[ord("A"): ord("Z") + 1] += 32

#: Everything but the six ASCII white-space characters; A-Z folded.
SPACED = alphabet(~_members((0x20, 0x20), (0x09, 0x0D)))
#: The same words, with upper and lower case told apart.
CASED = alphabet(SPACED.member, fold=False)
#: ASCII letters and digits, and everything beyond ASCII; A-Z folded.
ALNUM = alphabet(_members((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as they were needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, CHUNK_BYTES + 1)
            found = []
            for ratio in (RATIO, pow(RATIO, -1, 1 << 64)):
                steps = np.full(size, ratio, np.uint64)
                steps[0] = 1
                found.append(np.cumprod(steps))
            self.up, self.down = found
        return self.up, self.down


POWERS = _Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of the numbers over all bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


class Chunk(NamedTuple):
    """Texts ``first`` to ``last`` of a batch and their bytes, end to end."""

    first: int
    last: int
    raw: np.ndarray
    bounds: np.ndarray

    def text(self, start: int, end: int) -> str:
        return self.raw[start:end].tobytes().decode("utf-8", "replace")


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column in chunks; null texts are empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield Chunk(first, last, raw[bounds[first]: bounds[last]], bounds[first: last + 1] - bounds[first])
        first = last


class Words(NamedTuple):
    """Words in order; the words of text i are ``first[i]`` to ``first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def spans_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each span of bytes: a polynomial over the bytes' random numbers."""
    up, down = POWERS.get(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(value[raw] * up[: len(raw)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start])


def words_of(chunk: Chunk, letters: Alphabet, hashed: bool = True) -> Words:
    inside = letters.member[chunk.raw]
    n = len(inside)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    inner = chunk.bounds[(chunk.bounds > 0) & (chunk.bounds < n)]
    before[inner] = False
    after[inner - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    hashes = spans_hash(chunk.raw, start, end, letters.value) if hashed else np.zeros(0, np.uint64)
    return Words(start, end, hashes, np.searchsorted(start, chunk.bounds))


def grams_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive words; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = 1
    for i in range(size):
        factor = factor * RATIO % (1 << 64)
        total += hashes[i: i + n] * U64(factor)
    return mixed(total)


def list_array(values: pa.Array, sizes: np.ndarray | list[int]) -> pa.ListArray:
    """Values in groups of the given sizes."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def joined(raw: np.ndarray, start: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A text for each group of ``sizes`` consecutive spans of bytes: the spans joined by one space."""
    lengths = end - start
    width = lengths + 1
    width[np.cumsum(sizes)[sizes > 0] - 1] -= 1
    at = np.cumsum(width) - width
    before = np.cumsum(lengths) - lengths
    out = np.full(int(width.sum()), 0x20, np.uint8)
    byte = np.arange(int(lengths.sum()))
    out[byte + np.repeat(at - before, lengths)] = raw[byte + np.repeat(start - before, lengths)]
    bounds = np.zeros(len(sizes) + 1, np.int64)
    bounds[1:] = np.append(0, np.cumsum(width))[np.cumsum(sizes)]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(bounds), pa.py_buffer(out)).cast(pa.string())
