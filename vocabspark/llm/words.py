"""Word and gram hashes of whole texts, computed over Arrow buffers inside tasks.

Texts are handled a few megabytes at a time, so the memory of a task does not depend on how many
rows an Arrow batch holds. A word is a maximal run of bytes outside a separator class; all
separator classes used here are ASCII, so a run of bytes is a run of characters.

Hashes have 64 bits and do not depend on the machine or the run. Two different words (or grams)
are told apart by their hashes: among 10^9 different ones the chance that any two clash is
about 3 %, and one clash changes one count by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

# Separators [\x20\x09-\x0D]: words are what stands between white space.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
# Everything of ASCII but digits and letters.
NOT_ALNUM = bytes(b for b in range(0x80) if not chr(b).isalnum())

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(separators: bytes, fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if fold:
        values[0x41:0x5B] = values[0x61:0x7B]
    values[list(separators)] = 0
    return values


class Kept(dict):
    """What a worker process keeps for itself; it never travels with a function."""

    def __reduce__(self):
        return Kept, ()


_powers = Kept()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base and of its inverse modulo 2^64, kept by the worker process."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK_BYTES + 64), base & _MASK, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def forget() -> None:
    """Drops the powers that the worker process keeps."""
    _powers.clear()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one offset more than texts). Null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = pa.compute.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``limit`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    start, before = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


@dataclass
class Words:
    """The words of a chunk of texts, in order."""

    hashes: np.ndarray  # uint64
    starts: np.ndarray  # byte of the chunk where the word begins
    ends: np.ndarray
    bounds: np.ndarray  # word index where each text begins, one more than texts

    def docs(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words_of(column: pa.Array, separators: bytes = WHITE, fold: bool = True) -> Words:
    """Words of each text, hashed with A-Z folded to lower case."""
    data, offsets = text_buffer(column)
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    values = _byte_values(separators, fold)
    inside = (values != 0)[data]
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    heads = offsets[:-1]
    edge[heads[heads < n]] = True
    at = np.flatnonzero(edge)
    at_end = np.append(at[1:], n)
    word = inside[at]
    starts, ends = at[word], at_end[word]
    up, down = powers(n)
    if len(starts):
        summed = np.add.reduceat(values[data] * up, starts)
        hashes = mix(summed * down[starts] + (ends - starts).astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on, as far as all ``k`` exist; across texts too."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + hashes[j : j + n]
    return mix(out + np.uint64(k))


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingles of each text; all words as one if there are fewer."""
    every = grams(words.hashes, k)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= k:
            found = np.sort(every[a : b - k + 1])
            if len(found) > 1:
                found = found[np.append(True, found[1:] != found[:-1])]
            out.append(found)
        else:
            out.append(grams(words.hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from one array a row."""
    sizes = np.fromiter((len(x) for x in parts), np.int32, len(parts))
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))
