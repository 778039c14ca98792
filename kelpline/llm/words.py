"""Words of Arrow string columns as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; more only if a single word is longer.
SEGMENT = 2 * 1024 * 1024

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Which of the eight bytes of a block belong to a word, by their number.
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hand memory that is not used any more back to the system: a worker lives on, and its executor's memory is shared."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the offsets of the texts; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def _segments(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches that end at a blank."""
    begin = 0
    while begin < len(data):
        end = min(begin + SEGMENT, len(data))
        while end < len(data) and not _BLANK[data[end - 1]]:
            rest = np.flatnonzero(_BLANK[data[end : end + SEGMENT]])
            end = end + int(rest[0]) + 1 if len(rest) else min(end + SEGMENT, len(data))
        yield begin, end
        begin = end


def _hashes(part: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, fold: bool) -> np.ndarray:
    """Words to hashes, eight bytes of all words at a time."""
    padded = np.zeros(len(part) + 8, np.uint8)
    padded[: len(part)] = _FOLD[part] if fold else part
    blocks = np.ndarray((len(part) + 1,), "<u8", padded, strides=(1,))
    out = mix(sizes.astype(np.uint64))
    rows, done = np.arange(len(firsts)), 0
    while len(rows):
        left = sizes[rows] - done
        block = blocks[firsts[rows] + done] & _KEEP[np.minimum(left, 8)]
        out[rows] = mix(out[rows] ^ block)
        rows, done = rows[left > 8], done + 8
    return out


def split_words(data: np.ndarray, starts: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and byte after the last of every word of ``data``.

    ``starts`` are places where a word begins even if no blank precedes (the begin of a
    text); ``fold`` takes A to Z as a to z. Words that differ have different hashes but for
    the chance of 64 bits.
    """
    hashes, firsts, ends = [], [], []
    for low, high in _segments(data):
        part = data[low:high]
        solid = np.zeros(len(part) + 2, bool)
        np.logical_not(_BLANK[part], out=solid[1:-1])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        own = starts[np.searchsorted(starts, low, "right") : np.searchsorted(starts, high)] - low
        own = np.unique(own[solid[own] & solid[own + 1]])
        # a text that begins where another ends without a blank: one word ends and one begins
        edges = np.insert(edges, np.repeat(np.searchsorted(edges, own), 2), np.repeat(own, 2)) if len(own) else edges
        first, end = edges[::2], edges[1::2]
        if not len(first):
            continue
        hashes.append(_hashes(part, first, end - first, fold))
        firsts.append(first + low)
        ends.append(end + low)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(ends)


def hashed_words(texts: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and for each text where its words begin (one entry more than texts)."""
    data, offsets = text_bytes(texts)
    hashes, firsts, _ = split_words(data, offsets[:-1], fold)
    return hashes, np.searchsorted(firsts, offsets)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; one shorter sequence gives one hash, none gives none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n]
    return mix(total)


def small_slices(batch: pa.RecordBatch, column: str, most: int = SEGMENT) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, so that memory does not follow the batch."""
    _, offsets = text_bytes(batch[column])
    begin = 0
    while begin < len(batch):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end
    give_back()
