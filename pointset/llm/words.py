"""Word and n-gram hashing over Arrow string buffers, whole blocks at a time.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D).
The kernels never build Python strings: they read the UTF-8 bytes Spark sent.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD = "[^\\x20\\x09-\\x0D]+"
# Bytes of text hashed at once; a longer text is one block of its own.
BLOCK_BYTES = 1 << 19


def process_cache() -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    return sys.modules.setdefault("pointset_llm_cache", types.ModuleType("pointset_llm_cache")).__dict__


def free_memory() -> None:
    """Give freed memory back to the system.

    A Python worker serves task after task; what one has freed in pieces would stay
    with it beside what the next one needs.
    """
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        ctypes.CDLL(None).malloc_trim(0)


def _constants(seed: int):
    cache = process_cache()
    if ("words", seed) not in cache:
        rng = np.random.default_rng(1000 + seed)
        table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        base = np.uint64(int(rng.integers(1 << 40, 1 << 62)) | 1)
        cache["words", seed] = [table, base, np.ones(1, np.uint64), np.ones(1, np.uint64)]
    return cache["words", seed]


def _powers(seed: int, n: int):
    """Byte table, powers of the base and of its inverse modulo 2^64 up to ``n``."""
    known = _constants(seed)
    if len(known[2]) < n:
        size = max(n, 2 * BLOCK_BYTES)
        base = int(known[1])
        for slot, factor in ((2, base), (3, pow(base, -1, 1 << 64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            known[slot] = np.multiply.accumulate(steps)
    return known[0], known[2], known[3]


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(32)
    return h


@dataclass
class Block:
    """Consecutive texts of a batch: bytes, and where each text begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Byte ranges of the words of a block; ``bounds`` are the words of each text."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def text_blocks(texts, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, raw = texts.buffers()
    if len(texts) == 0:
        return
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, side="right")) - 1
        last = min(len(texts), max(last, first + 1))
        yield Block(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last
    free_memory()


def find_words(block: Block) -> Words:
    data, offsets = block.data, block.offsets
    n = len(data)
    if not n:
        return Words(np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64))
    inside = (data != 32) & ((data - np.uint8(9)) > 4)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[offsets < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data - np.uint8(65)) < 26, data + np.uint8(32), data)


def word_hashes(data: np.ndarray, words: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of every word."""
    if not len(words.starts):
        return np.empty(0, np.uint64)
    table, power, inverse = _powers(seed, len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(table[data] * power[: len(data)], out=sums[1:])
    h = (sums[words.ends] - sums[words.starts]) * inverse[words.starts]
    h += (words.ends - words.starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(h)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive items, built by doubling."""
    if n == 1 or len(h) < n:
        return h[: max(0, len(h) - n + 1)] if n > 1 else h
    half = n - n // 2
    part = grams(h, half)
    tail = part[n - half : n - half + len(h) - n + 1]
    both = part[: len(tail)] * np.uint64(0xC2B2AE3D27D4EB4F)
    both += tail
    both *= np.uint64(0x165667B19E3779F9)
    both += np.uint64(n)
    return mix(both)


def sliding(pick: np.ufunc, a: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` items."""
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    span = 1
    while span * 2 <= width:
        a = pick(a[:-span], a[span:])
        span *= 2
    return pick(a[:n], a[width - span : width - span + n])


def covered(live: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` items lie in a window of ``width`` that begins at a live position."""
    edge = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(live)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.cumsum(edge[:-1]) > 0


def same_text_windows(words: Words, width: int) -> np.ndarray:
    """Which windows of ``width`` words lie inside one text."""
    n = int(words.bounds[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    owner = words.owner()
    return owner[:n] == owner[width - 1 :]


def by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def whole_runs(batches, names: list[str]) -> Iterator[pa.Table]:
    """Tables that never end within a run of rows equal in the columns ``names``.

    For rows sorted by these columns; at most one run is held besides a batch.
    """
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        columns = [table.column(c) for c in names]
        last = [c[-1].as_py() for c in columns]
        cut = table.num_rows
        while cut and [c[cut - 1].as_py() for c in columns] == last:
            cut -= 1
        rest = table.slice(cut)
        if cut:
            yield table.slice(0, cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()
