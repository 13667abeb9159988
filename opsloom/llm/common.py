"""Helpers the text operators share: Arrow batches as byte arrays, word hashes, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from opsloom.functions.shipping import ship
from opsloom.functions.staging import materialize

# Write a table to the shared folder and return a scan of it; it survives lost executors.
staged = materialize

# Rows and bytes of one Arrow batch handed to Python: a batch of very long texts stays small.
BATCH_ROWS = 256
BATCH_BYTES = 2 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPREAD_1 = np.uint64(0xBF58476D1CE4E5B9)
_SPREAD_2 = np.uint64(0x94D049BB133111EB)


def unused(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores at its end as no column of ``frame`` has."""
    taken = {c.lower() for c in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def map_batches(
    frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, *, rows: int = BATCH_ROWS
) -> DataFrame:
    """``mapInArrow`` with batches bounded in rows and bytes; the bounds hold for plans that run from now on."""
    ship(frame.sparkSession)
    conf = frame.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return frame.mapInArrow(function, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column as one array, and where each row starts (one more entry)."""
    filled = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit hash of two 64-bit values, in order."""
    h = a * _SPREAD_1 + b
    h ^= h >> np.uint64(29)
    h *= _SPREAD_2
    h ^= h >> np.uint64(32)
    return h


def finish(h: np.ndarray) -> np.ndarray:
    return mix(h, _ODD)


# A hash of a run is the sum of a random value per byte times a power of _BASE by its place in the
# run: differences of one running total, so any number of runs costs one pass over the bytes.
_BASE = 0xD6E8FEB86659FD93
_BLOCK = 1 << 16


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base & (2**64 - 1), np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


with np.errstate(over="ignore"):
    _BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD, _SPREAD_1)
_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(pow(_BASE, -1, 2**64), _BLOCK)


def _powers_at(small: np.ndarray, base: int, places: np.ndarray) -> np.ndarray:
    blocks = _powers(pow(base, _BLOCK, 2**64), int(places.max() >> 16) + 1)
    return small[places & (_BLOCK - 1)] * blocks[places >> 16]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; a run never crosses from one row to the next."""
    edge = np.zeros(len(inside) + 1, np.int8)
    edge[:-1] = inside
    change = np.empty(len(inside) + 1, bool)
    change[0] = False
    np.not_equal(edge[1:], edge[:-1], out=change[1:])
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(inside))]
    first[borders] |= inside[borders]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[borders - 1] |= inside[borders - 1]
    return starts, np.flatnonzero(last) + 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    count = -(-len(data) // _BLOCK)
    rising = np.multiply.outer(_powers(pow(_BASE, _BLOCK, 2**64), count), _UP).ravel()[: len(data)]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * rising, out=total[1:])
    shifted = (total[ends] - total[starts]) * _powers_at(_DOWN, pow(_BASE, -1, 2**64), starts)
    return mix(shifted, (ends - starts).astype(np.uint64))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# White space that ends a word: space and the five control characters from tab to return.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def lowered_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lowered, split at ASCII white space; words per text."""
    data, offsets = text_bytes(column)
    data = _LOWER[data]
    starts, ends = runs(~_SPACE[data], offsets)
    per_text = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return run_hashes(data, starts, ends), per_text


def shingle_hashes(words: np.ndarray, per_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word shingles and the text of each; shorter texts give one of all words."""
    text = np.repeat(np.arange(len(per_text)), per_text)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.cumsum(per_text)
    firsts = ends - per_text
    chained = words.copy()
    for step in range(1, size):
        following = np.zeros_like(words)
        following[:-step or None] = words[step:]
        chained = mix(chained, following)
    whole = np.arange(len(words)) + size <= ends[text]
    hashes, owner = chained[whole], text[whole]
    short = np.flatnonzero((per_text > 0) & (per_text < size))
    if len(short):
        ones = []
        for t in short:
            h = words[firsts[t] : firsts[t] + 1].copy()
            for w in words[firsts[t] + 1 : ends[t]]:
                h = mix(h, w)
            ones.append(mix(h, np.uint64(per_text[t]))[0])
        hashes = np.concatenate([hashes, np.array(ones, np.uint64)])
        owner = np.concatenate([owner, short])
    return hashes, owner
