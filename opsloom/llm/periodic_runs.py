"""Periodic runs: stretches of words that repeat one block, found by a dictionary of basic factors.

A basic factor is a stretch of ``2 ** k`` words. Level k names every factor by the names of its two
halves, equal factors of one text alike; factors that occur once need no name, and nothing that holds
them does. If a factor's next occurrences follow at one distance, no more than twice its length away,
that arithmetic progression proposes the distance as a period. The names also tell how far two places
agree, so every proposal is extended to the left and right in one step per level, and equal results
are kept once.

A run with period q and at least ``4 * q`` words is proposed by its own first factor of q to 2q - 1
words: within the run that factor cannot recur sooner than after q words, because q is the smallest
period, and three of its occurrences fit in. For the same reason a multiple of q is never proposed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import _SPACE, map_batches, mix, run_hashes, runs, text_bytes

# A run has at least this many words, and this many repetitions of its period.
MIN_WORDS, MIN_REPEATS = 6, 4


def _name(keys: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the places whose key occurs again, -1 elsewhere, and the distance to the next equal key.

    ``places`` ascend. Both results have one entry per word and one more, which is never named.
    """
    names, gaps = np.full(size + 1, -1, np.int64), np.zeros(size + 1, np.int64)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        ordered, at = keys[order], places[order]
        same = ordered[1:] == ordered[:-1]
        again = np.zeros(len(at), bool)
        again[1:] = same
        again[:-1] |= same
        number = np.zeros(len(at), np.int64)
        np.cumsum(~same, out=number[1:])
        names[at[again]] = number[again]
        gaps[at[:-1][same]] = at[1:][same] - at[:-1][same]
    return names, gaps


def _proposals(gaps: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First places and distances of the stretches whose factors occur three times in progression."""
    places = np.flatnonzero((gaps > 0) & (gaps <= 2 * length))
    distance = gaps[places]
    steady = gaps[places + distance] == distance
    places, distance = places[steady], distance[steady]
    first = np.ones(len(places), bool)
    first[1:] = (places[1:] != places[:-1] + 1) | (distance[1:] != distance[:-1])
    return places[first], distance[first]


def word_runs(words: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (place among all words), length and period of every run, by start, then period.

    ``words`` are 64-bit hashes of the words of all texts in order; no run crosses texts.
    """
    total = len(words)
    text = np.repeat(np.arange(len(per_text)), per_text)
    ends = np.repeat(np.cumsum(per_text), per_text)
    names, gaps = _name(mix(words, text.astype(np.uint64)).view(np.int64), np.arange(total), total)
    levels, starts, periods = [], [], []
    length = 1
    while True:
        levels.append(names)
        start, period = _proposals(gaps, length)
        starts.append(start)
        periods.append(period)
        named = np.flatnonzero(names >= 0)
        named = named[named + 2 * length <= ends[named]]
        whole = named[names[named + length] >= 0]
        if not len(whole):
            break
        names, gaps = _name(names[whole] * (total + 1) + names[whole + length], whole, total)
        length *= 2
    start, period = np.concatenate(starts), np.concatenate(periods)
    left, right = start.copy(), start.copy()
    for k in reversed(range(len(levels))):
        names, step = levels[k], 1 << k
        # No longer factors agree than those of the levels above, so one step per level is enough.
        here, there = names[np.minimum(right, total)], names[np.minimum(right + period, total)]
        right = np.where((here >= 0) & (here == there), right + step, right)
        # Place -1 is the entry that is never named.
        here, there = names[np.maximum(left - step, -1)], names[np.maximum(left - step, -1 - period) + period]
        left = np.where((here >= 0) & (here == there), left - step, left)
    size = right + period - left
    enough = size >= np.maximum(MIN_WORDS, MIN_REPEATS * period)
    found = np.unique(np.column_stack([left, period, size])[enough], axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kept: np.ndarray, per_text: np.ndarray) -> pa.Array:
    """The kept words of each text joined by one space."""
    text = np.repeat(np.arange(len(per_text)), per_text)[kept]
    starts, ends = starts[kept], ends[kept]
    edge = np.zeros(len(data) + 2, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    out = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    spaced = np.append(data, np.uint8(0x20))
    # The byte after a word that is not its text's last kept one is white space of the same text.
    inner = ends[:-1][text[1:] == text[:-1]]
    spaced[inner] = 0x20
    out[inner] = True
    words = np.bincount(text, minlength=len(per_text))
    sizes = np.bincount(text, weights=ends - starts, minlength=len(per_text)).astype(np.int64) + np.maximum(words - 1, 0)
    return _strings(spaced[out], sizes)


def find_runs(frame: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``runs`` and ``collapsed`` for every row.

    Words are split at ASCII white space. ``runs`` lists ``start`` (word number from 0), ``length`` and
    ``period`` of every stretch with smallest period q and at least ``max(6, 4 * q)`` words that no
    neighbouring word extends, by start, then period. ``collapsed`` joins by one space the words that
    are in no run, or only in the first period of each of theirs. Null, empty and blank texts have no
    words, no runs and an empty collapsed text. Rows are treated one by one: repeated rows and null
    keys change nothing. Other columns are not read. Words are compared by 64-bit hashes.
    """
    source = frame.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            starts, ends = runs(~_SPACE[data], offsets)
            firsts = np.searchsorted(starts, offsets)
            per_text = np.diff(firsts)
            begin, size, period = word_runs(run_hashes(data, starts, ends), per_text)
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, begin + period, 1)
            np.add.at(edge, begin + size, -1)
            kept = np.cumsum(edge[:-1]) == 0
            bounds = np.searchsorted(begin, firsts)
            number = begin - np.repeat(firsts[:-1], np.diff(bounds))
            cells = pa.StructArray.from_arrays([pa.array(c) for c in (number, size, period)], names=["start", "length", "period"])
            listed = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), cells)
            collapsed = _collapsed(data, starts, ends, kept, per_text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(per_text), listed, collapsed], names=["id", "n_words", "runs", "collapsed"])

    kind = source.schema["id"].dataType.simpleString()
    found = map_batches(source, search, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", key)


def with_periodic_tails(frame: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text``, in a tenth of the rows with a tail that repeats one block of its words.

    Rows are chosen and blocks placed by the crc32 ``h`` of the key as decimal text: where ``h % 10`` is
    0, with ``g = h // 10`` and n words, words from ``a = g % n`` on repeat the ``p = 1 + (n - a) // (3 + g % 8)``
    words that start there. Such a text is its words joined by one space. Rows with a null key or
    without words stay as they are.
    """
    hashed = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    source = frame.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), hashed.alias("h"))

    def rewrite(value: str, h: int) -> str:
        words = [w for w in value.translate(_BLANKS).split(" ") if w]
        if not words:
            return value
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        return " ".join(words[:a] + [words[a + i % p] for i in range(len(words) - a)])

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            chosen = [i for i, h in enumerate(batch.column(2).to_pylist()) if h is not None and h % 10 == 0 and texts[i].is_valid]
            if chosen:
                mask = np.zeros(batch.num_rows, bool)
                mask[chosen] = True
                changed = [rewrite(texts[i].as_py(), batch.column(2)[i].as_py()) for i in chosen]
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(changed, texts.type))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["id", "text"])

    kind = source.schema["id"].dataType.simpleString()
    rewritten = map_batches(source, change, f"id {kind}, text string")
    return rewritten.select(F.col("id").alias(key), F.col("text").alias(text))


_BLANKS = str.maketrans({c: " " for c in "\t\n\v\f\r"})


def run_digests(found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """The longest run and digests of all runs and of the collapsed text, one row per row of ``find_runs``."""
    ranked = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("__best", ranked)
    length, period = -F.col("__best.less"), F.col("__best.period")
    return rows.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("__best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(-1000L * __best.less) div __best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
