"""Suffix-array deduplication: bytes covered by a 200-byte string that starts twice are removed.

A suffix for each byte would be many times the corpus. Windows of 200 bytes whose rarest-looking
32-byte gram (the one of least hash) is the same occurrence form one *stretch*; the suffix that
starts at that gram, the anchor, stands for all of them. Equal windows have equal anchors at equal
distances, whatever surrounds them, so they can only be found among stretches of one anchor.

1. Stretches are range-partitioned by the leading bytes of their anchor suffix with splitters from
   a bounded sample of texts, and sorted. Stretches with one anchor and equal content are repeated
   in whole; an anchor that occurs once has no repeated window; the rest is open.
2. The distinct contents of open anchors are cut from the texts, range-partitioned the same way,
   and the windows of each anchor sorted by multikey quicksort: groups with equal words so far are
   sorted by the next eight bytes until they are alone or 200 bytes long.
3. Anchors at the first or last place of a sorted bucket may go on in the next one. Their windows
   are compared across boundaries by a 128-bit hash, which also splits a hot anchor over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.llm.common import finish, map_batches, mix, staged, text_bytes, unused

WINDOW, GRAM = 200, 32
# Texts, and later open stretches, the splitters are taken from.
SAMPLE_TEXTS, SAMPLE_STRETCHES = 2_000, 50_000
# Bytes scanned at once, and stretches of a bucket sorted at once.
SCAN_BYTES, SORT_ROWS, SORT_PIECES = 1 << 18, 1 << 15, 1 << 11

_PLACES = (1 << 20) - 1  # place in a scan, in the low bits of a gram's hash
REPEATED, OPEN, OPEN_REPEATED = 0, 1, 2


def _pack(first: np.ndarray, more: np.ndarray, anchor: np.ndarray, check: np.ndarray) -> np.ndarray:
    """First window, further windows, distance to the anchor and a check of the row in one long."""
    return (first << 32) | (more << 24) | (anchor << 16) | check


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 32, (packed >> 24) & 0xFF, (packed >> 16) & 0xFF


def _windows(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of the 32 bytes from each place, and of the 200 bytes from each place."""
    power = finish(data.astype(np.uint64) + np.uint64(1))
    kept = {}
    size = 1
    while size < 128:
        power = mix(power[:-size], power[size:])
        size *= 2
        kept[size] = power
    whole = len(data) - WINDOW + 1
    return kept[32], mix(mix(kept[128][:whole], kept[64][128 : 128 + whole]), kept[8][192 : 192 + whole])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    least, size = values, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count = len(values) - width + 1
    return np.minimum(least[:count], least[width - size : width - size + count])


def stretches(column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, first window, further windows, anchor distance, leading bytes, anchor hash, content hash."""
    data, offsets = text_bytes(column)
    for begin in range(0, max(0, len(data) - WINDOW + 1), SCAN_BYTES):
        part = data[begin : begin + SCAN_BYTES + WINDOW - 1]
        if len(part) < WINDOW:
            break
        grams, windows = _windows(part)
        places = np.arange(len(grams), dtype=np.uint64)
        marked = (grams & ~np.uint64(_PLACES)) | places
        anchor = (_least(marked, WINDOW - GRAM + 1) & np.uint64(_PLACES)).astype(np.int64)
        start = np.arange(begin, begin + len(anchor))
        row = np.searchsorted(offsets, start, side="right") - 1
        inside = start + WINDOW <= offsets[row + 1]
        change = np.ones(len(anchor), bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], len(anchor)) - 1
        first, last = first[inside[first]], last[inside[first]]
        if not len(first):
            continue
        at = anchor[first]
        lead = np.zeros(len(first), np.uint64)
        for k in range(8):
            lead = (lead << np.uint64(8)) | part[at + k]
        content = mix(mix(windows[first], windows[last]), (last - first).astype(np.uint64))
        yield row[first], begin + first - offsets[row[first]], last - first, at - first, lead, grams[at], content


_ORDER = ("lead", "gram", "content", "stretch", "row")


def _ordered(*columns: np.ndarray) -> np.ndarray:
    """Keys that compare as the numbers of ``_ORDER``, signed like Spark's own sort.

    Place and row come last, so that any number of equal stretches can be split over ranges; the
    place comes first of the two because a sampled text shows all its places.
    """
    wide = np.column_stack([c.view(np.uint64) ^ np.uint64(1 << 63) for c in columns]).astype(">u8")
    return np.ascontiguousarray(wide).view(f"S{8 * len(columns)}").ravel()


def _place_among(splitters: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return np.searchsorted(splitters, keys, side="right").astype(np.int32)


def _split(sample: pa.Table, parts: int) -> np.ndarray:
    """At most ``parts - 1`` splitters at even steps through the sorted sample."""
    keys = np.sort(_ordered(*(sample.column(c).to_numpy() for c in _ORDER)))
    steps = (np.arange(1, parts) * len(keys)) // parts
    return np.unique(keys[steps]) if len(keys) else keys


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together to at least ``rows`` rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _check(column: str) -> Column:
    """Sixteen more bits that tell rows apart, carried inside the packed stretch."""
    return F.pmod(F.hash(F.col(f"`{column}`")), F.lit(1 << 16)).cast("long")


def _scan(rows: DataFrame, splitters: np.ndarray | None) -> DataFrame:
    """The stretches of ``__row, check, text``, with their range if there are splitters."""
    shared = None if splitters is None else rows.sparkSession.sparkContext.broadcast(splitters)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, check = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, first, more, anchor, lead, gram, content in stretches(batch.column(2)):
                values = [lead, gram, content, _pack(first, more, anchor, check[row]), ids[row]]
                columns, names = list(map(_signed, values)), list(_ORDER)
                if shared is not None:
                    part = _place_among(shared.value, _ordered(*values))
                    columns, names = [*columns, pa.array(part)], [*names, "part"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "lead long, gram long, content long, stretch long, row long"
    return map_batches(rows, scan, schema if splitters is None else schema + ", part int")


def _runs_of(*columns: np.ndarray) -> np.ndarray:
    """Number of the run of equal values each place lies in."""
    new = np.zeros(len(columns[0]), bool)
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def _sort_stretches(found: DataFrame, parts: int) -> DataFrame:
    """Repeated stretches, and one stretch of each content of an open anchor."""
    dealt = found.repartitionById(parts, "part").drop("part")
    dealt = dealt.sortWithinPartitions(*_ORDER)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, SORT_ROWS):
            lead, gram, content = (batch.column(c).to_numpy() for c in range(3))
            anchor = _runs_of(lead, gram)
            same = _runs_of(anchor, content)
            copies = np.bincount(same)[same]
            first = np.ones(len(same), bool)
            first[1:] = same[1:] != same[:-1]
            contents = np.bincount(anchor[first])[anchor]
            # The anchors at both ends may go on in another bucket, so they stay open.
            is_open = (contents > 1) | (anchor == anchor[0]) | (anchor == anchor[-1])
            kind = np.where(copies > 1, REPEATED, -1)
            kind[first & is_open] = np.where(copies[first & is_open] > 1, OPEN_REPEATED, OPEN)
            keep = pa.array(np.flatnonzero(kind >= 0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(keep) for c in range(5)), pa.array(kind.astype(np.int8)).take(keep)],
                names=[*_ORDER, "kind"],
            )

    return map_batches(dealt, decide, "lead long, gram long, content long, stretch long, row long, kind byte")


def _cut(rows: DataFrame, wanted: DataFrame, splitters: np.ndarray) -> DataFrame:
    """The bytes of the open stretches, each with its range."""
    stretch = F.struct("stretch", "lead", "gram", "content", "kind")
    # Bounded by the length of the text: every stretch starts at a place of its own.
    lists = wanted.groupBy("row").agg(F.sort_array(F.collect_list(stretch)).alias("wanted"))
    joined = rows.join(lists, rows["__row"] == lists["row"]).select("row", "check", "text", "wanted")
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            packed, lead, gram, content, kind = (c.to_numpy() for c in lists.values.slice(ends[0], ends[-1] - ends[0]).flatten())
            # Rows that share a hash by accident differ in the check.
            own = (packed & 0xFFFF) == batch.column(1).to_numpy()[owner]
            owner, packed, lead, gram, content, kind = (c[own] for c in (owner, packed, lead, gram, content, kind))
            first, more, _ = _unpack(packed)
            start = offsets[owner] + first
            size = more + WINDOW
            bounds = np.zeros(len(size) + 1, np.int64)
            np.cumsum(size, out=bounds[1:])
            places = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], size)
            blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(data[places])])
            row = batch.column(0).to_numpy()[owner]
            part = _place_among(shared.value, _ordered(lead, gram, content, packed, row))
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (lead, gram, content, row, packed, kind)), blob.cast(pa.binary()), pa.array(part)],
                names=["lead", "gram", "content", "row", "stretch", "kind", "bytes", "part"],
            )

    schema = "lead long, gram long, content long, row long, stretch long, kind byte, bytes binary, part int"
    return map_batches(joined, cut, schema)


def repeated_windows(data: np.ndarray, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which windows of ``data`` equal another one of their group, by multikey quicksort.

    Windows are ordered by group; groups are split by the next eight bytes, and a window alone in
    its group is done with.
    """
    padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : k + len(data)]
    active = np.argsort(group, kind="stable")
    group = _runs_of(group[active])
    for depth in range(-1, WINDOW // 8):
        if depth >= 0:
            word = words[start[active] + 8 * depth]
            heads = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, int)
            mixed = np.zeros(len(heads), bool)
            mixed[group[word != word[heads][group]]] = True
            unsorted = np.flatnonzero(mixed[group])
            if len(unsorted):
                order = unsorted[np.lexsort((word[unsorted], group[unsorted]))]
                active[unsorted], word[unsorted] = active[order], word[order]
            group = _runs_of(group, word)
        several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        active, group = active[several], group[several]
        group = _runs_of(group) if len(group) else group
        if not len(active):
            break
    found = np.zeros(len(start), bool)
    found[active] = True
    return found


def _sort_windows(pieces: DataFrame, parts: int) -> DataFrame:
    """Runs of repeated windows, and the hashes of windows whose anchor may go on elsewhere."""
    dealt = pieces.repartitionById(parts, "part").drop("part").sortWithinPartitions(*_ORDER)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, SORT_PIECES):
            lead, gram, row, packed, kind = (batch.column(c).to_numpy() for c in (0, 1, 3, 4, 5))
            data, offsets = text_bytes(batch.column(6))
            anchor = _runs_of(lead, gram)
            first, more, distance = _unpack(packed)
            count = more + 1
            piece = np.repeat(np.arange(len(count)), count)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = offsets[piece] + step
            ahead = distance[piece] - step  # bytes from the start of the window to its anchor
            found = repeated_windows(data, start, anchor[piece] * (WINDOW + 1) + ahead)
            edge = (anchor[piece] == anchor[0]) | (anchor[piece] == anchor[-1])
            wanted = kind[piece] == OPEN
            head, tail = found & wanted, found & wanted
            head[1:] &= ~tail[:-1] | (piece[1:] != piece[:-1])
            tail[:-1] &= ~(found & wanted)[1:] | (piece[1:] != piece[:-1])
            a, b = np.flatnonzero(head), np.flatnonzero(tail)
            spans = [row[piece[a]], first[piece[a]] + step[a], step[b] - step[a], packed[piece[a]] & 0xFFFF]
            # Undecided windows go on with their place; of decided ones each text goes on once, to
            # be met by windows of other buckets.
            out = np.flatnonzero(edge)
            high, low = np.zeros(len(out), np.uint64), np.zeros(len(out), np.uint64)
            if len(out):
                _, windows = _windows(data)
                _, again = _windows(data ^ np.uint8(0x5A))
                high, low = windows[start[out]], mix(again[start[out]], windows[start[out]])
            undecided = (wanted & ~found)[out]
            decided = np.flatnonzero(~undecided)
            _, one = np.unique(high[decided], return_index=True)
            sent = np.concatenate([np.flatnonzero(undecided), decided[one]])
            out, high, low, undecided = out[sent], high[sent], low[sent], undecided[sent]
            numbers = [row[piece[out]], first[piece[out]] + step[out], packed[piece[out]] & 0xFFFF, undecided.astype(np.int64)]
            target = (high % np.uint64(parts)).astype(np.int32)
            order = np.argsort(target, kind="stable")
            table = np.column_stack([high.view(np.int64), low.view(np.int64), *numbers])[order]
            starts = np.flatnonzero(np.append(True, np.diff(target[order]) != 0)) if len(out) else np.zeros(0, np.int64)
            blocks = [t.tobytes() for t in np.split(table, starts[1:])] if len(out) else []
            size, none = len(spans[0]), [None] * len(blocks)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([*c.tolist(), *none], pa.int64()) for c in spans),
                    pa.array([*[None] * size, *target[order][starts].tolist()], pa.int32()),
                    pa.array([*[None] * size, *blocks], pa.binary()),
                ],
                names=["row", "first", "more", "check", "part", "block"],
            )

    return map_batches(dealt, compare, "row long, first long, more long, check long, part int, block binary")


def _meet_across(blocks: DataFrame, parts: int) -> DataFrame:
    """Undecided windows that equal a window sent from elsewhere.

    Windows are dealt by their hash, and no bucket sends a text twice unless it is undecided, so
    neither a hot anchor nor a hot window fills one task.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(b, np.int64).reshape(-1, 6) for batch in batches for b in batch.column(1).to_pylist()]
        if not held:
            return
        table = np.concatenate(held)
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        same = _runs_of(table[:, 0], table[:, 1])
        table = table[(np.bincount(same)[same] > 1) & (table[:, 5] == 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(table[:, 2].copy()), pa.array(table[:, 3].copy()), pa.array(np.zeros(len(table), np.int64)), pa.array(table[:, 4].copy())],
            names=["row", "first", "more", "check"],
        )

    return map_batches(blocks.repartitionById(parts, "part"), meet, "row long, first long, more long, check long")


def repeated_spans(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``row``, ``check``, first window and further windows of all repeated windows of the rows."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.count()
    share = min(1.0, SAMPLE_TEXTS / max(1, texts))
    sample = rows if share == 1.0 else rows.sample(share, 7)
    splitters = _split(_scan(sample, None).toArrow(), parts)
    decided = staged(_sort_stretches(_scan(rows, splitters), parts), "stretches")
    wanted = decided.where(F.col("kind") != REPEATED)
    share = min(1.0, SAMPLE_STRETCHES / max(1, wanted.count()))
    sample = wanted if share == 1.0 else wanted.sample(share, 7)
    splitters = _split(sample.select(*_ORDER).toArrow(), parts)
    compared = staged(_sort_windows(_cut(rows, wanted, splitters), parts), "windows")
    whole = decided.where(F.col("kind") != OPEN).selectExpr(
        "row", "shiftright(stretch, 32) as first", "shiftright(stretch, 24) & 255 as more", "stretch & 65535 as check"
    )
    inner = compared.where("part is null").select("row", "first", "more", "check")
    outer = _meet_across(compared.where("part is not null").select("part", "block"), parts)
    return whole.union(inner).union(outer)


def _covered(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of bytes covered by windows ``(first, more)``."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    begin, end = spans[:, 0], np.maximum.accumulate(spans[:, 0] + spans[:, 1] + WINDOW)
    new = np.append(True, begin[1:] > end[:-1])
    return np.column_stack([begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]])


def remove_repeats(frame: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``frame`` with the repeated bytes of ``text`` removed, and what was removed.

    Every byte covered by a ``WINDOW``-byte string that also starts elsewhere, in the same or
    another row, goes; overlaps count, and strings are judged on the input. Null texts count as
    empty. Repeated rows repeat each other. Adds ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` of the remaining bytes and ``kept_text``: the characters that are not covered
    in whole, since a repeat may begin or end inside a character. Columns of these names are
    replaced, all others kept.
    """
    spark = frame.sparkSession
    added = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
    kept = [c for c in frame.columns if c not in added]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    own, other, check, listed = unused(source, "row_hash", "span_row", "row_check", "row_spans")
    # A hash that tells rows apart by key and text; equal rows are one.
    source = source.withColumn(own, F.xxhash64(F.col(f"`{text}`"), F.col(f"`{key}`")))
    rows = source.select(F.col(own).alias("__row"), _check(text).alias("check"), F.col(f"`{text}`").alias("text"))
    long_enough = rows.where(F.octet_length("text") >= WINDOW)
    spans = repeated_spans(spark, long_enough)
    # Bounded by the length of the text, as above.
    lists = spans.groupBy(F.col("row").alias(other)).agg(F.collect_set(F.struct("first", "more", "check")).alias(listed))
    joined = source.withColumn(check, _check(text)).join(lists, F.col(own) == F.col(other), "left").drop(own, other)
    place = kept.index(text)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            check = batch.column(len(kept)).to_numpy()
            values = []
            for i, (content, spans) in enumerate(zip(batch.column(place).to_pylist(), batch.column(len(kept) + 1), strict=True)):
                raw = (content or "").encode()
                runs = np.zeros((0, 2), np.int64)
                if spans.is_valid:
                    table = np.column_stack([c.to_numpy() for c in spans.values.flatten()])
                    own = table[table[:, 2] == check[i]]
                    runs = _covered(own) if len(own) else runs
                values.append((len(raw), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), *_without(raw, runs)))
            counts = [pa.array([v[k] for v in values], pa.int64()) for k in range(3)]
            texts = [pa.array([v[k] for v in values], pa.string()) for k in (3, 4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *counts, *texts], names=[*kept, *added])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.select(*(F.col(f"`{c}`") for c in kept)).schema.fields]
    types = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    return map_batches(joined, remove, ", ".join([*fields, types]))


def _without(raw: bytes, runs: np.ndarray) -> tuple[str, str]:
    """The hash of the bytes outside the runs, and the characters not covered in whole."""
    digest, parts, at, kept_at = hashlib.sha256(), [], 0, 0
    for begin, end in runs.tolist():
        digest.update(raw[at:begin])
        at = end
        # Move both ends inwards to the start of a character.
        while begin < end and raw[begin] & 0xC0 == 0x80:
            begin += 1
        while end > begin and end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        parts.append(raw[kept_at:begin])
        kept_at = end
    digest.update(raw[at:])
    parts.append(raw[kept_at:])
    return digest.hexdigest(), b"".join(parts).decode()

