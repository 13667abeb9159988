"""Document fingerprints: bottom-k sketches of hashed five-word shingles.

A sketch keeps the k smallest distinct shingle hashes. Sketches of parts merge into the sketch of
the whole by keeping the k smallest of their union, and two sketches estimate resemblance,
containment and the number of distinct shingles. A text with fewer than k shingles is held whole,
so small texts are compared exactly.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsloom.llm.common import finish, lowered_words, map_batches, shingle_hashes

SHINGLE_WORDS = 5
SKETCH_SIZE = 128
# Hashes are kept with 48 bits: six bytes, eight characters of the fingerprint.
_DROP = np.uint64(16)
_SPAN = float(1 << 48)


def sketches(column: pa.Array, size: int = SKETCH_SIZE) -> list[np.ndarray]:
    """The bottom-k sketch of each text, ascending; null and empty texts have an empty sketch."""
    hashes, owner = shingle_hashes(*lowered_words(column), SHINGLE_WORDS)
    values = finish(hashes) >> _DROP
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    bounds = np.searchsorted(owner, np.arange(len(column) + 1))
    return [values[a : min(b, a + size)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def to_text(sketch: np.ndarray) -> str:
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return base64.b64encode(raw).decode()


def from_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, size: int = SKETCH_SIZE) -> np.ndarray:
    return np.union1d(a, b)[:size]


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SKETCH_SIZE) -> float:
    """Estimated intersection over union; two empty sketches are alike, an empty one is like no other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, size)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], side="right")) / len(union)


def distinct_shingles(sketch: np.ndarray, size: int = SKETCH_SIZE) -> float:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    if len(sketch) < size:
        return float(len(sketch))
    return (size - 1) * _SPAN / (float(sketch[size - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, size: int = SKETCH_SIZE) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``."""
    if not len(a):
        return 1.0
    alike = resemblance(a, b, size)
    union = distinct_shingles(merge(a, b, size), size)
    return min(1.0, alike * union / distinct_shingles(a, size))


def fingerprint_texts(frame: DataFrame, *, text: str = "text", size: int = SKETCH_SIZE) -> DataFrame:
    """``frame`` with ``fingerprint`` and ``shingles``, the estimated number of distinct shingles."""
    kept = [c for c in frame.columns if c not in ("fingerprint", "shingles")]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    place = kept.index(text)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sketches(batch.column(place), size)
            prints = pa.array([to_text(s) for s in found], pa.string())
            counts = pa.array([distinct_shingles(s, size) for s in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints, counts], names=[*kept, "fingerprint", "shingles"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    return map_batches(source, compute, ", ".join([*fields, "fingerprint string", "shingles double"]))


def merge_fingerprints(frame: DataFrame, keys: Sequence[str], *, size: int = SKETCH_SIZE) -> DataFrame:
    """One fingerprint per group, that of all its parts together, as rows of ``keys`` and ``hashes``.

    Hashes are made distinct and ranked with a limit, both of which Spark begins before it
    shuffles, so a group of any size sends at most k hashes from each task.
    """
    place = frame.columns.index("fingerprint")
    kept = [f.name for f in frame.schema.fields if f.name in keys]
    at = [frame.columns.index(k) for k in kept]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [from_text(p or "").astype(np.int64) for p in batch.column(place).to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(hashes)), [len(h) for h in hashes]))
            values = pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(rows) for i in at), values], names=[*kept, "hash"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields if f.name in keys]
    rows = map_batches(frame, unpack, ", ".join([*fields, "hash long"])).distinct()
    rank = F.row_number().over(Window.partitionBy(*kept).orderBy("hash"))
    smallest = rows.withColumn("rank", rank).where(F.col("rank") <= size)
    return smallest.groupBy(*kept).agg(F.sort_array(F.collect_list("hash")).alias("hashes"))


def in_order_with_guards(frame: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """``frame`` in ranges of ``key``, one range a partition, ordered inside; texts move once.

    Each range also gets, marked ``guard`` and sorted last, the first row of the range after it (the
    last range that of the first), so every row meets its follower without another join. The edges
    of the ranges are bounded by ``parts``.
    """
    ids = frame.select(F.col(key).alias("id"))
    points = [i / parts for i in range(1, parts)] or [0.5]
    edges = ids.agg(F.percentile_approx("id", points, 10_000).alias("edges")).first().edges or []
    edges = sorted(set(edges))
    place = F.when(F.col(key).isNull(), F.lit(0)).otherwise(
        F.lit(1) + F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(key))) if edges else F.lit(1)
    )
    placed = frame.withColumn("range", place)
    heads = placed.groupBy("range").agg(F.min(key).alias("head")).collect()
    heads = sorted((row.range, row.head) for row in heads)
    before = {r: heads[i - 1][0] for i, (r, _) in enumerate(heads)}
    is_head, previous = F.lit(False), F.lit(0)
    if heads:
        chosen = F.create_map(*[F.lit(x) for r, h in heads if h is not None for x in (r, h)] or [F.lit(-1), F.lit(-1)])
        is_head = F.col(key).eqNullSafe(F.try_element_at(chosen, F.col("range")))
        previous = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("range"))
    own = F.struct(F.col("range"), F.lit(False).alias("guard"))
    guard = F.struct(previous.alias("range"), F.lit(True).alias("guard"))
    copies = F.explode(F.when(is_head, F.array(own, guard)).otherwise(F.array(own)))
    rows = placed.withColumn("copy", copies).drop("range").select("*", "copy.range", "copy.guard").drop("copy")
    dealt = rows.repartitionById(len(edges) + 2, "range")
    return dealt.sortWithinPartitions("guard", F.col(key).asc_nulls_first(), F.col(text).asc_nulls_first())


def compare_with_edits(frame: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = SKETCH_SIZE) -> DataFrame:
    """Fingerprints of each text and of the text with its last quarter taken from the next one.

    Rows follow one another by ``key`` (nulls first, ties by text), the last is followed by the
    first. Null texts are empty. Returns ``key``, ``n_chars``, ``edited_sha256``, both fingerprints,
    ``near_edited`` and ``near_next``.
    """
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = frame.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = in_order_with_guards(source, "doc_id", "text", parts)
    id_type = source.schema["doc_id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last row waits for its follower in the next batch.
            table = pa.Table.from_batches([b for b in (held, batch) if b is not None]).combine_chunks()
            rows = table.to_batches()[0]
            held = rows.slice(rows.num_rows - 1)
            texts = rows.column("text").to_pylist()
            guards = rows.column("guard").to_pylist()
            own = [i for i in range(len(texts) - 1) if not guards[i]]
            if not own:
                continue
            first = sketches(rows.column("text"), size)
            edited = []
            for i in own:
                changed = len(texts[i]) // 4
                edited.append(texts[i][: len(texts[i]) - changed] + texts[i + 1][:changed])
            second = sketches(pa.array(edited, pa.string()), size)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(own)),
                    pa.array([len(texts[i]) for i in own], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array([to_text(first[i]) for i in own]),
                    pa.array([to_text(s) for s in second]),
                    pa.array([resemblance(first[i], s, size) for i, s in zip(own, second, strict=True)]),
                    pa.array([resemblance(first[i], first[i + 1], size) for i in own]),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    schema = f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_batches(ordered, compare, schema)
