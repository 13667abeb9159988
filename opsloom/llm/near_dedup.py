"""MinHash near-duplicate groups.

Minima of many universal hashes, cut into bands, bring alike texts into one bucket. Candidates are
verified by the agreement of their signatures and then on their full shingle sets, and verified
links become connected components.

No bucket is expanded into all its pairs. Equal sets are one candidate from the start. First each
candidate is compared with one hub, the best connected member of its buckets. What is left are
pairs of a bucket that lie in different components; of those, only pairs can be linked whose sets
still allow it: shingles that no other candidate has cannot be common, and a bitmap of each set
bounds their intersection from above. Both are decided inside the join, which emits no other pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import _ODD, _SPREAD_1, _SPREAD_2, finish, lowered_words, map_batches, mix, shingle_hashes, staged
from opsloom.llm.components import connected_components

SHINGLE_WORDS = 5
# Two texts with a similarity of 0.75 meet in none of the bands with probability
# (1 - 0.75 ** ROWS) ** BANDS = 5e-6, more similar ones with far less.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
# Links hold from 100 * intersection >= PERCENT * union on.
PERCENT = 75
# 64-bit words of the bitmap that bounds an intersection from above.
WORDS = 32
# Signatures of such texts agree in 96 of 128 places on average; 66 is six deviations below.
MIN_AGREEING = 66

with np.errstate(over="ignore"):
    _FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * _ODD, _SPREAD_1) | np.uint64(1)
    _SHIFTS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * _ODD, _SPREAD_2)


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and where each text starts."""
    hashes, owner = shingle_hashes(*lowered_words(column), SHINGLE_WORDS)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(column) + 1))


def _signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The least value of each hash function over each non-empty set."""
    filled = np.flatnonzero(np.diff(bounds))
    result = np.zeros((len(bounds) - 1, HASHES), np.uint32)
    if len(filled):
        for k in range(HASHES):
            values = ((hashes * _FACTORS[k] + _SHIFTS[k]) >> np.uint64(32)).astype(np.uint32)
            result[filled, k] = np.minimum.reduceat(values, bounds[filled])
    return result


def _totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.int64)


def sign(frame: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, the size and a 128-bit hash of its shingle set, and one bucket key per band."""
    source = frame.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, bounds = _sets(batch.column(1))
            signatures = _signatures(hashes, bounds).astype(np.uint64)
            buckets = np.tile(finish(np.arange(BANDS, dtype=np.uint64)), (batch.num_rows, 1))
            for row in range(ROWS):
                buckets = mix(buckets, signatures[:, row::ROWS])
            ends = pa.array(np.arange(0, buckets.size + 1, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(bounds)),
                    pa.array(_totals(finish(hashes), bounds)),
                    pa.array(_totals(mix(hashes, _SPREAD_2), bounds)),
                    pa.ListArray.from_arrays(ends, pa.array(buckets.ravel().astype(np.int64))),
                ],
                names=["id", "n_shingles", "set_high", "set_low", "buckets"],
            )

    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, compute, f"id {kind}, n_shingles long, set_high long, set_low long, buckets array<long>")


def shingle_sets(frame: DataFrame) -> DataFrame:
    """``id``, signature and full shingle set of the rows ``id, text``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, bounds = _sets(batch.column(1))
            signatures = [s.tobytes() for s in _signatures(hashes, bounds)]
            sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signatures, pa.binary()), sets], names=["id", "signature", "set"])

    kind = frame.schema["id"].dataType.simpleString()
    return map_batches(frame, compute, f"id {kind}, signature binary, set array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(u, v)`` that are linked: signatures first, then the full sets."""
    left = sets.select(F.col("id").alias("v"), F.col("signature").alias("signature_v"), F.col("set").alias("set_v"))
    right = sets.select(F.col("id").alias("u"), F.col("signature").alias("signature_u"), F.col("set").alias("set_u"))
    # The hub side is joined last, so that a hub's set is copied only as the rows stream by.
    rows = pairs.join(left, "v").join(right, "u").select("u", "v", "signature_u", "signature_v", "set_u", "set_v")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            lists = [batch.column(4), batch.column(5)]
            flat = [c.values.to_numpy().view(np.uint64) for c in lists]
            ends = [c.offsets.to_numpy() for c in lists]
            for i in range(batch.num_rows):
                one, two = (np.frombuffer(batch.column(c)[i].as_py(), np.uint32) for c in (2, 3))
                if np.count_nonzero(one == two) < MIN_AGREEING:
                    continue
                a, b = (values[e[i] : e[i + 1]] for values, e in zip(flat, ends, strict=True))
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= PERCENT * (len(a) + len(b) - both):
                    linked.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(linked, pa.int64())) for c in (0, 1)], names=["u", "v"])

    kind = pairs.schema["u"].dataType.simpleString()
    return map_batches(rows, check, f"u {kind}, v {kind}")


def _hub_pairs(members: DataFrame) -> DataFrame:
    """Each candidate with the best connected other member of its buckets."""
    degree = members.groupBy("id").agg(F.sum(F.col("size") - 1).alias("degree"))
    ranked = members.join(degree, "id").select("bucket", "id", "degree")
    hubs = ranked.groupBy("bucket").agg(F.max_by("id", F.struct("degree", "id")).alias("hub"), F.max("degree").alias("reach"))
    offers = members.join(hubs, "bucket").where("hub <> id")
    best = offers.groupBy("id").agg(F.max_by("hub", F.struct("reach", "hub")).alias("hub"))
    return best.select(F.col("hub").alias("u"), F.col("id").alias("v"))


def _bitmaps(sets: DataFrame) -> DataFrame:
    """``id, size``, the set as a bitmap of hashed shingles, and how many shingles it does not show."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            bounds = lists.offsets.to_numpy()
            hashes = lists.values.to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            bits = np.zeros((batch.num_rows, WORDS * 64), np.uint8)
            bits[owner, (finish(hashes[bounds[0] : bounds[-1]]) % np.uint64(WORDS * 64)).astype(np.int64)] = 1
            size = np.diff(bounds).astype(np.int64)
            words = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(size - bits.sum(axis=1, dtype=np.int64)), *(pa.array(words[:, k].copy()) for k in range(WORDS))],
                names=["id", "size", "excess", *(f"w{k}" for k in range(WORDS))],
            )

    kind = sets.schema["id"].dataType.simpleString()
    words = ", ".join(f"w{k} long" for k in range(WORDS))
    return map_batches(sets.select("id", "set"), compute, f"id {kind}, size long, excess long, {words}")


def _open_pairs(members: DataFrame, component: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of one bucket in different components that may be linked still."""
    labelled = members.select("bucket", "id").join(component, F.col("id") == F.col("node"), "left")
    labelled = labelled.select("bucket", "id", F.coalesce("component", "id").alias("component"))
    spread = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_rows = staged(labelled.join(spread.where("low <> high"), "bucket").select("bucket", "id", "component"), "open")
    involved = sets.join(open_rows.select("id").distinct(), "id", "left_semi")
    holders = involved.select("id", F.explode("set").alias("shingle")).groupBy("shingle")
    alone = holders.agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1").groupBy("id").agg(F.count("*").alias("own"))
    sizes = _bitmaps(involved).join(alone, "id", "left").withColumn("shared", F.col("size") - F.coalesce("own", F.lit(0)))
    rows = staged(open_rows.join(sizes, "id"), "open-sizes")
    a, b = rows.alias("a"), rows.alias("b")
    # Both terms are never less than the intersection: neither set has more shared shingles, and
    # common shingles share a bit unless they were added to one that was set already.
    common = sum((F.bit_count(F.col(f"a.w{k}").bitwiseAND(F.col(f"b.w{k}"))) for k in range(WORDS)), F.lit(0))
    most = F.least("a.shared", "b.shared")
    close = F.least(most, common + F.least("a.excess", "b.excess"))
    union = F.col("a.size") + F.col("b.size")
    may = (
        (F.col("a.bucket") == F.col("b.bucket"))
        & (F.col("a.id") < F.col("b.id"))
        & (F.col("a.component") != F.col("b.component"))
        & (most * 100 >= (union - most) * PERCENT)
        & (close * 100 >= (union - close) * PERCENT)
    )
    return a.join(b, may).select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()


def near_duplicate_groups(frame: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` for every row.

    A text's set is its distinct five-word shingles, words split at ASCII white space with A-Z
    lowered; fewer words make one shingle. Null and empty texts have an empty set and are linked
    with nothing, like rows with a null key. Rows of the same key are one document. ``kept`` is
    true for the least key of each component. Columns other than the two are not read.
    """
    signed = staged(sign(frame, key, text), "signed")
    linkable = signed.where("n_shingles > 0 and id is not null")
    same = linkable.groupBy("set_high", "set_low").agg(F.min("id").alias("first"), F.min_by("buckets", "id").alias("buckets"))
    same = staged(same, "sets")
    banded = same.select(F.col("first").alias("id"), F.explode("buckets").alias("bucket")).distinct()
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(banded.join(shared, "bucket"), "members")
    texts = frame.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sets = staged(shingle_sets(texts.join(members.select("id").distinct(), "id", "left_semi")), "shingles")
    links = staged(verified(_hub_pairs(members), sets), "links")
    component = connected_components(links)
    more = staged(verified(_open_pairs(members, component, sets), sets), "links")
    component = connected_components(component.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
    grouped = same.drop("buckets").join(component, F.col("first") == F.col("node"), "left")
    grouped = grouped.select("set_high", "set_low", F.coalesce("component", "first").alias("component_id"))
    placed = linkable.select("id", "n_shingles", "set_high", "set_low").join(grouped, ["set_high", "set_low"])
    alone = signed.where("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    result = placed.select("id", "n_shingles", "component_id").union(alone)
    return result.select(F.col("id").alias(key), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
