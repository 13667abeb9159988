"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are 64-bit hashes of its words, of neighbouring pairs and of pairs with one or two
words between, each with its number of occurrences up to ``MOST``. The learner keeps two numbers per
feature, so each has a learning rate of its own, and the L1 term leaves most weights at exactly zero:
the model is a short sorted array of hashes and weights that every task can hold.

Fitting is a few rounds over a bounded sample of labelled texts. The sample is dealt by hash into a
fixed number of parts; in each round every part runs the learner from the shared state, and the parts'
states are averaged. Parts, orders and sums are fixed, so the same rows give the same model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import _LOWER, map_batches, mix, run_hashes, runs, ship, staged, text_bytes

# Labelled texts the model is fitted on, at most, whatever the corpus.
MAX_FIT_ROWS = 20_000
# Occurrences of a feature in one text that count.
MOST = 3
# Distances of the two words of a pair: neighbours, and one or two words between them.
DISTANCES = (1, 2, 3)
# Bytes of the beginnings of longer words, which forms of one word share.
BEGINNINGS = (4, 5, 6)

_WORD = np.zeros(256, bool)
_WORD[128:] = True
for _first, _last in ("09", "AZ", "az"):
    _WORD[ord(_first) : ord(_last) + 1] = True


@dataclass(frozen=True)
class LearnerSettings:
    """Rate, its smoothing, L1 and L2 of the learner.

    A feature counts in the parts in which at least ``min_in_part`` texts have it, and is learnt if it
    is in ``min_texts`` texts of those; of too many the commonest are.
    """

    alpha: float = 0.6
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 0.1
    rounds: int = 6
    parts: int = 8
    min_in_part: int = 2
    min_texts: int = 4
    max_features: int = 1 << 20


@dataclass(frozen=True)
class SparseWeights:
    """Ascending feature hashes, their non-zero weights, and the weight every text has."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def margins(self, hashes: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
        """Sum of weight times count for each of ``rows`` texts, given each occurrence's hash and text."""
        margin = np.full(rows, self.bias)
        if len(self.hashes) and len(hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            cell, count = np.unique(owner[known] * len(self.hashes) + at[known], return_counts=True)
            value = self.weights[cell % len(self.hashes)] * np.minimum(count, MOST)
            np.add.at(margin, cell // len(self.hashes), value)
        return margin


def occurrences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hash and text number of every occurrence in a batch; words are letters and digits, A-Z lowered."""
    data, offsets = text_bytes(column)
    starts, ends = runs(_WORD[data], offsets)
    lowered = _LOWER[data]
    words = run_hashes(lowered, starts, ends)
    text = np.searchsorted(offsets, starts, side="right") - 1
    hashes, owner = [mix(words, np.uint64(0))], [text]
    for distance in DISTANCES:
        same = text[distance:] == text[:-distance]
        hashes.append(mix(mix(words[:-distance], words[distance:]), np.uint64(distance))[same])
        owner.append(text[distance:][same])
    for size in BEGINNINGS:
        longer = ends - starts > size
        hashes.append(mix(run_hashes(lowered, starts[longer], starts[longer] + size), np.uint64(100 + size)))
        owner.append(text[longer])
    return np.concatenate(hashes), np.concatenate(owner)


def counted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of each text, by text and hash, with their counts up to ``MOST``."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return hashes[first], owner[first], np.minimum(np.diff(np.append(first, len(hashes))), MOST)


def learn(
    z: np.ndarray, n: np.ndarray, rows: Iterator[tuple[np.ndarray, np.ndarray, float]], settings: LearnerSettings
) -> None:
    """Run the learner over rows of feature numbers, counts and label; ``z`` and ``n`` change in place.

    Feature 0 is the constant and has no L1 term.
    """
    s = settings
    for features, counts, label in rows:
        zi, ni = z[features], n[features]
        root = np.sqrt(ni)
        l1 = np.full(len(features), s.l1)
        l1[features == 0] = 0.0
        w = _weights(zi, root, l1, s)
        margin = float(w @ counts)
        p = 1.0 / (1.0 + np.exp(-min(max(margin, -35.0), 35.0)))
        g = (p - label) * counts
        more = ni + g * g
        z[features] = zi + g - (np.sqrt(more) - root) / s.alpha * w
        n[features] = more


def _weights(z: np.ndarray, root: np.ndarray, l1: np.ndarray | float, s: LearnerSettings) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((s.beta + root) / s.alpha + s.l2))


def weights_of(z: np.ndarray, n: np.ndarray, settings: LearnerSettings) -> np.ndarray:
    l1 = np.full(len(z), settings.l1)
    l1[0] = 0.0
    return _weights(z, np.sqrt(n), l1, settings)


# Texts read at once, and slices of the state summed on their own.
READ_TEXTS, SLICES = 256, 16


def _sample(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_rows: int, parts: int) -> DataFrame:
    """One row per part with its labelled texts in the order of a hash of their key, written."""
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label"))
    known = known.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    chosen = known.withColumn("place", F.xxhash64("id")).orderBy("place", "id").limit(max_rows)
    texts = documents.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # The broadcast side has max_rows ids at most; of a repeated id the least text is learnt from.
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "place", "label").agg(F.min("text").alias("text"))
    dealt = rows.select(F.expr(f"int(pmod(place, {parts}))").alias("part"), F.struct("place", "label", F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    listed = dealt.repartition(parts, "part").groupBy("part").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return staged(listed.select("part", F.col("rows.label").alias("labels"), F.col("rows.text").alias("texts")), "toxicity-sample")


def _per_text(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct features, their text and counts, for a few texts at a time."""
    for begin in range(0, len(texts), READ_TEXTS):
        hashes, owner, counts = counted(*occurrences(texts.slice(begin, READ_TEXTS)))
        yield hashes, owner + begin, counts


def _frequent(sample: DataFrame, settings: LearnerSettings) -> np.ndarray:
    """Ascending hashes of the features that are learnt."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = [hashes for hashes, _, _ in _per_text(batch.column(0)[row].values)]
                hashes, texts = np.unique(np.concatenate(found), return_counts=True)
                enough = texts >= settings.min_in_part
                yield pa.RecordBatch.from_arrays([pa.array(hashes[enough].view(np.int64)), pa.array(texts[enough])], names=["feature", "texts"])

    tallied = map_batches(sample.select("texts"), count, "feature long, texts long").groupBy("feature").agg(F.sum("texts").alias("texts"))
    enough = tallied.where(F.col("texts") >= settings.min_texts).orderBy(F.desc("texts"), "feature").limit(settings.max_features)
    return np.sort(enough.select("feature").toArrow()["feature"].to_numpy().view(np.uint64))


def _examples(sample: DataFrame, features: np.ndarray) -> DataFrame:
    """One row per part: its texts' feature numbers, counts and labels as packed arrays."""
    shared = sample.sparkSession.sparkContext.broadcast(features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                texts = batch.column(2)[row].values
                sizes, numbers, values = np.zeros(len(texts), np.int64), [], []
                for hashes, owner, counts in _per_text(texts):
                    at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
                    inside = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                    np.add.at(sizes, owner[inside], 1)
                    numbers.append((at[inside] + 1).astype(np.int32))
                    values.append(counts[inside].astype(np.int8))
                labels = batch.column(1)[row].values.to_numpy()
                packed = [[c.tobytes()] for c in (sizes, np.concatenate(numbers), np.concatenate(values), labels)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), *map(pa.array, packed)], names=["part", "sizes", "features", "counts", "labels"])

    return staged(map_batches(sample, pack, "part int, sizes binary, features binary, counts binary, labels binary"), "toxicity-examples")


def _round(examples: DataFrame, z: np.ndarray, n: np.ndarray, settings: LearnerSettings) -> tuple[np.ndarray, np.ndarray]:
    """The state after every part has learnt from it, averaged in the order of the parts."""
    shared = examples.sparkSession.sparkContext.broadcast((z, n))
    width = -(-len(z) // SLICES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before_z, before_n = shared.value
        for batch in batches:
            for part, sizes, features, counts, labels in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = np.cumsum(np.frombuffer(sizes, np.int64))
                numbers, values = np.frombuffer(features, np.int32), np.frombuffer(counts, np.int8)
                rows = zip(np.split(numbers, ends[:-1]), np.split(values, ends[:-1]), np.frombuffer(labels), strict=True)
                z1, n1 = before_z.copy(), before_n.copy()
                learn(z1, n1, ((np.append(f, 0), np.append(c, 1).astype(np.float64), y) for f, c, y in rows), settings)
                moved = [(z1 - before_z).astype(np.float32), (n1 - before_n).astype(np.float32)]
                for k in range(SLICES):
                    cut = [d[k * width : (k + 1) * width].tobytes() for d in moved]
                    yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()), "part": pa.array([part], pa.int32()), "z": cut[:1], "n": cut[1:]})

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        sums = [sum(np.frombuffer(v, np.float32).astype(np.float64) for v in table[c].to_pylist()) for c in ("z", "n")]
        return pa.table({"slice": table["slice"][:1], "z": [sums[0].tobytes()], "n": [sums[1].tobytes()]})

    moves = map_batches(examples, run, "slice int, part int, z binary, n binary").groupBy("slice").applyInArrow(merge, "slice int, z binary, n binary")
    # SLICES rows, together two numbers per feature.
    merged = sorted(moves.collect(), key=lambda r: r["slice"])
    shared.unpersist()
    parts = examples.count()
    return tuple(old + np.concatenate([np.frombuffer(r[c]) for r in merged]) / parts if merged else old for old, c in ((z, "z"), (n, "n")))


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = MAX_FIT_ROWS,
    settings: LearnerSettings = LearnerSettings(),  # noqa: B008
) -> SparseWeights:
    """The model learnt from at most ``max_rows`` labelled texts, taken in the order of a hash of the id.

    ``labels`` holds the rows that may be learnt from; null ids and labels and unknown ids are left out,
    and of a repeated id the greatest label and the least text count. Null and empty texts have the
    constant feature only. Without any row the model is empty and scores 0.5. What reaches the driver is
    two numbers for each of at most ``max_features`` features.
    """
    sample = _sample(documents, labels, key, text, label, max_rows, settings.parts)
    features = _frequent(sample, settings)
    examples = _examples(sample, features)
    z, n = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for _ in range(settings.rounds):
        z, n = _round(examples, z, n, settings)
    weights = weights_of(z, n, settings)
    used = np.flatnonzero(weights[1:])
    return SparseWeights(features[used], weights[1:][used], float(weights[0]))


def score_toxicity(frame: DataFrame, model: SparseWeights, *, text: str = "text") -> DataFrame:
    """``frame`` with ``score`` (0 to 1, higher: label 1 is likelier) and ``predicted`` (1 from 0.5 on).

    Null texts count as empty, empty texts get the constant's score. Other columns are kept; columns of
    the two names are replaced. The score depends on the text alone, so repeated rows score alike.
    """
    kept = [c for c in frame.columns if c not in ("score", "predicted")]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    place = kept.index(text)
    ship(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = shared.value.margins(*occurrences(batch.column(place)), batch.num_rows)
            found = 1.0 / (1.0 + np.exp(-margin))
            label = pa.array((found >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), label], names=[*kept, "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    return map_batches(source, score, ", ".join([*fields, "score double", "predicted int"]))
