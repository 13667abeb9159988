"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

Statistics come from one vectorised pass over the bytes of a batch. The trees are fitted on a
bounded sample of labelled texts and flattened into arrays, so scoring walks all texts of a batch
down all trees level by level in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import _LOWER, _SPACE, finish, map_batches, mix, run_hashes, runs, text_bytes

# The statistics, in the order of the feature matrix.
STATISTICS = (
    "log_bytes", "non_ascii", "upper", "digit", "space", "line_end", "sentence_mark", "symbol", "bar",
    "word_bytes", "word_ends_in_symbol", "upper_words", "capital_words", "distinct_words", "top_word",
    "word_again", "distinct_pairs", "line_bytes", "repeated_lines", "longest_word", "log_words", "marks_per_word",
)

# Labelled texts the trees are fitted on, at most. The fit needs no more, whatever the corpus.
MAX_FIT_ROWS = 20_000

# Bytes of text measured at once, about.
PART_BYTES = 1 << 18


def _table(characters: str) -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[[ord(c) for c in characters]] = True
    return inside


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _table("0123456789")
_MARK = _table(".,;:?!")
_SYMBOL = _table("#$%&*+/<=>@[\\]^_`{|}~")
_LETTER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True


def _sums(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True entries of each row."""
    total = np.zeros(len(inside) + 1, np.int64)
    np.cumsum(inside, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _distinct(values: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and the count of its commonest one."""
    if not len(values):
        return np.zeros(rows), np.zeros(rows)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(v)))
    most = np.zeros(rows)
    np.maximum.at(most, o[starts], sizes)
    return np.bincount(o[starts], minlength=rows).astype(np.float64), most


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text; null counts as empty, and an empty text has all zeros.

    Texts of about ``PART_BYTES`` are measured at once, since the working arrays take many times their bytes.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // PART_BYTES)) + 1).tolist(), len(column)]
    return np.concatenate([_measured(column.slice(a, b - a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def _measured(column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    n = np.diff(offsets).astype(np.float64)
    per_byte = 1.0 / np.maximum(n, 1)
    starts, ends = runs(~_SPACE[data], offsets)
    first = np.searchsorted(starts, offsets)
    words = np.diff(first).astype(np.float64)
    per_word = 1.0 / np.maximum(words, 1)
    owner = np.repeat(np.arange(rows), np.diff(first))
    lengths = (ends - starts).astype(np.float64)
    hashes = run_hashes(_LOWER[data], starts, ends)

    def by_word(inside: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=inside, minlength=rows)

    letters, uppers = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data], out=letters[1:])
    np.cumsum(_UPPER[data], out=uppers[1:])
    word_letters, word_uppers = letters[ends] - letters[starts], uppers[ends] - uppers[starts]
    distinct, most = _distinct(hashes, owner, rows)
    same_text = owner[1:] == owner[:-1]
    pairs, _ = _distinct(mix(hashes[:-1], hashes[1:])[same_text], owner[1:][same_text], rows)
    again = np.bincount(owner[1:], weights=(hashes[1:] == hashes[:-1]) & same_text, minlength=rows)
    longest = np.zeros(rows)
    np.maximum.at(longest, owner, lengths)

    line_starts, line_ends = runs(data != 0x0A, offsets)
    line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
    lines = np.bincount(line_owner, minlength=rows).astype(np.float64)
    distinct_lines, _ = _distinct(finish(run_hashes(data, line_starts, line_ends)), line_owner, rows)
    marks = _sums(_MARK[data], offsets)
    symbol_ends = _SYMBOL[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    return np.column_stack([
        np.log1p(n),
        _sums(data >= 128, offsets) * per_byte,
        _sums(_UPPER[data], offsets) * per_byte,
        _sums(_DIGIT[data], offsets) * per_byte,
        _sums(_SPACE[data], offsets) * per_byte,
        _sums(data == 0x0A, offsets) * per_byte,
        marks * per_byte,
        _sums(_SYMBOL[data], offsets) * per_byte,
        _sums(data == ord("|"), offsets) * per_byte,
        by_word(lengths) * per_word,
        by_word(symbol_ends) * per_word,
        by_word((word_letters > 1) & (word_uppers == word_letters)) * per_word,
        by_word(_UPPER[data[starts]] if len(starts) else np.zeros(0)) * per_word,
        distinct * per_word,
        most * per_word,
        again * per_word,
        pairs / np.maximum(words - 1, 1),
        n / np.maximum(lines, 1),
        (lines - distinct_lines) / np.maximum(lines, 1),
        longest,
        np.log1p(words),
        marks * per_word,
    ])


@dataclass(frozen=True)
class TreeSettings:
    trees: int = 80
    depth: int = 4
    bins: int = 64
    learning_rate: float = 0.15
    min_rows: int = 10
    ridge: float = 1.0


@dataclass(frozen=True)
class FlatTrees:
    """Complete binary trees as arrays: children of node i are 2i+1 and 2i+2, leaves come last."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; a value above it goes right
    leaf: np.ndarray  # trees x leaves

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        """Probability of label 1; all rows walk down each level of a tree together."""
        inner = self.feature.shape[1]
        depth = int(np.log2(inner + 1))
        margin = np.full(len(matrix), self.base)
        rows = np.arange(len(matrix))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(matrix), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (matrix[rows, feature[node]] > threshold[node])
            margin += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-margin))


def fit_trees(matrix: np.ndarray, label: np.ndarray, settings: TreeSettings = TreeSettings()) -> FlatTrees:  # noqa: B008
    """Boost the logistic loss with histogram splits. No rows give the constant score 0.5."""
    inner, leaves = 2**settings.depth - 1, 2**settings.depth
    shape = (settings.trees, inner)
    feature, threshold = np.zeros(shape, np.int64), np.full(shape, np.inf)
    leaf = np.zeros((settings.trees, leaves))
    positives = float(label.sum())
    if not len(label):
        return FlatTrees(0.0, feature, threshold, leaf)
    base = float(np.log((positives + 0.5) / (len(label) - positives + 0.5)))
    if positives in (0.0, float(len(label))):
        return FlatTrees(base, feature, threshold, leaf)
    levels = np.linspace(0, 1, settings.bins + 1)[1:-1]
    edges = [np.unique(np.quantile(column, levels)) for column in matrix.T]
    binned = np.column_stack([np.searchsorted(e, column) for e, column in zip(edges, matrix.T, strict=True)])
    margin = np.full(len(label), base)
    columns = matrix.shape[1]
    for tree in range(settings.trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, curvature = label - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(label), np.int64)
        for depth in range(settings.depth):
            width, first = 2**depth, 2**depth - 1
            best = np.zeros(width)
            for j in range(columns):
                cell = (node - first) * settings.bins + binned[:, j]
                size = width * settings.bins
                g, h, c = (
                    np.cumsum(np.bincount(cell, weights=w, minlength=size).reshape(width, -1), axis=1)
                    for w in (gradient, curvature, None)
                )
                gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
                gain = g**2 / (h + settings.ridge) + (gt - g) ** 2 / (ht - h + settings.ridge) - gt**2 / (ht + settings.ridge)
                gain = np.where((c >= settings.min_rows) & (ct - c >= settings.min_rows), gain, 0.0)[:, : len(edges[j])]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best + 1e-9):
                    best[k] = top[k]
                    feature[tree, first + k], threshold[tree, first + k] = j, edges[j][at[k]]
            go = matrix[np.arange(len(label)), feature[tree, node]] > threshold[tree, node]
            node = 2 * node + 1 + go
        at = node - inner
        g, h = (np.bincount(at, weights=w, minlength=leaves) for w in (gradient, curvature))
        leaf[tree] = settings.learning_rate * g / (h + settings.ridge)
        margin += leaf[tree][at]
    return FlatTrees(base, feature, threshold, leaf)


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """True for rows whose crc32 of the id as text leaves the remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def statistics_table(frame: DataFrame, *, text: str = "text", keep: list[str]) -> DataFrame:
    """``keep`` columns of ``frame`` and an array of ``STATISTICS``."""
    source = frame.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias("__text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = statistics(batch.column(len(keep)))
            sizes = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
            array = pa.ListArray.from_arrays(pa.array(sizes), pa.array(matrix.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], array], names=[*keep, "statistics"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return map_batches(source, measure, ", ".join([*fields, "statistics array<double>"]))


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = MAX_FIT_ROWS,
    settings: TreeSettings = TreeSettings(),  # noqa: B008
) -> FlatTrees:
    """Trees fitted on at most ``max_rows`` labelled texts, taken in the order of a hash of the id.

    ``labels`` holds the rows that may be learnt from. Null ids and labels are left out, labels of
    unknown ids too. The sample's ids, bounded by ``max_rows``, are the broadcast side of the join.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    sample = (
        known.select(F.col(key).alias("__key"), F.col(label).cast("double").alias("__label"))
        .orderBy(F.xxhash64("__key"), "__key", "__label")
        .limit(max_rows)
    )
    texts = documents.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    joined = texts.join(F.broadcast(sample), "__key")
    rows = statistics_table(joined, text="__text", keep=["__key", "__label"]).toPandas()
    rows = rows.sort_values(["__key", "__label"], kind="stable")
    matrix = np.array(rows["statistics"].tolist(), np.float64).reshape(len(rows), len(STATISTICS))
    return fit_trees(matrix, rows["__label"].to_numpy(np.float64), settings)


def score_quality(frame: DataFrame, model: FlatTrees, *, text: str = "text") -> DataFrame:
    """``frame`` with ``score`` (0 to 1, higher: label 1 is likelier) and ``predicted`` (1 from 0.5 on).

    Null texts count as empty, empty texts get a score too. Other columns are kept; columns of the
    two names are replaced. The score depends on the text alone, so repeated rows score alike.
    """
    kept = [c for c in frame.columns if c not in ("score", "predicted")]
    source = frame.select(*(F.col(f"`{c}`") for c in kept))
    place = kept.index(text)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(statistics(batch.column(place)))
            label = pa.array((found >= 0.5).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), label], names=[*kept, "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    return map_batches(source, score, ", ".join([*fields, "score double", "predicted int"]))
