"""Histogram gradient boosting with squared and pinball loss, several models in one fit.

Features are binned once at exact quantiles. A tree grows from histograms: every task adds up
gradients and counts per model, node, feature and bin over its Arrow batches, a grouped sum merges the
tasks' arrays, and the best cut of each node is chosen where its histogram was merged, so the driver
receives one row per node. One pass serves all nodes of a depth in all models: the losses of an
interval and the windows of a back-test are models of the same pass, and a row takes part in those
whose bit is set in its ``models`` mask. Of the cuts found, the ones of highest gain are made first
until a tree has its leaves.

Leaf values are the mean residual, or for pinball loss the quantile of the residuals, read from a
histogram of ``RESIDUAL_BINS`` steps between the leaf's least and greatest residual. Margins are
written with the rows every second round, so a pass walks one earlier tree at most; the table they
replace is deleted. A pass follows the rows only down to the nodes it asks for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.functions.ranks import exact_percentiles
from opsloom.functions.shipping import ship
from opsloom.functions.staging import discard, materialize

RESIDUAL_BINS = 4096
# Rounds between two writes of the margins.
WRITE_EVERY = 2
# Rows and bytes a task works on at once, about; Arrow batches of the session's size are joined up to it.
CHUNK_ROWS = 1 << 16
CHUNK_BYTES = 16 << 20


@dataclass(frozen=True)
class BoostingSettings:
    rounds: int = 100
    leaves: int = 15
    learning_rate: float = 0.1
    bins: int = 64
    leaf_rows: int = 20


@dataclass(frozen=True)
class BoostedModel:
    """What one of the models of a fit learns: its loss, and the bit of the rows it sees."""

    name: str
    bit: int = 0
    # None is squared loss, else the quantile of pinball loss.
    quantile: float | None = None
    # Leaves of a tree, where they are not the fit's.
    leaves: int | None = None


@dataclass
class Tree:
    """Nodes as arrays; a negative feature marks a leaf, a value above the cut goes to ``right``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    # The cut as a bin number: bins above it go right.
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def grow(self, node: int, feature: int, cut: float, bin_number: int) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.bin[node] = feature, cut, bin_number
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for column, blank in ((self.feature, -1), (self.cut, 0.0), (self.bin, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            column += [blank, blank]
        return self.left[node], self.right[node]

    def leaves(self) -> list[int]:
        return [node for node, feature in enumerate(self.feature) if feature < 0]

    def parts(
        self, columns: np.ndarray, rows: np.ndarray, cuts: Sequence[float] | Sequence[int], wanted: Sequence[int]
    ) -> Iterator[tuple[int, np.ndarray]]:
        """Each of the ``wanted`` nodes that holds some of ``rows``, with those; ``columns`` has a line per feature.

        Rows are split node by node, and only on the way to a wanted one.
        """
        above = {child: node for node, f in enumerate(self.feature) if f >= 0 for child in (self.left[node], self.right[node])}
        asked, way = set(wanted), set()
        for node in wanted:
            while node not in way:
                way.add(node)
                node = above.get(node, node)
        stack = [(0, rows)] if 0 in way and len(rows) else []
        while stack:
            node, here = stack.pop()
            if node in asked:
                yield node, here
            if self.feature[node] >= 0:
                over = columns[self.feature[node]][here] > cuts[node]
                for child, side in ((self.left[node], ~over), (self.right[node], over)):
                    if child in way and side.any():
                        stack.append((child, here[side]))

    def place(self, values: np.ndarray, cuts: Sequence[float] | Sequence[int]) -> np.ndarray:
        """The leaf of each row of ``values``."""
        node = np.zeros(len(values), np.int64)
        for leaf, here in self.parts(np.ascontiguousarray(values.T), np.arange(len(values)), cuts, self.leaves()):
            node[here] = leaf
        return node

    def add_to(self, total: np.ndarray, columns: np.ndarray, rows: np.ndarray, cuts: Sequence[float] | Sequence[int]) -> None:
        """Add the value of their leaf to the entries of ``rows``."""
        for leaf, here in self.parts(columns, rows, cuts, self.leaves()):
            total[here] += self.value[leaf]


def stacked(vectors: pd.Series) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    cells = vectors.tolist()
    return np.concatenate(cells).astype(np.float64, copy=False).reshape(len(cells), -1) if cells else np.zeros((0, 0))


@dataclass(frozen=True)
class HistogramModel:
    """A fitted model: a base value and trees over the positions of a feature vector."""

    base: float
    trees: tuple[Tree, ...]

    def values(self, matrix: np.ndarray) -> np.ndarray:
        total = np.full(len(matrix), self.base)
        columns, rows = np.ascontiguousarray(matrix.T), np.arange(len(matrix))
        for tree in self.trees:
            tree.add_to(total, columns, rows, tree.cut)
        return total

    def transform(self, encoded: DataFrame, *, out: str = "prediction", features: str = "features") -> DataFrame:
        """``encoded`` with the prediction, in Arrow batches."""

        ship(encoded.sparkSession)

        @F.pandas_udf("double")
        def predict(vectors: pd.Series) -> pd.Series:
            return pd.Series(self.values(stacked(vectors)))

        return encoded.withColumn(out, predict(vector_to_array(F.col(features))))

    def table(self, spark: SparkSession) -> DataFrame:
        """Leaf boxes: one row per leaf and feature it is bound by, ``low < x <= high``; a tree without cuts has feature -1."""
        rows = [(-1, 0, -1, None, None, self.base)]
        for t, tree in enumerate(self.trees):
            stack = [(0, {})]
            while stack:
                node, box = stack.pop()
                if tree.feature[node] < 0:
                    rows += [(t, node, f, low, high, tree.value[node]) for f, (low, high) in (box or {-1: (None, None)}).items()]
                    continue
                f, cut = tree.feature[node], tree.cut[node]
                low, high = box.get(f, (None, None))
                stack.append((tree.left[node], {**box, f: (low, cut)}))
                stack.append((tree.right[node], {**box, f: (cut, high)}))
        return spark.createDataFrame(rows, BOX_SCHEMA)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node, from which ``from_nodes`` builds the model again."""
        rows = [(-1, 0, -1, 0.0, 0, 0, 0, self.base)]
        for t, tree in enumerate(self.trees):
            rows += [(t, i, *cells) for i, cells in enumerate(zip(tree.feature, tree.cut, tree.bin, tree.left, tree.right, tree.value, strict=True))]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @classmethod
    def from_nodes(cls, nodes: DataFrame) -> HistogramModel:
        rows = sorted(nodes.collect())
        trees: dict[int, Tree] = {}
        for t, _, *cells in rows[1:]:
            tree = trees.setdefault(t, Tree([], [], [], [], [], []))
            for column, cell in zip((tree.feature, tree.cut, tree.bin, tree.left, tree.right, tree.value), cells, strict=True):
                column.append(cell)
        return cls(rows[0].value, tuple(trees[t] for t in sorted(trees)))


BOX_SCHEMA = "tree int, leaf int, feature int, low double, high double, value double"
NODE_SCHEMA = "tree int, node int, feature int, cut double, bin int, left int, right int, value double"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches joined to about ``CHUNK_ROWS`` rows, whatever size the session gives them."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, size = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


# About ``CHUNK_ROWS`` rows in one: labels, masks, bins by bit and feature, margins by model, each as raw numbers.
# A pass then moves a few large cells instead of many small ones.
_BLOCKS = "label binary, mask binary, bins binary, margins binary"


def _block(label: np.ndarray, mask: np.ndarray, bins: np.ndarray, margins: np.ndarray) -> pa.RecordBatch:
    cells = {"label": label, "mask": mask, "bins": bins, "margins": margins}
    return pa.RecordBatch.from_pydict({name: pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for name, c in cells.items()})


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Labels, masks, bins and margins of each block, the last two still without their shape."""
    kinds = {"label": np.float64, "mask": np.int64, "bins": np.uint8, "margins": np.float64}
    for batch in batches:
        for at in range(batch.num_rows):
            yield tuple(np.frombuffer(batch.column(name)[at].as_py(), kind) for name, kind in kinds.items())


@dataclass(frozen=True)
class _Fit:
    """What the tasks of a pass need: the models, their bins, and the trees the written margins lack."""

    models: tuple[BoostedModel, ...]
    columns: int
    bins: int
    trees: tuple[tuple[Tree, ...], ...]

    def rows(
        self, label: np.ndarray, mask: np.ndarray, bins: np.ndarray, margins: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per model of a block: bins with a line per feature, the rows it sees, and the margins of those rows."""
        packed = bins.reshape(-1, self.columns, len(label))
        before = margins.reshape(len(self.models), len(label))
        for place, bit in enumerate(sorted({m.bit for m in self.models})):
            seen = np.flatnonzero((mask >> bit) & 1 == 1).astype(np.int32)
            for i, model in enumerate(self.models):
                if model.bit != bit:
                    continue
                margin = before[i].copy()
                for tree in self.trees[i]:
                    tree.add_to(margin, packed[place], seen, tree.bin)
                yield i, packed[place], seen, margin


def _gradient(model: BoostedModel, label: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Direction a leaf's value should take: the residual, or the side of it by the quantile."""
    if model.quantile is None:
        return label - margin
    return np.where(label > margin, model.quantile, model.quantile - 1.0)


def _histogram(model: BoostedModel, cells: np.ndarray, label: np.ndarray, margin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradient sums and row counts per feature and bin."""
    if model.quantile is None:
        gradient = _gradient(model, label, margin)
        return np.stack([np.bincount(c, gradient, size) for c in cells]), np.stack([np.bincount(c, minlength=size) for c in cells])
    # The gradient has two values, so counting the rows of each is enough.
    over = (label > margin).astype(np.int64)
    counts = np.stack([np.bincount(2 * c.astype(np.int64) + over, minlength=2 * size) for c in cells]).reshape(len(cells), size, 2)
    return counts[:, :, 1] * model.quantile + counts[:, :, 0] * (model.quantile - 1.0), counts.sum(axis=2)


def _best_cut(sums: np.ndarray, counts: np.ndarray, leaf_rows: int) -> tuple[float, int, int]:
    """Gain, feature and bin of the best cut of a node's histogram ``(features, bins)``; ties to the first."""
    left, n_left = np.cumsum(sums, axis=1), np.cumsum(counts, axis=1)
    total, n = left[:, -1:], n_left[:, -1:]
    right, n_right = total - left, n - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left**2 / n_left + right**2 / n_right - total**2 / n
    gain = np.where((n_left >= leaf_rows) & (n_right >= leaf_rows), gain, 0.0)
    at = int(np.argmax(gain))
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


_CUTS = "model int, node int, gain double, feature int, bin int, low double, high double, total double, n long"


def _cuts(rows: DataFrame, fit: _Fit, partial: Sequence[Tree], wanted: Sequence[Sequence[int]], leaf_rows: int) -> list:
    """The best cut, the residuals' range and the gradient sum of every wanted node of every model."""
    shared = rows.sparkSession.sparkContext.broadcast((fit, tuple(partial), tuple(map(tuple, wanted))))
    shape = (fit.columns, fit.bins)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, partial, wanted = shared.value
        held: dict[tuple[int, int], list] = {}
        for label, *block in _opened(batches):
            for i, bins, seen, margin in fit.rows(label, *block):
                for node, here in partial[i].parts(bins, seen, partial[i].bin, wanted[i]):
                    cells = bins if len(here) == len(label) else bins[:, here]
                    own, start = label[here], margin[here]
                    sums, counts = _histogram(fit.models[i], cells, own, start, fit.bins)
                    residual = own - start
                    total = held.setdefault((i, node), [0.0, 0, np.inf, -np.inf])
                    total[0], total[1] = total[0] + sums, total[1] + counts
                    total[2], total[3] = min(total[2], residual.min()), max(total[3], residual.max())
        for (i, node), (sums, counts, low, high) in held.items():
            yield pa.RecordBatch.from_pydict({
                "model": pa.array([i], pa.int32()), "node": pa.array([node], pa.int32()), "low": [low], "high": [high],
                "sums": [sums.tobytes()], "counts": [counts.astype(np.int64).tobytes()],
            })

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("sums")
        sums = sum(np.frombuffer(v) for v in table["sums"].to_pylist()).reshape(shape)
        counts = sum(np.frombuffer(v, np.int64) for v in table["counts"].to_pylist()).reshape(shape)
        gain, feature, at = _best_cut(sums, counts, leaf_rows)
        return pa.table({
            "model": table["model"][:1], "node": table["node"][:1], "gain": [gain], "feature": pa.array([feature], pa.int32()),
            "bin": pa.array([at], pa.int32()), "low": [min(table["low"].to_pylist())], "high": [max(table["high"].to_pylist())],
            "total": [float(sums[0].sum())], "n": [int(counts[0].sum())],
        })

    added = rows.mapInArrow(add, "model int, node int, low double, high double, sums binary, counts binary")
    found = added.groupBy("model", "node").applyInArrow(merge, _CUTS).collect()
    shared.unpersist()
    return found


def _leaf_quantiles(rows: DataFrame, fit: _Fit, grown: Sequence[Tree], ranges: Mapping[tuple[int, int], tuple[float, float]]) -> dict:
    """The quantile of the residuals in every leaf of the pinball models."""
    shared = rows.sparkSession.sparkContext.broadcast((fit, tuple(grown), dict(ranges)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, grown, ranges = shared.value
        held: dict[tuple[int, int], np.ndarray] = {}
        for label, *block in _opened(batches):
            for i, bins, seen, margin in fit.rows(label, *block):
                if fit.models[i].quantile is None:
                    continue
                for node, here in grown[i].parts(bins, seen, grown[i].bin, grown[i].leaves()):
                    low, high = ranges[i, node]
                    steps = ((label[here] - margin[here] - low) / max(high - low, 1e-300) * (RESIDUAL_BINS - 1)).round()
                    counts = np.bincount(np.clip(steps, 0, RESIDUAL_BINS - 1).astype(np.int64), minlength=RESIDUAL_BINS)
                    held[i, node] = held.get((i, node), 0) + counts
        for (i, node), counts in held.items():
            yield pa.RecordBatch.from_pydict({"model": pa.array([i], pa.int32()), "node": pa.array([node], pa.int32()), "counts": [counts.tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(v, np.int64) for v in table["counts"].to_pylist())
        i, node = table["model"][0].as_py(), table["node"][0].as_py()
        low, high = shared.value[2][i, node]
        upto = np.cumsum(counts)
        step = int(np.searchsorted(upto, shared.value[0].models[i].quantile * (upto[-1] - 1), side="right"))
        return pa.table({"model": table["model"][:1], "node": table["node"][:1], "value": [low + (high - low) * step / (RESIDUAL_BINS - 1)]})

    added = rows.mapInArrow(add, "model int, node int, counts binary")
    found = added.groupBy("model", "node").applyInArrow(merge, "model int, node int, value double").collect()
    shared.unpersist()
    return {(r.model, r.node): r.value for r in found}


def _grow(rows: DataFrame, fit: _Fit, edges: Mapping[int, Sequence[np.ndarray]], settings: BoostingSettings) -> list[Tree]:
    """One tree per model; a pass per depth looks at the nodes that may still be cut in all models.

    ``tried`` holds every node whose cut is known. Each tree is built anew from those by always
    cutting the leaf of highest gain; leaves whose cut is not known yet are looked at next.
    """
    models = fit.models
    explored, known = [Tree() for _ in models], [{} for _ in models]
    wanted: list[list[int]] = [[0] for _ in models]
    while any(wanted):
        for r in _cuts(rows, fit, explored, wanted, settings.leaf_rows):
            known[r.model][r.node] = r
        wanted = [[] for _ in models]
        for i, tree in enumerate(explored):
            # Nodes best-first growth would cut as far as their gains are known.
            for node in _order(tree, known[i], models[i].leaves or settings.leaves):
                if tree.feature[node] < 0:
                    r = known[i][node]
                    cut = edges[models[i].bit][r.feature][r.bin]
                    wanted[i] += tree.grow(node, r.feature, float(cut), r.bin)
    grown = []
    for i, tree in enumerate(explored):
        kept = _order(tree, known[i], models[i].leaves or settings.leaves)
        final, place = Tree(), {0: 0}
        for node in kept:
            place[tree.left[node]], place[tree.right[node]] = final.grow(place[node], tree.feature[node], tree.cut[node], tree.bin[node])
        grown.append(final)
        known[i] = {place[node]: r for node, r in known[i].items() if node in place}
    return _with_values(rows, fit, grown, known, settings)


def _order(tree: Tree, known: Mapping[int, object], leaves: int) -> list[int]:
    """Nodes in the order best-first growth cuts them, among those whose best cut is known."""
    open_nodes, order = {0}, []
    while len(order) < leaves - 1:
        ready = [n for n in open_nodes if n in known and known[n].gain > 1e-12]
        if not ready:
            break
        node = max(ready, key=lambda n: (known[n].gain, -n))
        order.append(node)
        open_nodes.remove(node)
        if tree.feature[node] >= 0:
            open_nodes |= {tree.left[node], tree.right[node]}
    return order


def _with_values(rows: DataFrame, fit: _Fit, grown: list[Tree], known: list[dict], settings: BoostingSettings) -> list[Tree]:
    ranges = {
        (i, node): (known[i][node].low, known[i][node].high)
        for i, tree in enumerate(grown) if fit.models[i].quantile is not None
        for node, feature in enumerate(tree.feature) if feature < 0 and node in known[i]
    }
    quantiles = _leaf_quantiles(rows, fit, grown, ranges) if ranges else {}
    for i, tree in enumerate(grown):
        for node, feature in enumerate(tree.feature):
            if feature < 0 and node in known[i]:
                r = known[i][node]
                value = r.total / r.n if fit.models[i].quantile is None else quantiles[i, node]
                tree.value[node] = settings.learning_rate * value
    return grown


def _bits_seen(bits: Sequence[int]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col("mask").bitwiseAND(F.lit(1 << b).cast("long")) != 0, F.lit(b)) for b in bits]))


def _edges(rows: DataFrame, bits: Sequence[int], bins: int) -> dict[int, list[np.ndarray]]:
    """Per bit and feature the inner edges, exact quantiles without repeats and without the greatest value."""
    seen = rows.select("vector", F.explode(_bits_seen(bits)).alias("bit"))
    long = seen.select("bit", F.posexplode("vector").alias("at", "x"))
    points = {f"q{k}": k / bins for k in range(1, bins)} | {"top": 1.0}
    found = exact_percentiles(long, ["bit", "at"], "x", points, few_groups=True).collect()
    edges: dict[int, list[np.ndarray]] = {b: [] for b in bits}
    for r in sorted(found, key=lambda r: (r.bit, r["at"])):
        cuts = np.unique([r[f"q{k}"] for k in range(1, bins)])
        edges[r.bit].append(cuts[cuts < r.top])
    return edges


def _prepared(rows: DataFrame, models: Sequence[BoostedModel], edges: Mapping[int, Sequence[np.ndarray]], bases: Sequence[float]) -> DataFrame:
    """Blocks of rows: one byte per window and feature, one double per model."""
    shared = rows.sparkSession.sparkContext.broadcast((dict(edges), np.array(bases)))

    def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, start = shared.value
        for batch in _chunks(batches):
            matrix = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
            bins = np.stack([np.stack([np.searchsorted(e, x, side="left") for e, x in zip(edges[b], matrix.T, strict=True)]) for b in sorted(edges)])
            margins = np.repeat(start, batch.num_rows)
            yield _block(batch.column("label").to_numpy(), batch.column("mask").to_numpy(), bins.astype(np.uint8), margins)

    return rows.mapInArrow(bin_rows, _BLOCKS)


def _advanced(blocks: DataFrame, fit: _Fit) -> DataFrame:
    """The blocks with the margins after all trees of ``fit``."""
    shared = blocks.sparkSession.sparkContext.broadcast(fit)

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        for label, mask, bins, margins in _opened(batches):
            after = {i: margin for i, _, _, margin in fit.rows(label, mask, bins, margins)}
            yield _block(label, mask, bins, np.concatenate([after[i] for i in range(len(fit.models))]))

    return blocks.mapInArrow(advance, _BLOCKS)


def fit_boosting(
    encoded: DataFrame,
    label: str,
    models: Sequence[BoostedModel],
    settings: BoostingSettings = BoostingSettings(),  # noqa: B008
    *,
    features: str = "features",
    mask: str | None = None,
) -> dict[str, HistogramModel]:
    """Fit all models together over a table with a feature vector.

    ``mask`` is a column of bits, bit k set where models of bit k see the row; without it all rows are
    seen by bit 0. The number of jobs depends on rounds and depth, not on the number of models. Rows
    with a null label are left out; a model that sees no row is an error.
    """
    if not 2 <= settings.bins <= 256:
        raise ValueError("bins must be between 2 and 256")
    seen = F.col(mask).cast("long") if mask else F.lit(1).cast("long")
    rows = encoded.select(F.col(label).cast("double").alias("label"), seen.alias("mask"), vector_to_array(F.col(features)).alias("vector"))
    ship(encoded.sparkSession)
    rows = materialize(rows.where("label is not null"), "boosting-rows")
    bits = sorted({m.bit for m in models})
    edges = _edges(rows, bits, settings.bins)
    if missing := [b for b in bits if not edges[b]]:
        raise ValueError(f"no rows for the models of bits {missing}")
    bases = _bases(rows, models)
    columns = len(next(iter(edges.values())))
    current = materialize(_prepared(rows, models, edges, bases), "boosting-margins")
    trees: list[list[Tree]] = [[] for _ in models]
    written = 0
    for done in range(settings.rounds):
        fit = _Fit(tuple(models), columns, settings.bins, tuple(tuple(t[written:]) for t in trees))
        if done - written >= WRITE_EVERY:
            before, current = current, materialize(_advanced(current, fit), "boosting-margins")
            discard(before)
            written = done
            fit = _Fit(tuple(models), columns, settings.bins, tuple(() for _ in models))
        for own, tree in zip(trees, _grow(current, fit, edges, settings), strict=True):
            own.append(tree)
    return {m.name: HistogramModel(base, tuple(own)) for m, base, own in zip(models, bases, trees, strict=True)}


def _bases(rows: DataFrame, models: Sequence[BoostedModel]) -> list[float]:
    """Mean of the label for squared loss, its exact quantile for pinball loss, over the rows each model sees."""
    bits = sorted({m.bit for m in models})
    seen = rows.select("label", F.explode(_bits_seen(bits)).alias("bit"))
    means = {r.bit: r.mean for r in seen.groupBy("bit").agg(F.avg("label").alias("mean")).collect()}
    levels = sorted({m.quantile for m in models if m.quantile is not None})
    found = {}
    if levels:
        points = {f"q{k}": q for k, q in enumerate(levels)}
        found = {r.bit: r for r in exact_percentiles(seen, ["bit"], "label", points, few_groups=True).collect()}
    return [float(means[m.bit] if m.quantile is None else found[m.bit][f"q{levels.index(m.quantile)}"]) for m in models]



def score_by_boxes(frame: DataFrame, boxes: DataFrame, features: Sequence[str], out: str) -> DataFrame:
    """``frame`` with the prediction of saved leaf boxes as column expressions over plain columns.

    ``features`` names the column of each feature position. A tree is a choice among its leaves, of
    which exactly one box holds a row; no vector is built and nothing runs in Python. The boxes, a few
    rows per leaf, come to the driver to be written into the plan.
    """
    base, leaves = 0.0, {}
    for r in boxes.collect():
        if r.tree < 0:
            base = r.value
        else:
            leaves.setdefault(r.tree, {}).setdefault(r.leaf, []).append(r)
    total = F.lit(base)
    for tree in sorted(leaves):
        choice = None
        for _, box in sorted(leaves[tree].items()):
            inside = F.lit(True)
            for r in sorted(box):
                column = F.col(f"`{features[r.feature]}`") if r.feature >= 0 else None
                if r.low is not None:
                    inside = inside & (column > F.lit(r.low))
                if r.high is not None:
                    inside = inside & (column <= F.lit(r.high))
            value = F.lit(box[0].value)
            choice = F.when(inside, value) if choice is None else choice.when(inside, value)
        total = total + choice
    return frame.withColumn(out, total)


def box_contributions(model: HistogramModel, matrix: np.ndarray, weights: Sequence[Sequence[float]]) -> tuple[float, np.ndarray]:
    """What each feature adds to each row's prediction along its paths; with the expected value they sum to it.

    ``weights`` holds the share of the training rows in every node of every tree. A step from a node to
    its child adds the change of the expected value to the feature that was cut.
    """
    expected = model.base
    added = np.zeros(matrix.shape)
    rows = np.arange(len(matrix))
    for tree, share in zip(model.trees, weights, strict=True):
        mean = np.array(tree.value, np.float64)
        for node in reversed(range(len(mean))):
            if tree.feature[node] >= 0:
                a, b = tree.left[node], tree.right[node]
                both = share[a] + share[b]
                mean[node] = (mean[a] * share[a] + mean[b] * share[b]) / both if both else (mean[a] + mean[b]) / 2
        expected += mean[0]
        node = np.zeros(len(matrix), np.int64)
        feature, cut = np.array(tree.feature), np.array(tree.cut)
        left, right = np.array(tree.left), np.array(tree.right)
        going = rows[feature[node] >= 0]
        while len(going):
            at = node[going]
            below = np.where(matrix[going, feature[at]] > cut[at], right[at], left[at])
            np.add.at(added, (going, feature[at]), mean[below] - mean[at])
            node[going] = below
            going = going[feature[below] >= 0]
    return expected, added


def _summed(frame: DataFrame, features: str, size: int, add: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, int]:
    """Sum of ``add`` over all batches of the feature vectors, and the number of rows."""
    ship(frame.sparkSession)
    vectors = frame.select(vector_to_array(F.col(features)).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size), 0
        for batch in _chunks(batches):
            total += add(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1))
            rows += batch.num_rows
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64())), "rows": [rows]})

    parts = vectors.mapInArrow(run, "sums array<double>, rows long")
    by_place = parts.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
    totals = np.zeros(size)
    for r in by_place:
        totals[r["at"]] = r.x
    return totals, parts.agg(F.sum("rows")).first()[0] or 0


def path_importance(
    model: HistogramModel, fitted: DataFrame, scored: DataFrame, names: Sequence[str], *, features: str = "features"
) -> DataFrame:
    """``feature, importance``: the mean absolute contribution along the paths of ``scored`` rows.

    The expected values of the nodes are weighted by the rows of ``fitted`` in them. Both tables are
    read in Arrow batches whose sums, a number per node or feature, are added up by the engine.
    """
    bounds = np.cumsum([0, *(len(t.feature) for t in model.trees)])

    def nodes(matrix: np.ndarray) -> np.ndarray:
        total = np.zeros(bounds[-1])
        for start, tree in zip(bounds, model.trees, strict=False):
            share = np.bincount(tree.place(matrix, tree.cut), minlength=len(tree.feature))
            total[start : start + len(share)] += share
        return total

    counts, _ = _summed(materialize(fitted.select(features), "importance-fitted"), features, int(bounds[-1]), nodes)
    weights = []
    for start, tree in zip(bounds, model.trees, strict=False):
        share = counts[start : start + len(tree.feature)].copy()
        for node in reversed(range(len(share))):
            if tree.feature[node] >= 0:
                share[node] = share[tree.left[node]] + share[tree.right[node]]
        weights.append(share)
    rows = materialize(scored.select(features), "importance-scored")
    sums, n = _summed(rows, features, len(names), lambda matrix: np.abs(box_contributions(model, matrix, weights)[1]).sum(axis=0))
    listed = [(name, float(x) / max(n, 1)) for name, x in zip(names, sums, strict=True)]
    return fitted.sparkSession.createDataFrame(listed, "feature string, importance double")
