"""Histogram boosting against plain loops, and many models in one fit against separate fits."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from opsloom.operators import boosting
from opsloom.operators.boosting import BoostedModel, BoostingSettings, HistogramModel, fit_boosting

SETTINGS = BoostingSettings(rounds=1, leaves=6, learning_rate=1.0, bins=16, leaf_rows=10)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 5, 900), rng.integers(0, 2, 900), np.ones(900)]).round(3)
    y = (3 * (x[:, 0] > 0.3) + x[:, 1] * x[:, 2] + rng.normal(size=900)).round(3)
    late = np.arange(900) >= 500
    made = [(*map(float, r), float(v), 2 if after else 3) for r, v, after in zip(x, y, late, strict=True)]
    frame = spark.createDataFrame(made, "a double, b double, c double, d double, y double, seen long").repartition(4)
    return x, y, late, VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(frame)


def plain_edges(x, bins):
    edges = []
    for column in x.T:
        cuts = np.unique(np.quantile(column, np.arange(1, bins) / bins))
        edges.append(cuts[cuts < column.max()])
    return edges


def plain_tree(x, gradient, settings):
    """Best-first growth over all rows: the cuts in the order they are made, and the leaf of each row."""
    edges = plain_edges(x, settings.bins)

    def best(inside):
        found = (1e-12, None)
        for f, cuts in enumerate(edges):
            for cut in cuts:
                left, right = inside & (x[:, f] <= cut), inside & (x[:, f] > cut)
                if min(left.sum(), right.sum()) < settings.leaf_rows:
                    continue
                gain = gradient[left].sum() ** 2 / left.sum() + gradient[right].sum() ** 2 / right.sum() - gradient[inside].sum() ** 2 / inside.sum()
                if gain > found[0] + 1e-9:
                    found = (gain, (f, cut))
        return found

    leaves = [(np.ones(len(x), bool), best(np.ones(len(x), bool)))]
    cuts = []
    while len(leaves) < settings.leaves:
        at = max(range(len(leaves)), key=lambda i: leaves[i][1][0] if leaves[i][1][1] else 0.0)
        inside, (_, cut) = leaves[at]
        if cut is None:
            break
        cuts.append((cut[0], round(float(cut[1]), 9)))
        left, right = inside & (x[:, cut[0]] <= cut[1]), inside & (x[:, cut[0]] > cut[1])
        leaves[at : at + 1] = [(left, best(left)), (right, best(right))]
    return cuts, [inside for inside, _ in leaves]


@pytest.mark.parametrize("quantile", [None, 0.1, 0.9])
def test_one_tree_equals_a_plain_loop(rows, quantile):
    x, y, _, frame = rows
    model = fit_boosting(frame, "y", [BoostedModel("m", 0, quantile)], SETTINGS, mask=None)["m"]
    base = y.mean() if quantile is None else np.quantile(y, quantile)
    assert model.base == pytest.approx(base)
    gradient = y - base if quantile is None else np.where(y > base, quantile, quantile - 1)
    cuts, leaves = plain_tree(x, gradient, SETTINGS)
    tree = model.trees[0]
    assert sorted((f, round(c, 9)) for f, c in zip(tree.feature, tree.cut, strict=True) if f >= 0) == sorted(cuts)
    got = model.values(x)
    for inside in leaves:
        residual = (y - base)[inside]
        want = base + (residual.mean() if quantile is None else np.quantile(residual, quantile))
        step = 0 if quantile is None else (residual.max() - residual.min()) / boosting.RESIDUAL_BINS
        # The leaf quantile is a step of the histogram, between the two values around the quantile.
        slack = 0 if quantile is None else np.abs(np.quantile(residual, quantile, method="higher") - np.quantile(residual, quantile, method="lower"))
        assert np.allclose(got[inside], want, atol=1e-9 + step + slack)


def test_models_of_one_fit_equal_separate_fits(rows):
    """Rows up to 500 are seen by both windows, the others by the second only."""
    _, _, late, frame = rows
    settings = BoostingSettings(rounds=11, leaves=5, bins=16)
    models = [BoostedModel(f"{bit}-{q}", bit, q) for bit in (0, 1) for q in (None, 0.1, 0.9)]
    together = fit_boosting(frame, "y", models, settings, mask="seen")
    assert settings.rounds > boosting.WRITE_EVERY
    for bit, part in ((0, frame.where("seen = 3")), (1, frame)):
        for q in (None, 0.9):
            alone = fit_boosting(part, "y", [BoostedModel("m", 0, q)], settings)["m"]
            other = together[f"{bit}-{q}"]
            assert alone.base == pytest.approx(other.base)
            assert [t.feature for t in alone.trees] == [t.feature for t in other.trees]
            assert np.allclose(sum((t.value for t in alone.trees), []), sum((t.value for t in other.trees), []))


def test_jobs_do_not_grow_with_the_models(rows, monkeypatch):
    _, _, _, frame = rows
    passes = []
    real = boosting._cuts
    monkeypatch.setattr(boosting, "_cuts", lambda *a: passes.append(1) or real(*a))
    settings = BoostingSettings(rounds=2, leaves=4, bins=8)
    counts = []
    for models in ([BoostedModel("m", 1)], [BoostedModel(f"m{i}", 1) for i in range(5)]):
        passes.clear()
        fit_boosting(frame, "y", models, settings, mask="seen")
        counts.append(len(passes))
    assert counts[0] == counts[1]


def test_coverage_boxes_and_saved_trees(spark, rows, tmp_path):
    x, y, _, frame = rows
    models = [BoostedModel("low", 0, 0.1), BoostedModel("high", 0, 0.9), BoostedModel("mid")]
    fitted = fit_boosting(frame, "y", models, BoostingSettings(rounds=15, leaves=6))
    scored = fitted["high"].transform(fitted["low"].transform(frame, out="low"), out="high").toPandas()
    assert 0.7 < ((scored.y >= scored.low) & (scored.y <= scored.high)).mean() < 0.9
    assert np.abs(y - fitted["mid"].values(x)).mean() < 0.75 * np.abs(y - y.mean()).mean()
    fitted["mid"].nodes(spark).write.parquet(str(tmp_path / "trees"))
    again = HistogramModel.from_nodes(spark.read.parquet(str(tmp_path / "trees")))
    assert (again.values(x) == fitted["mid"].values(x)).all()
    boxes = fitted["mid"].table(spark).toPandas()
    for row in x[:20]:
        total = boxes.value[boxes.tree == -1].iloc[0]
        for _, tree in boxes[boxes.tree >= 0].groupby("tree"):
            inside = []
            for leaf, box in tree.groupby("leaf"):
                low, high = box.low.fillna(-np.inf), box.high.fillna(np.inf)
                if ((row[box.feature] > low) & (row[box.feature] <= high)).all():
                    inside.append(box.value.iloc[0])
            assert len(inside) == 1
            total += inside[0]
        assert total == pytest.approx(fitted["mid"].values(row[None])[0])


def test_nulls_constant_labels_and_no_rows(spark):
    frame = spark.createDataFrame([(float(i), 5.0 if i % 3 else None) for i in range(90)], "a double, y double")
    encoded = VectorAssembler(inputCols=["a"], outputCol="features").transform(frame)
    model = fit_boosting(encoded, "y", [BoostedModel("m"), BoostedModel("q", 0, 0.5)], BoostingSettings(rounds=3))
    assert (model["m"].values(np.array([[1.0], [99.0]])) == 5.0).all() and (model["q"].values(np.array([[1.0]])) == 5.0).all()
    with pytest.raises(ValueError, match="no rows"):
        fit_boosting(encoded.where(F.lit(False)), "y", [BoostedModel("m")], BoostingSettings(rounds=3))
    with pytest.raises(ValueError, match="bins"):
        fit_boosting(encoded, "y", [BoostedModel("m")], BoostingSettings(bins=1))


def test_contributions_add_up_and_boxes_score_as_expressions(spark, rows):
    x, y, _, frame = rows
    model = fit_boosting(frame, "y", [BoostedModel("m")], BoostingSettings(rounds=4, leaves=5))["m"]
    shares = []
    for tree in model.trees:
        share = np.bincount(tree.place(x, tree.cut), minlength=len(tree.feature)).astype(float) / len(x)
        for node in reversed(range(len(share))):
            if tree.feature[node] >= 0:
                share[node] = share[tree.left[node]] + share[tree.right[node]]
        shares.append(share)
    expected, added = boosting.box_contributions(model, x, shares)
    assert expected == pytest.approx(model.values(x).mean())
    assert np.allclose(expected + added.sum(axis=1), model.values(x))
    assert (added[:, 3] == 0).all() and np.abs(added[:, 0]).mean() > 0.1
    listed = {r.feature: r.importance for r in boosting.path_importance(model, frame, frame, list("abcd")).collect()}
    assert [listed[c] for c in "abcd"] == pytest.approx(np.abs(added).mean(axis=0))
    scored = boosting.score_by_boxes(frame, model.table(spark), list("abcd"), "p")
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    got = scored.select(*"abcd", "p").toPandas()
    assert np.allclose(got.p, model.values(got[list("abcd")].to_numpy()))
