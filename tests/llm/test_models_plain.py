"""Quality trees and language filters against plain walks and sets, and on rows they have not seen."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from tests_llm_helpers import TEXTS

from opsloom.llm import catalog, language, quality

LARGER = SF.replace("sf0.001", "sf0.01")


def test_trees_equal_a_plain_walk():
    rng = np.random.default_rng(2)
    matrix = np.round(rng.normal(size=(400, 5)), 2)
    label = (matrix[:, 0] + matrix[:, 1] * matrix[:, 2] > 0.2).astype(float)
    model = quality.fit_trees(matrix, label, quality.TreeSettings(trees=60, depth=3, bins=16))
    got = model.scores(matrix)
    for row, score in zip(matrix, got, strict=True):
        margin = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += leaf[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-margin)))
    assert ((got >= 0.5) == (label == 1)).mean() > 0.9


def test_first_cut_is_the_best_of_all_cuts():
    """One tree of depth one: its cut has the greatest gain of every feature and edge."""
    rng = np.random.default_rng(4)
    matrix, label = np.round(rng.normal(size=(150, 3)), 1), rng.integers(0, 2, 150).astype(float)
    settings = quality.TreeSettings(trees=1, depth=1, bins=8, min_rows=5)
    model = quality.fit_trees(matrix, label, settings)
    p = 1 / (1 + np.exp(-model.base))
    gains = {}
    for f, column in enumerate(matrix.T):
        for edge in np.unique(np.quantile(column, np.linspace(0, 1, 9)[1:-1])):
            left = column <= edge
            if min(left.sum(), (~left).sum()) >= 5:
                parts = [((label - p)[s].sum(), p * (1 - p) * s.sum()) for s in (left, ~left)]
                gains[f, float(edge)] = sum(g**2 / (h + settings.ridge) for g, h in parts)
    assert (int(model.feature[0, 0]), float(model.threshold[0, 0])) == max(gains, key=lambda k: gains[k])


def test_language_filters_hold_every_member(spark):
    """Bit-sliced filters against sets: no member is missed, and few others seem inside."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    model = language.fit_languages(docs)
    rows = [(r.lang, r.text) for r in docs.collect() if r.lang is not None and r.text is not None]
    counts: dict = {}
    for name, text in rows:
        grams, _, _ = language.text_grams(pa.array([text]))
        for g in grams.tolist():
            own = counts.setdefault(name, {})
            own[g] = own.get(g, 0) + 1
    members = {}
    for name, own in counts.items():
        totals: dict = {}
        for g, n in own.items():
            totals[g >> 56] = totals.get(g >> 56, 0) + n
        members[name] = {g for g, n in own.items() if n >= totals[g >> 56] * language.MIN_SHARE}
    assert model.languages == tuple(sorted(members))
    every = sorted(set().union(*map(set, counts.values())))
    grams = np.array(every, np.uint64)
    hits = model.counts(grams, np.arange(len(grams)), len(grams))
    for k, name in enumerate(model.languages):
        inside = np.array([g in members[name] for g in every])
        assert (hits[inside, k] == 1).all()
        assert hits[~inside, k].mean() <= model.accident[k] + 0.02
    column = pa.array([t for _, t in TEXTS])
    grams, owner, _ = language.text_grams(column)
    assert model.counts(grams, owner, len(column)).max(axis=0).shape == (len(model.languages),)


def test_held_out_quality(spark):
    known = spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", "quality")
    result = catalog.QUERIES["op1_quality"](spark, LARGER).join(known, "doc_id").where("held_out").toPandas()
    assert len(result) > 80 and (result.quality == result.predicted).mean() >= 0.95


def test_held_out_language(spark):
    known = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").where("lang is not null")
    result = catalog.QUERIES["op5_language"](spark, LARGER).join(known, "doc_id").where("held_out").toPandas()
    assert len(result) > 150 and (result.lang == result.lang_pred).mean() >= 0.97
