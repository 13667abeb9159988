"""The toxicity model against plain loops over the same features, and on labels it has not seen."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from tests_llm_helpers import documents, nothing  # noqa: F401

from opsloom.llm import catalog, quality, toxicity

SF_LARGER = SF.replace("sf0.001", "sf0.01")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_features(text):
    """Names of all occurrences, as words and byte beginnings."""
    words = [w.translate(LOWER).encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
    names = [("word", w) for w in words]
    for distance in toxicity.DISTANCES:
        names += [(distance, a, b) for a, b in zip(words, words[distance:], strict=False)]
    for size in toxicity.BEGINNINGS:
        names += [("begins", size, w[:size]) for w in words if len(w) > size]
    return names


def plain_learner(rows, settings, state):
    """One coordinate at a time; ``state`` maps a feature to its two numbers."""
    s = settings

    def weight(f):
        z, n = state.get(f, (0.0, 0.0))
        l1 = 0.0 if f == "constant" else s.l1
        return 0.0 if abs(z) <= l1 else -(z - math.copysign(l1, z)) / ((s.beta + math.sqrt(n)) / s.alpha + s.l2)

    for counts, label in rows:
        w = {f: weight(f) for f in counts}
        p = 1 / (1 + math.exp(-sum(w[f] * c for f, c in counts.items())))
        for f, c in counts.items():
            z, n = state.get(f, (0.0, 0.0))
            g = (p - label) * c
            state[f] = (z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / s.alpha * w[f], n + g * g)
    return weight


TEXTS = ["You IDIOT you idiot, éa b", "", None, "one two three-four five 12 you", "one two three", "x" * 40 + " 日本 日本 日本 日本"]


def test_occurrences_equal_plain_features():
    hashes, owner = toxicity.occurrences(pa.array(TEXTS * 2))
    by_name, by_hash = {}, {}
    for i, text in enumerate(TEXTS * 2):
        want = Counter(plain_features(text))
        found = Counter(hashes[owner == i].tolist())
        assert sorted(want.values()) == sorted(found.values())
        if i % len(TEXTS) == 0:
            assert max(want.values()) == 2
        by_name[i], by_hash[i] = set(want), set(found)
    for i in by_name:
        for j in by_name:
            assert len(by_name[i] & by_name[j]) == len(by_hash[i] & by_hash[j])


def test_learner_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    settings = toxicity.LearnerSettings(l1=0.2)
    rows = []
    for _ in range(200):
        features = np.append(rng.choice(np.arange(1, 30), rng.integers(0, 8), replace=False), 0)
        rows.append((features, np.append(rng.integers(1, 4, len(features) - 1), 1).astype(float), float(features[0] % 2)))
    z, n = np.zeros(30), np.zeros(30)
    toxicity.learn(z, n, iter(rows), settings)
    named = [({"constant" if f == 0 else int(f): c for f, c in zip(fs, cs, strict=True)}, y) for fs, cs, y in rows]
    state = {}
    weight = plain_learner(named, settings, state)
    weights = toxicity.weights_of(z, n, settings)
    assert np.allclose(weights, [weight("constant" if f == 0 else f) for f in range(30)])
    assert (weights == 0).any() and (weights != 0).any()


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, f"{'vile ' * (i % 3)}word{i % 7} and word{i % 5} here", int(i % 3 > 0)) for i in range(90)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(3, "a repeated id, later text")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (10_000, 1)], "doc_id long, toxic int")
    return rows, docs, labels


def test_fit_equals_the_plain_schedule(spark, labelled):
    rows, docs, labels = labelled
    settings = toxicity.LearnerSettings(parts=3, rounds=3, l1=0.1, min_texts=4)
    model = toxicity.fit_toxicity(docs, labels, settings=settings)
    texts = {i: (t, y) for i, t, y in rows} | {3: (min(rows[3][1], "a repeated id, later text"), rows[3][2])}
    dealt = spark.range(90).selectExpr("id", "xxhash64(id) as place", "pmod(xxhash64(id), 3) as part").collect()
    known = Counter()
    for part in range(3):
        held = Counter(f for r in dealt if r.part == part for f in set(plain_features(texts[r.id][0])))
        known.update({f: n for f, n in held.items() if n >= settings.min_in_part})
    state = {}
    for _ in range(settings.rounds):
        moved = []
        for part in range(3):
            order = [r.id for r in sorted(dealt, key=lambda r: r.place) if r.part == part]
            examples = []
            for i in order:
                counts = {f: min(c, toxicity.MOST) for f, c in Counter(plain_features(texts[i][0])).items() if known[f] >= 4}
                examples.append(({**counts, "constant": 1}, texts[i][1]))
            own = dict(state)
            weight = plain_learner(examples, settings, own)
            moved.append(own)
        names = set().union(*moved)
        state = {f: tuple(sum(m.get(f, (0.0, 0.0))[k] for m in moved) / 3 for k in (0, 1)) for f in names}
    weight = plain_learner([], settings, state)
    want = sorted(weight(f) for f in state if f != "constant" and weight(f))
    assert np.allclose(sorted(model.weights), want, atol=1e-5) and math.isclose(model.bias, weight("constant"), abs_tol=1e-5)
    scored = {r.doc_id: r.score for r in toxicity.score_toxicity(docs.where("doc_id <> 3"), model).collect()}
    for i, score in scored.items():
        counts = Counter(plain_features(texts[i][0]))
        margin = sum(weight(f) * min(c, toxicity.MOST) for f, c in counts.items() if f in state) + weight("constant")
        assert math.isclose(score, 1 / (1 + math.exp(-margin)), abs_tol=1e-4)


def test_rows_of_all_kinds(spark, labelled, documents, nothing):  # noqa: F811
    _, docs, labels = labelled
    model = toxicity.fit_toxicity(docs, labels, settings=toxicity.LearnerSettings(parts=3, rounds=2, min_texts=4))
    wide = documents.selectExpr("doc_id", "text", "score", "'x' as predicted", "1 as label", "2 as part", "3 as place", "4 as feature")
    result = toxicity.score_toxicity(wide, model)
    assert result.columns == ["doc_id", "text", "label", "part", "place", "feature", "score", "predicted"]
    rows = result.collect()
    assert len(rows) == documents.count()
    blank = {r.score for r in rows if not (r.text or "").strip()}
    assert len(blank) == 1 and all(r.predicted == int(r.score >= 0.5) for r in rows)
    assert len({(r.doc_id, r.score) for r in rows if r.doc_id == 14}) == 1
    assert toxicity.score_toxicity(nothing, model).count() == 0
    # Clashing names beside the text and the label are not read in the fit.
    named = docs.selectExpr("doc_id", "text", "1 as label", "2 as id", "3 as place", "4 as part")
    again = toxicity.fit_toxicity(named, labels.selectExpr("doc_id", "toxic", "7 as id", "8 as place"), settings=toxicity.LearnerSettings(parts=3, rounds=2, min_texts=4))
    assert (again.weights == model.weights).all() and again.bias == model.bias


def test_nothing_to_learn_from(spark, documents, nothing):  # noqa: F811
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for docs in (documents, nothing):
        model = toxicity.fit_toxicity(docs, labels)
        assert len(model.weights) == 0 and {r.score for r in toxicity.score_toxicity(documents, model).collect()} == {0.5}
    known = spark.createDataFrame([(6, 1), (7, 1)], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(documents, known).bias > 0  # texts without words teach the constant only


def test_held_out_labels(spark):
    result = catalog.QUERIES["op12_toxicity"](spark, SF_LARGER)
    known = spark.read.parquet(f"{SF_LARGER}/labels.parquet").select("doc_id", "toxic")
    held = result.join(known, "doc_id").where(quality.held_out("doc_id", 5, 0)).select("held_out", "toxic", "predicted", "score").toPandas()
    assert held.held_out.all() and len(held) > 50 and set(held.toxic) == {0, 1}
    assert (held.toxic == held.predicted).mean() >= 0.95
    assert held.score[held.toxic == 1].mean() > held.score[held.toxic == 0].mean() + 0.3
