"""Operators that compare texts with one another, against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from opsloom.llm import components, decontaminate, fingerprints, licenses, near_dedup, suffix_dedup
from tests_llm_helpers import SHARED, TEXTS, documents, nothing, prose, shingles  # noqa: F401


def _components(texts, percent=75):
    sets = {i: shingles(t) for i, t in texts if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if a < b and both and 100 * both >= percent * union:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark, documents, nothing):
    base = prose(50, 120).split()
    edited = []
    for k in range(40):  # near copies at both sides of the limit
        rng = np.random.default_rng(k)
        words = list(base)
        for at in rng.choice(len(words), k % 9, replace=False):
            words[at] = f"edit{k}x{at}"
        edited.append((100 + k, " ".join(words)))
    rows = TEXTS + edited
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want, sizes = _components(rows)
    found = near_dedup.near_duplicate_groups(frame).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.component_id, row.n_shingles) == (want[row.doc_id], sizes[row.doc_id])
            assert row.kept == (row.doc_id == row.component_id)
    assert near_dedup.near_duplicate_groups(nothing).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (7, 5), (5, 7), (9, 8), (8, 4), (4, 10), (None, 1), (20, 21)] + [(30, 31 + i) for i in range(30)]
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long"))
    parts = {}
    for row in got.collect():
        parts.setdefault(row.component, set()).add(row.node)
    assert parts == {1: {1, 2, 3}, 5: {5, 7}, 4: {4, 8, 9, 10}, 20: {20, 21}, 30: set(range(30, 61))}


def _without_repeats(texts, size=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + size] for b in raw for i in range(len(b) - size + 1))
    result = []
    for b in raw:
        covered = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                covered[i : i + size] = True
        spans = int((covered[:-1] & ~np.append(False, covered[:-2])).sum()) if len(b) else 0
        kept = bytes(x for x, out in zip(b, covered, strict=False) if not out)
        result.append((len(b), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return result


@pytest.mark.parametrize("parts", ["3", "97"])
def test_suffix_dedup_equals_brute_force(spark, nothing, parts):
    """With many parts most anchors lie at the edge of a bucket and are met across boundaries."""
    rows = [(i, t) for i, t in TEXTS if i != 11] + [
        (20, prose(70, 100)), (21, "k" + prose(70, 100)[150:480] + "m"), (22, prose(71, 90)[:300] + prose(70, 100)[100:400]),
        (23, SHARED + SHARED), (24, "é" * 150), (25, "è" + "é" * 150),
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        found = suffix_dedup.remove_repeats(frame).collect()
        assert suffix_dedup.remove_repeats(nothing).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = Counter((i, *w) for (i, _), w in zip(rows, _without_repeats([t for _, t in rows]), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == want
    assert all(len(r.kept_text.encode()) >= r.n_bytes - r.n_removed for r in found)
    assert all(r.kept_text == (r.text or "") for r in found if not r.n_removed)


def test_fingerprints(documents, nothing):
    rows = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [t or "" for _, t in rows]
    found = fingerprints.compare_with_edits(documents).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for (i, _), text, following in zip(rows, texts, texts[1:] + texts[:1], strict=True):
        if i == 14:
            continue  # a repeated row follows itself
        row, changed = by_id[i], len(text) // 4
        edited = text[: len(text) - changed] + following[:changed]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((row.near_edited, edited), (row.near_next, following)):
            a, b = shingles(text), shingles(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0, abs=0.15)
    assert by_id[1].fingerprint == by_id[2].fingerprint and by_id[6].fingerprint == by_id[7].fingerprint == ""
    assert fingerprints.compare_with_edits(nothing).count() == 0


def test_sketches_merge_and_estimate(spark):
    one, two = prose(80, 900), prose(81, 600)
    frame = spark.createDataFrame([("g", one), ("g", two), ("h", one), ("h", None)], "key string, text string")
    printed = fingerprints.fingerprint_texts(frame)
    merged = {r.key: r.hashes for r in fingerprints.merge_fingerprints(printed, ["key"]).collect()}
    alone = [fingerprints.from_text(r.fingerprint) for r in printed.where("key = 'g'").collect()]
    assert merged["g"] == fingerprints.merge(*alone).tolist() and len(merged["h"]) == fingerprints.SKETCH_SIZE
    sets = [shingles(one), shingles(two)]
    assert fingerprints.distinct_shingles(np.array(merged["g"])) == pytest.approx(len(sets[0] | sets[1]), rel=0.3)
    assert fingerprints.containment(alone[0], fingerprints.merge(*alone)) > 0.8


BENCHMARK = [(1, prose(90, 25)), (2, "Short Item here."), (3, None), (4, "..."), (None, prose(91, 20)), (5, SHARED), (5, SHARED)]


def test_decontamination_equals_brute_force(spark, nothing):
    import re

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    rows = TEXTS + [
        (30, prose(7, 10) + " " + prose(90, 25)), (31, " ".join(prose(90, 25).split()[3:14])), (32, "a SHORT item, here"),
        (33, "short item"), (34, " ".join(prose(90, 25).split()[:9])), (35, prose(91, 20)),
    ]
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    windows = {}
    for item, text in BENCHMARK:
        w = words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    want = Counter()
    for i, text in rows:
        w, hit, items = words(text), set(), set()
        for window, names in windows.items():
            for at in range(len(w) - len(window) + 1):
                if tuple(w[at : at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    items |= names
        want[(i, len(w), len(hit), tuple(sorted(map(str, items))), bool(hit))] += 1
    found = decontaminate.mark_contaminated(frame, benchmark).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found) == want
    assert sum(r.contaminated for r in found) >= 4
    assert decontaminate.mark_contaminated(nothing, benchmark).count() == 0
    assert decontaminate.mark_contaminated(frame, benchmark.limit(0)).where("contaminated").count() == 0


def test_near_matches(spark):
    places = [("a", 1, 1, 0), ("b", 1, 1, 7), ("a", 2, 2, 0), ("b", 2, 2, 8), ("a", 3, 3, 50), ("b", 3, 3, 44)]
    index = spark.createDataFrame(places, "word string, row_a long, row_b int, place int")
    pairs = spark.createDataFrame([("p", "a", "b")], "pair string, first string, second string")
    assert {r.row_a for r in decontaminate.near_matches(index, pairs, 7).collect()} == {1, 3}


def test_licenses(spark, documents, nothing):
    mit = licenses.TEMPLATES["MIT"]
    broken = " ".join(w for k, w in enumerate(mit.split()) if k % 40 != 20)
    rows = [
        (1, prose(1, 30) + " " + mit + " " + prose(2, 30)), (2, prose(3, 20) + "\nReleased under the MIT License.\n" + prose(4, 9)),
        (3, broken), (4, " ".join(mit.split()[:40])), (5, None), (6, "released UNDER the mit license"), (6, "released UNDER the mit license"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text")
    found = Counter((r.doc_id, tuple(r.licenses)) for r in licenses.scan_licenses(frame).collect())
    notice = ("MIT-notice",)
    assert found == {(1, ("MIT",)): 1, (2, notice): 1, (3, ("MIT",)): 1, (4, ()): 1, (5, ()): 1, (6, notice): 2}
    clean = licenses.scan_licenses(documents).collect()
    assert len(clean) == len(TEXTS) and not any(r.n_licenses for r in clean)
    assert licenses.scan_licenses(nothing).count() == 0


def test_stacked_licenses_equal_the_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from opsloom.llm import catalog

    names, rng = sorted(licenses.TEMPLATES), np.random.default_rng(8)
    stacks = [(a, b) for a in names for b in names if a != b]
    texts = ["\n".join(licenses.TEMPLATES[n] for n in stack) for stack in stacks]
    for k in range(150):
        three = [licenses.TEMPLATES[names[i]] for i in rng.permutation(len(names))[:3]]
        texts.append(" ".join([prose(k, 20), *three, prose(k + 500, 20)]))
    half = licenses.TEMPLATES["ISC"].split()
    texts.append(" ".join([*half[:15], prose(7, 80), *half[15:]]))  # in two places far apart
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: ",".join(r.licenses) for r in licenses.scan_licenses(frame).collect()}
    database = duckdb.connect()
    database.register("documents", frame.toArrow())
    wanted = {row[0]: row[2] for row in database.execute(catalog.ORACLES["op8_licenses"]).fetchall()}
    assert found == wanted
    assert all(set(stack) <= set(found[i].split(",")) for i, stack in enumerate(stacks))
