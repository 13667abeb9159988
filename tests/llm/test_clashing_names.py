"""Every operator keeps columns whose names it might want for itself, and its results with them."""

import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import LONG, TEXTS, documents  # noqa: F401

from opsloom.llm import decontaminate, licenses, near_dedup, pieces, quality, suffix_dedup, token_counts

NAMES = ("row", "row_a", "row_b", "row_hash", "span_row", "row_check", "row_spans", "spans", "first", "check", "stretch", "id", "word", "words", "start",
         "size", "n", "chunk", "part", "ids", "joined_ids", "place", "band", "template", "held_licenses", "hit_count", "hit_items", "word_count", "key", "value")


@pytest.fixture(scope="module")
def wide(spark, documents):  # noqa: F811
    plain = documents.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"])
    return plain, plain.select("doc_id", "text", *(F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in NAMES))


def _same(result, reference, added):
    """The added columns are those without clashes, and the others come back as they went in."""
    assert [c for c in NAMES if c not in result.columns] == []
    rows = {r.doc_id: r for r in result.collect()}
    want = {r.doc_id: r for r in reference.collect()}
    assert set(rows) == set(want)
    for doc_id, row in rows.items():
        assert all(row[c] == want[doc_id][c] for c in added)
        assert all(row[n] == f"{n}-{doc_id}" for n in NAMES)


def test_suffix_dedup(wide):
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    _same(suffix_dedup.remove_repeats(wide[1]), suffix_dedup.remove_repeats(wide[0]), added)


def test_licenses(wide):
    held = [f.withColumn("text", F.concat_ws(" ", "text", F.lit("Released under the MIT License."))) for f in wide]
    assert licenses.scan_licenses(held[0]).where("n_licenses = 1").count() == held[0].count()
    _same(licenses.scan_licenses(held[1]), licenses.scan_licenses(held[0]), ["licenses", "n_licenses"])


def test_pieces(spark, wide):
    from pathlib import Path

    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    assert len(LONG) > 4096
    results = [pieces.encode_texts(f, model, chunk=4096) for f in (wide[1], wide[0])]
    _same(*results, ["pieces", "n_pieces"])


def test_decontamination(spark, wide):
    words = re.findall(r"\w+", TEXTS[0][1])
    benchmark = spark.createDataFrame([("i1", " ".join(words[3:20])), ("i2", "none of it")], "item_id string, text string")
    added = ["n_words", "n_hit", "n_items", "items", "contaminated"]
    _same(decontaminate.mark_contaminated(wide[1], benchmark), decontaminate.mark_contaminated(wide[0], benchmark), added)


def test_quality_and_token_counts(spark, wide):
    model = quality.fit_quality(wide[0], spark.createDataFrame([(1, 1), (13, 0)], "doc_id long, quality int"))
    _same(quality.score_quality(wide[1], model), quality.score_quality(wide[0], model), ["score", "predicted"])
    from pathlib import Path

    definition = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    _same(token_counts.count_tokens(wide[1], definition), token_counts.count_tokens(wide[0], definition), ["n_bytes", "n_tokens", "over_limit"])


def test_near_duplicates(wide):
    one, two = (sorted(map(tuple, near_dedup.near_duplicate_groups(f).collect())) for f in wide)
    assert one == two


def test_proximity_equals_plain_search(spark, wide):
    texts = {r.doc_id: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")) for r in wide[0].collect()}
    some = texts[1]
    items = {"a": f"{some[5]} xx {some[9]}", "b": " ".join(some[20:24]), "c": "one", "d": f"{some[0]} {texts[5][40]}", "e": "absent words", "f": " ".join(texts[11][100:103])}
    benchmark = spark.createDataFrame([*items.items(), ("a", items["a"]), (None, "x y"), ("g", None)], "item_id string, text string")
    counts = {}
    for words in texts.values():
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    for terms, distance in ((2, 10), (3, 4), (2, 1)):
        want = set()
        for item, text in items.items():
            rarest = sorted({(counts.get(w, 0), w) for w in text.lower().split()})[:terms]
            if len(rarest) < terms or rarest[0][0] == 0:
                continue
            for doc_id, words in texts.items():
                at = [[i for i, w in enumerate(words) if w == r] for _, r in rarest]
                near = [any(0 < abs(i - j) <= distance for i in a for j in b) for a, b in zip(at, at[1:], strict=False)]
                if all(near):
                    want.add((doc_id, item))
        got = decontaminate.benchmark_neighbours(wide[1], benchmark, terms=terms, distance=distance)
        assert {tuple(r) for r in got.collect()} == want and (want or distance == 1)
    assert decontaminate.benchmark_neighbours(wide[0].limit(0), benchmark).count() == 0
    assert decontaminate.benchmark_neighbours(wide[0], benchmark.limit(0)).count() == 0
    with pytest.raises(ValueError):
        decontaminate.benchmark_neighbours(wide[0], benchmark, terms=1)
