"""The pipeline's stages one by one against brute force on their own inputs."""

import re

import corpus_pipeline
import pytest
from conftest import SF
from test_text_groups import _components, _without_repeats

from opsloom.llm import common

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(common.staged(stage(spark, results[-1], SF), f"test-{name}"))
    return [r.toPandas().sort_values("doc_id", ignore_index=True) for r in results]


def test_columns(tables):
    assert all(list(t.columns) == COLUMNS for t in tables[:5])
    assert [len(corpus_pipeline.STAGES), len(tables)] == [5, 6]


def test_quality_keeps_good_and_drops_bad(spark, tables):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = set(tables[1].doc_id)
    wrong = [i for i, q in labels.items() if (i in kept) != (q == 1)]
    assert len(wrong) <= 0.03 * len(labels)


def test_near_dedup_keeps_one_of_each_group(tables):
    want, _ = _components(list(zip(tables[1].doc_id, tables[1].text, strict=True)))
    assert set(tables[2].doc_id) == set(want.values())


def test_suffix_dedup_removes_repeats_only(tables):
    before, after = tables[2], tables[3]
    assert (before.doc_id == after.doc_id).all() and (after.n_chars == after.text.str.len()).all()
    for (size, removed, spans, _), old, new in zip(_without_repeats(before.text), before.text, after.text, strict=True):
        # A repeat that ends inside a character leaves that character whole.
        assert 0 <= len(new.encode()) - (size - removed) <= 6 * spans
        assert removed or new == old


def test_decontamination_drops_what_holds_a_window(spark, tables):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    windows = set()
    for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(row.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w}
    lengths = {len(w) for w in windows}

    def hit(text):
        w = words(text)
        return any(tuple(w[i : i + n]) in windows for n in lengths for i in range(len(w) - n + 1))

    before, kept = tables[3], set(tables[4].doc_id)
    assert {i for i, t in zip(before.doc_id, before.text, strict=True) if not hit(t)} == kept


def test_pieces_come_back(tables):
    assert set(tables[5].doc_id) == set(tables[4].doc_id) and tables[5].round_trip.all()
    assert (tables[5].n_pieces == tables[5].pieces.str.len() // 4).all()
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5), (3, "a b c", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sizes = [len(rows)]
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = common.staged(stage(spark, docs, SF), "odd")
        sizes.append(docs.count())
    assert sizes == [5, 4, 4, 4, 4]  # one of the repeated rows goes
    assert all(stage(spark, docs.limit(0).withColumn("text", docs.lang), SF).count() == 0 for _, stage in corpus_pipeline.STAGES[1:])
