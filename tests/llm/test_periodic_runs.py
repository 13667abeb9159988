"""Periodic runs against a plain search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
from conftest import SF
from tests_llm_helpers import documents, nothing  # noqa: F401

from opsloom.llm import catalog, periodic_runs


def plain_runs(words):
    """Every maximal stretch of every period, kept if no smaller period holds it."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w = np.array([number[x] for x in words], np.int64)
    found = []
    for q in range(1, len(w) // 4 + 1):
        same = np.concatenate([[False], w[q:] == w[:-q], [False]])
        starts, ends = np.flatnonzero(~same[:-1] & same[1:]), np.flatnonzero(same[:-1] & ~same[1:])
        for i, size in zip(starts.tolist(), (ends - starts + q).tolist(), strict=True):
            part = w[i : i + size]
            if size >= max(6, 4 * q) and all((part[p:] != part[:-p]).any() for p in range(1, q)):
                found.append((i, size, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(words, found):
    dropped = {i for start, size, q in found for i in range(start + q, start + size)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def with_tail(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_random_words_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(0, 4)):
            words, most = [], rng.choice([0, 3, 12, 90])
            while len(words) < most:
                block = [rng.randint(0, rng.choice([0, 1, 3, 9])) for _ in range(rng.randint(1, 12))]
                words += [block[i % len(block)] for i in range(rng.choice([1, len(block), rng.randint(1, 60)]))]
            texts.append(words)
        flat = np.array([w for t in texts for w in t], np.uint64)
        start, size, period = periodic_runs.word_runs(flat, np.array([len(t) for t in texts], np.int64))
        want, before = [], 0
        for t in texts:
            want += [(before + i, n, q) for i, n, q in plain_runs(t)]
            before += len(t)
        assert list(zip(start.tolist(), size.tolist(), period.tolist(), strict=True)) == want


def test_rows_of_all_kinds(spark, documents):
    more = [(20, "a a a a a"), (21, "a a a a a a"), (22, "x a b a b a b a b y y y y y y"), (23, "a b c\v" * 30), (24, "a A a A a A")]
    rows = documents.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    # Columns whose names the operator uses itself are not read.
    rows = rows.selectExpr("doc_id", "text", "1 as id", "'x' as runs", "2 as n_words", "3 as collapsed", "4 as h", "5 as __best")
    want = []
    for doc_id, text in rows.select("doc_id", "text").collect():
        words = words_of(text)
        found = plain_runs(words)
        want.append((doc_id, len(words), found, collapsed(words, found)))
    result = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(rows).collect()]
    assert sorted(result, key=str) == sorted(want, key=str)


def test_no_rows_and_null_keys(spark, nothing):
    assert periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.with_periodic_tails(nothing))).count() == 0
    rows = spark.createDataFrame([(None, "b b b b b b b"), (None, None)], "doc_id long, text string")
    result = periodic_runs.run_digests(periodic_runs.find_runs(periodic_runs.with_periodic_tails(rows))).collect()
    assert sorted((r.n_runs, r.period, r.exponent_milli) for r in result if r.n_runs) == [(1, 1, 7000)]
    assert [(r.start, r.length, r.period, r.exponent_milli) for r in result if not r.n_runs] == [(None,) * 4]


def test_query_equals_a_plain_search(spark):
    result = {r.doc_id: r for r in catalog.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(result) == len(docs)
    for doc_id, text in docs:
        words = with_tail(doc_id, words_of(text))
        found = plain_runs(words)
        row = result[doc_id]
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
        longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (row.start, row.length, row.period, row.exponent_milli) == longest and row.n_runs == len(found)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{i},{n},{q}\n" for i, n, q in found).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
