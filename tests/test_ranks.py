"""Exact order statistics and two-level running totals against brute force, with hot groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opsloom.functions import ranks
from opsloom.functions.ranks import Rank, exact_percentiles, values_at_ranks
from opsloom.functions.running import previous_value, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """Group ``hot`` holds most rows; a third of those share one value."""
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(100, 40, 60_000), 3)
    values[rng.random(60_000) < 0.33] = 77.5
    keys = np.where(rng.random(60_000) < 0.8, "hot", rng.choice(list("abcde"), 60_000))
    frame = pd.DataFrame({"key": keys, "value": values, "id": np.arange(60_000)})
    return frame, spark.createDataFrame(frame).repartition(6)


@pytest.mark.parametrize(("steps", "slots"), [(ranks.LOG_STEPS, ranks.SLOTS), (1, 4), (16, 100)])
def test_percentiles_equal_numpy(skewed, monkeypatch, steps, slots):
    monkeypatch.setattr(ranks, "LOG_STEPS", steps)
    monkeypatch.setattr(ranks, "SLOTS", slots)
    local, frame = skewed
    points = {"p0": 0.0, "p10": 0.1, "p33": 0.333, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = exact_percentiles(frame, ["key"], "value", points).toPandas().set_index("key")
    for key, group in local.groupby("key"):
        for name, p in points.items():
            assert got.loc[key, name] == pytest.approx(np.quantile(group.value, p), abs=1e-9)
        assert got.loc[key, "n"] == len(group)


def test_percentile_of_whole_table_and_of_nothing(skewed):
    local, frame = skewed
    row = exact_percentiles(frame, [], "value", {"m": 0.5}).first()
    assert row.m == pytest.approx(np.median(local.value))
    assert exact_percentiles(frame.where("value > 1e9"), [], "value", {"m": 0.5}).count() == 0


def test_equal_neighbours_give_that_value(spark):
    frame = spark.createDataFrame([(0.1,)] * 7, "v double")
    assert exact_percentiles(frame, [], "v", {"q": 0.3}).first().q == 0.1


def test_values_at_ranks(skewed):
    local, frame = skewed
    row = values_at_ranks(frame, [], "id", {"a": Rank("0"), "b": Rank("n div 2")}).first()
    assert (row.a, row.b) == (0, 30_000)


def test_first_and_last(skewed):
    local, frame = skewed
    row = values_at_ranks(frame, [], "value", {"a": Rank("0"), "b": Rank("n - 1")}).first()
    assert (row.a, row.b) == (local.value.min(), local.value.max())


def test_outlier_and_heavy_tail(spark):
    values = [5.0] * 999 + [1e12] + [float(2**i) for i in range(60)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_percentiles(frame, [], "v", {"p50": 0.5, "p99": 0.99, "p100": 1.0}).first()
    want = np.quantile(values, [0.5, 0.99, 1.0])
    assert (row.p50, row.p99, row.p100) == pytest.approx(tuple(want), rel=1e-12)


def test_close_and_odd_numbers(spark):
    """Neighbouring doubles, denormal ones, both signs, zeros, infinities and NaN keep their order."""
    near = [1.0]
    for _ in range(40):
        near.append(float(np.nextafter(near[-1], 2)))
    odd = [float("-inf"), -1e308, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1e-300, 1e308, float("inf"), float("nan")]
    values = sorted(near + odd[:-1]) + odd[-1:]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    named = {f"r{i}": Rank(str(i)) for i in range(len(values))}
    row = values_at_ranks(frame.repartition(5), [], "v", named).first()
    np.testing.assert_array_equal([row[name] for name in named], values)


def test_long_numbers(spark):
    """Longs that are one double apart from their neighbours, and the ends of the type."""
    values = sorted({-(2**63), 2**63 - 1, *range(2**62, 2**62 + 50), *range(-3, 4), *(1_700_000_000_000_000 + 7 * i for i in range(500))})
    frame = spark.createDataFrame([(v, "k") for v in values], "v long, k string")
    named = {f"r{i}": Rank(str(i)) for i in range(len(values))}
    row = values_at_ranks(frame, ["k"], "v", named).first()
    assert [row[name] for name in named] == values and row.n == len(values)


def test_weighted_values_equal_repeated_ones(skewed, spark):
    local, frame = skewed
    counts = frame.groupBy("key", "value").agg(F.count("*").alias("n_rows"))
    points = {"p10": 0.1, "p50": 0.5, "p97": 0.97}
    got = exact_percentiles(counts, ["key"], "value", points, weight="n_rows").toPandas().set_index("key")
    for key, group in local.groupby("key"):
        assert got.loc[key, "n"] == len(group)
        assert [got.loc[key, p] for p in points] == pytest.approx([np.quantile(group.value, p) for p in points.values()], abs=1e-9)


def test_decimals_and_null_keys(spark):
    frame = spark.sql("select cast(id as decimal(12,2)) / 4 as v, nullif(id % 3, 0) as k from range(300)")
    got = {r.k: (r.n, float(r.a)) for r in values_at_ranks(frame, ["k"], "v", {"a": Rank("n - 1")}).collect()}
    assert got == {1: (100, 298 / 4), 2: (100, 299 / 4)}


@pytest.mark.parametrize("include", [True, False])
def test_running_totals(skewed, include):
    local, frame = skewed
    out = running_totals(
        frame, ["key"], ["id"], {"s": F.lit(2)}, F.floor(F.col("id") / 997), include_current=include
    ).toPandas()
    ordered = out.sort_values(["key", "id"])
    expected = (ordered.groupby("key").cumcount() + (1 if include else 0)) * 2
    assert len(out) == len(local)
    assert (ordered.s == expected).all()


def test_previous_value_crosses_buckets(skewed):
    local, frame = skewed
    out = previous_value(frame, ["key"], ["id"], "value", "before", F.floor(F.col("id") / 997)).toPandas()
    ordered = out.sort_values(["key", "id"])
    expected = ordered.groupby("key").value.shift(1)
    assert ordered.before.fillna(-1).tolist() == expected.fillna(-1).tolist()
