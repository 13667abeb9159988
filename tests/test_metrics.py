import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from opsloom.operators import metrics as m


def values(frame, *keys):
    return {tuple(r[k] for k in (*keys, "metric")) if keys else r.metric: r.value for r in frame.collect()}


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"y": rng.integers(0, 2, 500), "p": np.round(rng.random(500), 2)})
    pdf.loc[:150, "p"] = 0.5
    return pdf, spark.createDataFrame(pdf)


def test_regression(spark):
    rows = [(10.0, 12.0), (20.0, 17.0), (5.0, 5.0), (8.0, 18.0)]
    got = values(m.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p"))
    errors = np.array([2.0, -3.0, 0.0, 10.0])
    assert got["mae"] == pytest.approx(np.abs(errors).mean())
    assert got["rmse"] == pytest.approx(np.sqrt((errors**2).mean()))
    assert got["median_absolute_error"] == pytest.approx(np.median(np.abs(errors)))
    assert got["p90_absolute_error"] == pytest.approx(np.quantile(np.abs(errors), 0.9))
    assert got["underprediction_rate"] == 0.25


def test_forecast_denominator_is_at_least_one(spark):
    rows = spark.createDataFrame([(0.0, 0.5), (0.0, 0.25)], "y double, p double")
    got = values(m.forecast_metrics(rows, "y", "p"))
    assert got["wape"] == 0.75 and got["bias"] == 0.375
    assert set(values(m.occupancy_metrics(rows, "y", "p"))) == {"mae_beds", "rmse_beds", "wape"}


def test_ranking_against_brute_force(scored):
    pdf, frame = scored
    got = values(m.classification_metrics(frame, "y", "p", 0.6))
    pos, neg = pdf.p[pdf.y == 1].to_numpy(), pdf.p[pdf.y == 0].to_numpy()
    pairs = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    assert got["roc_auc"] == pytest.approx(pairs)
    ap = 0.0
    for t in np.unique(pdf.p)[::-1]:
        chosen = pdf.p >= t
        ap += pdf.y[pdf.p == t].sum() / pdf.y.sum() * pdf.y[chosen].mean()
    assert got["pr_auc"] == pytest.approx(ap)
    assert got["brier_score"] == pytest.approx(((pdf.p - pdf.y) ** 2).mean())
    chosen = pdf.p >= 0.6
    assert got["precision"] == pytest.approx(pdf.y[chosen].mean())
    assert got["recall"] == pytest.approx(pdf.y[chosen].sum() / pdf.y.sum())
    assert got["selection_rate"] == pytest.approx(chosen.mean())
    edges = np.linspace(0, 1, 11)
    ece = 0.0
    for low, high in zip(edges[:-1], edges[1:]):
        mask = (pdf.p >= low) & ((pdf.p <= high) if high == 1 else (pdf.p < high))
        if mask.any():
            ece += mask.mean() * abs(pdf.y[mask].mean() - pdf.p[mask].mean())
    assert got["expected_calibration_error"] == pytest.approx(ece)


def test_nothing_selected_gives_zero(spark):
    got = values(m.classification_metrics(spark.createDataFrame([(1, 0.2), (0, 0.1)], "y int, p double"), "y", "p", 0.9))
    assert got["precision"] == got["recall"] == got["f1"] == 0.0
    assert got["roc_auc"] == 1.0


def test_calibration_edges_are_the_equal_bins():
    assert list(m.CALIBRATION_EDGES) == np.linspace(0, 1, 11)[1:-1].tolist()


def test_alerts(spark):
    rows = [(8.0, 9.0, 10), (9.0, 1.0, 10), (1.0, 9.0, 10), (1.0, 1.0, 10)]
    got = values(m.alert_metrics(spark.createDataFrame(rows, "y double, p double, c int"), "y", "p", "c", 0.8))
    assert got == {"alert_recall": 0.5, "false_alert_rate": 0.5}
    quiet = spark.createDataFrame([(1.0, 1.0, 10)], "y double, p double, c int")
    assert values(m.alert_metrics(quiet, "y", "p", "c", 0.8)) == {"alert_recall": 0.0, "false_alert_rate": 0.0}


def test_peak_mae_and_coverage(spark):
    rows = spark.createDataFrame([(i, "a", float(i), float(i) + 1) for i in range(11)], "i int, g string, y double, p double")
    assert values(m.peak_mae(rows, "y", "p", ["g"]), "g") == {("a", "peak_mae"): 1.0}
    bounded = rows.withColumns({"lo": F.lit(0.0), "hi": F.lit(5.0)})
    assert values(m.interval_coverage(bounded, "y", "lo", "hi"))["interval_coverage"] == pytest.approx(6 / 11)


def test_a_ward_outside_the_list_stops_the_pivot(spark):
    from opsloom.operators.profile import occupancy_pivot

    points = spark.sql("select timestamp'2026-01-01' as interval_start, w as ward_id, 0.5D as predicted_occupancy_ratio from values ('a'), ('b') t(w)")
    assert occupancy_pivot(points, ["a", "b"]).first().asDict()["b"] == 0.5
    with pytest.raises(Exception, match="missing from the list"):
        occupancy_pivot(points, ["a"]).collect()
