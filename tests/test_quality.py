from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsloom.errors import DataContractError, DataQualityError, TrainingDataError
from opsloom.operators.contracts import (
    CANONICAL_CONTRACTS,
    CANONICAL_REFERENCES,
    Reference,
    check_schema,
    data_dictionary,
)
from opsloom.operators.joins import checked_join
from opsloom.operators.quality import (
    ERRORS,
    assert_no_nulls,
    check_conservation,
    enforce_references,
    quarantine_split,
    tag_contract,
    tag_rows,
    validate_dataset,
)
from opsloom.sources import views

T0 = datetime(2026, 1, 5, 9)


def test_contract_table(spark):
    assert len(CANONICAL_CONTRACTS) == 9 and len(CANONICAL_REFERENCES) == 9
    assert data_dictionary(CANONICAL_CONTRACTS)["beds"] == {"bed_id": "string", "ward_id": "string"}


def test_schema_is_strict(spark):
    beds = CANONICAL_CONTRACTS["beds"]
    good = spark.createDataFrame([], "bed_id string, ward_id string")
    assert check_schema(good, beds).columns == ["bed_id", "ward_id"]
    for ddl in ("bed_id string", "bed_id string, ward_id string, x int", "bed_id int, ward_id string"):
        with pytest.raises(DataContractError):
            check_schema(spark.createDataFrame([], ddl), beds)


def test_all_copies_and_nulls_are_quarantined(spark):
    rows = [("b1", "w"), ("b1", "w"), ("b2", None), ("b3", "w")]
    clean, quarantine = quarantine_split(
        spark.createDataFrame(rows, "bed_id string, ward_id string"), CANONICAL_CONTRACTS["beds"]
    )
    assert [r.bed_id for r in clean.collect()] == ["b3"]
    bad = quarantine.collect()
    assert sorted(r.bed_id for r in bad) == ["b1", "b1", "b2"]
    assert {r.quality_error for r in bad} == {"not_null: ward_id; unique: bed_id"}
    assert {tuple(r[ERRORS]) for r in bad if r.bed_id == "b2"} == {("not_null: ward_id",)}


def test_empty_table_passes(spark):
    empty = spark.createDataFrame([], CANONICAL_CONTRACTS["admissions"].schema)
    assert tag_contract(empty, CANONICAL_CONTRACTS["admissions"]).count() == 0


def test_hot_duplicate_key_stays_whole(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") < 20_000, 0).otherwise(F.col("id")).alias("k"))
    tagged = tag_rows(rows, key=["k"])
    assert tagged.count() == 30_000
    assert tagged.where(F.size(ERRORS) > 0).count() == 20_000


def test_references_cascade(spark):
    tables = {
        "a": spark.createDataFrame([(1,), (2,)], "a int"),
        "b": spark.createDataFrame([(10, 1), (11, 3)], "b int, a int"),
        "c": spark.createDataFrame([(100, 10), (101, 11), (102, 12)], "c int, b int"),
    }
    out = enforce_references(tables, [Reference("b", "a", "a", "a"), Reference("c", "b", "b", "b")])
    kept = {n: t.where(F.size(ERRORS) == 0).count() for n, t in out.items()}
    assert kept == {"a": 2, "b": 1, "c": 1}
    reasons = {r[ERRORS][0] for r in out["c"].where(F.size(ERRORS) > 0).collect()}
    assert reasons == {"invalid reference: b -> b.b"}


def test_validation_conserves_rows(spark, sf_dir):
    tables = views.canonical_dataset(spark, sf_dir, anomalies=True)
    result = validate_dataset(tables)
    report = {r.table_name: r for r in result.report.collect()}
    assert report["encounters"].quarantined_rows > 0
    for name, table in tables.items():
        row = report[name]
        assert row.input_rows == table.count() == row.valid_rows + row.quarantined_rows
        assert result.clean[name].count() == row.valid_rows
        assert result.quarantine[name].count() == row.quarantined_rows
    with pytest.raises(DataQualityError, match="beds"):
        check_conservation(result.report, {"beds": tables["beds"].unionByName(tables["beds"])})


def test_table_set_must_match(spark):
    with pytest.raises(DataContractError, match="missing"):
        validate_dataset({"beds": spark.createDataFrame([], CANONICAL_CONTRACTS["beds"].schema)})


def test_assert_no_nulls(spark):
    frame = spark.createDataFrame([(1, None)], "a int, b int")
    assert assert_no_nulls(frame, ["a"]) is frame
    with pytest.raises(TrainingDataError, match="b"):
        assert_no_nulls(frame, error=TrainingDataError)


def test_checked_join_rejects_repeated_keys(spark):
    left = spark.createDataFrame([(1,), (1,)], "k int")
    right = spark.createDataFrame([(1, "x")], "k int, v string")
    assert checked_join(left, right, ["k"]).count() == 2
    with pytest.raises(DataQualityError, match="left"):
        checked_join(left, right, ["k"], cardinality="one_to_one")
    with pytest.raises(DataQualityError, match="right"):
        checked_join(right, left, ["k"])


def test_one_to_one_join_proven_in_its_plan(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, _copy string")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, v string")
    joined = checked_join(left, right, ["k"], how="left", cardinality="one_to_one", in_plan=True)
    assert sorted(joined.collect(), key=str) == sorted([(1, "a", "x"), (2, "b", None), (None, "c", None)], key=str)
    for one, two, side in ((left.union(left), right, "left"), (left, right.union(right), "right")):
        twice = checked_join(one, two, ["k"], cardinality="one_to_one", in_plan=True)
        with pytest.raises(Exception, match=f"{side} side repeats its key"):
            twice.select("v").collect()
    with pytest.raises(ValueError, match="one-to-one"):
        checked_join(left, right, ["k"], in_plan=True)


def test_exchanges_of_a_join_proven_in_its_plan(spark, tmp_path):
    for name in ("left", "right"):
        spark.range(50).selectExpr("id as k", f"id as {name}").write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / name)) for name in ("left", "right"))
    joined = checked_join(left, right, ["k"], cardinality="one_to_one", in_plan=True)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and joined.count() == 50


def test_anomalous_encounter_reason(spark):
    contract = CANONICAL_CONTRACTS["encounters"]
    start = T0 - timedelta(minutes=5)
    row = ("e", "a", "d", T0, T0, T0, T0, start, T0 + timedelta(minutes=9), T0 + timedelta(minutes=10))
    tagged = tag_contract(spark.createDataFrame([row], contract.schema), contract)
    assert tagged.first()[ERRORS] == ["queue_entered_at <= consultation_started_at"]
