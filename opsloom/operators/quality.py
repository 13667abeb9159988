"""Row rules, quarantine, reference checks and the quality report.

Every table is tagged once: ``row_errors`` lists all rules a row breaks. Clean rows and
quarantined rows are two filters over the tagged table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.errors import DataQualityError
from opsloom.functions.staging import materialize
from opsloom.operators.contracts import (
    CANONICAL_CONTRACTS,
    CANONICAL_REFERENCES,
    Reference,
    Rule,
    TableContract,
    check_schema,
    check_tables,
)

ERRORS = "row_errors"


def null_errors(columns: Sequence[str]) -> list[Column]:
    return [F.when(F.col(c).isNull(), F.lit(f"not_null: {c}")) for c in columns]


def rule_errors(rules: Sequence[Rule]) -> list[Column]:
    # A null operand is the not-null rule's finding, so it does not break a comparison too.
    return [
        F.when(~F.coalesce(F.expr(rule.predicate), F.lit(True)), F.lit(rule.name)) for rule in rules
    ]


def duplicate_keys(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, counted with a map-side combine."""
    return frame.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def tag_rows(
    frame: DataFrame,
    *,
    not_null: Sequence[str] = (),
    key: Sequence[str] = (),
    rules: Sequence[Rule] = (),
) -> DataFrame:
    """Add ``row_errors``, the broken rules of each row in rule order.

    All copies of a duplicate key are marked. The row itself is never grouped by its key: the
    duplicate keys are joined back, and the engine broadcasts them or splits a hot key.
    """
    errors = null_errors(not_null) + rule_errors(rules)
    if key:
        copies = duplicate_keys(frame, key).select(*key, F.lit(True).alias("_copied"))
        frame = frame.join(copies, list(key), "left")
        errors.append(F.when(F.col("_copied"), F.lit(f"unique: {', '.join(key)}")))
    if not errors:
        return frame.withColumn(ERRORS, F.array().cast("array<string>"))
    return frame.withColumn(ERRORS, F.array_compact(F.array(*errors))).drop("_copied")


def tag_contract(frame: DataFrame, contract: TableContract) -> DataFrame:
    checked = check_schema(frame, contract)
    tagged = tag_rows(
        checked, not_null=contract.schema.names, key=contract.key, rules=contract.rules
    )
    return tagged.select(*contract.schema.names, ERRORS)


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(ERRORS) == 0).drop(ERRORS)


def table_error(tagged: DataFrame) -> Column:
    """All distinct broken rules of the table in one string, as a scalar subquery."""
    broken = tagged.select(F.explode(ERRORS).alias("error")).distinct()
    return broken.agg(F.array_join(F.array_sort(F.collect_list("error")), "; ")).scalar()


def quarantine_rows(tagged: DataFrame, *, table_wide: bool = True) -> DataFrame:
    """Rows with errors, and ``quality_error`` as text.

    ``table_wide`` gives every row the joined errors of the whole table; otherwise each row
    carries only its own.
    """
    own = F.array_join(ERRORS, "; ")
    error = table_error(tagged) if table_wide else own
    return tagged.where(F.size(ERRORS) > 0).withColumn("quality_error", error)


def quarantine_split(
    frame: DataFrame, contract: TableContract, *, table_wide: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Clean rows and quarantined rows of one table, whose rules are evaluated once and written."""
    tagged = materialize(tag_contract(frame, contract), "tagged")
    return clean_rows(tagged), quarantine_rows(tagged, table_wide=table_wide)


def tag_references(
    tagged: Mapping[str, DataFrame], references: Sequence[Reference], *, stage: bool = False
) -> dict[str, DataFrame]:
    """Mark rows whose parent is missing, in list order, so that losses cascade.

    A parent counts only if it is itself still clean. With ``stage`` each table is written once,
    when it is final, so that a chain of children does not recompute its ancestors.
    """
    last_use = {r.child: i for i, r in enumerate(references)}
    state = {
        name: materialize(table, f"checked-{name}") if stage and name not in last_use else table
        for name, table in tagged.items()
    }
    for position, ref in enumerate(references):
        child, parent = state[ref.child], state[ref.parent]
        present = (
            parent.where(F.size(ERRORS) == 0)
            .select(F.col(ref.primary_key).alias("_parent"))
            .distinct()
            .withColumn("_found", F.lit(True))
        )
        lost = (F.size(ERRORS) == 0) & F.col("_found").isNull()
        joined = child.join(present, child[ref.foreign_key] == present["_parent"], "left")
        state[ref.child] = joined.withColumn(
            ERRORS, F.when(lost, F.array(F.lit(ref.reason))).otherwise(F.col(ERRORS))
        ).select(*child.columns)
        if stage and last_use[ref.child] == position:
            state[ref.child] = materialize(state[ref.child], f"checked-{ref.child}")
    return state


def enforce_references(
    tables: Mapping[str, DataFrame], references: Sequence[Reference]
) -> dict[str, DataFrame]:
    """The reference check alone, on tables without row errors."""
    empty = F.array().cast("array<string>")
    return tag_references({n: t.withColumn(ERRORS, empty) for n, t in tables.items()}, references)


def quality_report(tagged: Mapping[str, DataFrame]) -> DataFrame:
    """Input, valid and quarantined rows per table."""
    parts = [
        frame.select(F.lit(name).alias("table_name"), (F.size(ERRORS) == 0).alias("_valid"))
        for name, frame in tagged.items()
    ]
    counts = reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(
        F.count("*").alias("input_rows"),
        F.count_if("_valid").alias("valid_rows"),
        F.count_if(~F.col("_valid")).alias("quarantined_rows"),
    )
    # A table without rows still has a line.
    spark = counts.sparkSession
    names = spark.createDataFrame([(n,) for n in tagged], "table_name string")
    return names.join(counts, "table_name", "left").na.fill(0)


def check_conservation(report: DataFrame, inputs: Mapping[str, DataFrame]) -> None:
    """Raise unless every input row is either valid or quarantined."""
    parts = [
        t.agg(F.count("*").alias("rows_in")).withColumn("table_name", F.lit(n))
        for n, t in inputs.items()
    ]
    counted = reduce(DataFrame.unionByName, parts)
    lost = (
        report.join(counted, "table_name")
        .where("rows_in <> valid_rows + quarantined_rows")
        .select("table_name")
    )
    if names := sorted(r.table_name for r in lost.collect()):  # at most one row per table
        raise DataQualityError(f"row conservation failed for {names}")


@dataclass(frozen=True)
class ValidationResult:
    tagged: dict[str, DataFrame]
    clean: dict[str, DataFrame]
    quarantine: dict[str, DataFrame]
    report: DataFrame


def validate_dataset(
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, TableContract] = CANONICAL_CONTRACTS,
    references: Sequence[Reference] = CANONICAL_REFERENCES,
    *,
    stage: bool = True,
    table_wide: bool = True,
) -> ValidationResult:
    """Contract check, quarantine and reference cascade over a whole dataset; every input row must be accounted for."""
    check_tables(tables, contracts)
    tagged = {name: tag_contract(tables[name], contracts[name]) for name in tables}
    tagged = tag_references(tagged, references, stage=stage)
    report = materialize(quality_report(tagged), "quality-report")
    check_conservation(report, tables)
    return ValidationResult(
        tagged=tagged,
        clean={n: clean_rows(t) for n, t in tagged.items()},
        quarantine={n: quarantine_rows(t, table_wide=table_wide) for n, t in tagged.items()},
        report=report,
    )


def assert_no_nulls(
    frame: DataFrame, columns: Sequence[str] | None = None, error: type[Exception] = DataQualityError
) -> DataFrame:
    """Raise when any of ``columns`` holds a null, looked up in one aggregation."""
    names = list(columns or frame.columns)
    row = null_flags(frame, names).first()
    if found := [n for n in names if row[n]]:
        raise error(f"nulls in {found}")
    return frame


def null_flags(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: for each column, whether it holds a null."""
    return frame.agg(
        *[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(c) for c in columns]
    )


# What a scoring request row must satisfy.
WAIT_REQUEST_RULES = (
    Rule("department_id not empty", "length(department_id) >= 1"),
    Rule.one_of("appointment_type", ["new", "follow_up"]),
    Rule.one_of("priority_type", ["routine", "urgent"]),
    Rule("weekday between 0 and 6", "weekday between 0 and 6"),
    Rule("hour between 0 and 23", "hour between 0 and 23"),
    Rule.at_least("queue_length", 0),
    Rule.at_least("available_doctors", 0),
    Rule.at_least("available_rooms", 0),
)
NO_SHOW_REQUEST_RULES = (
    Rule("department_id not empty", "length(department_id) >= 1"),
    Rule.one_of("appointment_type", ["new", "follow_up"]),
    Rule.one_of("priority_type", ["routine", "urgent"]),
    Rule.at_least("booking_lead_hours", 0),
    Rule("scheduled_weekday between 0 and 6", "scheduled_weekday between 0 and 6"),
    Rule("scheduled_hour between 0 and 23", "scheduled_hour between 0 and 23"),
    Rule.at_least("historical_appointments", 0),
    Rule.at_least("historical_no_shows", 0),
    Rule.at_least("historical_late_arrivals", 0),
    Rule.at_least("historical_reminders", 0),
    Rule(
        "historical counts <= historical_appointments",
        "greatest(historical_no_shows, historical_late_arrivals, historical_reminders)"
        " <= historical_appointments",
    ),
)
FORECAST_REQUEST_RULES = (Rule("horizon_hours in (6, 12, 24)", "horizon_hours in (6, 12, 24)"),)


def tag_requests(requests: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Scoring-input contract: no nulls and all ``rules`` for each request row."""
    return tag_rows(requests, not_null=requests.columns, rules=rules)
