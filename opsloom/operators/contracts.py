"""Table contracts: column types, a unique key and row rules, and the schema check."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from opsloom.errors import DataContractError


@dataclass(frozen=True)
class Rule:
    """A named row predicate in SQL; a row breaks it when the predicate is false."""

    name: str
    predicate: str

    @classmethod
    def at_least(cls, column: str, bound: int) -> Rule:
        return cls(f"{column} >= {bound}", f"{column} >= {bound}")

    @classmethod
    def one_of(cls, column: str, values: Iterable[str]) -> Rule:
        listed = ", ".join(f"'{v}'" for v in values)
        return cls(f"{column} in ({listed})", f"{column} in ({listed})")

    @classmethod
    def ordered(cls, *terms: str) -> Rule:
        """A chain such as ``ordered("a", "<=", "b", "<", "c")``."""
        pairs = [" ".join(terms[i : i + 3]) for i in range(0, len(terms) - 2, 2)]
        return cls(" ".join(terms), " and ".join(pairs))


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    rules: tuple[Rule, ...] = field(default=())


@dataclass(frozen=True)
class Reference:
    """``child.foreign_key`` must exist in ``parent.primary_key``."""

    child: str
    foreign_key: str
    parent: str
    primary_key: str

    @property
    def reason(self) -> str:
        return f"invalid reference: {self.foreign_key} -> {self.parent}.{self.primary_key}"


EVENT_TIMES = ("event_time timestamp", "recorded_time timestamp", "ingested_time timestamp")
EVENT_ORDER = Rule.ordered("event_time", "<=", "recorded_time", "<=", "ingested_time")


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def contract(name: str, columns: str, *rules: Rule, timed: bool = False) -> TableContract:
    """Build a contract; the first column is the key, ``EVT`` stands for the three event times."""
    pairs = [c.split() for c in columns.replace("EVT", ", ".join(EVENT_TIMES)).split(", ")]
    schema = T.StructType([T.StructField(column, _TYPES[kind]) for column, kind in pairs])
    return TableContract(
        name, schema, (schema.names[0],), ((EVENT_ORDER, *rules) if timed else rules)
    )


# The nine canonical tables, their rules and the order of the reference checks.
CANONICAL_CONTRACTS = {
    c.name: c
    for c in (
        contract(
            "departments",
            "department_id string, hospital_id string, department_name string, nominal_capacity bigint",
            Rule.at_least("nominal_capacity", 1),
        ),
        contract("doctors", "doctor_id string, department_id string"),
        contract("beds", "bed_id string, ward_id string"),
        contract(
            "staffing_rosters",
            "roster_id string, department_id string, EVT, shift_start timestamp, shift_end timestamp, "
            "available_doctors bigint",
            Rule.ordered("shift_start", "<", "shift_end"),
            Rule.at_least("available_doctors", 1),
            timed=True,
        ),
        contract(
            "appointments",
            "appointment_id string, patient_key string, hospital_id string, department_id string, "
            "doctor_id string, EVT, booking_created_at timestamp, scheduled_at timestamp, "
            "appointment_type string, priority_type string, reminder_sent boolean, status string",
            Rule.ordered("booking_created_at", "<", "scheduled_at"),
            Rule.one_of("appointment_type", ["new", "follow_up"]),
            Rule.one_of("priority_type", ["routine", "urgent"]),
            Rule.one_of("status", ["completed", "no_show"]),
            timed=True,
        ),
        contract(
            "encounters",
            "encounter_id string, appointment_id string, department_id string, EVT, "
            "queue_entered_at timestamp, consultation_started_at timestamp, "
            "consultation_ended_at timestamp, checkout_at timestamp",
            Rule.ordered("queue_entered_at", "<=", "consultation_started_at"),
            Rule.ordered("consultation_started_at", "<", "consultation_ended_at"),
            Rule.ordered("consultation_ended_at", "<=", "checkout_at"),
            timed=True,
        ),
        contract(
            "queue_events",
            "queue_event_id string, encounter_id string, department_id string, EVT, "
            "queue_length bigint, available_doctors bigint, available_rooms bigint",
            Rule.at_least("queue_length", 0),
            Rule.at_least("available_doctors", 1),
            Rule.at_least("available_rooms", 1),
            timed=True,
        ),
        contract(
            "admissions",
            "admission_id string, encounter_id string, patient_key string, ward_id string, EVT, "
            "admitted_at timestamp, expected_discharge_at timestamp, discharged_at timestamp",
            Rule.ordered("admitted_at", "<", "discharged_at"),
            timed=True,
        ),
        contract(
            "bed_events",
            "bed_event_id string, bed_id string, admission_id string, EVT, event_type string",
            Rule.one_of("event_type", ["occupied", "released"]),
            timed=True,
        ),
    )
}

CANONICAL_REFERENCES = (
    Reference("doctors", "department_id", "departments", "department_id"),
    Reference("staffing_rosters", "department_id", "departments", "department_id"),
    Reference("appointments", "department_id", "departments", "department_id"),
    Reference("appointments", "doctor_id", "doctors", "doctor_id"),
    Reference("encounters", "appointment_id", "appointments", "appointment_id"),
    Reference("queue_events", "encounter_id", "encounters", "encounter_id"),
    Reference("admissions", "encounter_id", "encounters", "encounter_id"),
    Reference("bed_events", "bed_id", "beds", "bed_id"),
    Reference("bed_events", "admission_id", "admissions", "admission_id"),
)


def data_dictionary(contracts: Mapping[str, TableContract]) -> dict[str, dict[str, str]]:
    """Table -> column -> type name."""
    return {
        name: {f.name: f.dataType.simpleString() for f in c.schema.fields}
        for name, c in contracts.items()
    }


def check_tables(tables: Iterable[str], contracts: Mapping[str, TableContract]) -> None:
    missing, unexpected = set(contracts) - set(tables), set(tables) - set(contracts)
    if missing or unexpected:
        raise DataContractError(
            f"table set differs: missing={sorted(missing)}, unexpected={sorted(unexpected)}"
        )


def check_schema(frame: DataFrame, contract: TableContract) -> DataFrame:
    """Reject the whole table when a column is missing, extra or of another type."""
    actual = {f.name: f.dataType for f in frame.schema.fields}
    wanted = {f.name: f.dataType for f in contract.schema.fields}
    problems = [f"missing {c}" for c in wanted if c not in actual]
    problems += [f"unexpected {c}" for c in actual if c not in wanted]
    problems += [
        f"{c} is {actual[c].simpleString()}, not {wanted[c].simpleString()}"
        for c in wanted
        if c in actual and actual[c] != wanted[c]
    ]
    if problems:
        raise DataContractError(f"{contract.name}: " + "; ".join(problems))
    return frame.select(*contract.schema.names)


def require_columns(
    frame: DataFrame, columns: Iterable[str], error: type[Exception] = DataContractError
) -> None:
    if missing := sorted(set(columns) - set(frame.columns)):
        raise error(f"missing columns: {missing}")


def require_tables(tables: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    if missing := sorted(set(names) - set(tables)):
        raise DataContractError(f"missing tables: {missing}")
