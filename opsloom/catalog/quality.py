"""Queries over row rules, quarantine, references and checked joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.catalog.registry import query, r6, rounded, sql
from opsloom.operators.contracts import Reference, Rule, contract
from opsloom.operators.features import with_history_rate
from opsloom.operators.joins import checked_join, join_with_fallback, lookup_shifted, point_in_time_history
from opsloom.operators.quality import (
    ERRORS,
    NO_SHOW_REQUEST_RULES,
    WAIT_REQUEST_RULES,
    enforce_references,
    null_flags,
    quality_report,
    quarantine_split,
    tag_requests,
    tag_rows,
    validate_dataset,
)
from opsloom.operators.targets import SERIES_KEYS, arrival_target
from opsloom.sources import views


def _error_counts(tagged: DataFrame) -> DataFrame:
    return tagged.select(F.explode(ERRORS).alias("error")).groupBy("error").agg(F.count("*").alias("rows_hit"))


def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = views.driver_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(views.driver_table(spark, sf_dir, "labels"), "doc_id", "left")


_LABELLED = "documents d LEFT JOIN labels l USING (doc_id)"


@query(
    "not_null_rule",
    f"""SELECT error, count(*) AS rows_hit FROM (
          SELECT 'not_null: quality' AS error FROM {_LABELLED} WHERE l.quality IS NULL
          UNION ALL SELECT 'not_null: toxic' FROM {_LABELLED} WHERE l.toxic IS NULL) GROUP BY error""",
)
def not_null_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled_documents(spark, sf_dir)
    return _error_counts(tag_rows(rows, not_null=rows.columns))


@query(
    "null_flags",
    f"""SELECT bool_or(d.doc_id IS NULL) AS doc_id, bool_or(l.quality IS NULL) AS quality,
               bool_or(l.toxic IS NULL) AS toxic, bool_or(d.lang IS NULL) AS lang FROM {_LABELLED}""",
)
def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_flags(_labelled_documents(spark, sf_dir), ["doc_id", "quality", "toxic", "lang"])


@query(
    "unique_rule",
    """SELECT l_orderkey, l_linenumber, n AS copies, total AS quantity FROM (
         SELECT l_orderkey, l_linenumber, count(*) AS n, sum(l_quantity) AS total
         FROM lineitem GROUP BY ALL) WHERE n > 1""",
)
def unique_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    tagged = tag_rows(items, key=["l_orderkey", "l_linenumber"]).where(F.size(ERRORS) > 0)
    return tagged.groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("copies"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "range_rule",
    """SELECT 'l_quantity >= 10' AS error, count(*) AS rows_hit FROM lineitem WHERE l_quantity < 10
       UNION ALL SELECT 'l_linenumber >= 2', count(*) FROM lineitem WHERE l_linenumber < 2""",
)
def range_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem")
    rules = [Rule.at_least("l_quantity", 10), Rule.at_least("l_linenumber", 2)]
    return _error_counts(tag_rows(items, rules=rules))


@query(
    "enum_rule",
    """SELECT o_orderstatus AS status, count(*) AS rows_hit FROM orders
       WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1""",
)
def enum_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tag_rows(
        views.driver_table(spark, sf_dir, "orders"), rules=[Rule.one_of("o_orderstatus", ["F", "O"])]
    )
    bad = tagged.where(F.size(ERRORS) > 0)
    return bad.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("rows_hit"))


@query(
    "temporal_rule",
    """SELECT l_returnflag, count(*) AS rows_hit, sum(l_orderkey)::BIGINT AS key_sum
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate > l_shipdate GROUP BY 1""",
)
def temporal_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")
    orders = views.driver_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    tagged = tag_rows(
        items.join(orders, "l_orderkey"), rules=[Rule.ordered("o_orderdate", "<=", "l_shipdate")]
    )
    return tagged.where(F.size(ERRORS) > 0).groupBy("l_returnflag").agg(
        F.count("*").alias("rows_hit"), F.sum("l_orderkey").alias("key_sum")
    )


_LINE_CONTRACT = contract(
    "lineitem",
    "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string",
    Rule.at_least("l_quantity", 5),
    Rule.one_of("l_returnflag", ["A", "N"]),
)


@query(
    "quarantine_split",
    """WITH tagged AS (
         SELECT l_orderkey, concat_ws('; ',
                  CASE WHEN l_quantity < 5 THEN 'l_quantity >= 5' END,
                  CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag in (''A'', ''N'')' END,
                  CASE WHEN count(*) OVER (PARTITION BY l_orderkey) > 1 THEN 'unique: l_orderkey' END) AS row_error
         FROM lineitem),
       whole AS (
         SELECT concat_ws('; ', CASE WHEN bool_or(l_quantity < 5) THEN 'l_quantity >= 5' END,
                  CASE WHEN bool_or(l_returnflag NOT IN ('A', 'N')) THEN 'l_returnflag in (''A'', ''N'')' END,
                  CASE WHEN count(*) > count(DISTINCT l_orderkey) THEN 'unique: l_orderkey' END) AS quality_error
         FROM lineitem)
       SELECT CASE WHEN row_error = '' THEN 'clean' ELSE 'quarantine' END AS side, row_error,
              CASE WHEN row_error <> '' THEN quality_error END AS quality_error,
              count(*) AS row_count, sum(l_orderkey)::BIGINT AS key_sum
       FROM tagged, whole GROUP BY ALL""",
)
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem").select(*_LINE_CONTRACT.schema.names)
    clean, quarantine = quarantine_split(items, _LINE_CONTRACT)
    both = clean.select(
        F.lit("clean").alias("side"), F.lit("").alias("row_error"),
        F.lit(None).cast("string").alias("quality_error"), "l_orderkey",
    ).unionByName(
        quarantine.select(
            F.lit("quarantine").alias("side"), F.array_join(ERRORS, "; ").alias("row_error"),
            "quality_error", "l_orderkey",
        )
    )
    return both.groupBy("side", "row_error", "quality_error").agg(
        F.count("*").alias("row_count"), F.sum("l_orderkey").alias("key_sum")
    )


_CASCADE = (
    Reference("orders", "o_custkey", "customer", "c_custkey"),
    Reference("lineitem", "l_orderkey", "orders", "o_orderkey"),
)


@query(
    "reference_cascade",
    """WITH c AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'),
            o AS (SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM c) AS kept FROM orders),
            l AS (SELECT l_orderkey IN (SELECT o_orderkey FROM o WHERE kept) AS kept FROM lineitem)
       SELECT 'customer' AS table_name, count(*) AS input_rows, count(*) AS valid_rows, 0 AS quarantined_rows FROM c
       UNION ALL SELECT 'orders', count(*), count_if(kept), count_if(NOT kept) FROM o
       UNION ALL SELECT 'lineitem', count(*), count_if(kept), count_if(NOT kept) FROM l""",
)
def reference_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "customer": views.driver_table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select("c_custkey"),
        "orders": views.driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        "lineitem": views.driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"),
    }
    return quality_report(enforce_references(tables, _CASCADE))


@query(
    "quarantine_reasons",
    sql(
        """SELECT 'encounters' AS table_name, 'queue_entered_at <= consultation_started_at' AS reason,
                  count(*) AS row_count FROM raw_encounters WHERE early
           UNION ALL SELECT 'queue_events', 'invalid reference: encounter_id -> encounters.encounter_id', count(*)
             FROM raw_encounters WHERE early
           UNION ALL SELECT 'admissions', 'invalid reference: encounter_id -> encounters.encounter_id', count(*)
             FROM admissions WHERE encounter_id NOT IN (SELECT encounter_id FROM raw_encounters WHERE NOT early)
           UNION ALL SELECT 'bed_events', 'invalid reference: admission_id -> admissions.admission_id', count(*)
             FROM bed_events WHERE admission_id IN (SELECT admission_id FROM admissions
               WHERE encounter_id NOT IN (SELECT encounter_id FROM raw_encounters WHERE NOT early))""",
        "raw_encounters", "bed_events", "admissions",
    ),
)
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = validate_dataset(views.canonical_dataset(spark, sf_dir, anomalies=True), table_wide=False)
    parts = [
        frame.select(F.lit(name).alias("table_name"), F.col("quality_error").alias("reason"))
        for name, frame in result.quarantine.items()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("table_name", "reason").agg(F.count("*").alias("row_count"))


def _wait_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.keyed_events(spark, sf_dir)
    return e.select(
        F.when(F.col("k") % 11 != 0, F.col("event_type")).otherwise("").alias("department_id"),
        F.when(F.col("user_id") % 3 != 0, "new").otherwise("walk_in").alias("appointment_type"),
        F.lit("routine").alias("priority_type"),
        (F.col("k") % 5 != 0).alias("reminder_sent"),
        (F.col("k") % 8).alias("weekday"),
        (F.col("k") % 25).alias("hour"),
        (F.col("k") % 9 - 1).alias("queue_length"),
        (F.col("user_id") % 4).alias("available_doctors"),
        F.when(F.col("k") % 13 != 0, F.col("user_id") % 5).alias("available_rooms"),
    )


@query(
    "wait_request_contract",
    sql(
        """SELECT error, count(*) AS rows_hit FROM (
             SELECT unnest([CASE WHEN k % 13 = 0 THEN 'not_null: available_rooms' END,
                     CASE WHEN k % 11 = 0 THEN 'department_id not empty' END,
                     CASE WHEN user_id % 3 = 0 THEN 'appointment_type in (''new'', ''follow_up'')' END,
                     CASE WHEN k % 8 > 6 THEN 'weekday between 0 and 6' END,
                     CASE WHEN k % 25 > 23 THEN 'hour between 0 and 23' END,
                     CASE WHEN k % 9 = 0 THEN 'queue_length >= 0' END]) AS error FROM keyed)
           WHERE error IS NOT NULL GROUP BY 1""",
        "keyed",
    ),
)
def wait_request_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _error_counts(tag_requests(_wait_requests(spark, sf_dir), WAIT_REQUEST_RULES))


def _no_show_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.keyed_events(spark, sf_dir)
    return e.select(
        F.col("event_type").alias("department_id"),
        F.lit("new").alias("appointment_type"),
        F.lit("urgent").alias("priority_type"),
        (F.col("value") - 5).alias("booking_lead_hours"),
        (F.col("k") % 7).alias("scheduled_weekday"),
        (F.col("k") % 24).alias("scheduled_hour"),
        (F.col("user_id") % 6).alias("historical_appointments"),
        (F.col("k") % 5).cast("bigint").alias("historical_no_shows"),
        F.lit(0).cast("bigint").alias("historical_late_arrivals"),
        (F.col("k") % 3).cast("bigint").alias("historical_reminders"),
    )


@query(
    "no_show_request_contract",
    sql(
        """SELECT error, count(*) AS rows_hit FROM (
             SELECT 'booking_lead_hours >= 0' AS error FROM keyed WHERE value - 5 < 0
             UNION ALL SELECT 'historical counts <= historical_appointments' FROM keyed
               WHERE greatest(k % 5, k % 3, 0) > user_id % 6) GROUP BY error""",
        "keyed",
    ),
)
def no_show_request_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _error_counts(tag_requests(_no_show_requests(spark, sf_dir), NO_SHOW_REQUEST_RULES))


@query(
    "history_rate",
    sql(
        f"""SELECT user_id % 6 AS historical_appointments, k % 5 AS historical_no_shows, count(*) AS row_count,
                   {r6("max(CASE WHEN user_id % 6 > 0 THEN (k % 5) / (user_id % 6) ELSE 0 END)", "historical_no_show_rate")}
            FROM keyed GROUP BY 1, 2""",
        "keyed",
    ),
)
def rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_history_rate(_no_show_requests(spark, sf_dir))
    return rounded(
        scored.groupBy("historical_appointments", "historical_no_shows").agg(
            F.count("*").alias("row_count"), F.max("historical_no_show_rate").alias("historical_no_show_rate")
        )
    )


@query(
    "checked_join",
    f"""SELECT o_orderpriority, count(*) AS row_count, {r6("sum(l_extendedprice)", "revenue")}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    orders = views.driver_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"
    )
    both = checked_join(items, orders, ["l_orderkey"], cardinality="many_to_one")
    return rounded(
        both.groupBy("o_orderpriority").agg(
            F.count("*").alias("row_count"), F.sum("l_extendedprice").alias("revenue")
        )
    )


@query(
    "join_with_fallback",
    f"""SELECT p_partkey, {r6("coalesce(m, -1.0)", "mean_quantity")}
        FROM part LEFT JOIN (SELECT l_partkey, avg(l_quantity) AS m FROM lineitem
                             WHERE l_returnflag = 'R' AND l_discount > 0.08 GROUP BY 1) ON l_partkey = p_partkey""",
)
def fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = (
        views.driver_table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R' AND l_discount > 0.08")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.avg("l_quantity").alias("mean_quantity"))
    )
    parts = views.driver_table(spark, sf_dir, "part").select("p_partkey")
    return rounded(join_with_fallback(parts, means, ["p_partkey"], {"mean_quantity": F.lit(-1.0)}))


@query(
    "point_in_time_history",
    sql(
        """SELECT d.event_id, count(o.event_id) AS earlier, count(*) FILTER (WHERE o.event_type = 'error') AS earlier_errors,
                  coalesce(sum(o.k), 0)::BIGINT AS earlier_k
           FROM keyed d LEFT JOIN keyed o
             ON o.user_id = d.user_id AND o.ts + to_hours(o.k + 1) < d.ts
           GROUP BY d.event_id""",
        "keyed",
    ),
)
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.keyed_events(spark, sf_dir)
    done = e.withColumn("done_at", F.timestamp_add("HOUR", F.col("k") + 1, F.col("ts")))
    found = point_in_time_history(
        e.select("event_id", "user_id", "ts"),
        done,
        "user_id",
        "ts",
        "done_at",
        {
            "earlier": F.lit(1),
            "earlier_errors": (F.col("event_type") == "error").cast("int"),
            "earlier_k": F.col("k"),
        },
    )
    return found.select("event_id", "earlier", "earlier_errors", "earlier_k")


@query(
    "shifted_lookup",
    sql(
        """SELECT a.department_id, strftime(a.interval_start, '%Y-%m-%d %H:%M:%S') AS interval_start, a.arrivals,
                  d.arrivals::DOUBLE AS day_before, w.arrivals::DOUBLE AS week_before
           FROM arrivals a
           LEFT JOIN arrivals d ON d.department_id = a.department_id AND d.interval_start = a.interval_start - INTERVAL 1 DAY
           LEFT JOIN arrivals w ON w.department_id = a.department_id AND w.interval_start = a.interval_start - INTERVAL 7 DAY""",
        "arrivals",
    ),
)
def shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = arrival_target(
        views.appointments(spark, sf_dir), views.encounters(spark, sf_dir)
    )
    day = lookup_shifted(target, target, SERIES_KEYS, "interval_start", "arrivals", hours=24, out="day_before")
    week = lookup_shifted(day, target, SERIES_KEYS, "interval_start", "arrivals", hours=168, out="week_before")
    return rounded(week.select("department_id", "interval_start", "arrivals", "day_before", "week_before"))
