"""Employee name lookup and notification rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import UNKNOWN_EMPLOYEE_PREFIX
from ..functions.messages import failure_reason, message_text, outbox_body
from ..functions.people import full_name


def name_table(employees: DataFrame) -> DataFrame:
    """``employee_id, _known_name`` — the two columns the lookup needs."""
    if "_known_name" in employees.columns:
        return employees
    return employees.select("employee_id", full_name("first_name", "last_name").alias("_known_name"))


def with_employee_names(events: DataFrame, employees: DataFrame) -> DataFrame:
    """Adds ``full_name``: 'first last' of a known employee, else 'Employé #<id>'.

    A left join replaces one database point query per event. ``employees`` is
    the employee table or a prepared :func:`name_table`. Spark broadcasts the
    name side when its size estimate is under the threshold, otherwise it is
    a shuffle join (a name table already hash-partitioned by employee_id and
    persisted is not shuffled again).
    """
    joined = events.join(name_table(employees), "employee_id", "left")
    fallback = F.concat(F.lit(UNKNOWN_EMPLOYEE_PREFIX), F.col("employee_id").cast("string"))
    return joined.withColumn("full_name", F.coalesce(F.col("_known_name"), fallback)).drop("_known_name")


def with_messages(events: DataFrame) -> DataFrame:
    """Adds ``text`` (NULL when it cannot be built) and ``reason`` (why not)."""
    sport, dist, dur = F.col("sport_type"), F.col("distance_m"), F.col("duration_s")
    return events.withColumn(
        "text", message_text(F.col("full_name"), sport, dist, dur, F.col("comment"))
    ).withColumn("reason", failure_reason(sport, dist, dur))


def notifications(events: DataFrame) -> DataFrame:
    """Deliverable notifications: ``activity_id, employee_id, text, body``."""
    return (
        events.filter(F.col("text").isNotNull())
        .select("activity_id", "employee_id", "text", outbox_body(F.col("text")).alias("body"))
    )


def dead_letters(events: DataFrame) -> DataFrame:
    """Events no message could be built for, with the reason."""
    return events.filter(F.col("text").isNull()).select("activity_id", "employee_id", "reason")
