"""Explicit schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Flattened change message of the activities table (after-image + metadata).
CDC_ACTIVITY = T.StructType(
    [
        T.StructField("activity_id", T.LongType()),
        T.StructField("employee_id", T.LongType()),
        T.StructField("sport_type", T.StringType()),
        T.StructField("start_at", T.StringType()),
        T.StructField("end_at", T.StringType()),
        T.StructField("distance_m", T.IntegerType()),
        T.StructField("duration_s", T.IntegerType()),
        T.StructField("comment", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("__op", T.StringType()),
        T.StructField("__source_ts_ms", T.LongType()),
    ]
)

# The same with the log position that the connector adds (identifies a change, however often it is delivered).
CDC_ACTIVITY_LSN = T.StructType([*CDC_ACTIVITY.fields, T.StructField("__source_lsn", T.LongType())])

# Row image carried by the employee change envelope (before / after).
EMPLOYEE_IMAGE = T.StructType(
    [
        T.StructField("employee_id", T.LongType()),
        T.StructField("business_unit", T.StringType()),
        T.StructField("transport_mode", T.StringType()),
        T.StructField("home_address", T.StringType()),
        T.StructField("gross_salary", T.DoubleType()),
    ]
)

# Change envelope before flattening: before / after images, op, source info.
CDC_ENVELOPE = T.StructType(
    [
        T.StructField("before", EMPLOYEE_IMAGE),
        T.StructField("after", EMPLOYEE_IMAGE),
        T.StructField("op", T.StringType()),
        T.StructField(
            "source",
            T.StructType([T.StructField("ts_ms", T.LongType()), T.StructField("lsn", T.LongType())]),
        ),
    ]
)

# Distance service reply.
DISTANCE_REPLY = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField(
            "rows",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "elements",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("status", T.StringType()),
                                        T.StructField(
                                            "distance",
                                            T.StructType([T.StructField("value", T.LongType())]),
                                        ),
                                    ]
                                )
                            ),
                        )
                    ]
                )
            ),
        ),
    ]
)

# Benefit parameters, one row per validity date.
PARAMETERS = T.StructType(
    [
        T.StructField("snapshot_date", T.DateType(), False),
        T.StructField("premium_rate", T.DecimalType(5, 4), False),
        T.StructField("wellbeing_threshold", T.IntegerType(), False),
        T.StructField("wellbeing_days", T.IntegerType(), False),
        T.StructField("max_distance_walk_km", T.IntegerType(), False),
        T.StructField("max_distance_bike_km", T.IntegerType(), False),
    ]
)

# HR extract as delivered: French headers, every value a string.
HR_EXTRACT_HEADERS = [
    "ID salarié",
    "Nom",
    "Prénom",
    "Date de naissance",
    "BU",
    "Date d'embauche",
    "Salaire brut",
    "Type de contrat",
    "Nombre de jours de CP",
    "Adresse du domicile",
    "Moyen de déplacement",
]
HR_EXTRACT = T.StructType([T.StructField(h, T.StringType()) for h in HR_EXTRACT_HEADERS])
