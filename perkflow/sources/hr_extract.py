"""HR extract: a delimited file with French headers, every value as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.people import to_date_or_null, to_double_or_null, to_int_or_null, to_long_or_null
from ..schemas import HR_EXTRACT_HEADERS

# Header -> column name.
HR_COLUMNS = dict(
    zip(
        HR_EXTRACT_HEADERS,
        [
            "employee_id",
            "last_name",
            "first_name",
            "birth_date",
            "business_unit",
            "hire_date",
            "gross_salary",
            "contract_type",
            "paid_leave_days",
            "home_address",
            "transport_mode",
        ],
    )
)
DATE_COLUMNS = {"birth_date", "hire_date"}
#: Place of a row in the extract: file, block of the file, row of the block. Splits and partitions don't change the order.
POSITION = "_position"


def read_hr_extract(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The extract's columns by header name, as text, plus ``_position``.

    The header line gives the columns, in any order and with others between
    them; a missing one fails here. Files of one folder must share one header
    (Spark checks each against the first), so no value is taken by place.
    """
    options = {"header": "true", "sep": sep, "encoding": "UTF-8"}
    names = spark.read.options(**options).csv(path).columns
    missing = [h for h in HR_EXTRACT_HEADERS if h not in names]
    if missing:
        raise ValueError(f"HR extract {path} lacks the columns {missing}; it has {names}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.options(**options, enforceSchema="false").schema(schema).csv(path)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(*[F.col(f"`{h}`") for h in HR_EXTRACT_HEADERS], position.alias(POSITION))


def normalize_hr_extract(raw: DataFrame, decimal_comma: bool = False, day_first: bool = False) -> DataFrame:
    """Rename headers, trim text, parse ids / numbers / dates. Bad values become NULL.

    ``decimal_comma``: amounts written the French way (``45 000,50``, with
    normal or non-breaking spaces between thousands); ``day_first``: dates as
    ``dd/MM/yyyy``.
    """
    return raw.select(*[c.alias(n) for n, c in _parsed(decimal_comma, day_first).items()])


def _parsed(decimal_comma: bool, day_first: bool) -> dict:
    cols = {}
    for header, name in HR_COLUMNS.items():
        v = F.trim(F.col(f"`{header}`"))
        if name == "employee_id":
            v = to_long_or_null(v)
        elif name == "paid_leave_days":
            v = to_int_or_null(v)
        elif name == "gross_salary":
            if decimal_comma:
                v = F.regexp_replace(F.regexp_replace(v, "[\\s  ]", ""), ",", ".")
            v = to_double_or_null(v)
        elif name in DATE_COLUMNS:
            v = to_date_or_null(v, day_first)
        cols[name] = v
    return cols


def checked_hr_extract(raw: DataFrame, decimal_comma: bool = False, day_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``_position``, rejected rows): every column of the employee table is NOT NULL.

    A rejected row keeps its text as JSON, its place, and the names of the
    columns that are empty or can't be read.
    """
    parsed = _parsed(decimal_comma, day_first)
    bad = F.array_compact(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in parsed.items()]))
    line = F.to_json(F.struct(*[F.col(f"`{h}`") for h in HR_EXTRACT_HEADERS]))
    marked = raw.select(*[c.alias(n) for n, c in parsed.items()], POSITION, bad.alias("_bad"), line.alias("_line"))
    good = marked.where(F.size("_bad") == 0).drop("_bad", "_line")
    rejected = marked.where(F.size("_bad") > 0).select(
        F.concat(F.lit("missing or unreadable: "), F.concat_ws(", ", "_bad")).alias("reason"),
        F.col("_line").alias("line"), F.col(f"{POSITION}.file").alias("file"), F.col(f"{POSITION}.row").alias("row"),
    )
    return good, rejected
