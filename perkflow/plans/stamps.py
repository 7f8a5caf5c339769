"""Audit columns added when a layer is written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, as_of: dt.date) -> DataFrame:
    """``extract_date`` = the run's as-of date, ``extract_ts`` = write time."""
    return df.withColumns({"extract_date": F.lit(as_of), "extract_ts": F.current_timestamp()})
