"""Results do not depend on the session time zone (timestamps are NTZ)."""

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

KEYS = ["cdc_parse_json", "cdc_current_state", "employee_eligibility", "snapshot_scan"]


@pytest.mark.parametrize("key", KEYS)
def test_same_result_in_another_zone(spark, key):
    q = entry.queries()[key]
    base = sorted(map(tuple, q(spark, SF_SMALL).collect()), key=repr)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
        other = sorted(map(tuple, q(spark, SF_SMALL).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == other
