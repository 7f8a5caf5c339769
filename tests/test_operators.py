"""Operators on literal fixtures (FIXTURES.md section 4)."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perkflow.operators import cdc, eligibility, lookup, parameters, quality
from perkflow.operators.enrichment import (
    CallbackProvider, NoKeyProvider, StoredReplies, enrich_distances, resolve_addresses,
)
from perkflow.schemas import PARAMETERS

AS_OF = dt.date(2024, 1, 31)
WALK, BIKE, CAR = "Marche/running", "Vélo/Trottinette/Autres", "véhicule thermique/électrique"


def _emp(spark, rows):
    return spark.createDataFrame(
        rows,
        "employee_id long, full_name string, business_unit string, contract_type string, gross_salary double, "
        "transport_mode string, home_to_office_km double, distance_check_status string",
    )


def test_mobility_edges(spark):
    rows = [(1, WALK, 15.0), (2, WALK, 15.01), (3, BIKE, 25.0), (4, BIKE, 25.01), (5, CAR, 1.0), (6, WALK, None),
            (7, None, 3.0)]
    df = spark.createDataFrame(rows, "id int, mode string, km double")
    p = parameters.parameter_columns({"premium_rate": 0.05, "wellbeing_threshold": 15, "wellbeing_days": 5,
                                      "max_distance_walk_km": 15, "max_distance_bike_km": 25})
    flag = eligibility.mobility_flag(F.col("mode"), F.col("km"), eligibility.mode_limits(p))
    got = {r.id: r.f for r in df.select("id", flag.alias("f")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False, 7: False}


def _ts(day, *hms):
    return dt.datetime.combine(day, dt.time(*hms))


def test_wellbeing_threshold_and_window(spark):
    emp = _emp(spark, [(i, f"E {i}", "Finance", "CDI", 36500.0, CAR, None, "error") for i in (1, 2, 3, 4, 5)])
    bound = _ts(AS_OF - dt.timedelta(days=365))
    acts = []
    for emp_id, n in [(2, 14), (3, 15), (4, 16)]:
        acts += [(emp_id, _ts(dt.date(2024, 1, 10), 12)) for _ in range(n)]
    acts += [(5, bound), (5, bound - dt.timedelta(microseconds=1)), (5, _ts(dt.date(2024, 3, 1), 9))]
    a = spark.createDataFrame(acts, "employee_id long, start_at timestamp_ntz")
    g = eligibility.employee_eligibility(emp, a, AS_OF)
    got = {r.employee_id: (r.activities_count_12m, r.is_eligible_wellbeing, r.wellbeing_days, r.wellbeing_cost)
           for r in g.collect()}
    assert got[1] == (0, False, 0, 0.0)
    assert got[2] == (14, False, 0, 0.0)
    assert got[3] == (15, True, 5, 500.0)
    assert got[4] == (16, True, 5, 500.0)
    assert got[5][0] == 2  # bound included, 1 us before excluded, after as_of counted


def test_premium_amount_and_total(spark):
    emp = _emp(spark, [(1, "A B", "Finance", "CDI", 14910.72, WALK, 15.0, "ok")])
    a = spark.createDataFrame([], "employee_id long, start_at timestamp_ntz")
    r = eligibility.employee_eligibility(emp, a, AS_OF).first()
    assert (r.is_eligible_premium, r.premium_amount, r.total_cost) == (True, 745.54, 745.54)
    assert r.snapshot_date == AS_OF


def _history(spark, rows):
    return spark.createDataFrame(rows, PARAMETERS)


def test_latest_parameters(spark):
    h = _history(spark, [
        (dt.date(2023, 6, 1), Decimal("0.0400"), 20, 3, 10, 20),
        (dt.date(2024, 1, 1), Decimal("0.0500"), 15, 5, 15, 25),
        (dt.date(2024, 6, 1), Decimal("0.0800"), 10, 7, 20, 30),
    ])
    assert parameters.latest_parameters(h, AS_OF).first().snapshot_date == dt.date(2024, 1, 1)
    assert parameters.latest_parameters(h, dt.date(2024, 6, 1)).first().snapshot_date == dt.date(2024, 6, 1)
    p = parameters.parameter_columns(h, AS_OF)
    row = spark.range(1).select(*[c.alias(k) for k, c in p.items()]).first()
    assert (float(row.premium_rate), row.wellbeing_threshold, row.max_distance_bike_km) == (0.05, 15, 25)


def test_parameters_in_force_per_day(spark):
    h = _history(spark, [
        (dt.date(2024, 1, 1), Decimal("0.0500"), 15, 5, 15, 25),
        (dt.date(2024, 6, 1), Decimal("0.0800"), 10, 7, 20, 30),
    ])
    days = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 1),),
                                  (dt.date(2024, 5, 31),), (dt.date(2024, 6, 1),), (dt.date(2025, 1, 1),)], "day date")
    got = {r.day: r.snapshot_date for r in parameters.parameters_in_force(days, h).collect()}
    assert got == {
        dt.date(2023, 12, 31): None,
        dt.date(2024, 1, 1): dt.date(2024, 1, 1),
        dt.date(2024, 5, 31): dt.date(2024, 1, 1),
        dt.date(2024, 6, 1): dt.date(2024, 6, 1),
        dt.date(2025, 1, 1): dt.date(2024, 6, 1),
    }


def test_no_parameters_in_force_fails(spark):
    h = _history(spark, [(dt.date(2024, 6, 1), Decimal("0.0800"), 10, 7, 20, 30)])
    p = parameters.parameter_columns(h, AS_OF)
    with pytest.raises(Exception, match="no benefit parameters"):
        spark.range(1).select(p["premium_rate"]).collect()
    with pytest.raises(ValueError):
        parameters.parameter_columns({"premium_rate": 0.05})


def test_distance_enrichment_cache_and_providers(spark):
    emp = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "C")], "employee_id long, home_address string")
    ok = '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":%d}}]}]}'
    replies = spark.createDataFrame([("A", ok % 1500), ("B", ok % 30000)], "home_address string, reply string")
    cache = spark.createDataFrame([("C", 2.5, "ok")], "home_address string, home_to_office_km double, "
                                                      "distance_check_status string")
    got = {r.home_address: (r.home_to_office_km, r.distance_check_status)
           for r in resolve_addresses(emp, StoredReplies(replies), cache).collect()}
    assert got == {"A": (1.5, "ok"), "B": (30.0, "ok"), "C": (2.5, "ok")}

    calls = []

    def fetch(addresses):
        calls.append(len(addresses))
        return [ok % 4000 if a == "A" else None for a in addresses]

    got = {r.home_address: (r.home_to_office_km, r.distance_check_status)
           for r in resolve_addresses(emp, CallbackProvider(fetch)).collect()}
    assert got == {"A": (4.0, "ok"), "B": (None, "error"), "C": (None, "error")}
    capped = {r.home_address: r.distance_check_status
              for r in resolve_addresses(emp, CallbackProvider(fetch, max_callers=2)).collect()}
    assert capped == {"A": "ok", "B": "error", "C": "error"}
    stored = {r.home_address: r.distance_check_status for r in resolve_addresses(emp, StoredReplies(replies)).collect()}
    assert stored == {"A": "ok", "B": "ok", "C": "error"}  # no stored reply is not "no key"
    lost = spark.createDataFrame([(1, None), (2, "A")], "employee_id long, home_address string")
    both = enrich_distances(lost, StoredReplies(replies)).select("employee_id", "distance_check_status")
    assert dict(both.collect()) == {1: "error", 2: "ok"}
    got = {r.distance_check_status for r in resolve_addresses(emp, NoKeyProvider()).collect()}
    assert got == {"no_api_key"}

    def flaky(addresses):
        if "B" in addresses:
            raise TimeoutError("service timed out")
        return [ok % 4000 for _ in addresses]

    got = {r.home_address: (r.home_to_office_km, r.distance_check_status)
           for r in resolve_addresses(emp, CallbackProvider(flaky)).collect()}
    assert got == {"A": (4.0, "ok"), "B": (None, "error"), "C": (4.0, "ok")}


def _messages(spark, payloads):
    return spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads], "value string")


def test_parse_and_live_filter(spark):
    base = {"activity_id": 1, "employee_id": 7, "sport_type": "Yoga", "duration_s": 600, "source": "live",
            "__op": "c", "__source_ts_ms": 5}
    payloads = [
        base,
        {**base, "activity_id": 2, "__op": "r"},
        {**base, "activity_id": 3, "__op": "u"},
        {**base, "activity_id": 4, "__op": "d"},
        {**base, "activity_id": 5, "source": "historical"},
        {**base, "activity_id": 6, "employee_id": None},
        "not json",
        {"activity_id": 8, "__op": "c", "source": "live", "employee_id": 9},  # missing fields
        {**base, "activity_id": 9, "extra": {"x": 1}},  # extra field
    ]
    parsed = cdc.parse_messages(_messages(spark, payloads))
    assert parsed.count() == 9
    assert parsed.filter(F.col("activity_id").isNull()).count() == 1  # the text that is not JSON
    live = sorted(r.activity_id for r in cdc.live_creations(parsed).collect())
    assert live == [1, 8, 9]


def test_null_message_is_a_row_of_nulls(spark):
    df = spark.createDataFrame([('{"activity_id": 1}',), (None,)], "value string")  # None = tombstone
    rows = cdc.parse_messages(df).select("activity_id", "__op").collect()
    assert sorted(rows, key=lambda r: r.activity_id is None) == [(1, None), (None, None)]


def _env(op, key, lsn, ts, unit):
    image = {"employee_id": key, "business_unit": unit, "transport_mode": WALK, "home_address": "a",
             "gross_salary": 1.0}
    return {"before": image if op in ("u", "d") else None, "after": None if op == "d" else image, "op": op,
            "source": {"ts_ms": ts, "lsn": lsn}}


def test_unwrap_and_current_state(spark):
    env = [
        _env("c", 1, 10, 100, "v1"), _env("u", 1, 11, 101, "v2"), _env("d", 1, 12, 102, "v2"),  # gone
        _env("c", 2, 20, 200, "old"), _env("u", 2, 22, 200, "new"),  # same time, higher LSN wins
        _env("d", 3, 30, 300, "x"),  # delete only
        _env("r", 4, 40, 400, "snap"), _env("u", 4, 41, 401, "later"),
    ]
    flat = cdc.unwrap_envelopes(_messages(spark, env))
    d = flat.filter("__op = 'd'").select("employee_id", "business_unit", "__deleted").collect()
    assert sorted(tuple(r) for r in d) == [(1, "v2", True), (3, "x", True)]
    state = {r["employee_id"]: (r["business_unit"], r["__source_lsn"], r["updated_at"])
             for r in cdc.current_state(flat, ["employee_id"]).collect()}
    assert set(state) == {2, 4}
    assert state[2][:2] == ("new", 22)
    assert state[4][:2] == ("later", 41)
    assert state[4][2] == dt.datetime(1970, 1, 1, 0, 0, 0, 401000)


def test_name_lookup_and_dead_letters(spark):
    ev = spark.createDataFrame(
        [(1, 10, "Yoga", None, 600, None), (2, 99, "Yoga", None, 600, None), (3, 10, None, None, 600, None)],
        "activity_id long, employee_id long, sport_type string, distance_m int, duration_s int, comment string",
    )
    emp = spark.createDataFrame([(10, "Ana", "Lopez")], "employee_id long, first_name string, last_name string")
    named = lookup.with_employee_names(ev, emp)
    names = {r.activity_id: r.full_name for r in named.collect()}
    assert names == {1: "Ana Lopez", 2: "Employé #99", 3: "Ana Lopez"}
    worded = lookup.with_messages(named)
    assert [r.activity_id for r in lookup.notifications(worded).collect()] == [1, 2]
    dead = lookup.dead_letters(worded).collect()
    assert [(r.activity_id, r.reason) for r in dead] == [(3, "missing sport_type")]


def test_quality_suite(spark):
    gold = spark.createDataFrame(
        [(1, 10.0, 30000.0, "Finance"), (2, 20000.0, 30000.0, "Support"), (None, None, 1000.0, "Nope"),
         (4, 5.0, None, None)],
        "employee_id long, total_cost double, gross_salary double, business_unit string",
    )
    from perkflow.plans.rules import gold_suite

    rep = {r.rule: (r.evaluated, r.failed, r.success) for r in quality.run_suite(gold, gold_suite(4)).collect()}
    assert rep == {
        "row_count_equal": (4, 0, True),
        "total_cost_between": (3, 1, False),
        "gross_salary_between": (3, 1, False),
        "business_unit_in_set": (3, 1, False),
        "employee_id_not_null": (4, 1, False),
    }
    s = quality.summarize(quality.run_suite(gold, gold_suite(5))).first()
    assert (s.success, s.successful_rules, s.evaluated_rules) == (False, 0, 5)
    assert s.failed_rules == ("business_unit_in_set,employee_id_not_null,gross_salary_between,row_count_equal,"
                              "total_cost_between")


def test_constraints_nulls_keys_orphans(spark):
    act = spark.createDataFrame([(1, 5, None), (1, -1, 3), (2, None, 4)], "id long, distance_m int, emp long")
    checks = {"chk_distance_positive": F.col("distance_m").isNull() | (F.col("distance_m") >= 0),
              "chk_positive_only": F.col("distance_m") > 0}
    v = {r.constraint_name: r.violations for r in quality.constraint_violations(act, "t", checks).collect()}
    assert v == {"chk_distance_positive": 1, "chk_positive_only": 1}  # NULL passes a CHECK
    assert [(r.id, r.n) for r in quality.duplicate_keys(act, ["id"]).collect()] == [(1, 2)]
    nulls = {r.column_name: r.nulls for r in quality.null_counts(act, ["id", "distance_m", "emp"], "t").collect()}
    assert nulls == {"id": 0, "distance_m": 1, "emp": 1}
    parents = spark.createDataFrame([(3,)], "emp long")
    assert [r.id for r in quality.orphans(act, parents, ["emp"]).collect()] == [2]  # a NULL key passes
    report = quality.key_violations(act, ["id"], "t").collect()
    assert [tuple(r) for r in report] == [("t", "id", "1", 2)]


def test_changes_without_a_key(spark):
    env = [
        _env("c", 1, 10, 100, "v1"), {"op": "t", "source": {"ts_ms": 5, "lsn": 11}}, {"op": "u", "source": {"ts_ms": 6, "lsn": 12}},
        "not json", _env("u", 1, 13, 101, "v2"),
    ]
    flat = cdc.unwrap_envelopes(_messages(spark, env))
    assert [(r.employee_id, r.business_unit) for r in cdc.current_state(flat, ["employee_id"]).collect()] == [(1, "v2")]
    lost = {r["__source_lsn"]: r["reason"] for r in cdc.keyless(flat, ["employee_id"]).collect()}
    assert lost == {11: "truncate", 12: "no key in the row image", None: "not a change envelope"}


def test_kpis_of_an_empty_table(spark):
    from perkflow.operators.kpis import program_kpis

    emp = _emp(spark, [(1, "A B", "Finance", "CDI", 36500.0, WALK, 1.0, "ok")])
    acts = spark.createDataFrame([], "employee_id long, start_at timestamp_ntz")
    gold = eligibility.employee_eligibility(emp, acts, AS_OF)
    assert program_kpis(gold).first().bonus_pct == 100.0
    r = program_kpis(gold.limit(0)).first()
    assert (r.employees, r.bonus_count, r.cost_pct_payroll, r.bonus_pct) == (0, 0, None, None)


def test_rules_of_the_real_tables(spark):
    from perkflow.plans import rules

    emp = spark.createDataFrame([(1, None)], "employee_id long, last_name string")
    nulls = {r.column_name: r.nulls for r in quality.null_counts(emp, rules.EMPLOYEE_NOT_NULL[:2], "employees").collect()}
    assert nulls == {"employee_id": 0, "last_name": 1}
    assert set(rules.SERVING_NOT_NULL) <= set(eligibility.GOLD_COLUMNS)
    assert rules.PRIMARY_KEYS["employee_eligibility"] == ["snapshot_date", "employee_id"]
