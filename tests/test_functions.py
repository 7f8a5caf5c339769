"""Scalar functions on literal edge rows (FIXTURES.md section 4)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perkflow.functions import activity, messages, people
from perkflow.functions.distance import decode_replies
from perkflow.functions.numeric import round_half_up


def test_distance_reply_decode(spark):
    ok = '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":15004}}]}]}'
    rows = [
        ("ok", ok),
        ("not_found", '{"status":"OK","rows":[{"elements":[{"status":"NOT_FOUND"}]}]}'),
        ("denied", '{"status":"REQUEST_DENIED","error_message":"bad key"}'),
        ("malformed", "<html>"),
        ("empty_rows", '{"status":"OK","rows":[]}'),
        ("no_distance", '{"status":"OK","rows":[{"elements":[{"status":"OK"}]}]}'),
        ("no_key", None),
    ]
    df = spark.createDataFrame(rows, "case string, reply string")
    got = {r.case: (r.home_to_office_km, r.distance_check_status) for r in decode_replies(df).collect()}
    assert got == {
        "ok": (15.0, "ok"),  # 15,004 m rounds to 15.00 km before any threshold
        "not_found": (None, "not_found"),
        "denied": (None, "error"),
        "malformed": (None, "error"),
        "empty_rows": (None, "error"),
        "no_distance": (None, "error"),
        "no_key": (None, "no_api_key"),
    }


def test_pace(spark):
    df = spark.createDataFrame([(1, None, 1800), (2, 0, 1800), (3, 5000, 1830)], "id int, m int, s int")
    km, mins = activity.metres_to_km(F.col("m")), activity.seconds_to_minutes(F.col("s"))
    got = {r.id: r.p for r in df.select("id", activity.pace_min_per_km(mins, km).alias("p")).collect()}
    assert got == {1: None, 2: None, 3: 6.1}


def test_money_rounding_is_half_up_on_cents(spark):
    df = spark.createDataFrame([(745.5360000000001,), (0.125,), (2.675,), (1.004999,)], "x double")
    got = [r.y for r in df.select(round_half_up(F.col("x")).alias("y")).collect()]
    assert got == [745.54, 0.13, 2.68, 1.0]


def test_completed_years_edges(spark):
    cases = [
        (dt.date(2000, 2, 29), dt.date(2001, 2, 28), 1),  # both month ends: whole months
        (dt.date(2000, 2, 29), dt.date(2004, 2, 29), 4),
        (dt.date(2000, 5, 10), dt.date(2024, 5, 10), 24),  # birthday today
        (dt.date(2000, 5, 10), dt.date(2024, 5, 9), 23),  # day before
        (dt.date(2025, 1, 1), dt.date(2024, 1, 1), -1),  # future date
    ]
    df = spark.createDataFrame(cases, "d date, as_of date, want int")
    got = df.select("want", people.completed_years(F.col("as_of"), "d").alias("y")).collect()
    assert [r.y for r in got] == [r.want for r in got]


@settings(max_examples=40, deadline=None)
@given(
    st.dates(min_value=dt.date(1940, 1, 1), max_value=dt.date(2020, 12, 31)),
    st.dates(min_value=dt.date(2021, 1, 1), max_value=dt.date(2030, 12, 31)),
)
def test_completed_years_is_age(spark, born, as_of):
    # away from month ends the floor(months/12) rule is the usual age
    born, as_of = born.replace(day=min(born.day, 28)), as_of.replace(day=min(as_of.day, 28))
    want = as_of.year - born.year - ((as_of.month, as_of.day) < (born.month, born.day))
    got = spark.range(1).select(people.completed_years(as_of, F.lit(born)).alias("y")).first().y
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=400_000), min_size=1, max_size=50))
def test_km_one_decimal_matches_printf(spark, metres):
    df = spark.createDataFrame([(m,) for m in metres], "m int")
    got = [r.s for r in df.select(messages.km_one_decimal_fr(F.col("m")).alias("s")).collect()]
    assert got == [f"{m / 1000.0:.1f}".replace(".", ",") for m in metres]


def test_km_one_decimal_ties(spark):
    df = spark.createDataFrame([(2250,), (150,), (2750,), (1234567,)], "m int")
    got = [r.s for r in df.select(messages.km_one_decimal_fr(F.col("m")).alias("s")).collect()]
    assert got == ["2,2", "0,1", "2,8", "1234,6"]


def test_type_normalize(spark):
    df = spark.createDataFrame([("x", "2024-02-30", None), ("42", "2024-02-29", "7"), (None, None, " 8 ")],
                               "i string, d string, n string")
    got = df.select(
        people.to_long_or_null(F.col("i")).alias("i"),
        people.to_date_or_null(F.col("d")).alias("d"),
        people.to_int_or_null(F.trim(F.col("n"))).alias("n"),
    ).collect()
    assert [tuple(r) for r in got] == [(None, None, None), (42, dt.date(2024, 2, 29), 7), (None, None, 8)]


def test_date_text_forms(spark):
    rows = [("2024-02-29",), ("2024-02-29 13:45:00",), ("2024-02-29T13:45:00",), ("2024-02-29x",), ("29/02/2024",),
            ("2023-02-29",), ("",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.d for r in df.select(people.to_date_or_null(F.col("t")).alias("d")).collect()]
    feb29 = dt.date(2024, 2, 29)
    assert got == [feb29, feb29, feb29, None, None, None, None]


def test_day_first_dates(spark):
    df = spark.createDataFrame([("14/07/1985",), ("14/07/1985 00:00:00",), ("31/02/2024",), ("1985-07-14",)], "t string")
    got = [r.d for r in df.select(people.to_date_or_null(F.col("t"), day_first=True).alias("d")).collect()]
    assert got == [dt.date(1985, 7, 14), dt.date(1985, 7, 14), None, None]


def test_full_name(spark):
    df = spark.createDataFrame([("Ana", "Lopez")], "f string, l string")
    assert df.select(people.full_name("f", "l").alias("n")).first().n == "Ana Lopez"


MESSAGE_CASES = [
    # sport, distance_m, duration_s, comment, expected text (None = dead letter)
    ("Course à pied", 5200, 1830, None, "Bravo Ana Lopez ! Tu viens de courir 5,2 km en 30 min ! 🏃"),
    ("Tennis", 2300, 3600, "super", 'Bravo Ana Lopez ! Tu viens de faire 60 min de tennis sur 2,3 km ! 🎾 ("super")'),
    ("Yoga", None, 2700, None, "Bravo Ana Lopez ! 45 min de yoga bouclées ! 🧘"),
    ("Escalade", None, 3600, "", "Bravo Ana Lopez ! 60 min d'escalade bouclées ! 🧗"),
    ("Course à pied", 0, 600, None, "Bravo Ana Lopez ! 10 min de course à pied bouclées ! 🏃"),
    ("Badminton", None, 1200, None, "Bravo Ana Lopez ! 20 min de badminton bouclées ! 🏅"),
    ("Badminton", 3000, 1800, None, "Bravo Ana Lopez ! Tu viens de faire 30 min de badminton sur 3,0 km ! 🏅"),
    ("Vélo", 2250, 3000, None, "Bravo Ana Lopez ! Tu viens de rouler 2,2 km en 50 min ! 🚴"),
    ("Marche", 150, 600, None, "Bravo Ana Lopez ! Tu viens de marcher 0,1 km en 10 min ! 🚶"),
    ("Natation", 2750, 1500, None, "Bravo Ana Lopez ! Tu viens de nager 2,8 km en 25 min ! 🏊"),
    ("Randonnée", None, 7200, None, "Bravo Ana Lopez ! 120 min de randonnée bouclées ! 🥾"),
    ("Équitation", None, 3599, None, "Bravo Ana Lopez ! 59 min d'équitation bouclées ! 🏅"),
    ("", 1000, 600, None, "Bravo Ana Lopez ! Tu viens de faire 10 min de  sur 1,0 km ! 🏅"),
    ("", None, 600, None, None),
    (None, 1000, 600, None, None),
    ("Yoga", None, None, None, None),
]


def test_message_text(spark):
    rows = [(i, *c[:4]) for i, c in enumerate(MESSAGE_CASES)]
    df = spark.createDataFrame(rows, "i int, sport string, m int, s int, comment string")
    text = messages.message_text(F.lit("Ana Lopez"), F.col("sport"), F.col("m"), F.col("s"), F.col("comment"))
    reason = messages.failure_reason(F.col("sport"), F.col("m"), F.col("s"))
    got = {r.i: (r.t, r.why) for r in df.select("i", text.alias("t"), reason.alias("why")).collect()}
    for i, case in enumerate(MESSAGE_CASES):
        assert got[i][0] == case[4], case
        assert (got[i][1] is None) == (case[4] is not None), case
    assert got[13][1] == "empty sport_type"
    assert got[14][1] == "missing sport_type"
    assert got[15][1] == "missing duration_s"


def test_outbox_body_is_json(spark):
    import json

    df = spark.createDataFrame([('Bravo ! ("x") 🏃',)], "t string")
    body = df.select(messages.outbox_body(F.col("t")).alias("b")).first().b
    assert json.loads(body) == {"text": 'Bravo ! ("x") 🏃'}


def test_km_equals_python_round(spark):
    """Every whole-metre value up to 60 km: 25,005 m is 25.0 km, and the bonus is paid."""
    from perkflow.functions.numeric import metres_to_km_2dp

    got = spark.range(60_001).select("id", metres_to_km_2dp(F.col("id")).alias("km")).collect()
    assert all(r.km == round(r.id / 1000.0, 2) for r in got)
    assert got[25_005].km == 25.0
