"""spark-submit entry points, run in-process on the sf0.001 tables."""

import datetime as dt
import json

from perkflow import cli
from perkflow.operators import cdc
from perkflow.sources import testbed as tb
from perkflow.operators.lookup import notifications, with_employee_names, with_messages

from .conftest import SF_SMALL


def test_daily_then_quality(spark, scratch, capsys):
    src = f"{scratch}/src"
    tb.employees(spark, SF_SMALL).write.parquet(f"{src}/employees")
    tb.activities(spark, SF_SMALL).write.parquet(f"{src}/activities")
    tb.distance_replies(spark, SF_SMALL).write.parquet(f"{src}/replies")
    tb.parameter_history(spark).write.parquet(f"{src}/params")
    n = tb.employees(spark, SF_SMALL).count()
    assert cli.main(["daily", "--employees", f"{src}/employees", "--activities", f"{src}/activities",
                     "--replies", f"{src}/replies", "--params", f"{src}/params", "--lake", f"{scratch}/lake",
                     "--as-of", "2024-01-31"]) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["gold.employee_eligibility"] == n
    rc = cli.main(["quality", "--lake", f"{scratch}/lake", "--as-of", "2024-01-31", "--expected-rows", str(n),
                   "--out", f"{scratch}/quality"])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["evaluated_rules"] == 5
    assert rc == (0 if summary["success"] else 1)

    url, driver = "jdbc:derby:memory:perkflow_cli;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    from perkflow.plans import medallion

    medallion.publish_gold(spark, medallion.LakePaths(f"{scratch}/lake"), dt.date(2024, 1, 31), url, "FCT", {"driver": driver})
    cli.main(["quality", "--jdbc-url", url, "--jdbc-table", "FCT", "--jdbc-driver", driver,
              "--expected-rows", str(n), "--out", f"{scratch}/quality_served"])
    served = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert served == summary


def test_notifier_on_text_files(spark, scratch, capsys):
    msgs = tb.cdc_messages(spark, SF_SMALL).select("value")
    msgs.write.text(f"{scratch}/in")
    tb.known_employees(spark, SF_SMALL).write.parquet(f"{scratch}/employees")
    assert cli.main(["notifier", "--files", f"{scratch}/in", "--employees", f"{scratch}/employees",
                     "--outbox", f"{scratch}/outbox", "--dead-letters", f"{scratch}/dead",
                     "--checkpoint", f"{scratch}/ckpt", "--available-now"]) == 0
    want = notifications(with_messages(with_employee_names(
        cdc.live_creations(cdc.parse_messages(msgs)), tb.known_employees(spark, SF_SMALL))))
    got = spark.read.parquet(f"{scratch}/outbox")
    assert sorted(r.activity_id for r in got.collect()) == sorted(r.activity_id for r in want.collect())
    capsys.readouterr()
    assert cli.main(["deliver", "--outbox", f"{scratch}/outbox", "--deliveries", f"{scratch}/deliveries",
                     "--webhook-url", "MOCK"]) == 0
    sent = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert sent == {"delivered": got.count(), "failed": 0}


def test_daily_from_database_tables(spark, scratch, capsys):
    url = "jdbc:derby:memory:perkflow_src;create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    props = {"driver": driver}
    tb.employees(spark, SF_SMALL).write.mode("overwrite").jdbc(url, "HR_EMPLOYEES", properties=props)
    tb.activities(spark, SF_SMALL).write.mode("overwrite").jdbc(url, "OPS_ACTIVITIES", properties=props)
    tb.distance_replies(spark, SF_SMALL).write.parquet(f"{scratch}/replies")
    assert cli.main(["daily", "--source-jdbc-url", url, "--source-jdbc-driver", driver, "--jdbc-partitions", "4",
                     "--employees", "HR_EMPLOYEES", "--activities", "OPS_ACTIVITIES",
                     "--replies", f"{scratch}/replies", "--lake", f"{scratch}/lake", "--as-of", "2024-01-31",
                     "--params-table", ""]) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts["bronze.activities"] == tb.activities(spark, SF_SMALL).count()
    assert counts["gold.employee_eligibility"] == tb.employees(spark, SF_SMALL).count()


def test_state_on_text_files(spark, scratch, capsys):
    from perkflow.streaming.current_state import read_state

    tb.employee_envelopes(spark, SF_SMALL).select("value").write.text(f"{scratch}/in")
    assert cli.main(["state", "--files", f"{scratch}/in", "--updates", f"{scratch}/updates",
                     "--checkpoint", f"{scratch}/ckpt", "--available-now"]) == 0
    cols = ["employee_id", "business_unit", "gross_salary"]
    got = sorted(tuple(r) for r in read_state(spark, f"{scratch}/updates", ["employee_id"]).select(*cols).collect())
    want = cdc.current_state(cdc.unwrap_envelopes(tb.employee_envelopes(spark, SF_SMALL)), ["employee_id"])
    assert got == sorted(tuple(r) for r in want.select(*cols).collect())


def test_load_hr_insert_if_absent(spark, tmp_path, capsys):
    header = ("ID salarié;Nom;Prénom;Date de naissance;BU;Date d'embauche;Salaire brut;Type de contrat;"
              "Nombre de jours de CP;Adresse du domicile;Moyen de déplacement")
    lines = [header,
             "1;Durand;Zoé;1985-07-14;Ventes;2019-09-01;45 000,50;CDI;27;3 rue C;Marche/running",
             "2;Petit;Léa;1990-01-02;R&D;2020-01-01;38 000,00;CDD;25;4 rue D;Transports en commun"]
    path = tmp_path / "rh.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    url, driver = "jdbc:derby:memory:perkflow_hr;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    args = ["load-hr", "--file", str(path), "--sep", ";", "--decimal-comma", "--jdbc-url", url,
            "--jdbc-table", "HR_EMP", "--jdbc-driver", driver]
    tb.employees(spark, SF_SMALL).limit(0).select(
        "employee_id", "last_name", "first_name", "birth_date", "business_unit", "hire_date", "gross_salary",
        "contract_type", "paid_leave_days", "home_address", "transport_mode",
    ).write.mode("overwrite").jdbc(url, "HR_EMP", properties={"driver": driver})
    assert cli.main(args) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"inserted": 2, "rejected": 0}
    assert cli.main(args) == 0  # second load: both already there
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"inserted": 0, "rejected": 0}


def test_load_hr_rejects(spark, tmp_path, scratch, capsys):
    import pytest

    header = ("ID salarié,Nom,Prénom,Date de naissance,BU,Date d'embauche,Salaire brut,Type de contrat,"
              "Nombre de jours de CP,Adresse du domicile,Moyen de déplacement")
    line = "{},{},Zoé,1985-07-14,Ventes,2019-09-01,45000,CDI,27,3 rue C,Marche/running"
    path = tmp_path / "rh.csv"
    path.write_text("\n".join([header, line.format(1, "First"), line.format("x", "Bad"), line.format(1, "Second")]) + "\n",
                    encoding="utf-8")
    args = ["load-hr", "--file", str(path), "--out", f"{scratch}/employees"]
    with pytest.raises(ValueError, match="employee_id"):  # a bad row stops the load, as long as no table is given for it
        cli.main(args)
    assert cli.main([*args, "--rejects", f"{scratch}/rejects"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"written": 1, "rejected": 1}
    assert [r.last_name for r in spark.read.parquet(f"{scratch}/employees").collect()] == ["First"]
    r = spark.read.parquet(f"{scratch}/rejects").first()
    assert r.reason == "missing or unreadable: employee_id" and json.loads(r.line)["Nom"] == "Bad"


class _Reader:
    """Stands in for spark.read: records what a JDBC read is given."""

    def __init__(self):
        self.calls = []

    def jdbc(self, url, table, **options):
        self.calls.append((url, table, options))
        return self

    def first(self):
        return {"LO": 5, "HI": 904}


class _Session:
    def __init__(self):
        self.read = _Reader()


def test_daily_reads_parameters_and_tables_from_the_database():
    args = cli.parser().parse_args(["daily", "--employees", "hr.employees", "--activities", "ops.activities", "--lake", "/l",
                                    "--as-of", "2024-01-31", "--source-jdbc-url", "jdbc:x", "--source-jdbc-user", "u",
                                    "--jdbc-partitions", "12"])
    s = _Session()
    cli._parameters(s, args)
    url, table, options = s.read.calls[0]
    assert url == "jdbc:x" and options["properties"]["user"] == "u"
    assert table == ("(SELECT * FROM analytics.dim_parameters WHERE snapshot_date <= DATE '2024-01-31' "
                     "ORDER BY snapshot_date DESC LIMIT 1) p")
    cli._source_table(s, args, args.employees, "employee_id")
    bounds, scan = s.read.calls[1:]
    assert bounds[1] == '(SELECT MIN("employee_id") AS LO, MAX("employee_id") AS HI FROM hr.employees) q'
    assert scan[1] == "hr.employees" and scan[2]["numPartitions"] == 12
    assert (scan[2]["lowerBound"], scan[2]["upperBound"]) == (5, 905)


def example_fetch(addresses):
    reply = '{"status":"OK","rows":[{"elements":[{"status":"OK","distance":{"value":1000}}]}]}'
    return [reply if a.endswith("1") else None for a in addresses]


def test_daily_provider_choice(spark):
    from perkflow.operators.enrichment import NoKeyProvider, resolve_addresses

    base = ["daily", "--employees", "e", "--activities", "a", "--lake", "/l", "--as-of", "2024-01-31"]
    assert isinstance(cli._provider(spark, cli.parser().parse_args(base)), NoKeyProvider)
    args = cli.parser().parse_args([*base, "--provider", "tests.test_cli:example_fetch", "--max-callers", "2"])
    addresses = spark.createDataFrame([("R1",), ("R2",)], "home_address string")
    got = {r.home_address: r.distance_check_status for r in resolve_addresses(addresses, cli._provider(spark, args)).collect()}
    assert got == {"R1": "ok", "R2": "error"}


def test_jobs_run_in_utc(spark, monkeypatch):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    seen = []
    monkeypatch.setattr(cli, "cmd_compact_state", lambda s, a: seen.append(s.conf.get("spark.sql.session.timeZone")) or {})
    try:
        cli.main(["compact-state", "--updates", "/nowhere"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen == ["UTC"]
