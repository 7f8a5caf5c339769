"""Sources and sinks: lake snapshots, partition replace, insert-ignore, HR extract, JDBC."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perkflow.sinks import jdbc as jdbc_sink
from perkflow.sinks.keys import first_per_key, insert_ignore, rows_to_insert, without_key
from perkflow.sinks.lake import recover_partition, replace_partition, write_counted, write_partitioned
from perkflow.sinks.outbox import write_outbox
from perkflow.sources import jdbc as jdbc_src
from perkflow.sources import folders, lake
from perkflow.sources.hr_extract import POSITION, checked_hr_extract, normalize_hr_extract, read_hr_extract

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def _days(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, extract_date date")


def test_replace_partition(spark, scratch):
    write_partitioned(_days(spark, [(1, "a", D1), (2, "b", D2)]), scratch, "extract_date")
    day2 = _days(spark, [(3, "c", D2), (4, "d", D2)])
    replace_partition(day2, scratch, "extract_date", D2)
    replace_partition(day2, scratch, "extract_date", D2)  # rerun: same result, no duplicates
    got = sorted((r.id, r.extract_date) for r in lake.read_table(spark, scratch).collect())
    assert got == [(1, D1), (3, D2), (4, D2)]
    replace_partition(day2.limit(0), scratch, "extract_date", D2)  # empty frame empties the day
    assert sorted(r.id for r in lake.read_table(spark, scratch).collect()) == [1]
    with pytest.raises(Exception, match="row outside partition"):
        replace_partition(_days(spark, [(9, "x", D3)]), scratch, "extract_date", D2)
    assert sorted(r.id for r in lake.read_table(spark, scratch).collect()) == [1]


def _ids(spark, path):
    return sorted(r.id for r in lake.read_table(spark, path).collect())


def test_failed_replace_keeps_the_old_rows(spark, scratch):
    write_partitioned(_days(spark, [(1, "a", D1), (2, "b", D2), (3, "c", D2)]), scratch, "extract_date")
    foreign = _days(spark, [(7, "x", D2), (9, "y", D3)])
    with pytest.raises(Exception, match="row outside partition"):
        replace_partition(foreign, scratch, "extract_date", D2)
    assert _ids(spark, scratch) == [1, 2, 3]
    half = spark.range(4000, numPartitions=8).select(
        F.when(F.col("id") == 3900, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).cast("long").alias("id"),
        F.lit("z").alias("v"), F.lit(D2).alias("extract_date"),
    )
    with pytest.raises(Exception, match="bad row"):
        replace_partition(half, scratch, "extract_date", D2)
    assert _ids(spark, scratch) == [1, 2, 3]
    replace_partition(_days(spark, [(5, "n", D2)]), scratch, "extract_date", D2)  # rerun after the failures
    assert _ids(spark, scratch) == [1, 5]
    assert not [n for n in folders.child_folders(spark, scratch) if n.startswith(".")]


def test_replace_that_died_between_the_renames(spark, scratch):
    write_partitioned(_days(spark, [(1, "a", D1), (2, "b", D2)]), scratch, "extract_date")
    name = f"extract_date={D2.isoformat()}"
    folders.rename(spark, f"{scratch}/{name}", f"{scratch}/.replaced-{name}")  # died here
    _days(spark, [(8, "s", D2)]).drop("extract_date").write.parquet(f"{scratch}/.staging-{name}-0123456789ab")
    assert _ids(spark, scratch) == [1]  # readers ignore the hidden folders
    recover_partition(spark, scratch, "extract_date", D2)
    assert _ids(spark, scratch) == [1, 2]
    assert not [n for n in folders.child_folders(spark, scratch) if n.startswith(".")]


def test_swap_that_cannot_rename_puts_the_old_rows_back(spark, scratch, monkeypatch):
    write_partitioned(_days(spark, [(1, "a", D2)]), scratch, "extract_date")
    real = folders.rename

    def no_new(spark, path, to):
        if "/.staging-" in path:
            raise OSError("disk full")
        real(spark, path, to)

    monkeypatch.setattr(folders, "rename", no_new)
    with pytest.raises(OSError, match="disk full"):
        replace_partition(_days(spark, [(2, "b", D2)]), scratch, "extract_date", D2)
    assert _ids(spark, scratch) == [1]


def test_snapshot_scan_prunes_and_as_of(spark, scratch):
    write_partitioned(_days(spark, [(1, "a", D1), (2, "b", D1), (3, "c", D3)]), scratch, "extract_date")
    s = lake.snapshot_scan(spark, scratch, D1)
    assert sorted(r.id for r in s.collect()) == [1, 2]
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extract_date" in plan
    assert sorted(r.id for r in lake.snapshot_as_of(spark, scratch, D2).collect()) == [1, 2]
    assert sorted(r.id for r in lake.snapshot_as_of(spark, scratch, D3).collect()) == [3]
    assert lake.snapshot_as_of(spark, scratch, dt.date(2023, 1, 1)).collect() == []


def test_write_counted_and_outbox_replay(spark, scratch):
    df = spark.range(123).withColumn("extract_date", F.lit(D1))
    assert write_counted(df, lambda d: write_partitioned(d, scratch + "/t", "extract_date")) == 123
    rows = spark.createDataFrame([(1, "hi")], "activity_id long, text string")
    write_outbox(rows, scratch + "/o", 7)
    write_outbox(rows, scratch + "/o", 7)
    out = spark.read.parquet(scratch + "/o").collect()
    assert [(r.activity_id, r.batch_id) for r in out] == [(1, 7)]


def test_insert_ignore(spark):
    existing = spark.createDataFrame([(1, "old")], "k long, v string")
    new = spark.createDataFrame([(1, "dup", 1), (2, "second", 5), (2, "first", 3), (3, "new", 9)],
                                "k long, v string, seq int")
    ins = rows_to_insert(existing, new, ["k"], "seq")
    assert sorted((r.k, r.v) for r in ins.collect()) == [(2, "first"), (3, "new")]
    table = insert_ignore(existing, new.select("k", "v", "seq"), ["k"], "seq")
    assert sorted((r.k, r.v) for r in table.select("k", "v").collect()) == [(1, "old"), (2, "first"), (3, "new")]


def test_hr_extract(spark, tmp_path):
    path = str(tmp_path / "rh.csv")
    header = ("ID salarié,Nom,Prénom,Date de naissance,BU,Date d'embauche,Salaire brut,Type de contrat,"
              "Nombre de jours de CP,Adresse du domicile,Moyen de déplacement")
    lines = [
        header,
        " 59019 , Dupont ,Ana,1990-05-01 00:00:00, Finance ,2020-03-02, 45000.50 ,CDI, 25 , 1 rue A ,Marche/running",
        "x,Martin,Léo,1990-02-30,R&D,2021-01-01,abc,CDD,n/a,2 rue B,Transports en commun",
    ]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    got = normalize_hr_extract(read_hr_extract(spark, path)).collect()
    a, b = got
    assert (a.employee_id, a.last_name, a.birth_date, a.business_unit, a.gross_salary, a.paid_leave_days) == (
        59019, "Dupont", dt.date(1990, 5, 1), "Finance", 45000.5, 25)
    assert (a.hire_date, a.home_address) == (dt.date(2020, 3, 2), "1 rue A")
    assert (b.employee_id, b.birth_date, b.gross_salary, b.paid_leave_days, b.first_name) == (
        None, None, None, None, "Léo")


DERBY = "jdbc:derby:memory:perkflow_test;create=true"
PROPS = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_scan_subquery_publish_append(spark):
    emp = spark.createDataFrame([(i, f"E{i}") for i in range(1, 101)], "EMPLOYEE_ID int, NAME string")
    emp.write.mode("overwrite").jdbc(DERBY, "EMPLOYEES", properties=PROPS)
    scan = jdbc_src.jdbc_scan(spark, DERBY, "EMPLOYEES", PROPS, "EMPLOYEE_ID", 1, 101, 4)
    assert scan.rdd.getNumPartitions() == 4
    assert scan.count() == 100

    params = spark.createDataFrame([(dt.date(2024, 1, 1), 0.05), (dt.date(2024, 6, 1), 0.08)],
                                   "SNAPSHOT_DATE date, PREMIUM_RATE double")
    params.write.mode("overwrite").jdbc(DERBY, "PARAMS", properties=PROPS)
    latest = jdbc_src.jdbc_subquery_scan(
        spark, DERBY, 'SELECT * FROM PARAMS ORDER BY "SNAPSHOT_DATE" DESC FETCH FIRST 1 ROWS ONLY', PROPS)
    assert [r.PREMIUM_RATE for r in latest.collect()] == [0.08]

    jdbc_sink.publish(emp.filter("EMPLOYEE_ID <= 10"), DERBY, "EMPLOYEES", PROPS)
    assert jdbc_src.jdbc_scan(spark, DERBY, "EMPLOYEES", PROPS).count() == 10
    jdbc_sink.append(emp.filter("EMPLOYEE_ID > 95"), DERBY, "EMPLOYEES", PROPS, batchsize=2)
    assert jdbc_src.jdbc_scan(spark, DERBY, "EMPLOYEES", PROPS).count() == 15


def test_jdbc_parallel_scan_finds_bounds(spark):
    df = spark.createDataFrame([(i * 7, f"A{i}") for i in range(50)], "ACTIVITY_ID bigint, NOTE string")  # upper case
    df.write.mode("overwrite").jdbc(DERBY, "ACTIVITIES", properties=PROPS)
    scan = jdbc_src.jdbc_parallel_scan(spark, DERBY, "ACTIVITIES", PROPS, "ACTIVITY_ID", 5)
    assert scan.rdd.getNumPartitions() == 5
    assert sorted(r.ACTIVITY_ID for r in scan.collect()) == [i * 7 for i in range(50)]
    df.limit(0).write.mode("overwrite").jdbc(DERBY, "EMPTY_T", properties=PROPS)
    assert jdbc_src.jdbc_parallel_scan(spark, DERBY, "EMPTY_T", PROPS, "ACTIVITY_ID", 5).count() == 0


def test_outbox_delivery_is_resumable(spark, scratch):
    from perkflow.sinks.outbox import deliver

    rows = spark.createDataFrame([(i, f'{{"text":"m{i}"}}') for i in range(20)], "activity_id long, body string")
    write_outbox(rows, scratch + "/outbox", 0)

    def flaky(bodies):  # the service rejects odd messages
        return [None if int(b.split('"m')[1].rstrip('"}')) % 2 == 0 else "HTTP 503" for b in bodies]

    first = deliver(spark, scratch + "/outbox", scratch + "/deliveries", flaky)
    assert first.filter("delivered").count() == 10 and first.filter("NOT delivered").count() == 10
    final = deliver(spark, scratch + "/outbox", scratch + "/deliveries", lambda bodies: [None] * len(bodies))
    delivered = final.filter("delivered")
    assert delivered.count() == 20  # the retry sent only the 10 that had failed
    assert delivered.select("activity_id").distinct().count() == 20

    def broken(bodies):
        raise ConnectionError("down")

    write_outbox(spark.createDataFrame([(99, '{"text":"x"}')], "activity_id long, body string"), scratch + "/outbox", 1)
    out = deliver(spark, scratch + "/outbox", scratch + "/deliveries", broken)
    r = out.filter("activity_id = 99").first()
    assert (r.delivered, r.error) == (False, "ConnectionError: down")


def test_jdbc_insert_ignore(spark):
    existing = spark.createDataFrame([(1, "old", 0)], "K long, V string, SEQ int")
    existing.write.mode("overwrite").jdbc(DERBY, "KEYED", properties=PROPS)
    new = spark.createDataFrame([(1, "dup", 1), (2, "second", 5), (2, "first", 3), (3, "new", 9)],
                                "K long, V string, SEQ int")
    assert jdbc_sink.insert_ignore(spark, new, DERBY, "KEYED", PROPS, ["K"], "SEQ") == 2
    assert jdbc_sink.insert_ignore(spark, new, DERBY, "KEYED", PROPS, ["K"], "SEQ") == 0  # rerun: nothing new
    rows = sorted((r.K, r.V) for r in jdbc_src.jdbc_scan(spark, DERBY, "KEYED", PROPS).collect())
    assert rows == [(1, "old"), (2, "first"), (3, "new")]


def test_write_partitioned_salted_files(spark, scratch):
    import glob

    from pyspark.sql import functions as F

    df = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(D1)).otherwise(F.lit(D2)).alias("extract_date")
    )
    write_partitioned(df, scratch, "extract_date", files_per_value=4)
    for d in (D1, D2):
        files = glob.glob(f"{scratch}/extract_date={d.isoformat()}/*.parquet")
        assert 1 <= len(files) <= 4
    got = lake.read_table(spark, scratch)
    assert got.count() == 3000 and got.filter(F.col("extract_date") == F.lit(D1)).count() == 1000


def test_hr_extract_french_export(spark, tmp_path):
    path = str(tmp_path / "rh.csv")
    header = ("ID salarié;Nom;Prénom;Date de naissance;BU;Date d'embauche;Salaire brut;Type de contrat;"
              "Nombre de jours de CP;Adresse du domicile;Moyen de déplacement")
    line = "7;Durand;Zoé;14/07/1985;Ventes;01/09/2019;45\u00a0000,50;CDI;27;3 rue C, Lattes;Vélo/Trottinette/Autres"
    with open(path, "w", encoding="utf-8") as f:
        f.write(header + "\n" + line + "\n")
    r = normalize_hr_extract(read_hr_extract(spark, path, sep=";"), decimal_comma=True, day_first=True).first()
    assert (r.employee_id, r.gross_salary, r.home_address, r.transport_mode) == (
        7, 45000.5, "3 rue C, Lattes", "Vélo/Trottinette/Autres")
    assert (r.birth_date, r.hire_date) == (dt.date(1985, 7, 14), dt.date(2019, 9, 1))


HEADERS = ["Moyen de déplacement", "Prénom", "ID salarié", "Nom", "Remarque", "Date de naissance", "BU", "Date d'embauche",
           "Salaire brut", "Type de contrat", "Nombre de jours de CP", "Adresse du domicile"]


def _hr_line(i, last="Dupont"):
    return f"Marche/running,Alice,{i},{last},-,1990-05-01,Finance,2020-03-02,45000.5,CDI,25,1 rue A"


def test_hr_columns_by_name(spark, tmp_path):
    path = tmp_path / "rh.csv"
    path.write_text("\n".join([",".join(HEADERS), _hr_line(7)]) + "\n", encoding="utf-8")
    r = normalize_hr_extract(read_hr_extract(spark, str(path))).first()
    assert (r.employee_id, r.first_name, r.last_name, r.gross_salary) == (7, "Alice", "Dupont", 45000.5)
    path.write_text("ID salarié,Nom\n7,Dupont\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Prénom"):
        read_hr_extract(spark, str(path))


def test_hr_files_must_share_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([",".join(HEADERS), _hr_line(7)]) + "\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("\n".join([",".join(reversed(HEADERS)), _hr_line(8)]) + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        normalize_hr_extract(read_hr_extract(spark, str(tmp_path))).collect()


@pytest.mark.parametrize("split", ["128m", "300b"])
def test_first_row_in_the_file_wins(spark, tmp_path, split):
    """Whatever the splits and partitions; bad rows are rejected with a reason."""
    path = tmp_path / "rh.csv"
    lines = [_hr_line(i % 40, f"N{i:04d}") for i in range(400)] + [_hr_line("x"), _hr_line(""), _hr_line(99).replace("1990-05-01", "soon")]
    path.write_text("\n".join([",".join(HEADERS), *lines]) + "\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        good, rejected = checked_hr_extract(read_hr_extract(spark, str(path)))
        first = first_per_key(good.repartition(5), ["employee_id"], POSITION)
        assert {r.employee_id: r.last_name for r in first.collect()} == {i: f"N{i:04d}" for i in range(40)}
        reasons = sorted(r.reason for r in rejected.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert reasons == ["missing or unreadable: birth_date"] + ["missing or unreadable: employee_id"] * 2


def test_first_per_key_ties_and_null_keys(spark):
    rows = [(1, "C", 1), (1, "D", 1), (1, "B", None), (None, "x", 1), (None, "y", 2)]
    df = spark.createDataFrame(rows, "k long, v string, o int")
    for parts in (1, 4):
        assert [tuple(r) for r in first_per_key(df.repartition(parts), ["k"], "o").collect()] == [(1, "B", None)]
        tied = first_per_key(df.where("o = 1").repartition(parts), ["k"], "o").collect()
        assert [tuple(r) for r in tied] == [(1, "C", 1)]
    assert sorted(r.v for r in without_key(df, ["k"]).collect()) == ["x", "y"]


def test_broken_deliveries_table_sends_nothing(spark, scratch):
    from perkflow.sinks.outbox import deliver

    write_outbox(spark.createDataFrame([(1, "b")], "activity_id long, body string"), scratch + "/outbox", 0)
    spark.createDataFrame([(1, 0)], "other long, batch_id long").write.partitionBy("batch_id").parquet(scratch + "/deliveries")

    def send(bodies):
        raise AssertionError("must not be called")

    for batch in (None, 0):
        with pytest.raises(Exception, match="(?i)delivered"):
            deliver(spark, scratch + "/outbox", scratch + "/deliveries", send, batch_id=batch)
    assert spark.read.parquet(scratch + "/deliveries").columns == ["other", "batch_id"]
