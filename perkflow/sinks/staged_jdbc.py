"""JDBC writes that a lost executor, a rerun or a dead job can neither double nor leave half done.

Spark's JDBC writer commits each task by itself, so a plain append that fails
leaves some tasks' rows behind, and a task that is run again after its commit
writes its rows twice. Here the tasks write to a staging table, every row under
its (partition, attempt). Then one transaction of the database moves one
attempt per partition into the target and closes the batch in a ledger.

Ledger ``<table>_batches``: one row per batch with its staging table and, once
moved, its number of rows. A batch that is closed isn't written again. A batch
that was left open (its job died) gets a new staging table and loses the old
one, so a task of the dead job that is still running has nowhere to write.

The rows of a partition must be the same in every attempt: true for rows read
from files or hashed by their values, and for the even deal made here as long as
``spark.sql.execution.sortBeforeRepartition`` is on (the default) and the rows
hold no random values. The database must have transactions that cover INSERT, DELETE and
UPDATE. The move is one statement inside the database; nothing but counts comes
to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.jdbc import jdbc_scan

PUBLISHED = "published"  # the ledger's row of the table's current content


def append_once(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_id: str,
                batchsize: int = 500, num_partitions: int = 8) -> int:
    """Append ``df`` to ``table`` once per ``batch_id``; returns the rows that the batch has put there.

    A rerun after success writes nothing and returns the same number. A rerun
    after a failure at any point starts anew. Two runs of one batch at the same
    time: the later one to start wins, the other raises. An empty ``df`` closes
    the batch with 0 rows; a missing table is created from ``df``'s types.
    ``batch_id``: up to 200 characters, any.
    """
    if batch_id == PUBLISHED:
        raise ValueError(f"{PUBLISHED!r} is kept for the published content")
    return _staged(df, url, table, properties, batch_id, False, batchsize, num_partitions)


def publish_staged(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batchsize: int = 500,
                   num_partitions: int = 8) -> int:
    """Replace the content of ``table`` by ``df`` in one transaction; returns the new number of rows.

    Readers see the old rows or the new ones, never none and never a part; a
    failure at any point leaves the old rows. The table's definition stays.
    """
    return _staged(df, url, table, properties, PUBLISHED, True, batchsize, num_partitions)


def _staged(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_id: str, replace: bool,
            batchsize: int, num_partitions: int) -> int:
    spark = df.sparkSession
    df.limit(0).write.mode("append").jdbc(url, table, properties=dict(properties))
    staging = f"{table}_stg_{uuid.uuid4().hex[:12]}"
    done = _open_batch(spark, url, table, properties, batch_id, staging, replace)
    if done is not None:
        return done
    rows = write_staging(df, url, staging, properties, batchsize, num_partitions)
    _move(spark, url, table, properties, batch_id, staging, df.columns, rows, replace)
    with _transaction(spark, url, properties) as db:
        _drop(db, staging)
    return rows


def write_staging(df: DataFrame, url: str, staging: str, properties: Mapping[str, str], batchsize: int,
                  num_partitions: int) -> int:
    """The rows of ``df`` with their partition and task attempt, as a table; returns how many there are.

    Counted on the attempts that Spark takes as the partitions' results, so the
    number is right however many attempts have committed.
    """
    part, attempt = _own_columns(df.columns)
    schema = StructType([*df.schema.fields, StructField(part, LongType()), StructField(attempt, LongType())])

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        for b in batches:
            own = [pa.array([v] * b.num_rows, pa.int64()) for v in (task.partitionId(), task.taskAttemptId())]
            yield pa.RecordBatch.from_arrays([*b.columns, *own], names=schema.names)

    seen = Observation()
    tagged = df.repartition(num_partitions).mapInArrow(tag, schema).observe(seen, F.count(F.lit(1)).alias("rows"))
    tagged.write.mode("append").option("batchsize", str(batchsize)).jdbc(url, staging, properties=dict(properties))
    return int(seen.get.get("rows", 0))


def _open_batch(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], batch_id: str,
                staging: str, reopen: bool) -> int | None:
    """The number of rows of a closed batch; else None, and the batch is open under ``staging``."""
    ledger = f"{table}_batches"
    if not _exists(spark, url, properties, ledger):
        with _transaction(spark, url, properties) as db:
            _run(db, f"CREATE TABLE {ledger} (batch_id VARCHAR(200) NOT NULL PRIMARY KEY, "
                     "staging VARCHAR(200) NOT NULL, n_rows BIGINT)")
    with _transaction(spark, url, properties) as db:
        found = _first(db, f"SELECT staging, n_rows FROM {ledger} WHERE batch_id = ?", batch_id)
    if found and _exists(spark, url, properties, found[0]):  # of a run that died
        with _transaction(spark, url, properties) as db:
            _drop(db, found[0])
    if found and found[1] is not None and not reopen:
        return int(found[1])
    with _transaction(spark, url, properties) as db:
        if found:
            _run(db, f"UPDATE {ledger} SET staging = ?, n_rows = NULL WHERE batch_id = ?", staging, batch_id)
        else:
            _run(db, f"INSERT INTO {ledger} (batch_id, staging) VALUES (?, ?)", batch_id, staging)
    return None


def _move(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], batch_id: str, staging: str,
          columns: list[str], rows: int, replace: bool) -> None:
    """One transaction: close the batch, then put one attempt per partition into the target."""
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    part, attempt = map(quote, _own_columns(columns))
    named = {c.lower(): c for c in jdbc_scan(spark, url, table, properties).columns}
    missing = [c for c in columns if c.lower() not in named]
    if missing:
        raise ValueError(f"{table} has no column {missing}")
    into, taken = ", ".join(quote(named[c.lower()]) for c in columns), ", ".join(f"s.{quote(c)}" for c in columns)
    with _transaction(spark, url, properties) as db:
        closed = _run(db, f"UPDATE {table}_batches SET n_rows = {rows} "
                          "WHERE batch_id = ? AND staging = ? AND n_rows IS NULL", batch_id, staging)
        if closed != 1:
            raise RuntimeError(f"another run has taken over batch {batch_id!r} of {table}")
        if replace:
            _run(db, f"DELETE FROM {table}")
        moved = _run(db, f"INSERT INTO {table} ({into}) SELECT {taken} FROM {staging} s JOIN "
                         f"(SELECT {part} AS p, MIN({attempt}) AS a FROM {staging} GROUP BY {part}) m "
                         f"ON s.{part} = m.p AND s.{attempt} = m.a")
        if moved != rows:
            raise RuntimeError(f"{staging} holds {moved} rows of {rows}: the database doesn't commit tasks whole")


def _own_columns(columns: list[str]) -> tuple[str, str]:
    """Names for partition and attempt that no column has."""
    taken = {c.lower() for c in columns}
    end = ""
    while {f"stage_part{end}", f"stage_attempt{end}"} & taken:
        end += "_"
    return f"stage_part{end}", f"stage_attempt{end}"


@contextmanager
def _transaction(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A connection of the driver's whose statements are committed together, or not at all."""
    jvm = spark._jvm
    given = jvm.java.util.Properties()
    for k, v in properties.items():
        if k == "driver":
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(v)
        else:
            given.setProperty(k, v)
    db = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        db.setAutoCommit(False)
        yield db
        db.commit()
    except BaseException:
        db.rollback()
        raise
    finally:
        db.close()


def _prepared(db, sql: str, values: tuple[str, ...]):
    statement = db.prepareStatement(sql)
    for i, v in enumerate(values):
        statement.setString(i + 1, v)
    return statement


def _run(db, sql: str, *values: str) -> int:
    """Run one statement; returns the rows that it has changed."""
    return _prepared(db, sql, values).executeUpdate()


def _first(db, sql: str, *values: str) -> tuple | None:
    found = _prepared(db, sql, values).executeQuery()
    if not found.next():
        return None
    return tuple(found.getObject(i + 1) for i in range(found.getMetaData().getColumnCount()))


def _drop(db, table: str) -> None:
    _run(db, f"DROP TABLE {table}")


def _exists(spark: SparkSession, url: str, properties: Mapping[str, str], table: str) -> bool:
    from py4j.protocol import Py4JJavaError

    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    try:
        with _transaction(spark, url, properties) as db:
            _first(db, dialect.getTableExistsQuery(table))
        return True
    except Py4JJavaError as e:
        if isinstance(e, Py4JJavaError) and e.java_exception.getClass().getName().startswith("java.sql.SQL"):
            return False
        raise
