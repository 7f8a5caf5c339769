"""JDBC sources: full table scan (parallel when bounds are known) and pushed-down subquery."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10000,
) -> DataFrame:
    """Scan a table. With a numeric ``partition_column`` and bounds the read is
    split into ``num_partitions`` range queries run by parallel tasks."""
    props = dict(properties)
    props.setdefault("fetchsize", str(fetchsize))
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=props,
    )


def jdbc_subquery_scan(spark: SparkSession, url: str, sql: str, properties: Mapping[str, str],
                       alias: str = "q") -> DataFrame:
    """Run ``sql`` inside the database (sort, limit, ...) and read its result."""
    return spark.read.jdbc(url, f"({sql}) {alias}", properties=dict(properties))


def jdbc_parallel_scan(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
                       partition_column: str, num_partitions: int, fetchsize: int = 10000) -> DataFrame:
    """Parallel scan without known bounds: one pushed-down ``MIN/MAX`` query
    (a single row) gives the range, then ``num_partitions`` range queries
    read the table in parallel. An empty table is read as one partition.
    The column is quoted as written (standard SQL quoting), like Spark does
    in its own range queries."""
    col = _quoted(partition_column)
    bounds = jdbc_subquery_scan(
        spark, url, f"SELECT MIN({col}) AS LO, MAX({col}) AS HI FROM {table}", properties
    ).first()
    if bounds is None or bounds["LO"] is None:
        return jdbc_scan(spark, url, table, properties, fetchsize=fetchsize)
    return jdbc_scan(spark, url, table, properties, partition_column, int(bounds["LO"]), int(bounds["HI"]) + 1,
                     num_partitions, fetchsize)


def depth_bounds(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], partition_column: str,
                 num_partitions: int) -> list[int]:
    """Inner bounds of at most ``num_partitions`` ranges with about equal numbers of rows, ascending.

    A histogram of ``32 * num_partitions`` equal-width bins is counted inside
    the database. Bins that hold more than a quarter of a range's share are
    counted anew at that resolution, until they are light or one value wide.
    At most ``4 * num_partitions`` bins can be that heavy, so a query's result
    and what comes to the driver don't grow with the table.
    """
    col, bins = _quoted(partition_column), 32 * num_partitions
    low, high, total = jdbc_subquery_scan(
        spark, url, f"SELECT MIN({col}) AS LO, MAX({col}) AS HI, COUNT({col}) AS N FROM {table}", properties
    ).first()
    if low is None:
        return []
    edges: dict[int, int] = {}  # first value of a bin -> rows
    heavy = [(int(low), int(high))]
    while heavy:
        width = max(-(-(b - a + 1) // bins) for a, b in heavy)
        kept = " OR ".join(f"({col} BETWEEN {a} AND {b})" for a, b in heavy)
        counted = jdbc_subquery_scan(
            spark, url,
            f"SELECT B, COUNT(*) AS N FROM (SELECT FLOOR(({col} - {int(low)}) / {width}) AS B FROM {table} WHERE {kept}) h GROUP BY B",
            properties,
        ).collect()
        fresh = {int(low) + int(r["B"]) * width: int(r["N"]) for r in counted}
        for a, b in heavy:
            edges = {e: n for e, n in edges.items() if not a <= e <= b}
        edges.update(fresh)
        heavy = [(a, a + width - 1) for a, n in sorted(fresh.items()) if width > 1 and 4 * num_partitions * n > total]
    bounds, before = [], 0
    for start, n in sorted(edges.items()):
        if before * num_partitions >= total * (len(bounds) + 1):
            bounds.append(start)
        before += n
    return bounds


def jdbc_equi_depth_scan(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
                         partition_column: str, num_partitions: int, fetchsize: int = 10000) -> DataFrame:
    """Parallel scan by ranges of about equal numbers of rows, for ids that are sparse or bunched.

    Rows of a NULL in the column are read by the first task. A value that alone
    holds many rows isn't split. Rows that come in between the count and the
    read are read too: the outer ranges are open.
    """
    col = _quoted(partition_column)
    bounds = depth_bounds(spark, url, table, properties, partition_column, num_partitions)
    if not bounds:
        return jdbc_scan(spark, url, table, properties, fetchsize=fetchsize)
    ranges = [f"{col} < {bounds[0]} OR {col} IS NULL"]
    ranges += [f"{col} >= {a} AND {col} < {b}" for a, b in zip(bounds, bounds[1:])]
    ranges.append(f"{col} >= {bounds[-1]}")
    props = dict(properties)
    props.setdefault("fetchsize", str(fetchsize))
    return spark.read.jdbc(url, table, predicates=ranges, properties=props)


def _quoted(column: str) -> str:
    return column if column.startswith('"') else f'"{column}"'
