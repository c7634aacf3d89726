"""JDBC source and sinks (any driver on the classpath; tests use embedded Derby).

Reads split into parallel range queries when a numeric partition column is
given, so one table is not pulled through a single connection; ``equi_depth_ranges`` gives
each query about as many rows, however skewed the column is. Loads are two-phase
(``full_refresh``, ``append``): staging first, then one transaction.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edustar.session import ensure_checkpoint_dir
from edustar.sources.sinks import JDBC_MAX_CONNECTIONS, write_jdbc


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, equi_depth: bool = False) -> DataFrame:
    """Read ``table``; ``equi_depth`` reads ranges of ``partition_column`` that hold about as many rows each. With ``partition_column`` as ``num_partitions`` parallel range
    queries. Missing bounds are fetched first as one MIN/MAX aggregate, so the
    ranges cover the whole table; the database computes it where the dialect
    supports aggregate pushdown, else Spark reads that one column once."""
    if partition_column and (lower is None or upper is None):
        lo, hi = _bounds(spark, url, table, properties, partition_column)
        if lo is None:  # empty table: nothing to split
            partition_column = None
        else:
            lower = lo if lower is None else lower
            upper = hi if upper is None else upper
    if partition_column and equi_depth:
        with connection(spark, url, properties) as conn:
            column = _quoted(conn, next((c for c in _columns(conn, table) if c.lower() == partition_column.lower()), partition_column))
        ranges = equi_depth_ranges(spark, url, table, column, lower, upper, num_partitions or 8, properties)
        return spark.read.jdbc(url, table, predicates=range_predicates(column, ranges), properties=properties)
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions or 8)))
    return r.load()


def _bounds(spark: SparkSession, url: str, table: str, properties: dict | None, column: str):
    """MIN and MAX of ``column`` (one row; pushed to the database where supported)."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("pushDownAggregate", "true"))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    row = r.load().agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return (None, None) if row is None or row["lo"] is None else (int(row["lo"]), int(row["hi"]))


CELLS = 16  # cells of a histogram per range wanted


def _histogram(spark: SparkSession, url: str, table: str, column: str, low: int, width: int, high: int, properties: dict | None) -> list[tuple[int, int]]:
    """(cell, rows) of ``column`` between low and high, counted by the database; at most (high - low) / width + 1 rows come back."""
    inner = f"SELECT ({column} - {low} - MOD({column} - {low}, {width})) / {width} AS c FROM {table} WHERE {column} BETWEEN {low} AND {high}"
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"(SELECT c, COUNT(*) AS n FROM ({inner}) x GROUP BY c) h")
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return sorted((int(c), int(n)) for c, n in r.load().collect())


def equi_depth_ranges(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, properties: dict | None = None) -> list[tuple[int, int]]:
    """Ranges (both ends included) of a whole-number column that hold about as many rows each.

    The database counts cells of equal width; a cell with more than a quarter of a range's rows is counted again in
    finer cells, until it is one value. So no range but one of a single value exceeds 1.25 times the mean, and the
    driver sees a bounded number of counts, however many rows or ids there are.
    """
    cells, leaves, limit = parts * CELLS, [], None
    todo = [(low, high)]
    while todo:
        a, b = todo.pop()
        width = max(1, -(-(b - a + 1) // cells))
        counts = _histogram(spark, url, table, column, a, width, b, properties)
        if limit is None:
            limit = max(1, sum(n for _, n in counts) // (4 * parts))
        for c, n in counts:
            x, y = a + c * width, min(b, a + (c + 1) * width - 1)
            if n > limit and y > x:
                todo.append((x, y))
            else:
                leaves.append((x, y, n))
    leaves.sort()
    total, out, held, start = sum(n for *_, n in leaves), [], 0, low
    for i, (x, y, n) in enumerate(leaves):
        held += n
        if held >= total / parts or i == len(leaves) - 1:
            out.append((start, y))
            held, start = 0, y + 1
    return [*out[:-1], (out[-1][0], high)] if out else [(low, high)]


def range_predicates(column: str, ranges: list[tuple[int, int]]) -> list[str]:
    """A WHERE clause per range: the first takes what lies below and nulls, the last what lies above."""
    out = []
    for i, (a, b) in enumerate(ranges):
        ends = [f"{column} >= {a}"] * (i > 0) + [f"{column} <= {b}"] * (i < len(ranges) - 1)
        own = " AND ".join(ends) or "1 = 1"
        out.append(f"({own}) OR {column} IS NULL" if i == 0 and ends else own)
    return out


FACT = "fact_performance"
DIMENSIONS = ("dim_course", "dim_student", "dim_assessment")


def refresh_steps(names) -> list[tuple[str, str]]:
    """(action, table) of a full refresh under foreign keys: the fact is emptied before the dimensions it points
    at, and loaded after them."""
    dims = [d for d in DIMENSIONS if d in names]
    fact = [FACT] if FACT in names else []
    return [("empty", t) for t in fact + dims[::-1]] + [("load", t) for t in dims + fact]


RUN, PART = "etl_run", "etl_part"
LOAD_TRIES = 3  # of staging the parts that don't have their rows exactly once


def full_refresh(tables: dict[str, DataFrame], url: str, properties: dict | None = None,
                 batchsize: int = 5000, run: str | None = None) -> None:
    """Replace the rows of each warehouse table, keeping its definition (see ``refresh_steps``).

    Two phases. Every table's rows, numbered by part, go to a staging table of its own; parts that a retried or
    speculative task has written twice, or not at all, are found by their counts and staged again. Then one transaction
    empties the tables and fills them from staging, and ends only if every table got exactly its rows. A failure
    anywhere before its end leaves the old rows.
    """
    load(tables, url, properties, batchsize, run, refresh_steps(tables))


def append(df: DataFrame, url: str, table: str, properties: dict | None = None, batchsize: int = 5000, run: str | None = None,
           instead_of: tuple[str, str] | None = None) -> None:
    """Add rows in the same two phases, so that a retried task adds none twice.

    ``instead_of``: a column and an SQL literal; rows that have it go in the same transaction, so that a job run again
    replaces what it has added before.
    """
    load({table: df}, url, properties, batchsize, run, [*([("replace", table, *instead_of)] if instead_of else []), ("load", table)])


def load(tables: dict[str, DataFrame], url: str, properties: dict | None, batchsize: int, run: str | None, steps: list[tuple]) -> None:
    run = run or uuid.uuid4().hex
    spark = next(iter(tables.values())).sparkSession
    staged = {t: Staged(df, url, t, properties, batchsize, run) for t, df in tables.items()}
    for s in staged.values():
        s.stage()
        s.mend()
    with connection(spark, url, properties) as conn:
        switch(conn, staged, steps)


class Staged:
    """A table's rows on their way to the database: written to the shared folder in parts, then to the staging table."""

    def __init__(self, df: DataFrame, url: str, table: str, properties: dict | None, batchsize: int, run: str):
        self.spark, self.url, self.table, self.properties, self.batchsize, self.run = df.sparkSession, url, table, properties, batchsize, run
        self.staging = f"{table}_load"
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/jdbc-{table}-{uuid.uuid4().hex}"
        # the part is data from here on: whatever task copies a row, it carries its part
        df.coalesce(JDBC_MAX_CONNECTIONS).withColumn(PART, F.spark_partition_id()).write.parquet(path)
        self.rows = self.spark.read.schema(df.withColumn(PART, F.spark_partition_id()).schema).parquet(path)
        self.columns = df.columns
        self.expected = {r[PART]: r["n"] for r in self.rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most JDBC_MAX_CONNECTIONS

    def _write(self, rows: DataFrame) -> None:
        write_jdbc(rows.withColumn(RUN, F.lit(self.run)), self.url, self.staging, mode="append", properties=self.properties, batchsize=self.batchsize)

    def stage(self) -> None:
        """Make the table (if there is none) and an empty staging table of its definition; write all rows there."""
        with connection(self.spark, self.url, self.properties) as conn:
            if not _exists(conn, self.table):
                write_jdbc(self.rows.select(*self.columns).limit(0), self.url, self.table, mode="append", properties=self.properties)
            if _exists(conn, self.staging):
                _update(conn, f"DROP TABLE {self.staging}")
            _update(conn, f"CREATE TABLE {self.staging} AS SELECT * FROM {self.table} " + ("WHERE 1 = 0" if ":mysql:" in self.url else "WITH NO DATA"))
            for name, kind in ((RUN, "VARCHAR(64)"), (PART, "INTEGER")):
                _update(conn, f"ALTER TABLE {self.staging} ADD COLUMN {_quoted(conn, name)} {kind}")
            conn.commit()
        self._write(self.rows)

    def wrong(self, conn) -> list[int]:
        """Parts that don't have their rows exactly once. A task writes in one transaction, so a copy is a whole one."""
        run, part = _quoted(conn, RUN), _quoted(conn, PART)
        found = dict(_query(conn, f"SELECT {part}, COUNT(*) FROM {self.staging} WHERE {run} = '{self.run}' GROUP BY {part}"))
        return sorted(p for p in {*found, *self.expected} if found.get(p, 0) != self.expected.get(p, 0))

    def mend(self) -> None:
        """Stage wrong parts anew."""
        for _ in range(LOAD_TRIES):
            with connection(self.spark, self.url, self.properties) as conn:
                wrong = self.wrong(conn)
                if not wrong:
                    return
                _update(conn, f"DELETE FROM {self.staging} WHERE {_quoted(conn, RUN)} = '{self.run}' AND {_quoted(conn, PART)} IN ({', '.join(map(str, wrong))})")
                conn.commit()
            self._write(self.rows.where(F.col(PART).isin(wrong)))
        raise RuntimeError(f"{self.staging}: parts {wrong} could not be staged once in {LOAD_TRIES} tries")


def switch(conn, staged: dict[str, Staged], steps: list[tuple]) -> None:
    """One transaction: empty the tables and fill them from staging; rolled back unless every table gets exactly its rows."""
    try:
        for action, table, *which in steps:
            if action == "empty":  # a referenced table can't be truncated
                _update(conn, f"DELETE FROM {table}")
                continue
            if action == "replace":
                column = next(n for n in _columns(conn, table) if n.lower() == which[0].lower())
                _update(conn, f"DELETE FROM {table} WHERE {_quoted(conn, column)} = {which[1]}")
                continue
            s = staged[table]
            names = [n for n in _columns(conn, table) if n.lower() in {c.lower() for c in s.columns}]
            cols = ", ".join(_quoted(conn, n) for n in names)
            n = _update(conn, f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {s.staging} WHERE {_quoted(conn, RUN)} = '{s.run}'")
            if n != sum(s.expected.values()):
                raise RuntimeError(f"{table}: {n} rows staged, {sum(s.expected.values())} expected")
        for s in staged.values():
            _update(conn, f"DELETE FROM {s.staging} WHERE {_quoted(conn, RUN)} = '{s.run}'")
        conn.commit()
    except BaseException:
        conn.rollback()
        raise


# --- one connection of the driver's, through the driver class that Spark itself uses -----------------

@contextmanager
def connection(spark: SparkSession, url: str, properties: dict | None = None):
    """A connection without autocommit; what isn't committed is rolled back."""
    props = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, v)
    if (properties or {}).get("driver"):
        spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    conn = spark._jvm.java.sql.DriverManager.getConnection(url, props)
    conn.setAutoCommit(False)
    try:
        yield conn
        conn.commit()
    finally:
        conn.rollback()
        conn.close()


def _update(conn, sql: str) -> int:
    s = conn.createStatement()
    try:
        return s.executeUpdate(sql)
    finally:
        s.close()


def _query(conn, sql: str) -> list[tuple]:
    s = conn.createStatement()
    try:
        r, out = s.executeQuery(sql), []
        n = r.getMetaData().getColumnCount()
        while r.next():
            out.append(tuple(r.getObject(i + 1) for i in range(n)))
        return out
    finally:
        s.close()


def _exists(conn, table: str) -> bool:
    return bool(_columns(conn, table))


def _columns(conn, table: str) -> list[str]:
    """Column names as the database has them; none if there is no such table."""
    for name in (table.upper(), table):
        r, out = conn.getMetaData().getColumns(None, None, name, None), []
        while r.next():
            out.append(r.getString("COLUMN_NAME"))
        if out:
            return out
    return []


def _quoted(conn, name: str) -> str:
    q = conn.getMetaData().getIdentifierQuoteString().strip()
    return f"{q}{name}{q}"
