"""SQL sources: one SQL text (or several, or one split into ranges) read as a DataFrame.

A *source* is either a JDBC database (URL + properties; Postgres, MySQL, SQL
Server, Oracle, SQLite, Trino … whichever drivers are on the classpath) or a
set of parquet tables attached to the Spark catalog under one database name.
The same ``read_sql`` call serves both; for JDBC every part is one task with
its own connection on an executor, for catalog sources Catalyst plans the SQL.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import parse_qsl, quote, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partition import (check_numeric, partition_assign, plan_ranges,
                                   range_predicates, validate_num)
from ..operators.setops import union_parts
from .fs import _fs_and_path, path_exists

# URL schemes and the JDBC scheme/driver each one maps to.
JDBC_SCHEMES = {
    "postgresql": ("postgresql", "org.postgresql.Driver"),
    "postgres": ("postgresql", "org.postgresql.Driver"),
    "redshift": ("postgresql", "org.postgresql.Driver"),
    "mysql": ("mysql", "com.mysql.cj.jdbc.Driver"),
    "mariadb": ("mariadb", "org.mariadb.jdbc.Driver"),
    "clickhouse": ("clickhouse", "com.clickhouse.jdbc.ClickHouseDriver"),
    "mssql": ("sqlserver", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
    "sqlite": ("sqlite", "org.sqlite.JDBC"),
    "oracle": ("oracle:thin", "oracle.jdbc.OracleDriver"),
    "trino": ("trino", "io.trino.jdbc.TrinoDriver"),
}

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")

# Rows per JDBC fetch unless the caller sets ``fetchsize``: drivers that default to
# 0 (Postgres) would otherwise hold a task's whole result in memory.
DEFAULT_FETCH_ROWS = 10_000


def check_identifier(name: str) -> str:
    """Allow only ``[A-Za-z0-9_]`` names (each part of a dotted name) into DDL/SQL text."""
    for part in name.split("."):
        if not _IDENT.match(part):
            raise ValueError(f"illegal table name {name!r}")
    return name


@dataclass(frozen=True)
class JdbcSource:
    """A database reached through JDBC. ``properties`` go to the driver as-is
    (``user``, ``password``, ``driver``, ``fetchsize``, ``sessionInitStatement`` …)."""

    url: str
    properties: dict = field(default_factory=dict)

    def read_properties(self) -> dict:
        props = {"fetchsize": str(DEFAULT_FETCH_ROWS)}
        props.update({k: str(v) for k, v in self.properties.items()})
        return props

    def reader(self, spark: SparkSession):
        r = spark.read.format("jdbc").option("url", self.url)
        for k, v in self.read_properties().items():
            r = r.option(k, v)
        return r

    def query(self, spark: SparkSession, sql: str, prepare: str | None = None) -> DataFrame:
        """Run ``sql`` in the database. ``prepare`` is the text that must stand before the query Spark
        builds around it, such as a WITH clause (not every database takes one inside a derived table)."""
        r = self.reader(spark)
        if prepare:
            r = r.option("prepareQuery", prepare)
        return r.option("dbtable", f"({sql}) tablehaul_q").load()

    def query_parts(self, spark: SparkSession, sql: str, predicates: list[str],
                    prepare: str | None = None) -> DataFrame:
        props = self.read_properties()
        if prepare:
            props["prepareQuery"] = prepare
        return spark.read.jdbc(self.url, f"({sql}) tablehaul_part", predicates=predicates,
                               properties=props)

    def has_table(self, spark: SparkSession, name: str) -> bool:
        """Ask the database's metadata for a table, in any of the cases databases fold names to."""
        *schema, table = check_identifier(name).split(".")
        jvm = spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for k, v in self.properties.items():
            properties.setProperty(k, str(v))
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            metadata = connection.getMetaData()
            for fold in (str, str.lower, str.upper):
                pattern = fold(table).replace("_", metadata.getSearchStringEscape() + "_")
                if metadata.getTables(None, fold(schema[-1]) if schema else None, pattern, None).next():
                    return True
            return False
        finally:
            connection.close()

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return self.reader(spark).option("dbtable", check_identifier(name)).load()


@dataclass(frozen=True)
class FormatSource:
    """A source reached through any Spark data source that takes a ``query`` option (BigQuery's
    connector, for one). ``options`` go to the reader as they are."""

    format: str
    options: dict = field(default_factory=dict)

    def query(self, spark: SparkSession, sql: str, prepare: str | None = None) -> DataFrame:
        r = spark.read.format(self.format)
        for k, v in self.options.items():
            r = r.option(k, str(v))
        return r.option("query", f"{prepare}\n{sql}" if prepare else sql).load()


def _bare(location: str) -> str:
    """A location without the ways of writing a local path's scheme."""
    return re.sub(r"^file:/+", "/", location).rstrip("/")


@dataclass(frozen=True)
class CatalogSource:
    """Parquet tables attached to the Spark catalog as database ``database``.

    ``tables`` maps table name -> parquet path. Attaching registers external
    tables (metadata only, the files stay where they are).
    """

    database: str
    tables: dict

    def attach(self, spark: SparkSession) -> "CatalogSource":
        db = check_identifier(self.database)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        for name, path in self.tables.items():
            check_identifier(name)
            # A persistent catalog may still point the name to where an earlier source lay.
            if spark.catalog.tableExists(f"{db}.{name}") and not self._lies_at(spark, name, path):
                spark.sql(f"DROP TABLE {db}.{name}")  # external: its files stay
            # A table target not written yet has no files; it is registered by its first write.
            if not spark.catalog.tableExists(f"{db}.{name}") and path_exists(spark, path):
                spark.catalog.createTable(f"{db}.{name}", path=path, source="parquet")
        return self

    def _lies_at(self, spark: SparkSession, name: str, path: str) -> bool:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {self.database}.{name}").collect()
        found = next((r["data_type"] for r in rows if r["col_name"] == "Location"), None)
        _, wanted = _fs_and_path(spark, path)
        return found is not None and _bare(found) == _bare(str(wanted.toUri().toString()))

    def query(self, spark: SparkSession, sql: str, prepare: str | None = None) -> DataFrame:
        """Analyse ``sql`` with this source's database as the current one.

        Names resolve during ``spark.sql`` (eagerly), after which the previous
        current database is restored. Threads that share one session and build
        queries at the same moment should qualify table names instead.
        """
        self.attach(spark)
        previous = spark.catalog.currentDatabase()
        spark.catalog.setCurrentDatabase(self.database)
        try:
            # names resolve now, against this database
            return spark.sql(f"{prepare}\n{sql}" if prepare else sql)
        finally:
            spark.catalog.setCurrentDatabase(previous)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        self.attach(spark)
        return spark.table(f"{self.database}.{check_identifier(name)}")


def parquet_dir_source(spark: SparkSession, directory: str, names: Sequence[str] | None = None,
                       database: str | None = None) -> CatalogSource:
    """A catalog source over ``<directory>/<name>.parquet`` files."""
    directory = directory.rstrip("/")
    if names is None:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(directory)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = sorted(s.getPath().getName()[: -len(".parquet")] for s in fs.listStatus(p)
                       if s.getPath().getName().endswith(".parquet"))
    if database is None:
        database = "th_" + hashlib.sha1(directory.encode()).hexdigest()[:10]
    return CatalogSource(database, {n: f"{directory}/{n}.parquet" for n in names}).attach(spark)


def parse_url(conn: str) -> tuple[str, dict]:
    """A connection URL as its driver's JDBC URL, and the properties that don't belong in one.

    ``scheme://user:password@host:port/database?option=value``: user and password are percent-decoded
    into properties (never left in the URL, where they would show in plans and logs), with the driver
    class. The database and the options take each driver's form. ``jdbc:`` URLs pass through.
    """
    if conn.startswith("jdbc:"):
        return conn, {}
    scheme = conn.split(":", 1)[0]
    if "://" not in conn or scheme not in JDBC_SCHEMES:
        raise ValueError(f"unsupported source URL {conn!r}")
    jdbc_scheme, driver = JDBC_SCHEMES[scheme]
    props = {"driver": driver}
    if jdbc_scheme == "sqlite":
        return f"jdbc:sqlite:{unquote(conn.split('://', 1)[1])}", props
    url = urlsplit(conn)
    login, _, host = url.netloc.rpartition("@")
    if login:
        user, colon, password = login.partition(":")
        props["user"] = unquote(user)
        if colon:
            props["password"] = unquote(password)
    database = unquote(url.path.lstrip("/"))
    options = parse_qsl(url.query, keep_blank_values=True)
    if jdbc_scheme == "sqlserver":
        settings = ([("databaseName", database)] if database else []) + options
        return f"jdbc:sqlserver://{host}" + "".join(f";{k}={{{v}}}" if re.search(r"[;{}]", v) else f";{k}={v}"
                                                    for k, v in settings), props
    if jdbc_scheme == "oracle:thin":
        props.update(options)  # the thin driver takes options as properties
        return f"jdbc:oracle:thin:@//{host}/{database}", props
    query = "&".join(f"{quote(k)}={quote(v)}" for k, v in options)
    return f"jdbc:{jdbc_scheme}://{host}/{quote(database)}" + (f"?{query}" if query else ""), props


def jdbc_source(conn: str, properties: dict | None = None) -> JdbcSource:
    """The source of a connection URL; given properties win over those of the URL."""
    url, props = parse_url(conn)
    return JdbcSource(url, {**props, **(properties or {})})


def is_database_url(conn: str) -> bool:
    """``jdbc:…`` or a known database scheme; every other path is a file system."""
    m = re.match(r"^([a-z][a-z0-9+.-]*)://", conn)
    return conn.startswith("jdbc:") or bool(m and m.group(1) in JDBC_SCHEMES)


def as_source(spark: SparkSession, conn) -> JdbcSource | CatalogSource | FormatSource:
    if isinstance(conn, (JdbcSource, CatalogSource, FormatSource)):
        return conn
    if isinstance(conn, dict) and "format" in conn:
        return FormatSource(conn["format"], dict(conn.get("options", {})))
    if isinstance(conn, dict):
        return jdbc_source(conn["url"], conn.get("properties"))
    if isinstance(conn, str) and is_database_url(conn):
        return jdbc_source(conn)
    return parquet_dir_source(spark, conn)


def partition_bounds_sql(source, spark: SparkSession, sql: str, column: str,
                         prepare: str | None = None) -> tuple[int, int]:
    """MIN/MAX of ``column`` over the user's SQL, evaluated in the database; NULL -> 0.

    Fractional bounds become integers: the minimum by floor (so no row below the
    first range is lost), the maximum by floor too (``max + 1`` stays above it).
    """
    check_identifier(column)
    probe = (f"SELECT MIN({column}) AS lo, MAX({column}) AS hi "
             f"FROM ({sql}) tablehaul_bounds")
    row = source.query(spark, probe, prepare).select(
        F.coalesce(F.floor(F.col("lo")).cast("bigint"), F.lit(0)).alias("lo"),
        F.coalesce(F.floor(F.col("hi")).cast("bigint"), F.lit(0)).alias("hi")).first()
    return int(row["lo"]), int(row["hi"])


def read_sql(spark: SparkSession, conn, sql: str | Sequence[str], partition_on: str | None = None,
             partition_range: tuple[int, int] | None = None, partition_num: int | None = None,
             keep_nulls: bool = False, pre_execution_query: str | None = None,
             schema_only: bool = False, prepare_query: str | None = None,
             part_col: str | None = None, deal: bool = False) -> DataFrame:
    """Run SQL on a source and return a DataFrame.

    * one SQL text -> one read;
    * a list of SQL texts -> their bag union (schema of the first);
    * ``partition_on`` + ``partition_num`` -> the SQL split into half-open ranges
      of that numeric column (bounds probed with MIN/MAX unless
      ``partition_range`` is given). A database gets one query per part, each
      over its own connection, so part i is task i. Any other source is read
      once, in as many tasks as its files give, with the rows of the ranges as
      a pushed filter and the part as a label (``part_col`` names a column for
      it); only ``deal=True`` shuffles the rows so that part i is task i.
      Rows whose column is NULL or outside the ranges are not read, unless
      ``keep_nulls`` adds a ``column IS NULL`` part.

    ``prepare_query`` is text to stand before the whole statement, such as a WITH clause.
    """
    source = as_source(spark, conn)
    if pre_execution_query and isinstance(source, JdbcSource):
        source = JdbcSource(source.url, {**source.properties,
                                         "sessionInitStatement": pre_execution_query})
    if not isinstance(sql, str):
        if partition_on:
            raise ValueError("give one SQL text to partition, or a list without partition_on")
        sqls = list(sql)
        if not sqls:
            raise ValueError("no SQL given")
        parts = [source.query(spark, s, prepare_query) for s in sqls]
        # Positional bag union: every part takes the first part's column names.
        return parts[0].limit(0) if schema_only else union_parts(parts)
    if schema_only:
        return source.query(spark, sql, prepare_query).limit(0)
    if not partition_on:
        return source.query(spark, sql, prepare_query)

    n = validate_num(partition_num)
    check_identifier(partition_on)
    if partition_range is not None and (len(partition_range) != 2 or None in partition_range):
        raise ValueError("partition_range needs both a lower and an upper bound")
    if isinstance(source, JdbcSource):
        if partition_range is None:
            lo, hi = partition_bounds_sql(source, spark, sql, partition_on, prepare_query)
        else:
            lo, hi = int(partition_range[0]), int(partition_range[1])
        preds = range_predicates(partition_on, plan_ranges(lo, hi, n), keep_nulls)
        return source.query_parts(spark, sql, preds, prepare_query)
    df = source.query(spark, sql, prepare_query)
    check_numeric(df, partition_on)
    label = part_col or "__tablehaul_part"
    parts = partition_assign(df, partition_on, n, partition_range, keep_nulls, label)
    if deal:
        parts = parts.repartitionById(n + (1 if keep_nulls else 0), F.col(label))
    return parts if part_col else parts.drop(label)
