"""One SQL statement over tables that live in different sources.

Each source becomes a name the SQL can qualify tables with (``db1.nation``):

* a parquet directory -> a database of external parquet tables;
* a JDBC URL -> a V2 ``JDBCTableCatalog`` named after the source (filters,
  aggregates and limits are pushed into the database by Spark);
* ``{"url": …, "tables": [...], "views": {name: sql}, "properties": {...}}`` -> a
  database whose tables are JDBC relations; each view's SQL runs inside its
  database (joins between tables of one source stay there — the pushdown
  strategy), the rest of the statement runs in Spark. ``"ranges": {name:
  {"column": …, "lower": …, "upper": …, "num": …}}`` reads a table or view over
  so many connections and tasks; without it each is one.

A relation's options, login included, are kept by the session's catalog. That is
memory only by default; with a persistent metastore a source with a password is
refused (register it without tables or views: a V2 catalog keeps nothing).

The cross-source part (joins, aggregates) is planned by Catalyst and executed
distributed; nothing is collected in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.sql import (CatalogSource, JdbcSource, check_identifier, is_database_url, jdbc_source,
                           parquet_dir_source)

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def _sql_string(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_source(spark: SparkSession, name: str, spec) -> None:
    check_identifier(name)
    if isinstance(spec, CatalogSource):
        spec = spec.tables
    if isinstance(spec, dict) and "path" in spec:  # parquet directory (+ views)
        _replace_database(spark, name)
        parquet_dir_source(spark, spec["path"], spec.get("tables"), database=name)
        for view, sql in spec.get("views", {}).items():
            # unqualified names in the view resolve inside this source only
            previous = spark.catalog.currentDatabase()
            spark.catalog.setCurrentDatabase(name)
            try:
                spark.sql(f"CREATE VIEW {name}.{check_identifier(view)} AS {sql}")
            finally:
                spark.catalog.setCurrentDatabase(previous)
        return
    if isinstance(spec, dict) and "url" not in spec:  # {table: parquet path}
        _replace_database(spark, name)
        CatalogSource(name, dict(spec)).attach(spark)
        return
    if isinstance(spec, JdbcSource):
        spec = {"url": spec.url, "properties": spec.properties}
    if isinstance(spec, str):
        if is_database_url(spec):
            spec = {"url": spec}
        else:
            _replace_database(spark, name)
            parquet_dir_source(spark, spec, database=name)
            return
    remote = jdbc_source(spec["url"], spec.get("properties"))
    tables = list(spec.get("tables", []))
    views = dict(spec.get("views", {}))
    if not tables and not views:
        spark.conf.set(f"spark.sql.catalog.{name}", JDBC_CATALOG)
        spark.conf.set(f"spark.sql.catalog.{name}.url", remote.url)
        for k, v in remote.properties.items():
            spark.conf.set(f"spark.sql.catalog.{name}.{k}", str(v))
        return
    statements = relation_statements(name, remote, tables, views, dict(spec.get("ranges", {})))
    if "password" in remote.properties and spark.conf.get("spark.sql.catalogImplementation") == "hive":
        raise ValueError("a persistent metastore would store the password of this source")
    _replace_database(spark, name)
    for statement in statements:
        spark.sql(statement)


def relation_statements(name: str, remote: JdbcSource, tables: list[str], views: dict[str, str],
                        ranges: dict[str, dict]) -> list[str]:
    """The statements that create a source's JDBC relations, each with its read options."""
    relations = {t: check_identifier(t) for t in tables}
    relations.update({check_identifier(v): f"({sql}) {v}" for v, sql in views.items()})
    shorts = [t.split(".")[-1] for t in relations]
    if len(set(shorts)) < len(shorts):
        raise ValueError(f"tables of one source need different last names: {sorted(relations)}")
    if set(ranges) - set(relations):
        raise KeyError(f"ranges for unknown tables: {sorted(set(ranges) - set(relations))}")
    out = []
    for short, (table, dbtable) in zip(shorts, relations.items()):
        options = {"url": remote.url, "dbtable": dbtable, **remote.read_properties()}
        if table in ranges:
            r = ranges[table]
            options |= {"partitionColumn": check_identifier(r["column"]), "lowerBound": r["lower"],
                        "upperBound": r["upper"], "numPartitions": r["num"]}
        listed = ", ".join(f"{k} {_sql_string(v)}" for k, v in options.items())
        out.append(f"CREATE TABLE {name}.{short} USING jdbc OPTIONS ({listed})")
    return out


OWNER_PROPERTY = "tablehaul.source"


def _owned(spark: SparkSession, name: str) -> bool:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {name}").collect()
    props = " ".join(str(r[1]) for r in rows if str(r[0]).lower().startswith("properties"))
    return OWNER_PROPERTY in props


def _replace_database(spark: SparkSession, name: str) -> None:
    """(Re)create the database a source is registered under. Only databases this
    module created (tagged with a property) are ever dropped; any other
    database of that name is left alone and the registration fails. DataFrames of
    an earlier call keep the relations they were resolved to: the tables are
    external, and dropping them removes names only."""
    if spark.catalog.databaseExists(name):
        if not _owned(spark, name):
            raise ValueError(f"database {name!r} exists and was not created for a source; "
                             f"choose another source name")
        spark.sql(f"DROP DATABASE {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name} WITH DBPROPERTIES ('{OWNER_PROPERTY}' = 'true')")


def federated_sql(spark: SparkSession, sources: dict, sql: str) -> DataFrame:
    """Register every source under its name, then run ``sql`` as one Spark plan."""
    for name, spec in sources.items():
        register_source(spark, name, spec)
    return spark.sql(sql)
