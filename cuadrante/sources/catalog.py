"""Databases and tables of the session catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """Create the database unless it exists."""
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(db)}{where}")


def table_exists(spark: SparkSession, db: str, table: str) -> bool:
    """Whether the table is in the catalog; false when that cannot be told."""
    try:
        return spark.catalog.tableExists(f"{_quoted(db)}.{_quoted(table)}")
    except Exception:
        return False


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Make files at ``path`` a table, unless the name is taken."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} USING {fmt} LOCATION {_text(path)}")


def init_table(spark: SparkSession, db: str, table: str, schema: StructType, path: str, fmt: str = "parquet") -> bool:
    """Create an empty table with its schema; true if it was created now."""
    if table_exists(spark, db, table):
        return False
    spark.createDataFrame([], schema).write.format(fmt).mode("ignore").save(path)
    register_table(spark, f"{db}.{table}", path, fmt)
    return True


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table from the catalog; external files stay where they are."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def catalog_report(spark: SparkSession, db: str | None = None) -> DataFrame:
    """Databases, tables and columns as rows of (kind, database, name, detail)."""
    names = [db] if db else [d.name for d in spark.catalog.listDatabases()]
    rows = []
    for d in names:
        rows.append(("database", d, d, spark.catalog.getDatabase(d).locationUri))
        for t in spark.catalog.listTables(d):
            rows.append(("table", d, t.name, t.tableType))
            if t.isTemporary:
                continue
            for c in spark.catalog.listColumns(f"{_quoted(d)}.{_quoted(t.name)}"):
                rows.append(("column", d, f"{t.name}.{c.name}", c.dataType))
    return spark.createDataFrame(rows, "kind string, database string, name string, detail string")


def health_check(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Try to read each named path: (name, alive, error)."""
    rows = []
    for name, path in paths.items():
        try:
            spark.read.format(fmt).load(path).limit(3).collect()
            rows.append((name, True, None))
        except Exception as error:
            rows.append((name, False, str(error).splitlines()[0]))
    return spark.createDataFrame(rows, "name string, alive boolean, error string")


def first_rows(df: DataFrame, order_by, n: int = 10) -> DataFrame:
    """The first n rows in a stated order, for reports."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[F.col(c) if isinstance(c, str) else c for c in order]).limit(n)
