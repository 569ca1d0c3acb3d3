"""Tables of another database, read in parallel ranges. The driver jar must be on the classpath."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# JDBC address prefix and driver class per kind of database.
DRIVERS = {
    "sqlite": ("jdbc:sqlite:", "org.sqlite.JDBC"),
    "postgres": ("jdbc:postgresql://", "org.postgresql.Driver"),
    "mysql": ("jdbc:mysql://", "com.mysql.cj.jdbc.Driver"),
}


def jdbc_options(kind: str, address: str, table: str) -> dict[str, str]:
    """Connection options; ``address`` is what follows the prefix of the kind."""
    prefix, driver = DRIVERS[kind]
    return {"url": prefix + address, "driver": driver, "dbtable": table}


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    partition_column: str | None = None,
    partitions: int = 32,
    bounds: tuple[object, object] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table, in ``partitions`` ranges of ``partition_column`` that are fetched independently.

    The bounds only place the cuts, they filter nothing: rows outside go to the first or last range,
    NULLs to the first. Without them the database is asked for the column's range.
    """
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", fetch_size)
    if partition_column is None:
        return reader.load()
    if bounds is None:
        edges = dict(options)
        table = edges.pop("dbtable")
        query = f"SELECT MIN({partition_column}) AS low, MAX({partition_column}) AS high FROM {table}"
        row = spark.read.format("jdbc").options(**edges).option("query", query).load().head()
        if row[0] is None:
            return reader.load()
        bounds = (row[0], row[1])
    return (
        reader.option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", partitions)
        .load()
    )


def attach_jdbc(
    spark: SparkSession,
    kind: str,
    address: str,
    tables: Iterable[str] | Mapping[str, str | None],
    alias: str = "ext_source",
    partitions: int = 32,
) -> None:
    """Makes tables of a database readable as views ``alias_table``.

    A mapping names each table's partition column (or None); such tables are read in ``partitions`` ranges.
    """
    columns = tables if isinstance(tables, Mapping) else dict.fromkeys(tables)
    for table, column in columns.items():
        view = f"{alias}_{table.replace('.', '_')}"
        df = read_jdbc(spark, jdbc_options(kind, address, table), column, partitions)
        df.createOrReplaceTempView(view)
