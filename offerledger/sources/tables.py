"""Stored pages, the relational tables, and appends to the history and the review queue."""

from __future__ import annotations

from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.sources.parts import PartTable


def read_pages(spark: SparkSession, path: str, provider: str | None = None) -> DataFrame:
    """Stored pages (provider, raw_slug, url, html, observed_at), of one platform on request."""
    pages = spark.read.parquet(path)
    return pages.where(F.col("provider") == provider) if provider else pages


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One page a file: its name and whole text."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("html"))


def history_table(path: str, schema: str) -> PartTable:
    """A history in parts by day."""
    return PartTable(path, schema)


def append_history(rows: DataFrame, table: PartTable, batch: int) -> None:
    """Append history rows, clustered by their day; nothing is ever rewritten, and a batch run again adds nothing."""
    table.append(rows, F.date_format("observed_at", "yyyy-MM-dd"), batch)


def append_reviews(items: DataFrame, path: str) -> None:
    items.write.mode("append").parquet(path)


def read_table(spark: SparkSession, location: str, table: str, split: tuple[str, int] | None = None, **jdbc: str) -> DataFrame:
    """A relational table: Parquet under location, or over JDBC where location is a jdbc: address.

    split: a column of whole numbers and a number of parts; each part is read over a connection of its own, between
    bounds that one query asks for.
    """
    if not location.startswith("jdbc:"):
        return spark.read.parquet(f"{location}/{table}.parquet")
    loaded = lambda **options: spark.read.format("jdbc").options(url=location, **jdbc, **options).load()
    if split is None:
        return loaded(dbtable=table)
    column, parts = split
    low, high = loaded(query=f"select min({column}) as low, max({column}) as high from {table}").first()
    if low is None:
        return loaded(dbtable=table)
    return loaded(dbtable=table, partitionColumn=column, lowerBound=int(low), upperBound=int(high) + 1, numPartitions=parts)


def write_table(df: DataFrame, location: str, table: str, **jdbc: str) -> None:
    """The whole table anew."""
    if location.startswith("jdbc:"):
        df.write.format("jdbc").options(url=location, dbtable=table, **jdbc).mode("overwrite").save()
    else:
        df.write.mode("overwrite").parquet(f"{location}/{table}.parquet")


def upsert_table(df: DataFrame, location: str, table: str, key: list[str], **jdbc: str) -> None:
    """Rows of df update those of equal key and are added where there are none; all rows in one statement.

    df is written to a staging table of the table's own types, by as many connections as it has partitions, and merged by the
    database in a transaction of its own; a run that is repeated stages the rows anew and leaves the same table.  df has
    all columns of the table, and a key's row once.
    """
    spark, staging = df.sparkSession, f"{table}_staged"
    with suppress(Py4JJavaError):  # it is there only after a failure
        execute(spark, location, f"drop table {staging}", **jdbc)
    execute(spark, location, f"create table {staging} as select * from {table} with no data", **jdbc)
    df.write.format("jdbc").options(url=location, dbtable=staging, **jdbc).mode("append").save()
    rest = [c for c in df.columns if c not in key]
    same = " and ".join(f"t.{c} = s.{c}" for c in key)
    matched = f" when matched then update set {', '.join(f'{c} = s.{c}' for c in rest)}" if rest else ""
    statement = f"merge into {table} t using {staging} s on {same}{matched} when not matched then insert ({', '.join(df.columns)}) values ({', '.join(f's.{c}' for c in df.columns)})"
    execute(spark, location, statement, f"drop table {staging}", **jdbc)


def execute(spark: SparkSession, location: str, *statements: str, **jdbc: str) -> None:
    """Statements that the database runs itself, in one transaction."""
    properties = spark._jvm.java.util.Properties()
    for k, v in jdbc.items():
        properties.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(location, properties)
    try:
        connection.setAutoCommit(False)
        each = connection.createStatement()
        for s in statements:
            each.executeUpdate(s)
        connection.commit()
    finally:
        connection.rollback()
        connection.close()
