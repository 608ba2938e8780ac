"""Reading the tables, and lineage cuts in the folder that all machines of a cluster share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.operators.graph import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: df as a Parquet table in the shared folder, read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table that written() made.  Only once all that was made of it is in tables of its own: a lost
    executor would ask for it again."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries that are over: it does so when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id (long) and the text (null: empty), whatever else the table carries."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
