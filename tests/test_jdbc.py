"""Relational tables over JDBC, in the in-memory database that Spark ships with."""

from __future__ import annotations

import uuid

from offerledger.sources import tables as TB
from pyspark.sql import functions as F


def test_round_trip_in_parts_and_repeated_upsert(spark):
    url, driver = f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    first = spark.range(10_000).select(F.col("id").alias("merchant_id"), F.concat(F.lit("m-"), "id").alias("slug"), (F.col("id") % 7).cast("int").alias("volume"))
    TB.execute(spark, url, "create table merchant (merchant_id bigint primary key, slug varchar(40), volume int)", **driver)
    TB.upsert_table(first.repartition(4), url, "merchant", ["merchant_id"], **driver)
    got = TB.read_table(spark, url, "merchant", split=("merchant_id", 4), **driver)
    assert got.rdd.getNumPartitions() == 4
    sizes = [r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 4 and max(sizes) < 3_000
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, first.collect()))
    change = spark.range(9_990, 10_020).select(F.col("id").alias("merchant_id"), F.lit("new").alias("slug"), F.lit(None).cast("int").alias("volume"))
    for _ in range(2):
        TB.upsert_table(change, url, "merchant", ["merchant_id"], **driver)
        rows = {r[0]: (r[1], r[2]) for r in TB.read_table(spark, url, "merchant", **driver).collect()}
        assert len(rows) == 10_020 and rows[9_995] == ("new", None) == rows[10_019] and rows[9_989] == ("m-9989", 9_989 % 7)
    TB.execute(spark, url, "delete from merchant", **driver)
    assert TB.read_table(spark, url, "merchant", split=("merchant_id", 4), **driver).count() == 0


def test_parquet_tables(spark, tmp_path):
    df = spark.range(5)
    TB.write_table(df, str(tmp_path), "t")
    assert TB.read_table(spark, str(tmp_path), "t").count() == 5
