"""Offer tables derived from the given star-schema tables, and the same derivations in SQL.

The given tables hold no cashback data; these views give every operator rows that grow with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.functions import text as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt to all cores, if the scan has fewer splits than there are cores: a table of one small file is one
    task's work otherwise, however much is done with a row.  A large table is left as it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as history: alias = user, kind = event type, label = k mod 3 (0: none), every 7th id closes."""
    label = F.nullif((F.get_json_object("props", "$.k").cast("long") % 3).cast("string"), F.lit("0"))
    value = F.when(F.col("event_id") % 7 != 0, F.col("value")).cast(T.MONEY)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("alias"),
        F.col("event_type").alias("kind"),
        label.alias("category_label"),
        value.alias("value"),
        F.when(F.col("event_id") % 2 == 0, "percent").otherwise("fixed_eur").alias("unit"),
        F.when((F.col("event_type") == "purchase") & label.isNull(), value).alias("effective_value"),
        F.col("ts").alias("observed_at"),
        F.col("event_id").alias("ordinal"),
    )


HISTORY_SQL = """obs as (
  select user_id as alias, event_type as kind, nullif(cast(cast(json_extract_string(props, '$.k') as bigint) % 3 as varchar), '0') as label,
         case when event_id % 7 <> 0 then cast(value as decimal(10,3)) end as value,
         case when event_id % 2 = 0 then 'percent' else 'fixed_eur' end as unit, ts, event_id as ordinal
  from events)"""


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as aliases: merchant = user mod 40 + 1 (none for every 11th user), platform = user mod 5."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last_checked_at"))
    return users.select(F.col("user_id").alias("alias"), F.when(F.col("user_id") % 11 != 0, F.col("user_id") % 40 + 1).alias("merchant_id"), (F.col("user_id") % 5).cast("int").alias("provider_id"), F.concat(F.lit("u-"), "user_id").alias("raw_slug"), "last_checked_at")


ALIASES_SQL = """al as (
  select user_id as alias, case when user_id % 11 <> 0 then user_id % 40 + 1 end as merchant_id, user_id % 5 as provider_id,
         'u-' || user_id as raw_slug, max(ts) as last_checked_at
  from events group by user_id)"""


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as merchants; every third has a priority, every fourth is published."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        (key + 1).alias("merchant_id"),
        F.concat(F.lit("m-"), key).alias("slug"),
        F.col("s_name").alias("name"),
        F.when(key % 5 != 0, F.concat(F.lit("shop"), key, F.lit(".fr"))).alias("canonical_domain"),
        F.concat(F.lit("n"), "s_nationkey").alias("category"),
        F.when(key % 3 == 0, F.concat(F.lit("P"), (key % 4 + 1).cast("int"))).alias("_p"),
        (key * 10).cast("int").alias("search_volume"),
        (key % 4 == 0).alias("is_published"),
    ).withColumn("priority", F.when(F.col("_p").isin("P1", "P2", "P3"), F.col("_p"))).drop("_p")


MERCHANTS_SQL = """mer as (
  select s_suppkey + 1 as merchant_id, 'm-' || s_suppkey as slug, s_name as name,
         case when s_suppkey % 5 <> 0 then 'shop' || s_suppkey || '.fr' end as canonical_domain, 'n' || s_nationkey as category,
         case when s_suppkey % 3 = 0 and s_suppkey % 4 < 3 then 'P' || (s_suppkey % 4 + 1) end as priority,
         s_suppkey * 10 as search_volume, s_suppkey % 4 = 0 as is_published
  from supplier)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of events by platform (user mod 5) as runs; error events above a third of the day are errors."""
    events = table(spark, sf_dir, "events").withColumn("provider_id", F.col("user_id") % 5).withColumn("day", F.to_date("ts"))
    per = events.groupBy("provider_id", "day").agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"), F.count("*").alias("urls_fetched"), F.count_if((F.col("event_type") == "error") & (F.col("value") > 150)).alias("errors_count"), F.count_if(F.col("event_type") == "purchase").alias("offers_found"), F.count_if((F.col("event_type") == "view") & (F.col("value") < 5)).alias("pages_empty"))
    return per.withColumn("run_id", F.col("provider_id") + 5 * F.datediff("day", F.lit("2020-01-01").cast("date")))


RUNS_SQL = """run as (
  select user_id % 5 as provider_id, cast(ts as date) as day, min(ts) as started_at, max(ts) as finished_at, count(*) as urls_fetched,
         count(*) filter (event_type = 'error' and value > 150) as errors_count, count(*) filter (event_type = 'purchase') as offers_found,
         count(*) filter (event_type = 'view' and value < 5) as pages_empty,
         user_id % 5 + 5 * date_diff('day', date '2020-01-01', cast(ts as date)) as run_id
  from events group by user_id % 5, cast(ts as date))"""


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
