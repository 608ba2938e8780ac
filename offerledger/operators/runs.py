"""Run metrics: totals, status, drift against the last good run, and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DRIFT_ALARM = 0.20


def totals(pages: DataFrame, offers_read: DataFrame, rows_written: DataFrame) -> DataFrame:
    """One row per run: pages read, errors, pages without offers, offers found and rows written (closures too)."""
    per_page = pages.groupBy("run_id").agg(F.count("*").alias("urls_fetched"), F.count_if(F.col("error").isNotNull()).alias("errors_count"), F.count_if(F.col("error").isNull() & (F.col("n_offers") == 0)).alias("pages_empty"))
    found = offers_read.groupBy("run_id").agg(F.count("*").alias("offers_found"))
    written = rows_written.groupBy("run_id").agg(F.count("*").alias("offers_written"))
    joined = per_page.join(found, "run_id", "left").join(written, "run_id", "left")
    return joined.na.fill(0, ["offers_found", "offers_written"])


def status(errors: Column, offers: Column) -> Column:
    return F.when(errors == 0, "ok").when(offers > 0, "partial").otherwise("failed")


def previous_offers(runs: DataFrame) -> DataFrame:
    """offers_found of the platform's last successful run that had ended before this one began.

    Starts and ends are events of one time line, so overlapping runs are told right.
    """
    starts = runs.select("provider_id", "run_id", F.col("started_at").alias("at"), F.lit(1).alias("is_start"), F.lit(None).cast("long").alias("found"))
    ends = runs.where("status = 'ok'").select("provider_id", "run_id", F.col("finished_at").alias("at"), F.lit(0).alias("is_start"), F.col("offers_found").cast("long").alias("found"))
    line = Window.partitionBy("provider_id").orderBy("at", "is_start", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    known = starts.unionByName(ends).withColumn("previous", F.last("found", ignorenulls=True).over(line)).where("is_start = 1")
    return runs.join(known.select("run_id", "previous"), "run_id", "left")


def drift(runs: DataFrame) -> DataFrame:
    """drift, is_drift and a note; runs: previous_offers' result with pages_empty."""
    share = F.when(F.col("previous") > 0, F.abs(F.col("offers_found") - F.col("previous")) / F.col("previous"))
    out = runs.withColumn("drift", share).withColumn("is_drift", F.coalesce(share > DRIFT_ALARM, F.lit(False)))
    change = F.when(F.col("is_drift"), F.concat_ws("", F.lit("offers "), F.col("previous"), F.lit(" -> "), F.col("offers_found")))
    empty = F.when(F.col("pages_empty") > 0, F.concat_ws("", F.col("pages_empty"), F.lit(" pages without offers")))
    return out.withColumn("notes", F.nullif(F.concat_ws(" ; ", change, empty), F.lit("")))


def latest_runs(runs: DataFrame, providers: DataFrame, n: int = 15) -> DataFrame:
    return runs.join(providers.select("provider_id", "slug"), "provider_id").orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def listing_preview(listing: DataFrame, n: int) -> DataFrame:
    """The first n of a listing, with its length in every row."""
    count = listing.groupBy("provider").agg(F.count("*").alias("n_listed"))
    return listing.orderBy("ordinal").limit(n).join(count, "provider")


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per match action or per priority."""
    return df.groupBy(column).agg(F.count("*").alias("n"))
