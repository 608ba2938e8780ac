"""Current offers, coverage, freshness, publication and rankings, derived from history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerledger.operators.history import latest


def offer_current_all(history: DataFrame, aliases: DataFrame) -> DataFrame:
    """Last row of each (alias, kind, label) that is not a closure, with the alias's merchant and check time.

    Closures go after the last row is taken: before, they would bring old rates back.
    """
    mine = aliases.select("alias", "merchant_id", "provider_id", "last_checked_at")
    return latest(history).where(F.col("value").isNotNull()).join(mine, "alias")


def offer_current(current_all: DataFrame) -> DataFrame:
    """The purchase offer without a label of each alias; a cut of offer_current_all, no second pass."""
    return current_all.where((F.col("kind") == "purchase") & F.col("category_label").isNull())


def merchant_coverage(merchants: DataFrame, current: DataFrame, current_all: DataFrame) -> DataFrame:
    """Every merchant: platforms, best value (mixed and per unit), oldest times and number of offers.

    Both sides are aggregated before they are joined, so nothing fans out.
    """
    best = lambda unit: F.max(F.when(F.col("unit") == unit, F.col("effective_value")))
    main = current.groupBy("merchant_id").agg(
        F.countDistinct("provider_id").alias("n_platforms"),
        F.max("effective_value").alias("best_value"),
        best("percent").alias("best_percent"),
        best("fixed_eur").alias("best_fixed_eur"),
        F.min("observed_at").alias("oldest_collected_at"),
        F.min("last_checked_at").alias("oldest_checked_at"),
    )
    every = current_all.groupBy("merchant_id").agg(F.count("*").alias("n_offers"))
    joined = merchants.join(main, "merchant_id", "left").join(every, "merchant_id", "left")
    return joined.withColumn("n_platforms", F.coalesce("n_platforms", F.lit(0))).withColumn("n_offers", F.coalesce("n_offers", F.lit(0)))


def stale(coverage: DataFrame, as_of, hours: int = 48) -> DataFrame:
    """Merchants with an offer that was not checked for more than so many hours before as_of."""
    return coverage.where(F.col("oldest_checked_at") < F.lit(as_of) - F.expr(f"interval {hours} hours"))


def publish(merchants: DataFrame, current_all: DataFrame) -> DataFrame:
    """is_published becomes true with any current offer and never false; newly_published marks the change."""
    hits = current_all.where("merchant_id is not null").select("merchant_id").distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False))
    return merchants.join(hits, "merchant_id", "left").withColumn("newly_published", hit & ~F.col("is_published")).withColumn("is_published", hit | F.col("is_published")).drop("_hit")


def ranking(current: DataFrame, k: int, by: tuple[str, ...] = ("unit",), salt: int = 32, tie: str = "alias") -> DataFrame:
    """The k best effective values within each unit (or merchant and unit).

    There are few units, so rows are cut to k within each of `salt` parts of a unit first.
    """
    order = [F.col("effective_value").desc_nulls_last(), F.col(tie)]
    part = current.where(F.col("effective_value").isNotNull()).withColumn("_part", F.pmod(F.xxhash64(tie), F.lit(salt)))
    cut = part.withColumn("_n", F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))).where(F.col("_n") <= k)
    return cut.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k).drop("_n", "_part")


def refresh(history: DataFrame, aliases: DataFrame, merchants: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """offer_current_all, offer_current and the published merchants, in that order."""
    every = offer_current_all(history, aliases)
    return every, offer_current(every), publish(merchants, every)
