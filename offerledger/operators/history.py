"""Offer history: append-only, written on change, with closures.

A history row has alias, kind, category_label, the compared fields of STATE, observed_at and ordinal
(the tie-break).  A row whose value is null is a closure.  A blank label counts as none.  All keys
begin with the alias, so one exchange by alias serves the whole pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerledger.functions import text as T

KEY = ("alias", "kind", "category_label")
MONEY_FIELDS = ("value", "value_base", "effective_value")
TEXT_FIELDS = ("unit", "conditions_text")
FLAGS = ("is_upto", "is_new_customer_only", "is_sale_excluded", "is_marketplace_excluded")
#: the fields, besides the key, that make two observations the same offer
STATE = (*MONEY_FIELDS, *TEXT_FIELDS, *FLAGS)
CLOSED_TEXT = "offer no longer on the page"


def normal_state(df: DataFrame) -> Column:
    """The compared fields in one struct: amounts by value, texts trimmed, blanks as null; missing columns are null."""
    have = set(df.columns)
    part = lambda c: F.col(c) if c in have else F.lit(None)
    fields = [part(c).cast(T.MONEY).alias(c) for c in MONEY_FIELDS] + [T.blank_to_null(part(c).cast("string")).alias(c) for c in TEXT_FIELDS] + [part(c).cast("boolean").alias(c) for c in FLAGS]
    return F.struct(*fields)


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("category_label", T.blank_to_null(F.col("category_label")))


def latest(history: DataFrame) -> DataFrame:
    """The last row of each offer key; aggregated map-side, nothing is sorted."""
    rest = [c for c in history.columns if c not in KEY]
    last = F.max_by(F.struct(*rest), F.struct("observed_at", "ordinal")).alias("r")
    return keyed(history).groupBy(*KEY).agg(last).select(*KEY, *(F.col(f"r.{c}").alias(c) for c in rest))


def write_on_change(observations: DataFrame, stored_latest: DataFrame | None = None) -> DataFrame:
    """The observations that differ from the one before them in their key (stored rows come first).

    Equality is an equivalence, so comparing with the previous observation equals comparing with
    the last one written; duplicates of a key on one page compare in page order.
    """
    new = keyed(observations).withColumn("_new", F.lit(True)).withColumn("_state", normal_state(observations))
    if stored_latest is not None:
        old = keyed(stored_latest).withColumn("_new", F.lit(False)).withColumn("_state", normal_state(stored_latest))
        new = new.unionByName(old, allowMissingColumns=True)
    order = Window.partitionBy(*KEY).orderBy("_new", "observed_at", "ordinal")
    seen = new.withColumn("_before", F.lag("_state").over(order)).withColumn("_first", F.row_number().over(order) == 1)
    return seen.where("_new").where(F.col("_first") | ~F.col("_state").eqNullSafe(F.col("_before"))).select(*observations.columns)


def closures(stored_latest: DataFrame, pages_read: DataFrame, seen_keys: DataFrame) -> DataFrame:
    """Closing rows for open offers of the pages read (alias, observed_at) whose key was not seen.

    A page that was not read closes nothing; one that was read and holds no offer closes all of a
    known alias.  Labels are compared null-safe.
    """
    open_rows = keyed(stored_latest).where(F.col("value").isNotNull()).select(*KEY, "unit")
    read = pages_read.groupBy("alias").agg(F.max("observed_at").alias("observed_at"))
    seen = keyed(seen_keys).select("alias", F.col("kind").alias("_k"), F.col("category_label").alias("_l")).distinct()
    gone = open_rows.join(read, "alias").join(seen, (open_rows["alias"] == seen["alias"]) & (F.col("kind") == F.col("_k")) & F.col("category_label").eqNullSafe(F.col("_l")), "left_anti")
    none = [F.lit(None).cast(T.MONEY).alias(c) for c in MONEY_FIELDS]
    flags = [F.lit(False).alias("is_upto"), F.lit(False).alias("is_new_customer_only"), F.lit(None).cast("boolean").alias("is_sale_excluded"), F.lit(None).cast("boolean").alias("is_marketplace_excluded")]
    return gone.select(*KEY, "unit", *none, F.lit(None).cast("string").alias("conditions_text"), *flags, F.lit(CLOSED_TEXT).alias("raw_text"), "observed_at")


def backfill(observations: DataFrame, passes: DataFrame) -> DataFrame:
    """Many passes at once: keyed states in force over time, closures included.

    observations: KEY, state, observed_at, ordinal, pass_at; passes: (alias, pass_at) of each page
    read.  A key that is missing at the alias's next pass is closed there, and may reappear.  Returns
    the observations written, and closing rows (value null) at their pass.
    """
    numbered = passes.distinct().withColumn("pass_no", F.dense_rank().over(Window.partitionBy("alias").orderBy("pass_at")))
    seen = keyed(observations).join(numbered, ["alias", "pass_at"])
    keys = seen.select(*KEY, "unit", "pass_no").groupBy(*KEY, "pass_no").agg(F.max("unit").alias("unit"))
    ahead = keys.withColumn("next_no", F.lead("pass_no").over(Window.partitionBy(*KEY).orderBy("pass_no")))
    gaps = ahead.where(F.col("next_no").isNull() | (F.col("next_no") > F.col("pass_no") + 1))
    at = numbered.select("alias", F.col("pass_no").alias("close_no"), F.col("pass_at"))
    closing = gaps.withColumn("close_no", F.col("pass_no") + 1).join(at, ["alias", "close_no"]).select(*KEY, "unit", "pass_at", F.col("pass_at").alias("observed_at"), F.lit(-1).cast("long").alias("ordinal"))
    rows = keyed(observations).unionByName(closing, allowMissingColumns=True)
    return write_on_change(rows)


def upsert_providers(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Platforms by slug: name and base_url overwritten, other columns kept."""
    n = new.select("slug", F.col("name").alias("_name"), F.col("base_url").alias("_url"))
    joined = stored.join(n, "slug", "full_outer")
    changed = {"name": F.coalesce("_name", "name"), "base_url": F.coalesce("_url", "base_url")}
    return joined.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in stored.columns))


def upsert_aliases(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Aliases by (provider_id, raw_slug): name and url overwritten, the domain only by a known one.

    Of several new rows of a key the last ordinal wins; the domain is the last known one.
    """
    key = ["provider_id", "raw_slug"]
    last = new.groupBy(*key).agg(F.max_by(F.struct("raw_name", "raw_url"), "ordinal").alias("n"), F.max_by("raw_domain", F.when(F.col("raw_domain").isNotNull(), F.col("ordinal"))).alias("_domain"))
    joined = stored.join(last, key, "full_outer")
    out = {"raw_name": F.when(F.col("n").isNotNull(), F.col("n.raw_name")).otherwise(F.col("raw_name")), "raw_url": F.when(F.col("n").isNotNull(), F.col("n.raw_url")).otherwise(F.col("raw_url")), "raw_domain": F.coalesce("_domain", "raw_domain")}
    return joined.select(*(out[c].alias(c) if c in out else F.col(c) for c in stored.columns))


def touch(aliases: DataFrame, pages_read: DataFrame) -> DataFrame:
    """last_checked_at of every alias whose page was read, changed or not."""
    read = pages_read.groupBy("alias").agg(F.max("observed_at").alias("_at"))
    return aliases.join(read, "alias", "left").withColumn("last_checked_at", F.greatest("last_checked_at", "_at")).drop("_at")


def collect_pass(history: DataFrame, observations: DataFrame, pages_read: DataFrame) -> DataFrame:
    """The rows to append after one pass: changed offers, then closures."""
    before = latest(history)
    written = write_on_change(observations, before)
    gone = closures(before, pages_read, observations).withColumn("ordinal", F.lit(-1).cast("long"))
    return written.unionByName(gone, allowMissingColumns=True)
