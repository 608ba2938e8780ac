"""A whole collect pass over kept tables: history, latest state, aliases, merchants, coverage, reviews and runs.

Each pass is a batch with an id; run again, it leaves the same tables.  What a pass reads and writes follows from
the pages it was given: of the latest state, the aliases and the coverage it touches the buckets of its own pages
and merchants, and the history is only added to.  The latest rows of all offers are the state itself, so current offers need
no look at the history.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerledger.functions import text as T
from offerledger.operators import current as C
from offerledger.operators import history as H
from offerledger.operators import matching as M
from offerledger.operators import pages as P
from offerledger.operators import runs as R
from offerledger.operators.graph import checkpoint_dir_set
from offerledger.operators.slugs import allocate_slugs
from offerledger.sources.parts import PartTable, bucket, touched

HISTORY = "alias long, provider_id int, run_id long, kind string, category_label string, value decimal(10,3), value_base decimal(10,3), unit string, conditions_text string, is_upto boolean, is_new_customer_only boolean, is_sale_excluded boolean, is_marketplace_excluded boolean, effective_value decimal(10,3), raw_text string, observed_at timestamp, ordinal long"
ALIASES = "alias long, provider_id int, raw_slug string, raw_name string, raw_url string, raw_domain string, merchant_id long, confidence double, last_checked_at timestamp"
MERCHANTS = "merchant_id long, slug string, name string, canonical_domain string, category string, priority string, search_volume int, is_published boolean"
PARTIALS = "alias long, merchant_id long, provider_id int, best_percent decimal(10,3), best_fixed_eur decimal(10,3), oldest_collected_at timestamp, oldest_checked_at timestamp, has_main boolean, n_offers long"
REVIEWS = "kind string, payload string, status string"
RUNS = "run_id long, provider_id int, started_at timestamp, finished_at timestamp, status string, urls_fetched long, offers_found long, offers_written long, errors_count long, pages_empty long, notes string"


@dataclass(frozen=True)
class Ledger:
    """The tables under one folder; buckets is fixed when the first pass is written."""

    root: str
    buckets: int = 64
    tables: dict = field(default_factory=dict, compare=False, hash=False)

    def _table(self, name: str, schema: str) -> PartTable:
        return self.tables.setdefault(name, PartTable(f"{self.root}/{name}", schema))

    @cached_property
    def history(self) -> PartTable:
        return self._table("history", HISTORY)

    @cached_property
    def state(self) -> PartTable:
        return self._table("state", HISTORY)

    @cached_property
    def aliases(self) -> PartTable:
        return self._table("aliases", ALIASES)

    @cached_property
    def merchants(self) -> PartTable:
        return self._table("merchants", MERCHANTS)

    @cached_property
    def partials(self) -> PartTable:
        return self._table("partials", PARTIALS)

    @cached_property
    def reviews(self) -> PartTable:
        return self._table("reviews", REVIEWS)

    @cached_property
    def runs(self) -> PartTable:
        return self._table("runs", RUNS)

    def by_alias(self) -> Column:
        return bucket("alias", self.buckets)

    def by_slug(self) -> Column:
        return bucket(F.concat_ws("\x01", "provider_id", "raw_slug"), self.buckets)

    def by_merchant(self) -> Column:
        return bucket("merchant_id", self.buckets)

    def by_day(self) -> Column:
        return F.date_format("observed_at", "yyyy-MM-dd")

    def in_one(self) -> Column:
        return F.lit("all")


def numbered(rows: DataFrame, after: int, *order: str, parts: int = 256) -> DataFrame:
    """rows with `number`: after + 1, after + 2 ... in the order of hashed parts, then of `order`; no task gets all rows."""
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    sizes = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_past"))
    return dealt.withColumn("_turn", F.row_number().over(Window.partitionBy("_part").orderBy(*order))).join(sizes, "_part").withColumn("number", after + F.col("_past") + F.col("_turn")).drop("_part", "_turn", "_past")


def upserted_aliases(ledger: Ledger, parsed: DataFrame, listing: DataFrame, batch: int) -> DataFrame:
    """Aliases of the batch's pages: new or changed for pages with offers, touched for all that were read.

    The table's other rows are carried along bucket by bucket; new ids follow the largest one.
    """
    spark, key = parsed.sparkSession, ["provider_id", "raw_slug"]
    seen = P.with_listing(parsed.where("error is null"), listing).select(*key, "raw_name", F.col("url").alias("raw_url"), "raw_domain", "observed_at", F.col("page").alias("ordinal"), (F.size("offers") > 0).alias("has_offers"))
    parts = touched(seen, ledger.by_slug())
    stored = ledger.aliases.read(spark, parts, batch)
    # Ids are unique over all buckets: one column of the whole table is read for the largest.
    after = ledger.aliases.read(spark, None, batch).agg(F.coalesce(F.max("alias"), F.lit(0))).first()[0]
    merged = H.upsert_aliases(stored, seen.where("has_offers"))
    fresh = numbered(merged.where("alias is null").drop("alias"), after, *key).withColumnRenamed("number", "alias")
    known = merged.where("alias is not null").unionByName(fresh.select(*merged.columns))
    read = seen.groupBy(*key).agg(F.max("observed_at").alias("_at"))
    out = known.join(read, key, "left").withColumn("last_checked_at", F.greatest("last_checked_at", "_at")).drop("_at")
    ledger.aliases.replace(out, ledger.by_slug(), batch, parts)
    return ledger.aliases.read(spark, parts, batch + 1)


def latest_merged(ledger: Ledger, rows: DataFrame, batch: int) -> None:
    """The state with a batch's history rows: only the buckets of their aliases are read and written."""
    parts = touched(rows, ledger.by_alias())
    old = ledger.state.read(rows.sparkSession, parts, batch)
    ledger.state.replace(H.latest(old.unionByName(rows.select(*old.columns))), ledger.by_alias(), batch, parts)


def record_observations(ledger: Ledger, observations: DataFrame, pages_read: DataFrame, batch: int) -> DataFrame:
    """Write on change and closures of a batch against the kept state; the rows written to the history.

    observations: HISTORY's columns; pages_read: alias, observed_at.
    """
    spark = observations.sparkSession
    parts = touched(pages_read, ledger.by_alias())
    # Of the buckets' rows only those of the pages read can be compared or closed.
    before = ledger.state.read(spark, parts, batch).join(pages_read.select("alias").distinct(), "alias", "left_semi")
    written = H.write_on_change(observations, before)
    gone = H.closures(before, pages_read, observations).withColumn("ordinal", F.lit(-1).cast("long"))
    owner = before.groupBy("alias").agg(F.max("provider_id").alias("provider_id"))
    gone = gone.join(owner, "alias").withColumn("run_id", F.lit(batch).cast("long"))
    rows = written.unionByName(gone, allowMissingColumns=True)
    ledger.history.append(rows, ledger.by_day(), batch)
    new = ledger.history.written(spark, batch)
    latest_merged(ledger, new, batch)
    return new


def alias_partials(latest: DataFrame, aliases: DataFrame) -> DataFrame:
    """What each alias adds to its merchant's coverage; aliases without an open offer or a merchant are left out."""
    open_rows = latest.where(F.col("value").isNotNull())
    main = (F.col("kind") == "purchase") & F.col("category_label").isNull()
    best = lambda unit: F.max(F.when(main & (F.col("unit") == unit), F.col("effective_value")))
    per = open_rows.groupBy("alias").agg(best("percent").alias("best_percent"), best("fixed_eur").alias("best_fixed_eur"), F.min(F.when(main, F.col("observed_at"))).alias("oldest_collected_at"), F.max(main).alias("has_main"), F.count("*").alias("n_offers"))
    mine = aliases.where("merchant_id is not null").select("alias", "merchant_id", "provider_id", "last_checked_at")
    return per.join(mine, "alias").withColumn("oldest_checked_at", F.when(F.col("has_main"), F.col("last_checked_at")))


def coverage_merged(ledger: Ledger, aliases: DataFrame, batch: int) -> None:
    """Partials of the given aliases made anew from the state; the others of their merchants' buckets stay."""
    spark = aliases.sparkSession
    linked = aliases.where("merchant_id is not null")
    latest = ledger.state.read(spark, touched(linked, ledger.by_alias()), batch + 1).join(linked.select("alias"), "alias", "left_semi")
    parts = touched(linked, ledger.by_merchant())
    old = ledger.partials.read(spark, parts, batch).join(linked.select("alias"), "alias", "left_anti")
    ledger.partials.replace(old.unionByName(alias_partials(latest, linked).select(*old.columns)), ledger.by_merchant(), batch, parts)


def coverage(ledger: Ledger, merchants: DataFrame) -> DataFrame:
    """merchant_coverage out of the partials: a row per alias is read, and no history."""
    part = ledger.partials.read(merchants.sparkSession)
    per = part.groupBy("merchant_id").agg(
        F.countDistinct(F.when(F.col("has_main"), F.col("provider_id"))).alias("n_platforms"),
        F.max(F.greatest("best_percent", "best_fixed_eur")).alias("best_value"),
        F.max("best_percent").alias("best_percent"),
        F.max("best_fixed_eur").alias("best_fixed_eur"),
        F.min("oldest_collected_at").alias("oldest_collected_at"),
        F.min("oldest_checked_at").alias("oldest_checked_at"),
        F.sum("n_offers").alias("n_offers"),
    )
    joined = merchants.join(per, "merchant_id", "left")
    return joined.withColumn("n_platforms", F.coalesce("n_platforms", F.lit(0))).withColumn("n_offers", F.coalesce("n_offers", F.lit(0)))


def current_all(ledger: Ledger, spark: SparkSession, before: int | None = None) -> DataFrame:
    """offer_current_all from the state: its rows are the last ones already."""
    mine = ledger.aliases.read(spark, before=before).select("alias", "merchant_id", "last_checked_at")
    return ledger.state.read(spark, before=before).where(F.col("value").isNotNull()).join(mine, "alias")


def run_row(ledger: Ledger, spark: SparkSession, provider_id: int, batch: int, started_at, finished_at, counts: dict) -> None:
    """The run's row with status, drift against the last good run before it, and notes."""
    row = {"run_id": batch, "provider_id": provider_id, "started_at": started_at, "finished_at": finished_at, "status": None, "notes": None} | counts
    new = spark.createDataFrame([tuple(row[c.split()[0]] for c in RUNS.split(", "))], RUNS).withColumn("status", R.status(F.col("errors_count"), F.col("offers_found")))
    past = ledger.runs.read(spark, before=batch).where(F.col("provider_id") == provider_id)
    told = R.drift(R.previous_offers(past.unionByName(new)).where(F.col("run_id") == batch))
    ledger.runs.append(told, ledger.in_one(), batch)


def failed_run(ledger: Ledger, spark: SparkSession, provider_id: int, batch: int, started_at, finished_at, why: str) -> None:
    """The row of a run that could read no page: no listing, or no target to cut it to."""
    row = (batch, provider_id, started_at, finished_at, "failed", 0, 0, 0, 1, 0, why)
    ledger.runs.append(spark.createDataFrame([row], RUNS), ledger.in_one(), batch)


def match_and_publish(ledger: Ledger, spark: SparkSession, batch: int) -> None:
    """Unmatched aliases with a history become linked, new merchants or reviews; merchants with an offer are published."""
    checkpoint_dir_set(spark.range(1))
    aliases, merchants = ledger.aliases.read(spark, before=batch), ledger.merchants.read(spark, before=batch)
    open_ones = M.unmatched_aliases(aliases, ledger.state.read(spark, before=batch).select("alias"))
    decisions = M.resolve_aliases(open_ones, M.known_merchants(merchants, aliases)).checkpoint()
    created = decisions.where("action = 'create'").join(open_ones, "alias")
    after = merchants.agg(F.coalesce(F.max("merchant_id"), F.lit(0))).first()[0]
    named = numbered(allocate_slugs(created.select("alias", F.col("raw_name").alias("name"), T.domain_key(F.col("raw_domain")).alias("canonical_domain")), merchants), after, "alias").withColumnRenamed("number", "merchant_id").checkpoint()
    # A merchant made in this batch is known to the decisions by its alias.
    real = decisions.join(named.select((-F.col("alias")).alias("merchant_id"), F.col("merchant_id").alias("_made")), "merchant_id", "left").withColumn("merchant_id", F.coalesce("_made", "merchant_id")).withColumn("confidence", F.when(F.col("action") == "create", 1.0).otherwise(F.col("confidence")))
    linked = M.link_aliases(open_ones, real).select(*aliases.columns).checkpoint()
    ledger.reviews.append(M.queue_once(M.match_reviews(open_ones, real), ledger.reviews.read(spark, before=batch)), ledger.in_one(), batch)
    parts = touched(linked, ledger.by_slug())
    rest = ledger.aliases.read(spark, parts, batch).join(linked.select("alias"), "alias", "left_anti")
    ledger.aliases.replace(rest.unionByName(linked), ledger.by_slug(), batch, parts)
    coverage_merged(ledger, linked, batch)
    fresh = named.select("merchant_id", "slug", "name", "canonical_domain", F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("priority"), F.lit(None).cast("int").alias("search_volume"), F.lit(False).alias("is_published"))
    published = C.publish(merchants.unionByName(fresh), current_all(ledger, spark, batch + 1))
    ledger.merchants.replace(published.drop("newly_published"), ledger.in_one(), batch, {"all"})


def collect(ledger: Ledger, pages: DataFrame, listing: DataFrame, provider_id: int, batch: int, started_at, finished_at) -> None:
    """One pass over a platform's pages: parse, upsert and touch aliases, write on change, close, review, count, match, publish.

    pages: provider, raw_slug, page (its place in the listing), url, html, observed_at and maybe fetch_error; listing: provider,
    raw_slug, raw_name, raw_domain.  The pass takes the ids batch (pages) and batch + 1 (matching).
    """
    spark = pages.sparkSession
    checkpoint_dir_set(pages)
    parsed = P.parse_pages(pages).drop("html").withColumn("provider_id", F.lit(provider_id).cast("int")).checkpoint()
    aliases = upserted_aliases(ledger, parsed, listing, batch)
    mine = parsed.join(aliases.select("alias", "provider_id", "raw_slug"), ["provider_id", "raw_slug"]).where("error is null")
    observations = P.observations(mine).withColumn("run_id", F.lit(batch).cast("long"))
    written = record_observations(ledger, observations.select(*[c.split()[0] for c in HISTORY.split(", ")]), mine.select("alias", "observed_at"), batch)
    ledger.reviews.append(P.page_failures(parsed), ledger.in_one(), batch)
    coverage_merged(ledger, aliases.join(mine.select("alias").distinct(), "alias", "left_semi"), batch)
    told = parsed.agg(F.count("*").alias("urls_fetched"), F.count_if(F.col("error").isNotNull()).alias("errors_count"), F.count_if(F.col("error").isNull() & (F.size("offers") == 0)).alias("pages_empty"), F.coalesce(F.sum(F.when(F.col("error").isNull(), F.size("offers"))), F.lit(0)).alias("offers_found")).first().asDict()
    run_row(ledger, spark, provider_id, batch, started_at, finished_at, told | {"offers_written": written.count()})
    match_and_publish(ledger, spark, batch + 1)
