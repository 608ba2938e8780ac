"""Registered queries by name, and their SQL twins for DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerledger.functions import offers as O
from offerledger.functions import text as T
from offerledger.functions.similarity import scored_pairs
from offerledger.operators import current as C
from offerledger.operators import graph as G
from offerledger.operators import history as H
from offerledger.operators import ledger as K
from offerledger.operators import matching as M
from offerledger.operators import pages as P
from offerledger.operators import runs as R
from offerledger.operators.slugs import allocate_slugs
from offerledger.plans import derive as D
from offerledger.sources import listing as L
from offerledger.sources import tables as TB

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with its SQL if there is one."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _d(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


_CURRENT_SQL = f"""{D.HISTORY_SQL}, {D.ALIASES_SQL}, last_row as (
  select * from obs qualify row_number() over (partition by alias, kind, coalesce(label, '') order by ts desc, ordinal desc) = 1),
cur as (select l.*, a.merchant_id, a.provider_id, a.last_checked_at,
               case when kind = 'purchase' and label is null then value end as effective_value
        from last_row l join al a using (alias) where value is not null)"""


def _current_all(s: SparkSession, d: str) -> DataFrame:
    return C.offer_current_all(D.history(s, d), D.aliases(s, d))


@registered(f"with {_CURRENT_SQL} select alias, kind, coalesce(label, '') as label, cast(value as double) as value, unit, merchant_id, ts as observed_at, last_checked_at from cur")
def offer_current_all(s: SparkSession, d: str) -> DataFrame:
    return _current_all(s, d).select("alias", "kind", F.coalesce("category_label", F.lit("")).alias("label"), _d("value").alias("value"), "unit", "merchant_id", "observed_at", "last_checked_at")


@registered(f"with {_CURRENT_SQL} select alias, cast(value as double) as value, unit, merchant_id, provider_id, ts as observed_at from cur where kind = 'purchase' and label is null")
def offer_current(s: SparkSession, d: str) -> DataFrame:
    return C.offer_current(_current_all(s, d)).select("alias", _d("value").alias("value"), "unit", "merchant_id", F.col("provider_id").cast("long").alias("provider_id"), "observed_at")


_COVERAGE_SQL = f"""{_CURRENT_SQL}, {D.MERCHANTS_SQL}, main as (
  select merchant_id, count(distinct provider_id) as n_platforms, max(effective_value) as best_value,
         max(effective_value) filter (unit = 'percent') as best_percent, max(effective_value) filter (unit = 'fixed_eur') as best_fixed_eur,
         min(ts) as oldest_collected_at, min(last_checked_at) as oldest_checked_at
  from cur where kind = 'purchase' and label is null group by merchant_id),
every as (select merchant_id, count(*) as n_offers from cur group by merchant_id),
cov as (select m.merchant_id, m.slug, coalesce(n_platforms, 0) as n_platforms, cast(best_value as double) as best_value,
               cast(best_percent as double) as best_percent, cast(best_fixed_eur as double) as best_fixed_eur,
               oldest_collected_at, oldest_checked_at, coalesce(n_offers, 0) as n_offers
        from mer m left join main using (merchant_id) left join every using (merchant_id))"""


def _coverage(s: SparkSession, d: str) -> DataFrame:
    every = _current_all(s, d)
    return C.merchant_coverage(D.merchants(s, d).select("merchant_id", "slug"), C.offer_current(every), every)


@registered(f"with {_COVERAGE_SQL} select * from cov")
def merchant_coverage(s: SparkSession, d: str) -> DataFrame:
    return _coverage(s, d).select("merchant_id", "slug", "n_platforms", _d("best_value").alias("best_value"), _d("best_percent").alias("best_percent"), _d("best_fixed_eur").alias("best_fixed_eur"), "oldest_collected_at", "oldest_checked_at", "n_offers")


@registered(f"with {_COVERAGE_SQL} select merchant_id, oldest_checked_at from cov where oldest_checked_at < timestamp '2024-02-01 12:00:00' - interval 48 hours")
def stale_merchants(s: SparkSession, d: str) -> DataFrame:
    return C.stale(_coverage(s, d), "2024-02-01 12:00:00").select("merchant_id", "oldest_checked_at")


@registered(f"with {_CURRENT_SQL}, {D.MERCHANTS_SQL}, hit as (select distinct merchant_id from cur where merchant_id is not null) select m.merchant_id, m.is_published or h.merchant_id is not null as is_published, h.merchant_id is not null and not m.is_published as newly_published from mer m left join hit h using (merchant_id)")
def publish(s: SparkSession, d: str) -> DataFrame:
    return C.refresh(D.history(s, d), D.aliases(s, d), D.merchants(s, d))[2].select("merchant_id", "is_published", "newly_published")


@registered("""with rate as (select l_partkey as alias, max(l_discount * 100) as v, case when l_partkey % 2 = 0 then 'percent' else 'fixed_eur' end as unit from lineitem group by l_partkey)
select unit, alias, cast(v as double) as value, row_number() over (partition by unit order by v desc, alias) as rank from rate qualify rank <= 20""")
def top_rates(s: SparkSession, d: str) -> DataFrame:
    rates = D.table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("alias")).agg(F.max(F.col("l_discount") * 100).alias("effective_value")).withColumn("unit", F.when(F.col("alias") % 2 == 0, "percent").otherwise("fixed_eur"))
    return C.ranking(rates, 20).select("unit", "alias", F.col("effective_value").alias("value"), F.col("rank").cast("long").alias("rank"))


_STEP = "floor(value / 40)"


@registered(f"with {D.HISTORY_SQL}, st as (select *, {_STEP} as state from obs), seen as (select *, lag(state) over w as before, row_number() over w as n from st window w as (partition by alias, kind, label order by ts, ordinal)) select alias, kind, coalesce(label, '') as label, cast(state as double) as state, ordinal from seen where n = 1 or state is distinct from before")
def write_on_change(s: SparkSession, d: str) -> DataFrame:
    obs = D.history(s, d).withColumn("value", F.expr(_STEP).cast(T.MONEY)).drop("unit", "effective_value")
    return H.write_on_change(obs).select("alias", "kind", F.coalesce("category_label", F.lit("")).alias("label"), _d("value").alias("state"), "ordinal")


def _day_parts(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored rows before 20 January; pages read on the 20th (users of that day) and the keys seen then."""
    h = D.history(s, d)
    day = h.where(F.to_date("observed_at") == "2024-01-20")
    return h.where(F.col("observed_at") < "2024-01-20"), day.select("alias", "observed_at"), day


_CLOSE_SQL = f"""{D.HISTORY_SQL}, stored as (select * from obs where ts < timestamp '2024-01-20' qualify row_number() over (partition by alias, kind, coalesce(label, '') order by ts desc, ordinal desc) = 1),
today as (select * from obs where cast(ts as date) = date '2024-01-20'),
pages_read as (select alias, max(ts) as at from today group by alias)"""


@registered(f"with {_CLOSE_SQL} select s.alias, s.kind, coalesce(s.label, '') as label, s.unit, p.at as observed_at from stored s join pages_read p using (alias) where s.value is not null and not exists (select 1 from today t where t.alias = s.alias and t.kind = s.kind and t.label is not distinct from s.label)")
def close_missing(s: SparkSession, d: str) -> DataFrame:
    stored, read, seen = _day_parts(s, d)
    return H.closures(H.latest(stored), read, seen).select("alias", "kind", F.coalesce("category_label", F.lit("")).alias("label"), "unit", "observed_at")


@registered(f"""with {_CLOSE_SQL}, line as (
  select alias, kind, label, value, unit, timestamp '1970-01-01' as ts, cast(0 as bigint) as ordinal, false as fresh from stored union all select *, true from today),
seen as (select *, lag(struct_pack(v := value, u := unit)) over w as before, row_number() over w as n from line window w as (partition by alias, kind, label order by fresh, ts, ordinal)),
gone as (select s.alias, s.kind, s.label from stored s join pages_read p using (alias) where s.value is not null and not exists (select 1 from today t where t.alias = s.alias and t.kind = s.kind and t.label is not distinct from s.label))
select alias, kind, coalesce(label, '') as label, cast(value as double) as value from seen where fresh and (n = 1 or struct_pack(v := value, u := unit) is distinct from before) union all select alias, kind, coalesce(label, ''), null from gone""")
def collect_pass(s: SparkSession, d: str) -> DataFrame:
    stored, read, seen = _day_parts(s, d)
    return H.collect_pass(stored, seen, read).select("alias", "kind", F.coalesce("category_label", F.lit("")).alias("label"), _d("value").alias("value"))


@registered(f"""with {D.HISTORY_SQL}, o as (select alias, kind, label, cast(ts as date) as day, ts, ordinal, coalesce(value, 1) as value, unit from obs),
pages as (select alias, day, dense_rank() over (partition by alias order by day) as no from (select distinct alias, day from o)),
keys as (select alias, kind, label, o.day, no, max(unit) as unit from o join pages p using (alias, day) group by all),
ahead as (select *, lead(no) over (partition by alias, kind, label order by no) as next_no from keys)
select a.alias, a.kind, coalesce(a.label, '') as label, a.unit, strftime(p.day, '%Y-%m-%d') as closed_on from ahead a join pages p on p.alias = a.alias and p.no = a.no + 1 where a.next_no is null or a.next_no > a.no + 1""")
def backfill_closures(s: SparkSession, d: str) -> DataFrame:
    obs = D.history(s, d).withColumn("value", F.coalesce("value", F.lit(1).cast(T.MONEY))).withColumn("pass_at", F.to_date("observed_at").cast("timestamp"))
    rows = H.backfill(obs, obs.select("alias", "pass_at"))
    return rows.where("value is null").select("alias", "kind", F.coalesce("category_label", F.lit("")).alias("label"), "unit", F.date_format("pass_at", "yyyy-MM-dd").alias("closed_on"))


_BATCH_DAYS = ("2024-01-10", "2024-01-20")
_BATCH_SQL = f"""bt as (select alias, kind, label, coalesce(value, 1) as value, unit, ts, ordinal, case when ts < timestamp '{_BATCH_DAYS[0]}' then 1 when ts < timestamp '{_BATCH_DAYS[1]}' then 2 else 3 end as batch from obs),
seen as (select alias, max(batch) as batch, max(ts) as seen_at from bt group by alias),
last_row as (select * from bt qualify row_number() over (partition by alias, kind, coalesce(label, '') order by ts desc, ordinal desc) = 1),
st as (select l.alias, kind, label, case when l.batch = s.batch then value end as value, unit, ts from last_row l join seen s using (alias))"""


def _after_batches(s: SparkSession, d: str) -> K.Ledger:
    """Three batches of events as passes over kept tables; coverage is brought up to date with each."""
    h = D.history(s, d)
    value = F.coalesce("value", F.lit(1).cast(T.MONEY))
    filled = h.withColumn("value", value).withColumn("effective_value", F.when((F.col("kind") == "purchase") & F.col("category_label").isNull(), value)).withColumn("provider_id", (F.col("alias") % 5).cast("int"))
    merchant = F.when(F.col("alias") % 11 != 0, F.col("alias") % 40 + 1).cast("long")
    ledger = K.Ledger(f"{G.shared_dir(s)}/ledger-{uuid.uuid4().hex}", buckets=16)
    bounds = (None, *_BATCH_DAYS, None)
    for batch in (1, 2, 3):
        low, high = bounds[batch - 1], bounds[batch]
        rows = filled.where((F.col("observed_at") >= low if low else F.lit(True)) & (F.col("observed_at") < high if high else F.lit(True))).withColumn("run_id", F.lit(batch).cast("long"))
        read = rows.groupBy("alias", "provider_id").agg(F.max("observed_at").alias("observed_at"))
        missing = [F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in K.HISTORY.split(", ") if c.split()[0] not in rows.columns]
        K.record_observations(ledger, rows.select("*", *missing).select(*[c.split()[0] for c in K.HISTORY.split(", ")]), read.select("alias", "observed_at"), batch)
        K.coverage_merged(ledger, read.select("alias", merchant.alias("merchant_id"), "provider_id", F.col("observed_at").alias("last_checked_at")), batch)
    return ledger


@registered(f"with {D.HISTORY_SQL}, {_BATCH_SQL} select alias, kind, coalesce(label, '') as label, cast(value as double) as value, unit from st")
def incremental_latest(s: SparkSession, d: str) -> DataFrame:
    """The latest state that batches leave: offers that their alias's last pass didn't show are closed."""
    rows = _after_batches(s, d).state.read(s)
    return rows.select("alias", "kind", F.coalesce("category_label", F.lit("")).alias("label"), _d("value").alias("value"), "unit")


@registered(f"""with {D.HISTORY_SQL}, {D.MERCHANTS_SQL}, {_BATCH_SQL},
op as (select st.*, alias % 40 + 1 as merchant_id, alias % 5 as provider_id, (kind = 'purchase' and label is null) as is_main, seen_at from st join seen using (alias) where value is not null and alias % 11 <> 0),
cov as (select merchant_id, count(distinct provider_id) filter (is_main) as n_platforms, max(value) filter (is_main) as best_value, max(value) filter (is_main and unit = 'percent') as best_percent,
  max(value) filter (is_main and unit = 'fixed_eur') as best_fixed_eur, min(seen_at) filter (is_main) as oldest_checked_at, count(*) as n_offers from op group by merchant_id)
select m.merchant_id, coalesce(n_platforms, 0) as n_platforms, cast(best_value as double) as best_value, cast(best_percent as double) as best_percent, cast(best_fixed_eur as double) as best_fixed_eur, oldest_checked_at, coalesce(n_offers, 0) as n_offers from mer m left join cov using (merchant_id)""")
def incremental_coverage(s: SparkSession, d: str) -> DataFrame:
    """Coverage out of the partials of changed aliases, batch by batch."""
    rows = K.coverage(_after_batches(s, d), D.merchants(s, d).select("merchant_id"))
    return rows.select("merchant_id", "n_platforms", _d("best_value").alias("best_value"), _d("best_percent").alias("best_percent"), _d("best_fixed_eur").alias("best_fixed_eur"), "oldest_checked_at", "n_offers")


@registered(f"with {D.ALIASES_SQL}, pr as (select user_id as alias, max(ts) as seen_at from events where event_type = 'view' group by user_id) select alias, greatest(timestamp '2024-01-25', coalesce(seen_at, timestamp '2024-01-25')) as last_checked_at from al left join pr using (alias)")
def touch_alias(s: SparkSession, d: str) -> DataFrame:
    stored = D.aliases(s, d).withColumn("last_checked_at", F.lit("2024-01-25").cast("timestamp"))
    read = D.history(s, d).where("kind = 'view'").select("alias", "observed_at")
    return H.touch(stored, read).select("alias", "last_checked_at")


def _stored_aliases(s: SparkSession, d: str) -> DataFrame:
    return D.table(s, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_nationkey").alias("provider_id"), F.concat(F.lit("c-"), "c_custkey").alias("raw_slug"), F.col("c_name").alias("raw_name"), F.lit("old").alias("raw_url"), F.when(F.col("c_custkey") % 2 == 0, "kept.fr").alias("raw_domain"))


@registered("""with old as (select c_nationkey as provider_id, 'c-' || c_custkey as raw_slug, c_name as raw_name, 'old' as raw_url, case when c_custkey % 2 = 0 then 'kept.fr' end as raw_domain from customer where c_custkey % 3 <> 0),
new as (select c_nationkey as provider_id, 'c-' || c_custkey as raw_slug, c_mktsegment as raw_name, 'new' as raw_url, case when c_custkey % 7 = 0 then 'new.fr' end as raw_domain from customer where c_custkey % 5 <> 0)
select coalesce(n.provider_id, o.provider_id) as provider_id, coalesce(n.raw_slug, o.raw_slug) as raw_slug, coalesce(n.raw_name, o.raw_name) as raw_name, coalesce(n.raw_url, o.raw_url) as raw_url, coalesce(n.raw_domain, o.raw_domain) as raw_domain from old o full join new n on o.provider_id = n.provider_id and o.raw_slug = n.raw_slug""")
def alias_upsert(s: SparkSession, d: str) -> DataFrame:
    new = D.table(s, d, "customer").where("c_custkey % 5 <> 0").select(F.col("c_nationkey").alias("provider_id"), F.concat(F.lit("c-"), "c_custkey").alias("raw_slug"), F.col("c_mktsegment").alias("raw_name"), F.lit("new").alias("raw_url"), F.when(F.col("c_custkey") % 7 == 0, "new.fr").alias("raw_domain"), F.col("c_custkey").alias("ordinal"))
    return H.upsert_aliases(_stored_aliases(s, d), new)


@registered("""select coalesce(n.slug, o.slug) as slug, coalesce(n.name, o.name) as name, coalesce(n.base_url, o.base_url) as base_url from (select 'p' || c_custkey as slug, c_name as name, 'old' as base_url from customer where c_custkey % 2 = 0) o full join (select 'p' || s_suppkey as slug, s_name as name, 'new' as base_url from supplier) n on n.slug = o.slug""")
def provider_upsert(s: SparkSession, d: str) -> DataFrame:
    old = D.table(s, d, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("p"), "c_custkey").alias("slug"), F.col("c_name").alias("name"), F.lit("old").alias("base_url"))
    new = D.table(s, d, "supplier").select(F.concat(F.lit("p"), "s_suppkey").alias("slug"), F.col("s_name").alias("name"), F.lit("new").alias("base_url"))
    return H.upsert_providers(old, new)


def _rate_texts(s: SparkSession, d: str) -> DataFrame:
    """Sentences with a percentage, and a price with a comma, from line items."""
    percent = F.round(F.col("l_discount") * 100).cast("int")
    euros = F.concat((F.col("l_quantity").cast("int")).cast("string"), F.lit(",5"))
    text = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("Jusqu'à "), percent, F.lit("% de remise, hors soldes"))).when(F.col("l_linenumber") % 3 == 1, F.concat(euros, F.lit(" € pour un nouveau client"))).otherwise(F.concat(percent, F.lit("%"), percent + 2, F.lit("% en bon d'achat")))
    return D.spread(D.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_quantity")).select("l_orderkey", "l_linenumber", "l_partkey", text.alias("text"))


_TEXT_SQL = """txt as (select l_orderkey, l_linenumber, l_partkey, cast(round(l_discount * 100) as int) as p, cast(l_quantity as int) as e, l_linenumber % 3 as m from lineitem)"""


@registered(f"with {_TEXT_SQL} select l_orderkey, l_linenumber, l_partkey, case when m = 2 then 2 else 1 end as n, cast(case when m = 1 then e + 0.5 else p end as double) as first_value, case when m = 1 then 'fixed_eur' else 'percent' end as first_unit from txt")
def extract_amounts(s: SparkSession, d: str) -> DataFrame:
    found = _rate_texts(s, d).withColumn("a", T.extract_amounts(F.col("text")))
    return found.select("l_orderkey", "l_linenumber", "l_partkey", F.size("a").alias("n"), _d(F.col("a")[0]["value"]).alias("first_value"), F.col("a")[0]["unit"].alias("first_unit"))


@registered(f"with {_TEXT_SQL} select l_orderkey, l_linenumber, l_partkey, cast(case m when 0 then p when 1 then e + 0.5 else p + 2 end as double) as value, cast(case when m = 2 then p end as double) as value_base, case when m = 1 then 'fixed_eur' else 'percent' end as unit, case when m = 2 then 'giftcard' else 'purchase' end as kind, m = 0 as is_upto, m = 1 as is_new_customer_only, case when m = 0 then true end as is_sale_excluded, cast(case when m = 0 then p end as double) as effective_value from txt")
def normalize_offer(s: SparkSession, d: str) -> DataFrame:
    o = _rate_texts(s, d).withColumn("o", O.offer_from_text(F.col("text")))
    return o.select("l_orderkey", "l_linenumber", "l_partkey", _d("o.value").alias("value"), _d("o.value_base").alias("value_base"), "o.unit", "o.kind", "o.is_upto", "o.is_new_customer_only", "o.is_sale_excluded", _d("o.effective_value").alias("effective_value"))


@registered("""with u as (select page_id, url, split_part(split_part(regexp_replace(lower(trim(url)), '^https?://', ''), '/', 1), ':', 1) as host from pages), r as (select page_id, url, regexp_replace(host, '^www\\.', '') as root from u),
l as (select *, string_split(root, '.') as p from r)
select page_id, root, case when len(p) >= 2 then case when len(p) >= 3 and p[-2] in ('co', 'com', 'org', 'net', 'gouv') and len(p[-1]) = 2 then array_to_string(p[-3:], '.') else array_to_string(p[-2:], '.') end end as key,
  regexp_replace(regexp_replace(lower(strip_accents(url)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from l""")
def slug_name_domain(s: SparkSession, d: str) -> DataFrame:
    url = F.col("url")
    return D.table(s, d, "pages").select("page_id", T.domain_root(url).alias("root"), T.domain_key(url).alias("key"), T.slugify(url).alias("slug"))


@registered("""with t as (select p_partkey, string_split(regexp_replace(regexp_replace(lower(p_name || ' Boutique ' || p_brand || ' en ligne'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '-') as w from part)
select p_partkey, array_to_string(list_filter(w, lambda x: x not in ('fr','france','com','www','shop','store','boutique','officiel','official','en','ligne','online','site')), ' ') as name,
 array_to_string(list_filter(w, lambda x: x not in ('fr','france','com','www','shop','store','boutique','officiel','official','en','ligne','online','site')), '') as compact from t""")
def normalized_names(s: SparkSession, d: str) -> DataFrame:
    raw = F.concat_ws(" ", F.col("p_name"), F.lit("Boutique"), F.col("p_brand"), F.lit("en ligne"))
    return D.parts(s, d).select("p_partkey", T.normalize_name(raw).alias("name"), T.compact(raw).alias("compact"))


_STATUS_SQL = "case when errors_count = 0 then 'ok' when offers_found > 0 then 'partial' else 'failed' end"


@registered(f"with {D.RUNS_SQL} select run_id, provider_id, urls_fetched, errors_count, offers_found, {_STATUS_SQL} as status from run")
def run_status(s: SparkSession, d: str) -> DataFrame:
    return D.runs(s, d).select("run_id", "provider_id", "urls_fetched", "errors_count", "offers_found", R.status(F.col("errors_count"), F.col("offers_found")).alias("status"))


@registered(f"""with {D.RUNS_SQL}, st as (select *, {_STATUS_SQL} as status from run),
prev as (select r.*, (select max_by(o.offers_found, struct_pack(f := o.finished_at, r := o.run_id)) from st o where o.provider_id = r.provider_id and o.status = 'ok' and o.finished_at <= r.started_at) as previous from st r),
dr as (select *, case when previous > 0 then abs(offers_found - previous) / previous end as drift from prev)
select run_id, previous, round(drift, 6) as drift, coalesce(drift > 0.2, false) as is_drift,
 nullif(concat_ws(' ; ', case when drift > 0.2 then 'offers ' || previous || ' -> ' || offers_found end, case when pages_empty > 0 then pages_empty || ' pages without offers' end), '') as notes from dr""")
def run_drift(s: SparkSession, d: str) -> DataFrame:
    runs = D.runs(s, d).withColumn("status", R.status(F.col("errors_count"), F.col("offers_found")))
    return R.drift(R.previous_offers(runs)).select("run_id", "previous", F.round("drift", 6).alias("drift"), "is_drift", "notes")


@registered(f"with {D.RUNS_SQL} select run_id, 'platform-' || provider_id as slug, started_at, offers_found from run order by started_at desc, run_id desc limit 15")
def latest_runs(s: SparkSession, d: str) -> DataFrame:
    runs = D.runs(s, d)
    providers = runs.select("provider_id").distinct().withColumn("slug", F.concat(F.lit("platform-"), "provider_id"))
    return R.latest_runs(runs, providers).select("run_id", "slug", "started_at", "offers_found")


@registered("""with pg as (select user_id * 100 + day(ts) as run_id, count(*) as urls_fetched, count(*) filter (event_type = 'error') as errors_count, count(*) filter (event_type = 'view') as pages_empty, count(*) filter (event_type = 'purchase') as offers_found, count(*) filter (event_type = 'signup') as offers_written from events group by 1) select * from pg""")
def run_totals(s: SparkSession, d: str) -> DataFrame:
    e = D.table(s, d, "events").withColumn("run_id", F.col("user_id") * 100 + F.dayofmonth("ts"))
    pages = e.select("run_id", F.when(F.col("event_type") == "error", "e").alias("error"), F.when(F.col("event_type") != "view", 1).otherwise(0).alias("n_offers"))
    return R.totals(pages, e.where("event_type = 'purchase'"), e.where("event_type = 'signup'"))


@registered(f"with {D.ALIASES_SQL}, {D.MERCHANTS_SQL} select m.merchant_id, count(distinct a.provider_id) as n_platforms, coalesce(min(a.provider_id), -1) as first_platform from mer m left join al a using (merchant_id) group by m.merchant_id")
def known_merchants(s: SparkSession, d: str) -> DataFrame:
    k = M.known_merchants(D.merchants(s, d), D.aliases(s, d))
    return k.select("merchant_id", F.size("provider_ids").cast("long").alias("n_platforms"), F.coalesce(F.try_element_at("provider_ids", F.lit(1)), F.lit(-1)).cast("long").alias("first_platform"))


@registered("select c_custkey as alias from customer c where c_custkey % 3 <> 0 and exists (select 1 from orders o where o.o_custkey = c.c_custkey)")
def unmatched_aliases(s: SparkSession, d: str) -> DataFrame:
    aliases = D.table(s, d, "customer").select(F.col("c_custkey").alias("alias"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey")).alias("merchant_id"))
    return M.unmatched_aliases(aliases, D.table(s, d, "orders").select(F.col("o_custkey").alias("alias"))).select("alias")


@registered("""select o_custkey as alias_id, min_by('{"alias_id":' || o_custkey || ',"reason":"' || o_orderstatus || '"}', o_orderkey) as payload from orders where o_custkey not in (select c_custkey from customer where c_custkey % 4 = 0) group by 1""")
def review_once(s: SparkSession, d: str) -> DataFrame:
    """Every order asks for a review of its customer; the first per customer is queued, none where one is open."""
    new = M.review_items(D.table(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("alias_id"), F.col("o_orderstatus").alias("reason")), "match", "alias_id", "reason", order="o_orderkey")
    queue = M.review_items(D.table(s, d, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("alias_id")), "match", "alias_id")
    return M.queue_once(new, queue, "turn").select(F.get_json_object("payload", "$.alias_id").cast("long").alias("alias_id"), "payload")


@registered("""select c_custkey as alias, case when c_custkey % 4 in (0, 1) then c_custkey + 7 else case when c_custkey % 3 = 0 then c_custkey end end as merchant_id,
 case when c_custkey % 4 = 0 then 0.95 when c_custkey % 4 = 1 then 1.0 when c_custkey % 3 = 0 then 0.5 end as confidence from customer""")
def link_alias(s: SparkSession, d: str) -> DataFrame:
    """Link and create decisions set the merchant; reviews and aliases without a decision stay as they are."""
    key = F.col("c_custkey")
    aliases = D.table(s, d, "customer").select(key.alias("alias"), F.when(key % 3 == 0, key).alias("merchant_id"), F.when(key % 3 == 0, 0.5).alias("confidence"))
    decisions = D.table(s, d, "customer").where("c_custkey % 4 < 3").select(key.alias("alias"), F.when(key % 4 == 0, "link").when(key % 4 == 1, "create").otherwise("review").alias("action"), (key + 7).alias("merchant_id"), F.when(key % 4 == 0, 0.95).otherwise(1.0).alias("confidence"))
    return M.link_aliases(aliases, decisions).select("alias", "merchant_id", "confidence")


def _shop_aliases(s: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    return D.table(s, d, "customer").select(key.alias("alias"), F.col("c_nationkey").alias("provider_id"), F.concat(F.lit("c-"), key).alias("raw_slug"), F.col("c_name").alias("raw_name"), F.concat(F.lit("https://www.shop"), key % 150, F.lit(".fr/fr/home")).alias("raw_domain"))


@registered(f"""with {D.ALIASES_SQL}, {D.MERCHANTS_SQL}, lk as (select merchant_id, list(distinct provider_id) as ps from al where merchant_id is not null group by 1)
select c_custkey as alias, m.merchant_id, case when list_contains(coalesce(ps, []), c_nationkey) then 'review' else 'link' end as action from customer join mer m on m.canonical_domain = 'shop' || (c_custkey % 150) || '.fr' left join lk using (merchant_id)""")
def match_domain(s: SparkSession, d: str) -> DataFrame:
    return M.match_by_domain(_shop_aliases(s, d), M.known_merchants(D.merchants(s, d), D.aliases(s, d)))


def _name_sql(c: str) -> str:
    """A normal name: slug tokens without noise words."""
    noise = ", ".join(f"'{w}'" for w in T.NOISE)
    tokens = f"string_split(regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '-')"
    return f"array_to_string(list_filter({tokens}, lambda x: x <> '' and x not in ({noise})), ' ')"


# The ratio of all pairs (l, r) of `pr`: the longest common block of two texts, the first in l and then in r, counts;
# then those of what stands before it and behind it in both.
_RATIO_SQL = """seg as (select l, r, l as a, r as b, cast(0 as bigint) as k from pr union all
  select l, r, unnest([substr(a, 1, i - 1), substr(a, i + k)]), unnest([substr(b, 1, j - 1), substr(b, j + k)]), unnest([k, 0]) from (
    select l, r, a, b, cast(best.k as bigint) as k, cast(-best.i as bigint) as i, cast(-best.j as bigint) as j from (
      select *, list_max(flatten(list_transform(range(1, length(a) + 1), lambda i: list_transform(range(1, length(b) + 1), lambda j:
        struct_pack(k := len(list_filter(range(1, least(length(a) - i, length(b) - j) + 2), lambda n: substr(a, i, n) = substr(b, j, n))), i := -i, j := -j))))) as best
      from seg where a <> '' and b <> '') where best.k > 0)),
ratio as (select l, r, case when length(l) + length(r) = 0 then 1.0 else 2.0 * sum(k) / (length(l) + length(r)) end::double as score from seg group by l, r)"""
_PART_NAMES_SQL = f"""mc as (select p_name as name, min(p_partkey) as merchant_id, replace(p_name, ' ', '-') as slug, {_name_sql("p_name")} as r from part group by p_name),
pa as (select p_partkey + 1 as alias, p_partkey % 3 as provider_id, case p_partkey % 4 when 0 then p_name || ' FR' when 1 then p_name || 's' when 2 then 'le ' || p_name else p_name || ' ' || p_type end as raw_name from part),
an as (select distinct raw_name, {_name_sql("raw_name")} as l from pa)"""
_LIKELY = "2.0 * least(length(l), length(r)) >= {} * (length(l) + length(r))"
_DECIDED_SQL = f"""with recursive {_PART_NAMES_SQL}, pr as (select distinct an.l, mc.r from an, mc where {_LIKELY.format(M.REVIEW)}), {_RATIO_SQL},
hit as (select pa.alias, max(struct_pack(score := score, m := -merchant_id)) as b from pa join an using (raw_name) join ratio using (l) join mc using (r) where score >= {M.REVIEW} and provider_id <> 0 group by pa.alias),
told as (select pa.alias, b.score as score, -b.m as merchant_id, name from pa left join hit using (alias) left join mc on merchant_id = -b.m),
dec as (select alias, case when score >= {M.LINK} then 'link' when score >= {M.REVIEW} then 'review' else 'create' end as action, merchant_id, round(score, 3) as confidence,
  case when score >= {M.LINK} then replace('{M.REASONS["near"]}', '{{0}}', name) when score >= {M.REVIEW} then replace('{M.REASONS["alike"]}', '{{0}}', name) else '{M.REASONS["none"]}' end as reason from told)"""


def _part_merchants(s: SparkSession, d: str) -> DataFrame:
    """One merchant per distinct part name."""
    return D.parts(s, d).groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("merchant_id")).select("merchant_id", "name", T.slugify(F.col("name")).alias("slug"), F.lit(None).cast("string").alias("canonical_domain"), F.array(F.lit(0)).alias("provider_ids"))


def _part_aliases(s: SparkSession, d: str) -> DataFrame:
    """Part names with one change by part key, as a platform would write them."""
    key = F.col("p_partkey")
    name = F.when(key % 4 == 0, F.concat(F.col("p_name"), F.lit(" FR"))).when(key % 4 == 1, F.concat(F.col("p_name"), F.lit("s"))).when(key % 4 == 2, F.concat(F.lit("le "), "p_name")).otherwise(F.concat_ws(" ", "p_name", "p_type"))
    return D.parts(s, d).select((key + 1).alias("alias"), (key % 3).cast("int").alias("provider_id"), name.alias("raw_name"), F.when(key % 9 == 0, F.concat(F.lit("www.s"), key % 45, F.lit(".fr"))).alias("raw_domain"))


@registered(f"with recursive {_PART_NAMES_SQL}, pr as (select distinct an.l, mc.r from an, mc where {_LIKELY.format(M.REVIEW)}), {_RATIO_SQL} select l, r, round(score, 9) as score from ratio where score >= {M.REVIEW}")
def name_similarity(s: SparkSession, d: str) -> DataFrame:
    """Every pair of a written and a known name with a ratio of 0.75 or more."""
    left = _part_aliases(s, d).select(T.normalize_name(F.col("raw_name")).alias("name"))
    right = _part_merchants(s, d).select(T.normalize_name(F.col("name")).alias("name"))
    return scored_pairs(left, right, M.REVIEW).select("l", "r", F.round("score", 9).alias("score"))


@registered(f"""with recursive {_PART_NAMES_SQL}, pr as (select distinct an.l, mc.r from an, mc), {_RATIO_SQL}, top as (select l, max(score) as score from ratio group by l),
first as (select l, min(slug) as slug from ratio join top using (l, score) join mc using (r) where score >= {M.LINK} group by l)
select raw_name as name, slug, score from an join top using (l) left join first using (l)""")
def best_match(s: SparkSession, d: str) -> DataFrame:
    return M.best_match(_part_aliases(s, d).select(F.col("raw_name").alias("name")), _part_merchants(s, d))


@registered(f"{_DECIDED_SQL} select * from dec")
def match_decisions(s: SparkSession, d: str) -> DataFrame:
    return M.decide(_part_aliases(s, d), _part_merchants(s, d))


@registered()
def resolve_aliases(s: SparkSession, d: str) -> DataFrame:
    return M.resolve_aliases(_part_aliases(s, d), _part_merchants(s, d))


@registered(f"{_DECIDED_SQL} select action, count(*) as n from dec where action <> 'review' or alias % 5 <> 0 group by action")
def match_counts(s: SparkSession, d: str) -> DataFrame:
    """Decisions by action; of the reviews only those that are queued (some aliases wait already)."""
    aliases = _part_aliases(s, d).withColumn("raw_slug", F.concat(F.lit("pp-"), "alias"))
    decisions = M.decide(aliases, _part_merchants(s, d))
    queue = M.review_items(aliases.where("alias % 5 = 0").select(F.col("alias").alias("alias_id")), "merchant_match", "alias_id")
    return M.match_counts(aliases, decisions, queue)


@registered("""with w as (select p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') as base, row_number() over (partition by p_name order by p_partkey) as turn from part),
taken as (select distinct regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') as base from part where p_partkey % 2 = 0)
select p_partkey, case when turn + (t.base is not null)::int = 1 then w.base else w.base || '-' || (turn + (t.base is not null)::int) end as slug from w left join taken t using (base)""")
def unique_slug(s: SparkSession, d: str) -> DataFrame:
    parts = D.parts(s, d)
    taken = parts.where("p_partkey % 2 = 0").select(T.slugify(F.col("p_name")).alias("slug"))
    return allocate_slugs(parts.select("p_partkey", F.col("p_name").alias("name")), taken, "p_partkey").select("p_partkey", "slug")


@registered(f"with {D.MERCHANTS_SQL} select slug, name, priority from mer where priority in ('P1', 'P2')")
def targets(s: SparkSession, d: str) -> DataFrame:
    return M.targets(D.merchants(s, d), 2).select("slug", "name", "priority")


@registered(f"with {D.MERCHANTS_SQL}, {D.ALIASES_SQL} select distinct provider_id, raw_slug from al join mer using (merchant_id) where priority in ('P1', 'P2')")
def aliases_of_targets(s: SparkSession, d: str) -> DataFrame:
    return M.aliases_of_targets(D.aliases(s, d), M.targets(D.merchants(s, d), 2)).select(F.col("provider_id").cast("long").alias("provider_id"), "raw_slug")


def _part_listing(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    listing = D.parts(s, d).select(F.col("p_partkey").alias("ordinal"), F.lit(0).alias("provider_id"), F.concat(F.lit("pp-"), "p_partkey").alias("raw_slug"), F.concat_ws(" ", F.upper("p_name"), F.lit("Shop")).alias("raw_name"))
    wanted = D.parts(s, d).where("p_size < 10").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("merchant_id")).select("merchant_id", "name", T.slugify(F.col("name")).alias("slug"), F.lit("P1").alias("priority"))
    return listing, wanted


@registered("select p_partkey as ordinal, replace(p_name, ' ', '-') as target from part where p_name in (select p_name from part where p_size < 10)")
def wanted_exact(s: SparkSession, d: str) -> DataFrame:
    return M.wanted_exact(*_part_listing(s, d))


@registered("select p_partkey as ordinal, 'pp-' || p_partkey as raw_slug from part where p_name in (select p_name from part where p_size < 10) or p_partkey % 10 = 0")
def cut_listing(s: SparkSession, d: str) -> DataFrame:
    listing, wanted = _part_listing(s, d)
    linked = listing.where("ordinal % 10 = 0").select("provider_id", "raw_slug")
    return M.cut_listing(listing, linked, M.wanted_exact(listing, wanted), targets=wanted).select("ordinal", "raw_slug")


_WANTED_SQL = f"""with recursive li as (select p_partkey as ordinal, upper(p_name) || ' Shop' || case when p_partkey % 3 = 0 then 's' else '' end as raw_name, 'pp-' || p_partkey as raw_slug from part),
tg as (select distinct p_name as name, replace(p_name, ' ', '-') as slug, {_name_sql("p_name")} as r from part where p_size < 10),
ln as (select *, {_name_sql("raw_name")} as l, {_name_sql("raw_slug")} as s from li),
ex as (select ordinal, min(slug) as target from ln join tg on replace(r, ' ', '') in (replace(l, ' ', ''), replace(s, ' ', '')) group by ordinal),
pr as (select distinct l, r from (select l from ln where ordinal not in (select ordinal from ex)), tg where {_LIKELY.format(M.LINK)}), {_RATIO_SQL},
nr as (select l, min_by(slug, struct_pack(a := -score, b := slug)) as target from ratio join tg using (r) where score >= {M.LINK} group by l),
wa as (select ordinal, target from ex union all select ordinal, target from ln join nr using (l) where ordinal not in (select ordinal from ex))"""


@registered(f"{_WANTED_SQL} select ordinal, target from wa")
def wanted(s: SparkSession, d: str) -> DataFrame:
    """Listed rows that are a target's by name or slug, or by a similar name."""
    return M.wanted(*_spelt_listing(s, d))


@registered(f"{_WANTED_SQL} select ordinal, 'pp-' || ordinal as raw_slug from (select ordinal from wa union select p_partkey from part where p_partkey % 10 = 0)")
def cut_listing_wanted(s: SparkSession, d: str) -> DataFrame:
    """The listing cut to linked and wanted rows, similar names among them."""
    listing, targets = _spelt_listing(s, d)
    linked = listing.where("ordinal % 10 = 0").select("provider_id", "raw_slug")
    return M.cut_listing(listing, linked, M.wanted(listing, targets), targets=targets).select("ordinal", "raw_slug")


def _spelt_listing(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Part names as a platform may write them, some with a letter more; and targets."""
    listing, targets = _part_listing(s, d)
    return listing.withColumn("raw_name", F.when(F.col("ordinal") % 3 == 0, F.concat("raw_name", F.lit("s"))).otherwise(F.col("raw_name"))), targets


@registered("select p_partkey as ordinal, 'pp-' || p_partkey as raw_slug, (select count(*) from part) as n_listed from part order by p_partkey limit 20")
def listing_preview(s: SparkSession, d: str) -> DataFrame:
    listing = _part_listing(s, d)[0].withColumn("provider", F.lit("a"))
    return R.listing_preview(listing, 20).select("ordinal", "raw_slug", "n_listed")


def _seed(s: SparkSession, d: str) -> DataFrame:
    """Rows as they stand in a seed file: customers meet the suppliers' slugs and domains, and later rows meet both."""
    key, customers = F.col("c_custkey"), D.table(s, d, "customer")
    first = customers.select(key.alias("ordinal"), F.when(key % 13 != 0, F.concat(F.lit(" M "), key)).alias("Slug"), F.col("c_name").alias("Marchand"), F.when(key % 2 == 0, F.concat(F.lit("https://www.shop"), key, F.lit(".fr/x"))).alias("Domaine"), F.col("c_mktsegment").alias("Categorie"), F.concat(F.lit("p"), (key % 5).cast("int")).alias("Prio"), F.concat(F.lit("1 "), F.lpad((key % 1000).cast("string"), 3, "0")).alias("Volume"))
    again = customers.where("c_custkey % 10 in (0, 3, 4, 5)").select((key + 1_000_000_000).alias("ordinal"), F.concat(F.lit("x "), key).alias("Slug"), F.lit("Again").alias("Marchand"), F.concat(F.lit("shop"), key, F.lit(".fr")).alias("Domaine"), F.lit(None).cast("string").alias("Categorie"), F.lit("P1").alias("Prio"), F.lit("n/a").alias("Volume"))
    return L.seed_rows(first.unionByName(again))


_SEED_SQL = """one as (select c_custkey as k, c_custkey as ordinal, 'm-' || c_custkey as slug, c_name as name, case when c_custkey % 2 = 0 then 'shop' || c_custkey || '.fr' end as domain, c_mktsegment as category, case when c_custkey % 5 between 1 and 3 then 'P' || (c_custkey % 5) end as priority, 1000 + c_custkey % 1000 as search_volume from customer where c_custkey % 13 <> 0),
two as (select c_custkey as k, c_custkey + 1000000000 as ordinal, 'x-' || c_custkey as slug, 'Again' as name, 'shop' || c_custkey || '.fr' as domain, cast(null as varchar) as category, 'P1' as priority, cast(null as bigint) as search_volume from customer where c_custkey % 10 in (0, 3, 4, 5)),
seed as (select * from one union all select * from two)"""


@registered(f"with {_SEED_SQL} select ordinal, slug, name, domain, category, priority, search_volume from seed")
def seed_rows(s: SparkSession, d: str) -> DataFrame:
    return _seed(s, d).select("ordinal", "slug", "name", "domain", "category", "priority", F.col("search_volume").cast("long").alias("search_volume"))


@registered(f"""with {_SEED_SQL}, {D.MERCHANTS_SQL}, m as (select merchant_id - 1 as k, * from mer),
met as (select k, m.merchant_id is not null as stored, one.ordinal is not null as listed, coalesce(m.slug, one.slug) as slug, m.name as m_name, one.name as one_name, m.canonical_domain, one.domain, m.category as m_category, one.category as one_category, m.priority as m_priority, one.priority as one_priority, m.search_volume as m_volume, one.search_volume as one_volume, m.is_published from m full join one using (k)),
seeded as (select met.*, two.ordinal is not null as again, two.domain as two_domain from met left join two on two.k = met.k and ((stored and canonical_domain is not null) or met.domain is not null))
select slug, case when again then 'Again' when listed then one_name else m_name end as name, coalesce(canonical_domain, domain, two_domain) as canonical_domain, case when again then null when listed then one_category else m_category end as category, case when again then 'P1' when listed then one_priority else m_priority end as priority, coalesce(one_volume, m_volume) as search_volume, coalesce(is_published, false) as is_published, case when not stored then 'created' when listed or again then 'updated' else 'kept' end as change from seeded
union all select slug, name, domain, category, priority, search_volume, false, 'created' from two where k not in (select k from seeded where again)""")
def seed_upsert(s: SparkSession, d: str) -> DataFrame:
    return M.seed_merchants(D.merchants(s, d), _seed(s, d)).select("slug", "name", "canonical_domain", "category", "priority", F.col("search_volume").cast("long").alias("search_volume"), "is_published", "change")


@registered(f"with {_SEED_SQL} select coalesce(priority, 'none') as priority, count(*) as n from seed group by 1")
def seed_counts(s: SparkSession, d: str) -> DataFrame:
    return R.counts_by(_seed(s, d).withColumn("priority", F.coalesce("priority", F.lit("none"))), "priority")


def _maps(s: SparkSession, d: str) -> DataFrame:
    """Sitemaps written from parts: a document of 100 parts each, whatever the table's size."""
    slug = F.replace("p_name", F.lit(" "), F.lit("-"))
    a = F.concat(F.lit("<url><loc> https://a.example/code-promo/"), slug, F.lit("-"), F.col("p_partkey"), F.lit(" </loc><lastmod>2024-01-01</lastmod></url><url><loc>https://a.example/other/x</loc></url>"))
    b = F.concat(F.lit("<url><loc>https://b.example/reduction-"), slug, F.lit("-"), F.col("p_partkey"), F.lit("</loc></url>"))
    docs = D.parts(s, d).groupBy(F.floor(F.col("p_partkey") / 100).alias("k")).agg(F.concat_ws("", F.collect_list(a)).alias("a"), F.concat_ws("", F.collect_list(b)).alias("b"))
    return docs.select(F.concat(F.lit("<urlset>"), "a", "b", F.lit("</urlset>")).alias("xml"))


_TITLE_SQL = "array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ')"


@registered(f"""select 'a' as provider, replace(p_name, ' ', '-') || '-' || p_partkey as raw_slug, {_TITLE_SQL} || ' ' || p_partkey as raw_name, 'https://a.example/code-promo/' || replace(p_name, ' ', '-') || '-' || p_partkey as raw_url, '2024-01-01' as lastmod from part
union all select 'b', replace(p_name, ' ', '-') || '-' || p_partkey, {_TITLE_SQL}, 'https://b.example/reduction-' || replace(p_name, ' ', '-') || '-' || p_partkey, null from part""")
def sitemap(s: SparkSession, d: str) -> DataFrame:
    entries = L.sitemap_entries(_maps(s, d))
    return L.listing_a(entries).unionByName(L.listing_b(entries)).select("provider", "raw_slug", "raw_name", "raw_url", "lastmod")


@registered("select page_id, url, length(html) as n_chars from pages")
def stored_pages(s: SparkSession, d: str) -> DataFrame:
    return TB.read_pages(s, f"{d}/pages.parquet").select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@registered(f"with {D.HISTORY_SQL} select alias, kind, coalesce(label, '') as label, cast(value as double) as value, strftime(ts, '%Y-%m-%d') as collected_date from obs")
def append_history(s: SparkSession, d: str) -> DataFrame:
    """The history appended by two batches to the shared folder, one of them twice, and read back."""
    h = D.history(s, d)
    table = TB.history_table(f"{G.shared_dir(s)}/offer-history-{uuid.uuid4().hex}", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in h.schema))
    TB.append_history(h.where("observed_at < '2024-01-15'"), table, 1)
    for _ in range(2):  # as after a failure: the second time adds nothing
        TB.append_history(h.where("observed_at >= '2024-01-15'"), table, 2)
    return table.read(s).select("alias", "kind", F.coalesce("category_label", F.lit("")).alias("label"), _d("value").alias("value"), F.date_format("observed_at", "yyyy-MM-dd").alias("collected_date"))


def _pages(s: SparkSession, d: str) -> DataFrame:
    """Merchant pages as they are stored: written to the shared folder and read again."""
    path = f"{G.shared_dir(s)}/stored-pages-{uuid.uuid4().hex}"
    _made_pages(s, d).write.parquet(path)
    return TB.read_pages(s, path)


def _made_pages(s: SparkSession, d: str) -> DataFrame:
    """Merchant pages of both layouts made of parts: rate = size mod 9 + 1 (% or, for every 8th, euros), every 5th boosted."""
    p, key = D.spread(D.parts(s, d)), F.col("p_partkey")
    rate, fixed = (F.col("p_size") % 9 + 1).cast("int"), key % 8 == 0
    shown, before = F.concat(rate, F.when(fixed, " €").otherwise("%")), F.when(fixed, "0,5 €").otherwise("0,5%")
    conditions = F.struct(F.array(F.struct(F.when(key % 9 == 0, "Hors Marketplace").alias("value"))).alias("conditionList"))
    described = F.struct(F.array(F.struct(shown.alias("value"), F.array(F.lit("Nouveaux clients"), F.col("p_type")).alias("descriptions")), F.struct(F.lit("12 €").alias("value"), F.array(F.lit("Marketplace")).alias("descriptions"))).alias("dynamic"), F.array(F.struct(F.when(key % 3 == 0, "Hors soldes.").alias("description"))).alias("static"))
    body = F.to_json(F.struct(F.lit("t").alias("metaTitle"), F.lit("r").alias("routeName"), F.col("p_name").alias("name"), F.concat(F.lit("http://www.m"), key, F.lit(".fr/x")).alias("url"), (key % 6 != 0).alias("isCashback"), (key % 4 == 0).alias("isVoucher"), (key % 5 == 0).alias("cashbackIsIncrease"), rate.alias("cashbackRate"), F.when(fixed, 2).otherwise(1).alias("cashbackType"), shown.alias("cashbackValue"), before.alias("cashbackBeforeIncreaseValue"), F.lit(3).alias("voucherCashbackRate"), described.alias("cashbackDescription"), conditions.alias("cashbackConditions")))
    state = F.to_json(F.map_from_arrays(F.array(F.lit("__nghData__"), F.concat(F.lit("k"), key)), F.array(F.struct(F.lit("x").alias("b")), F.struct(body.alias("b")))))
    html_a = F.when(key % 10 == 3, F.lit("<html>gone</html>")).otherwise(F.concat(F.lit('<script id="ng-state" type="application/json">'), state, F.lit("</script>")))
    number, sign = key + 1, F.when(fixed, "€").otherwise("%")
    shop = F.to_json(F.struct(number.alias("id"), F.col("p_name").alias("name"), (key % 7 != 0).alias("active"), F.struct(F.struct(rate.alias("amount"), sign.alias("currency"), (key % 5 == 0).alias("instead"), F.lit("0,5%").alias("insteadAmount")).alias("online"), F.struct(F.lit(2).alias("amount"), F.lit("%").alias("currency")).alias("ebon")).alias("channel")))
    phrases = F.to_json(F.array(F.concat(rate, sign, F.lit(" remboursés sur tout.")), F.lit("12€ remboursés au lieu de 8€ pour un nouveau client, hors marketplace")))
    payload = F.concat(F.lit('{"id":0,"channel":{"online":{}}},{"id":'), number + 1000000, F.lit(',"channel":{}},'), shop, F.lit(',"discounts":'), phrases, F.lit(',"more":[1]}'))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)
    half = (F.length(payload) / 2).cast("int")
    chunk = lambda c: F.concat(F.lit("self.__next_f.push([1,"), quoted(c), F.lit("])"))
    html_b = F.concat(F.lit("<script>"), chunk(F.substring(payload, F.lit(1), half)), F.lit("</script><script>"), chunk(F.substring(payload, half + 1, F.length(payload))), F.lit("</script>"))
    page = lambda provider, url, html: p.select(F.lit(provider).alias("provider"), key.alias("page"), url.alias("url"), html.alias("html"))
    return page("a", F.concat(F.lit("https://a.example/code-promo/x-"), key), html_a).unionByName(page("b", F.concat(F.lit("https://b.example/reduction-x-"), number), html_b))


def _offers_of(s: SparkSession, d: str, provider: str, parse: Callable) -> DataFrame:
    rows = P.observations(parse(_pages(s, d).where(F.col("provider") == provider)))
    return rows.select("page", "ordinal", _d("value").alias("value"), _d("value_base").alias("value_base"), "unit", "kind", F.coalesce("category_label", F.lit("")).alias("label"), "raw_text", "conditions_text", "is_upto", "is_new_customer_only", "is_sale_excluded", "is_marketplace_excluded", _d("effective_value").alias("effective_value"))


_RATE_SQL = "pt as (select p_partkey as page, p_size % 9 + 1 as rate, p_type, p_partkey % 8 = 0 as fixed, case when p_partkey % 8 = 0 then 'fixed_eur' else 'percent' end as unit from part)"


@registered(f"""with {_RATE_SQL}, ok as (select *, rate || case when fixed then ' €' else '%' end as shown, nullif(concat_ws(chr(10), case when page % 3 = 0 then 'Hors soldes.' end, case when page % 9 = 0 then 'Hors Marketplace' end), '') as told from pt where page % 10 <> 3)
select page, cast(0 as bigint) as ordinal, cast(rate as double) as value, case when page % 5 = 0 then cast(0.5 as double) end as value_base, unit, 'purchase' as kind, '' as label,
 '{{"cashbackValue":"' || shown || '","cashbackBeforeIncreaseValue":"' || case when fixed then '0,5 €' else '0,5%' end || '","label":"Nouveaux clients — ' || p_type || '"}}' as raw_text, told as conditions_text,
 true as is_upto, true as is_new_customer_only, case when page % 3 = 0 then true end as is_sale_excluded, case when page % 9 = 0 then true end as is_marketplace_excluded, cast(null as double) as effective_value from ok where page % 6 <> 0
union all select page, 1, rate, null, unit, 'category', 'Nouveaux clients — ' || p_type, shown || ' Nouveaux clients — ' || p_type, null, false, true, null, null, null from ok where page % 6 <> 0
union all select page, 2, 12, null, 'fixed_eur', 'category', 'Marketplace', '12 € Marketplace', null, false, false, null, null, null from ok where page % 6 <> 0
union all select page, case when page % 6 <> 0 then 3 else 0 end, 3, null, 'percent', 'giftcard', '', '3', null, false, false, null, null, null from ok where page % 4 = 0""")
def parse_page_a(s: SparkSession, d: str) -> DataFrame:
    return _offers_of(s, d, "a", P.parse_a)


@registered(f"""with {_RATE_SQL}, ok as (select * from pt where page % 7 <> 0)
select page, cast(0 as bigint) as ordinal, cast(rate as double) as value, case when page % 5 = 0 and not fixed then cast(0.5 as double) end as value_base, unit, 'purchase' as kind, '' as label,
 '{{"discount":null,"insteadAmount":"0,5%","label":"sur tout"}}' as raw_text, cast(null as varchar) as conditions_text, true as is_upto, false as is_new_customer_only, cast(null as boolean) as is_sale_excluded, true as is_marketplace_excluded, cast(rate as double) as effective_value from ok
union all select page, 1, rate, null, unit, 'category', 'sur tout', rate || case when fixed then '€' else '%' end || ' remboursés sur tout.', null, false, false, null, null, null from ok
union all select page, 2, 12, null, 'fixed_eur', 'category', 'pour un nouveau client, hors marketplace', '12€ remboursés au lieu de 8€ pour un nouveau client, hors marketplace', null, false, true, null, null, null from ok
union all select page, 3, 2, null, 'percent', 'giftcard', '', '2', null, false, false, null, null, null from ok""")
def parse_page_b(s: SparkSession, d: str) -> DataFrame:
    return _offers_of(s, d, "b", P.parse_b)


@registered("""select 'fetch_error' as kind, url, 'TimeoutError: page ' || page as error from (select 'https://a.example/code-promo/x-' || p_partkey as url, p_partkey as page from part union all select 'https://b.example/reduction-x-' || (p_partkey + 1), p_partkey from part) where page % 10 = 7
union all select 'parse_error', 'https://a.example/code-promo/x-' || p_partkey, 'no state on the page' from part where p_partkey % 10 = 3""")
def page_failures(s: SparkSession, d: str) -> DataFrame:
    """Pages that weren't fetched (every 10th), and pages without a state."""
    pages = _pages(s, d).withColumn("fetch_error", F.when(F.col("page") % 10 == 7, F.concat(F.lit("TimeoutError: page "), "page")))
    told = lambda c: F.get_json_object("payload", f"$.{c}").alias(c)
    return P.page_failures(P.parse_pages(pages)).select("kind", told("url"), told("error"))


@registered("""select 'a' as provider, p_partkey as page, case when p_partkey % 10 <> 3 then p_name end as page_name, case when p_partkey % 10 <> 3 then 'm' || p_partkey || '.fr' end as domain from part union all select 'b', p_partkey, p_name, null from part""")
def page_details(s: SparkSession, d: str) -> DataFrame:
    return P.parse_pages(_pages(s, d)).select("provider", "page", "page_name", T.domain_key(F.col("page_domain")).alias("domain"))
