"""Tables in parts, and whole passes over them: against the backfill and the full refresh."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest

from offerledger.operators import current as C
from offerledger.operators import history as H
from offerledger.operators import ledger as G
from offerledger.sources.parts import PartTable, bucket, touched
from pyspark.sql import functions as F

DAY = datetime(2024, 1, 1)


def pairs(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_parts_batch_by_batch(spark, tmp_path):
    table, part = PartTable(f"{tmp_path}/t", "k long, v long"), bucket("k", 8)
    frame = lambda *rows: spark.createDataFrame(list(rows), "k long, v long")
    assert pairs(table.read(spark)) == [] and table.commits(spark) == []
    table.append(frame(*((i, 0) for i in range(40))), part, 1)
    table.append(frame((100, 1)), part, 2)
    table.append(frame((100, 1)), part, 2)  # run again: nothing is added twice
    assert len(pairs(table.read(spark))) == 41 and pairs(table.read(spark, before=2)) == [(i, 0) for i in range(40)]
    some = touched(frame((3, 9)), part)
    kept = table.read(spark, some, 3).where("k <> 3").unionByName(frame((3, 9)))
    table.replace(kept, part, 3, some)
    assert (3, 9) in pairs(table.read(spark)) and (3, 0) not in pairs(table.read(spark)) and len(pairs(table.read(spark))) == 41
    assert pairs(table.written(spark, 2)) == [(100, 1)]
    table.replace(frame(), part, 4, some)  # a part may become empty
    assert not {k for k, _ in pairs(table.read(spark))} & {r[0] for r in pairs(kept)}
    before = pairs(table.read(spark))
    table.compact(spark, part, 5)
    assert pairs(table.read(spark)) == before and len(table.folders(spark)) == len({p for p, _ in table.folders(spark)})
    table.vacuum(spark, keep=1)
    assert pairs(table.read(spark)) == before and table.commits(spark) == [5]


def test_a_batch_without_a_commit_is_never_read(spark, tmp_path):
    table = PartTable(f"{tmp_path}/t", "k long, v long")
    table.append(spark.createDataFrame([(1, 1)], "k long, v long"), F.lit("all"), 1)
    spark.createDataFrame([(2, 2, "all")], "k long, v long, part string").write.partitionBy("part").parquet(f"{tmp_path}/t/rows/batch=2")
    assert pairs(table.read(spark)) == [(1, 1)]


def test_one_file_a_day_and_batch(spark, tmp_path):
    """Rows of a day lie together, whatever the number of tasks that made them."""
    table = PartTable(f"{tmp_path}/t", "k long, v long")
    table.append(spark.range(5000, numPartitions=9).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v")), F.col("v"), 1)
    assert len(table.read(spark).inputFiles()) == 3


def observations(spark, rows):
    kind = "alias long, provider_id int, run_id long, kind string, category_label string, value decimal(10,3), unit string, effective_value decimal(10,3), observed_at timestamp, ordinal long"
    df = spark.createDataFrame(rows, kind)
    have = set(df.columns)
    columns = [F.col(c.split()[0]) if c.split()[0] in have else F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in G.HISTORY.split(", ")]
    return df.select(*columns)


def simulated(batches: int, n_aliases: int, seed: int = 4):
    """Batches of (rows, aliases read)."""
    r, out = np.random.default_rng(seed), []
    for b in range(batches):
        at, rows, read = DAY + timedelta(days=b), [], sorted(r.choice(n_aliases, n_aliases // 2, replace=False).tolist())
        for alias in read:
            for n, (kind, label) in enumerate((("purchase", None), ("category", "x"), ("giftcard", None))):
                if r.random() < 0.6:
                    value = Decimal(int(r.integers(1, 4)))
                    rows.append((alias, alias % 3, b, kind, label, value, "percent" if alias % 2 else "fixed_eur", value if kind == "purchase" else None, at, n))
        out.append((at, rows, read))
    return out


def key(r):
    return (r.alias, r.kind, r.category_label or "", None if r.value is None else float(r.value), r.observed_at)


def test_twenty_batches_equal_the_backfill(spark, tmp_path):
    """Same history as all passes at once; the last batch reads the state's buckets of its own aliases alone."""
    ledger, every, passes = G.Ledger(str(tmp_path), buckets=16), [], []
    batches = simulated(20, 30)
    batches[-1] = (batches[-1][0], [r for r in batches[-1][1] if r[0] in (3, 4)], [3, 4])
    for b, (at, rows, read) in enumerate(batches, 1):
        pages = spark.createDataFrame([(a, at) for a in read], "alias long, observed_at timestamp")
        obs = observations(spark, rows)
        if b == 20:
            parts = touched(pages, ledger.by_alias())
            seen = ledger.state.read(spark, parts, b).inputFiles()
            whole = ledger.state.read(spark).inputFiles()
            assert 0 < len(seen) <= 2 < len(whole) and {f.rpartition("part=")[2].partition("/")[0] for f in seen} <= parts
        G.record_observations(ledger, obs, pages, b)
        if b == 7:  # a batch that is run again changes nothing
            G.record_observations(ledger, obs, pages, b)
        every.append(obs.withColumn("pass_at", F.col("observed_at")))
        passes += [(a, at) for a in read]
    from functools import reduce

    want = H.backfill(reduce(lambda a, b: a.unionByName(b), every), spark.createDataFrame(passes, "alias long, pass_at timestamp"))
    got = ledger.history.read(spark)
    assert sorted(map(key, got.collect()), key=repr) == sorted(map(key, want.collect()), key=repr)
    assert sorted(map(key, ledger.state.read(spark).collect()), key=repr) == sorted(map(key, H.latest(got).collect()), key=repr)
    rewritten = {p for p, f in ledger.state.folders(spark) if f.startswith("batch=20/")}
    assert rewritten <= touched(spark.createDataFrame([(3,), (4,)], "alias long"), ledger.by_alias())


def test_coverage_after_ten_passes_equals_the_full_refresh(spark, tmp_path):
    ledger = G.Ledger(str(tmp_path), buckets=8)
    merchants = spark.range(12).select(F.col("id").alias("merchant_id"), F.concat(F.lit("m"), "id").alias("slug"))
    aliases = {a: DAY for a in range(30)}
    for b, (at, rows, read) in enumerate(simulated(10, 30, seed=9), 1):
        pages = spark.createDataFrame([(a, at) for a in read], "alias long, observed_at timestamp")
        G.record_observations(ledger, observations(spark, rows), pages, b)
        aliases |= dict.fromkeys(read, at)
        mine = spark.createDataFrame([(a, None if a % 11 == 0 else a % 10, a % 3, aliases[a]) for a in read], "alias long, merchant_id long, provider_id int, last_checked_at timestamp")
        G.coverage_merged(ledger, mine, b)
    table = spark.createDataFrame([(a, None if a % 11 == 0 else a % 10, a % 3, t) for a, t in aliases.items()], "alias long, merchant_id long, provider_id int, last_checked_at timestamp")
    every = C.offer_current_all(ledger.history.read(spark).drop("provider_id"), table)
    want = C.merchant_coverage(merchants, C.offer_current(every), every)
    got = G.coverage(ledger, merchants).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def state_page(name: str, rate, tiers=()):
    body = {"metaTitle": "t", "routeName": "r", "name": name, "url": f"https://www.{name.lower()}.fr/x", "isCashback": rate is not None, "isVoucher": False, "cashbackRate": rate or 0, "cashbackType": 1, "cashbackValue": f"{rate}%", "cashbackDescription": {"dynamic": [{"value": v, "descriptions": [d]} for v, d in tiers], "static": []}}
    return f'<script id="ng-state" type="application/json">{json.dumps({"k": {"b": json.dumps(body)}})}</script>'


def a_pass(spark, ledger, batch, provider_id, day, pages):
    """pages: slug -> html, or an exception's text."""
    at = DAY + timedelta(days=day)
    rows = [("a", slug, i, f"https://a.example/code-promo/{slug}", html if html.startswith("<") else None, at, None if html.startswith("<") else html) for i, (slug, html) in enumerate(pages.items())]
    df = spark.createDataFrame(rows, "provider string, raw_slug string, page long, url string, html string, observed_at timestamp, fetch_error string")
    listing = df.select("provider", "raw_slug", F.col("raw_slug").alias("raw_name"), F.lit(None).cast("string").alias("raw_domain"))
    G.collect(ledger, df, listing, provider_id, batch, at, at + timedelta(minutes=5))


def test_whole_passes(spark, tmp_path):
    """History, touches, upserts, reviews, run rows, matching and publication, as a sequence of passes leaves them."""
    ledger = G.Ledger(str(tmp_path), buckets=4)
    first = {"nike": state_page("Nike", 5), "zara": state_page("Zara", 2, [("2%", "Tout"), ("3%", "Neuf")]), "none": state_page("Empty", None), "bad": "<html>gone</html>", "slow": "TimeoutError: slow"}
    a_pass(spark, ledger, 2, 1, 0, first)
    runs = {r.run_id: r for r in ledger.runs.read(spark).collect()}
    assert (runs[2].status, runs[2].urls_fetched, runs[2].offers_found, runs[2].offers_written, runs[2].errors_count, runs[2].pages_empty) == ("partial", 5, 4, 4, 2, 1)
    reviews = [(r.kind, json.loads(r.payload)["url"][-4:]) for r in ledger.reviews.read(spark).collect()]
    assert sorted(reviews) == [("fetch_error", "slow"), ("parse_error", "/bad")]
    aliases = {r.raw_slug: r for r in ledger.aliases.read(spark).collect()}
    assert set(aliases) == {"nike", "zara"} and aliases["nike"].raw_name == "Nike" and aliases["nike"].confidence == 1.0
    merchants = {r.slug: r for r in ledger.merchants.read(spark).collect()}
    assert set(merchants) == {"nike", "zara"} and all(m.is_published for m in merchants.values()) and merchants["nike"].canonical_domain == "nike.fr"
    # The same merchant on another platform is linked by its domain; the first pass changes nothing there.
    a_pass(spark, ledger, 4, 2, 1, {"nike-shop": state_page("Nike", 6)})
    aliases = {(r.provider_id, r.raw_slug): r for r in ledger.aliases.read(spark).collect()}
    assert aliases[2, "nike-shop"].merchant_id == merchants["nike"].merchant_id and len({a.alias for a in aliases.values()}) == 3
    # A page without offers closes those of a known alias; an unread one closes nothing; an unchanged one adds nothing.
    second = {"nike": state_page("Nike", 5), "zara": state_page("Zara", None), "new": state_page("New", 1)}
    for _ in range(2):  # the second time as after a failure
        a_pass(spark, ledger, 6, 1, 2, second)
        runs = {r.run_id: r for r in ledger.runs.read(spark).collect()}
        assert (runs[6].status, runs[6].offers_found, runs[6].offers_written, runs[6].pages_empty) == ("ok", 2, 4, 1)
        closed = sorted((r.kind, r.category_label or "") for r in ledger.history.read(spark).where("value is null").collect())
        assert closed == [("category", "Neuf"), ("category", "Tout"), ("purchase", "")]
        aliases = {(r.provider_id, r.raw_slug): r for r in ledger.aliases.read(spark).collect()}
        assert aliases[1, "nike"].last_checked_at == DAY + timedelta(days=2) and aliases[2, "nike-shop"].last_checked_at == DAY + timedelta(days=1)
        assert {m.slug for m in ledger.merchants.read(spark).collect()} == {"nike", "zara", "new"}
    now = {(r.alias, r.kind): float(r.value) for r in G.current_all(ledger, spark).collect()}
    assert sorted(now.values()) == [1.0, 5.0, 6.0]
    cover = {r.slug: (r.n_platforms, r.n_offers) for r in G.coverage(ledger, ledger.merchants.read(spark)).collect()}
    assert cover == {"nike": (2, 2), "zara": (0, 0), "new": (1, 1)}
    G.failed_run(ledger, spark, 1, 8, DAY, DAY, "no target")
    assert {r.run_id: r.status for r in ledger.runs.read(spark).collect()}[8] == "failed"


def test_numbers_go_on(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    assert sorted(r.number for r in G.numbered(df, 7, "k").collect()) == list(range(8, 1008))
    with pytest.raises(Exception):
        G.numbered(df, 7, "missing").collect()


def test_pages_as_a_stream(spark, tmp_path):
    """Two files of pages are two passes; the query goes on where it stopped, and one without news adds nothing."""
    ledger, kind = G.Ledger(f"{tmp_path}/ledger", buckets=4), "alias long, provider_id int, provider string, url string, html string, observed_at timestamp"
    from offerledger.streaming.passes import append_passes

    def run():
        pages = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/pages")
        append_passes(pages, ledger, f"{tmp_path}/checkpoint").awaitTermination(120)

    def arrive(day, **html):
        rows = [(int(a[1:]), 1, "a", "u", h, DAY + timedelta(days=day)) for a, h in html.items()]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/pages")

    arrive(0, p1=state_page("Nike", 5), p2=state_page("Zara", 2))
    run()
    arrive(1, p1=state_page("Nike", 5), p2=state_page("Zara", None), p3="<html>gone</html>")
    run()
    run()
    rows = [(r.alias, r.kind, None if r.value is None else float(r.value), r.run_id) for r in ledger.history.read(spark).collect()]
    assert sorted(rows, key=repr) == sorted([(1, "purchase", 5.0, 1), (2, "purchase", 2.0, 1), (2, "purchase", None, 2)], key=repr)
    assert [r.kind for r in ledger.reviews.read(spark).collect()] == ["parse_error"]
