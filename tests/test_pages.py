"""Pages of both layouts, sitemaps and appends, from pages written here."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from offerledger.operators import pages as P
from offerledger.sources import listing as L
from offerledger.sources import tables

SCHEMA = "provider string, raw_slug string, url string, html string"


def page_a(**shop):
    shop = {"metaTitle": "t", "routeName": "r", "cashbackRate": 4, "cashbackType": 1, "isCashback": True} | shop
    return f'<script id="ng-state" type="application/json">{json.dumps({"__nghData__": {"b": "x"}, "n1": 3, "k9": {"b": json.dumps(shop)}})}</script>'


def page_b(number, discounts=None, extra="", **channels):
    shop = {"id": number, "name": "B", "channel": channels}
    text = extra + json.dumps(shop, separators=(",", ":")).replace('"channel": ', '"channel":') + (',"discounts":' + json.dumps(discounts) if discounts else "")
    half = len(text) // 2
    return "".join(f"<script>self.__next_f.push([1,{json.dumps(part)}])</script>" for part in (text[:half], text[half:]))


def offers_of(spark, provider, html, url="https://b.example/reduction-x-7"):
    parsed = P.parse_pages(spark.createDataFrame([(provider, "x", url, html)], SCHEMA)).first()
    return parsed.error, [(o.kind, float(o.value), o.unit, o.category_label, None if o.value_base is None else float(o.value_base), o.is_upto, o.is_new_customer_only, o.is_marketplace_excluded, None if o.effective_value is None else float(o.effective_value)) for o in parsed.offers]


def test_page_a(spark):
    assert offers_of(spark, "a", page_a()) == (None, [("purchase", 4.0, "percent", None, None, False, False, None, 4.0)])
    boosted = page_a(cashbackIsIncrease=True, cashbackBeforeIncreaseValue="2,5%")
    assert offers_of(spark, "a", boosted)[1][0][4] == 2.5
    assert offers_of(spark, "a", page_a(cashbackIsIncrease=True, cashbackBeforeIncreaseValue="2 €"))[1][0][4] is None
    tiers = page_a(cashbackDescription={"dynamic": [{"value": "4%", "descriptions": ["Nouveaux clients", " "]}, {"value": "0%", "descriptions": ["Marketplace", "Livre"]}, {"value": "1% ou 2%", "descriptions": ["deux"]}]})
    assert offers_of(spark, "a", tiers)[1] == [("purchase", 4.0, "percent", None, None, True, True, True, None), ("category", 4.0, "percent", "Nouveaux clients", None, False, True, None, None), ("category", 0.0, "percent", "Marketplace — Livre", None, False, False, None, None)]
    voucher = page_a(isCashback=False, isVoucher=True, voucherCashbackRate=5.5, freeAmountMinValue=10, freeAmountMaxValue=250.5)
    assert offers_of(spark, "a", voucher)[1] == [("giftcard", 5.5, "percent", None, None, False, False, None, None)]
    row = P.parse_a(spark.createDataFrame([("a", "x", "u", voucher)], SCHEMA)).first()
    assert row.offers[0].conditions_text == "Bon d'achat de 10 à 250.5 €"
    assert offers_of(spark, "a", page_a(isCashback=False)) == (None, [])


@pytest.mark.parametrize("html", [None, "", "<html/>", page_a(cashbackType=9), page_a().replace("cashbackRate", "cashbackRat"), '<script id="ng-state">{"k": {"b": "{\\"cashbackRate\\": broken"}}</script>'])
def test_page_a_errors(spark, html):
    error, found = offers_of(spark, "a", html)
    assert error and not found


def test_page_b(spark):
    online = {"amount": 4.5, "currency": "%", "discount": "4,5%", "instead": True, "insteadAmount": "4,1%"}
    other = '{"id":8,"channel":{"online":{"amount":99,"currency":"%"}}},'
    assert offers_of(spark, "b", page_b(7, online=online, extra=other)) == (None, [("purchase", 4.5, "percent", None, 4.1, False, False, None, 4.5)])
    tiers = ["4,5% remboursés au lieu de 4,1% sur tout.", "11€ remboursés pour un nouveau client", "0% sur la marketplace", "gratuit"]
    got = offers_of(spark, "b", page_b(7, tiers, online=online, ebon={"amount": 3, "currency": "€"}))[1]
    assert [(x[0], x[1], x[2], x[3]) for x in got] == [("purchase", 4.5, "percent", None), ("category", 4.5, "percent", "sur tout"), ("category", 11.0, "fixed_eur", "pour un nouveau client"), ("category", 0.0, "percent", "sur la marketplace"), ("giftcard", 3.0, "fixed_eur", None)]
    assert got[0][5] and got[0][7]
    assert offers_of(spark, "b", page_b(7, ebon=None, online={"amount": 0, "currency": "%"})) == (None, [])
    long = page_b(7, online=online, extra="x" * 150_000 + other)
    assert offers_of(spark, "b", long)[1][0][1] == 4.5


def test_page_b_errors_and_unknown_platforms(spark):
    online = {"amount": 4, "currency": "%"}
    for html, url in ((None, "x"), ("<html/>", "https://b.example/reduction-x-7"), (page_b(8, online=online), "https://b.example/reduction-x-7"), (page_b(7, online=online), "https://b.example/other")):
        error, found = offers_of(spark, "b", html, url)
        assert error and not found
    assert offers_of(spark, "z", page_a())[0] == "unknown platform"


def test_sitemaps(spark, tmp_path):
    xml = '<?xml version="1.0"?><urlset xmlns="http://s"><url><loc> https://a.example/code-promo/1001-pneus </loc><lastmod>2024-01-02</lastmod></url><url><loc>https://a.example/categories</loc></url><url><loc>https://b.example/reduction-1001-bijoux-28/</loc></url></urlset>'
    entries = L.sitemap_entries(spark.createDataFrame([(xml,)], "xml string"))
    assert [(r.raw_slug, r.raw_name, r.lastmod) for r in L.listing_a(entries).collect()] == [("1001-pneus", "1001 Pneus", "2024-01-02")]
    assert [(r.raw_slug, r.raw_name) for r in L.listing_b(entries).collect()] == [("1001-bijoux-28", "1001 Bijoux")]
    (tmp_path / "m.xml").write_text(xml)
    assert {r["loc"].strip() for r in L.read_sitemap(spark, str(tmp_path / "m.xml")).collect()} == {"https://a.example/code-promo/1001-pneus", "https://a.example/categories", "https://b.example/reduction-1001-bijoux-28/"}
    (tmp_path / "seed.csv").write_text('﻿Slug, Marchand ,Domaine,Prio,Volume\nfnac,"Fnac, la",fnac.com,P1,10\n,x,,,\n')
    assert [(r.slug, r.name, r.domain) for r in L.read_seed(spark, str(tmp_path / "seed.csv")).collect()] == [("fnac", "Fnac, la", "fnac.com")]


def test_names_fall_back_to_the_listing(spark):
    listing = spark.createDataFrame([("a", "x", "Listed", None), ("b", "x", "Listed B", "l.fr")], "provider string, raw_slug string, raw_name string, raw_domain string")
    pages = spark.createDataFrame([("a", "x", "u", page_a(name="Shown", url="http://s.fr")), ("b", "x", "u", "<html/>")], SCHEMA)
    got = {r.provider: (r.raw_name, r.raw_domain) for r in P.with_listing(P.parse_pages(pages), listing).collect()}
    assert got == {"a": ("Shown", "http://s.fr"), "b": ("Listed B", "l.fr")}
    assert [json.loads(r.payload)["url"] for r in P.page_failures(P.parse_pages(pages)).collect()] == ["u"]


def test_history_in_parts_by_day(spark, tmp_path):
    """A history is added to and read by its days; a batch that is appended again adds nothing."""
    schema = "alias long, value int, observed_at timestamp"
    table = tables.history_table(str(tmp_path / "h"), schema)
    rows = lambda *days: spark.createDataFrame([(1, d, datetime(2024, 1, d)) for d in days], schema)
    for batch, days in ((1, (1, 2)), (2, (2, 3)), (2, (2, 3))):
        tables.append_history(rows(*days), table, batch)
    assert sorted(r.value for r in table.read(spark).collect()) == [1, 2, 2, 3]
    assert [r.value for r in table.read(spark, {"2024-01-03"}).collect()] == [3]


def test_pages_that_were_not_fetched(spark):
    """They aren't parsed, and their review tells the fetch error."""
    rows = [("a", "x", "u1", page_a(), None), ("a", "y", "u2", None, "TimeoutError: slow"), ("b", "z", "u3", "<html>", None), ("c", "w", "u4", "", "HTTPError: 500")]
    parsed = P.parse_pages(spark.createDataFrame(rows, SCHEMA + ", fetch_error string"))
    assert [(r.raw_slug, len(r.offers)) for r in parsed.where("error is null").collect()] == [("x", 1)]
    got = {(r.kind, tuple(json.loads(r.payload).values()), r.status) for r in P.page_failures(parsed).collect()}
    assert got == {("fetch_error", ("u2", "TimeoutError: slow"), "open"), ("parse_error", ("u3", "no payload on the page"), "open"), ("fetch_error", ("u4", "HTTPError: 500"), "open")}
    assert {r.raw_slug for r in P.observations(parsed).collect()} == {"x"}


def test_stored_files_and_tables(spark, tmp_path):
    (tmp_path / "p1.html").write_text("<p>é\n</p>", encoding="utf-8")
    (r,) = tables.read_page_files(spark, str(tmp_path / "p1.html")).collect()
    assert r.html == "<p>é\n</p>" and r.file.endswith("p1.html")
    items = spark.createDataFrame([("parse_error", "{}", "open")], "kind string, payload string, status string")
    for _ in range(2):
        tables.append_reviews(items, str(tmp_path / "reviews"))
    assert spark.read.parquet(str(tmp_path / "reviews")).count() == 2
    tables.write_table(items, str(tmp_path), "queue")
    assert tables.read_table(spark, str(tmp_path), "queue").collect() == items.collect()
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "provider string, n int")
    stored.write.parquet(str(tmp_path / "pages"))
    assert [r.n for r in tables.read_pages(spark, str(tmp_path / "pages"), "b").collect()] == [2]


def test_plans_of_the_parsers_stay_small(spark):
    pages = spark.createDataFrame([("a", "x", "u", page_a()), ("b", "x", "https://b.example/reduction-x-7", page_b(7, ["4% remboursés sur tout."], online={"amount": 4, "currency": "%"}))], SCHEMA)
    for parse in (P.parse_a, P.parse_b):
        plan = P.observations(parse(pages))._jdf.queryExecution().executedPlan().toString()
        assert len(plan) < 60_000
