"""Column functions from literals, and the exact accent form on every Latin letter."""

from __future__ import annotations

import difflib
import unicodedata
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerledger.functions import offers, similarity
from offerledger.functions import text as T


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("text,want", [("3,2 %", [("3.200", "percent")]), ("2%6%", [("2.000", "percent"), ("6.000", "percent")]), ("31€62€", [("31.000", "fixed_eur"), ("62.000", "fixed_eur")]), ("5 % ou 12 euros", [("5.000", "percent"), ("12.000", "fixed_eur")]), ("1 234€", [("234.000", "fixed_eur")]), ("12345%", []), ("rien", []), ("7 eurosx", []), ("", [])])
def test_amounts(spark, text, want):
    assert [(str(x.value), x.unit) for x in one(spark, T.extract_amounts(F.col("t")), t=text)] == want


@pytest.mark.parametrize("text,want", [("3 € à l'inscription en bon d'achat", "signup_bonus"), ("10% en bon d'achat", "giftcard"), ("bon d’achat", "purchase"), ("Prime de BIENVENUE", "signup_bonus"), ("Carte cadeau", "giftcard"), ("4%", "purchase")])
def test_classify(spark, text, want):
    assert one(spark, T.classify(F.col("t")), t=text) == want


def test_accents_are_exact(spark):
    points = [c for c in (*range(0xA0, 0x250), *range(0x1E00, 0x2000), *range(0x2460, 0x2474), *range(0xFF01, 0xFF5F)) if chr(c).strip() and (c < 0x2460 or len(unicodedata.normalize("NFKD", chr(c))) == 1 or c < 0x250)]
    rows = spark.createDataFrame([(chr(c),) for c in points] + [("™ é œ ’ ﬁ",)], "t string").select("t", T.strip_accents(F.col("t")).alias("x")).collect()
    for r in rows:
        assert r.x == "".join(c for c in unicodedata.normalize("NFKD", r.t) if not unicodedata.combining(c)), r.t


def test_names_and_domains(spark):
    cases = {"Nike FR": "nike", "Nike.com": "nike", "La Boutique en ligne": "la", "1001 Pneus": "1001 pneus", "Boutique": "", "Café Café": "cafe cafe"}
    for raw, want in cases.items():
        assert one(spark, T.normalize_name(F.col("t")), t=raw) == want
    domains = {"https://boutique.orange.fr/x": "orange.fr", "www.a.co.uk": "a.co.uk", "http://x.gouv.fr:80/": "x.gouv.fr", "localhost": None, "": None, "a.b.com.br": "b.com.br", " WWW.Zalando.FR ": "zalando.fr", None: None}
    for raw, want in domains.items():
        assert one(spark, T.domain_key(F.col("t")), t=raw) == want
    assert one(spark, T.slugify(F.col("t")), t="--Ça & Là!!") == "ca-la"
    assert [one(spark, T.to_decimal(F.col("t")), t=x) for x in ("3,2", "x", "7.2")] == [Decimal("3.200"), None, Decimal("7.200")]


def test_offer_from_text(spark):
    read = lambda t, **k: one(spark, offers.offer_from_text(F.col("t"), **{a: F.lit(b) for a, b in k.items()}), t=t)
    o = read("jusqu'à 6% au lieu de 2% hors soldes")
    assert (o.value, o.value_base, o.is_upto, o.is_sale_excluded, o.is_marketplace_excluded, o.effective_value) == (Decimal(6), Decimal(2), True, True, None, Decimal(6))
    assert read("rien du tout") is None
    assert read("2% puis 5€").value == 2 and read("2% puis 5€").value_base is None
    o = read("8%", label="Livres")
    assert o.kind == "category" and o.effective_value is None
    o = read("8%", conditions="nouveaux clients seulement, hors marketplace")
    assert o.is_new_customer_only and o.is_marketplace_excluded and o.effective_value is None
    o = read("texte 9%", current="3%", base="1%")
    assert (o.value, o.value_base) == (3, 1)
    assert read("5 € offert à l'inscription").effective_value is None


def test_similarity_pairs_lose_none(spark):
    r = np.random.default_rng(1)
    names = sorted({"".join(r.choice(list("abc"), int(n))) for n in r.integers(0, 9, 120)} | {"tide", "diet", "", "nike air", "nike"})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for threshold in (0.75, 0.92):
        want = {(a, b): s for a in names for b in names if (s := difflib.SequenceMatcher(None, a, b).ratio()) >= threshold}
        got = {(x.l, x.r): x.score for x in similarity.scored_pairs(df, df, threshold).collect()}
        assert got == want
