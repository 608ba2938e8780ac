"""Batch resolution against a plain sequential loop; slugs, targets and seeds."""

from __future__ import annotations

import difflib
import time

import numpy as np
import pytest

from offerledger.functions import similarity
from offerledger.functions import text as T
from offerledger.operators import graph
from offerledger.operators import matching as M
from offerledger.operators import slugs
from offerledger.sources import listing as L

NAMES = ["alpha shop", "alpha", "alphas", "beta", "betas", "beta rings", "gamma", "gama", "gamma plus", "delta one", "delta two", "tide", "diet", "boutique", "shop"]


def normal(name: str) -> str:
    return " ".join(t for t in name.split() if t not in T.NOISE)


def resolved(merchants, aliases):
    known = [[i, normal(n), d, set(p)] for i, n, d, p in sorted(merchants)]
    out = {}
    for a, provider, name, domain in sorted(aliases):
        hit = next((m for m in known if domain and m[2] == domain), None)
        if hit:
            out[a] = ("review" if provider in hit[3] else "link", hit[0])
            if provider not in hit[3]:
                hit[3].add(provider)
            continue
        best, score = None, 0.0
        for m in known:
            if provider not in m[3] and (s := difflib.SequenceMatcher(None, normal(name), m[1]).ratio()) > score:
                best, score = m, s
        if score >= 0.92 and not (domain and best[2] and best[2] != domain):
            best[3].add(provider)
            out[a] = ("link", best[0])
        elif score >= 0.75:
            out[a] = ("review", best[0])
        else:
            known.append([-a, normal(name), domain, {provider}])
            out[a] = ("create", -a)
    return out


def test_resolution_equals_a_loop(spark):
    r = np.random.default_rng(11)
    for _ in range(3):
        merchants = [(i + 1, str(r.choice(NAMES)), f"d{i}.fr" if r.random() < 0.5 else None, [int(x) for x in np.unique(r.integers(0, 3, int(r.integers(0, 2))))]) for i in range(6)]
        aliases = [(i + 1, int(r.integers(0, 3)), str(r.choice(NAMES)) + str(r.choice(["", " x", "s", " fr"])), f"d{r.integers(0, 12)}.fr" if r.random() < 0.4 else None) for i in range(40)]
        m = spark.createDataFrame([(i, n, d, p) for i, n, d, p in merchants], "merchant_id long, name string, canonical_domain string, provider_ids array<int>")
        a = spark.createDataFrame(aliases, "alias long, provider_id int, raw_name string, raw_domain string")
        assert {x.alias: (x.action, x.merchant_id) for x in M.resolve_aliases(a, m).collect()} == resolved(merchants, aliases)


def test_decisions_tell_their_reason(spark):
    merchants = spark.createDataFrame([(1, "fnac", "Fnac", "fnac.com", [3]), (2, "darty", "Darty Services", "darty.fr", []), (3, "nature", "Nature Decouvertes", None, [])], "merchant_id long, slug string, name string, canonical_domain string, provider_ids array<int>")
    rows = [(1, 3, "Fnac Spectacles", "www.fnac.com/x"), (2, 4, "Fnac", "fnac.com"), (3, 4, "Darty Service", None), (4, 4, "Darty Service", "autre.fr"), (5, 4, "Nature et Decouverte", None), (6, 4, "Zebra", None)]
    aliases = spark.createDataFrame(rows, "alias long, provider_id int, raw_name string, raw_domain string")
    want = {
        1: ("review", 1, 1.0, "domaine fnac.com déjà rattaché pour cette plateforme"),
        2: ("link", 1, 1.0, "domaine fnac.com"),
        3: ("link", 2, 0.963, "nom proche de « Darty Services »"),
        4: ("review", 2, 0.963, "nom proche de « Darty Services » mais domaines différents (autre.fr / darty.fr)"),
        5: ("review", 3, 0.895, "nom ressemblant à « Nature Decouvertes »"),
        6: ("create", None, None, "aucun marchand correspondant"),
    }
    assert {r.alias: (r.action, r.merchant_id, r.confidence, r.reason) for r in M.decide(aliases, merchants).collect()} == want
    # One by one, in batches of their own, the replay says the same.
    for i in want:
        (r,) = M.resolve_aliases(aliases.where(f"alias = {i}"), merchants).collect()
        assert (r.action, r.confidence, r.reason) == (want[i][0], *want[i][2:]) and r.merchant_id == (want[i][1] or -i)
    queue = M.review_items(aliases.where("alias = 5").select(M.F.col("alias").alias("alias_id")), "merchant_match", "alias_id")
    counts = M.match_counts(aliases.withColumn("raw_slug", M.F.lit("s")), M.decide(aliases, merchants), queue)
    assert {r.action: r.n for r in counts.collect()} == {"link": 2, "create": 1, "review": 2}


def test_slugs_never_collide(spark):
    new = spark.createDataFrame([(1, "Nike"), (2, "Nike FR"), (3, "Nike 2"), (4, "nike"), (5, "!!"), (6, "Shop"), (7, "Nike")], "alias long, name string")
    taken = spark.createDataFrame([("nike",), ("nike-3",), ("marchand",)], "slug string")
    got = {r.alias: r.slug for r in slugs.allocate_slugs(new, taken).collect()}
    assert len(set(got.values()) | {"nike", "nike-3", "marchand"}) == 10 and got[5] == "marchand-2" and got[6] == "shop"


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501)], "a long, b long")
    assert {r.node: r.component for r in graph.components(edges).collect()} == {i: 0 for i in range(101)} | {500: 500, 501: 500}


def test_seed_and_targets(spark):
    raw = spark.createDataFrame([(0, " Fnac ", "Fnac", "www.fnac.com", "Culture", "p1", "1 200"), (1, "", "x", None, None, None, None), (2, "1001 Pneus", "1001 Pneus", "intranet", None, "P9", "12k"), (3, "new", "New", None, "A", "P2", "5")], "ordinal long, `﻿Slug` string, Marchand string, Domaine string, Categorie string, Prio string, Volume string")
    seed = L.seed_rows(raw)
    assert [tuple(r)[1:] for r in seed.orderBy("ordinal").collect()] == [("fnac", "Fnac", "fnac.com", "Culture", "P1", 1200), ("1001-pneus", "1001 Pneus", "intranet", None, None, None), ("new", "New", None, "A", "P2", 5)]
    merchants = spark.createDataFrame([(1, "old-fnac", "FNAC", "fnac.com", "c", "P3", 7, True), (2, "1001-pneus", "Pneus", "pneus.fr", "c", "P1", 9, False)], "merchant_id long, slug string, name string, canonical_domain string, category string, priority string, search_volume int, is_published boolean")
    got = {r.slug: r for r in M.seed_merchants(merchants, seed).collect()}
    assert (got["old-fnac"].name, got["old-fnac"].priority, got["old-fnac"].search_volume, got["old-fnac"].is_published) == ("Fnac", "P1", 1200, True)
    assert (got["1001-pneus"].canonical_domain, got["1001-pneus"].priority, got["1001-pneus"].search_volume) == ("pneus.fr", None, 9)
    assert got["new"].change == "created" and not got["new"].is_published

    listing = spark.createDataFrame([(0, "fnac-12", "FNAC France"), (1, "zzz", "Zzz"), (2, "oldfnac", "Other"), (3, "pneuss", "1001 Pneuss")], "ordinal long, raw_slug string, raw_name string")
    goals = spark.createDataFrame([("old-fnac", "Fnac", "P1"), ("1001-pneus", "1001 Pneus", "P2")], "slug string, name string, priority string")
    assert {r.ordinal: r.target for r in M.wanted(listing, goals).collect()} == {0: "old-fnac", 2: "old-fnac", 3: "1001-pneus"}


def test_best_match_tells_every_score(spark, monkeypatch):
    """The best of all candidates, below the threshold too; in one block and in several."""
    r = np.random.default_rng(8)
    name = lambda: " ".join(r.choice(["alpha", "beta", "zeta", "tide", "diet", "x", "omega"], int(r.integers(1, 4))))
    names, goals = sorted({name() + str(r.choice(["", "s", "qq"])) for _ in range(50)}) + ["0"], [(f"t{i:02}", name()) for i in range(25)]
    want = {}
    for n in names:
        score = {s: difflib.SequenceMatcher(None, normal(n), normal(g)).ratio() for s, g in goals}
        best = max(score.values())
        want[n] = (min(s for s in score if score[s] == best) if best >= 0.92 else None, best)
    a, c = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(goals, "slug string, name string")
    for size in (2000, 3):
        monkeypatch.setattr(similarity, "BLOCK", size)
        assert {x.name: (x.slug, x.score) for x in M.best_match(a, c).collect()} == want
    assert {x.score for x in M.best_match(a, c.where("false")).collect()} == {0.0}
    assert min(s for _, s in want.values()) < 0.5 and any(slug for slug, _ in want.values())


def test_seed_rows_that_meet(spark):
    """Rows meet in one merchant by domain and by slug, in file order; a later row finds what an earlier one made."""
    fields = "slug string, name string, domain string, category string, priority string, search_volume int"
    merchants = spark.createDataFrame([(1, "a", "A", "a.fr", "c", "P3", 7, True), (2, "b", "B", None, None, None, None, True), (3, "z", "Z", "z.fr", None, None, 1, False)], "merchant_id long, slug string, name string, canonical_domain string, category string, priority string, search_volume int, is_published boolean")
    rows = [("x", "X", "a.fr", "k", "P1", None), ("a", "A2", None, None, "P2", 9), ("n", "N", "n.fr", None, None, 3), ("n", "N2", None, "l", None, None), ("b", "B2", "b.fr", None, "P1", None), ("y", "Y", "b.fr", None, "P2", 4)]
    seed = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"ordinal long, {fields}")
    got = sorted((tuple(r) for r in M.seed_merchants(merchants, seed).collect()), key=repr)
    want = [(1, "a", "A2", "a.fr", None, "P2", 9, True, "updated"), (2, "b", "Y", "b.fr", None, "P2", 4, True, "updated"), (3, "z", "Z", "z.fr", None, None, 1, False, "kept"), (None, "n", "N2", "n.fr", "l", None, 3, False, "created")]
    assert got == sorted(want, key=repr)


def test_wanted_by_similar_names_and_empty_targets(spark):
    """Against all pairs; and a run without targets fails."""
    r = np.random.default_rng(2)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    name = lambda: " ".join(r.choice(words, 3))
    goals = [(f"t{i}", name(), f"P{i % 3 + 1}") for i in range(12)]
    listed = [(i, 0, f"l-{i}", f"{name()}{r.choice(['', 's', 'x y'])}") for i in range(60)]
    listing = spark.createDataFrame(listed, "ordinal long, provider_id int, raw_slug string, raw_name string")
    targets = spark.createDataFrame(goals, "slug string, name string, priority string")
    got = {x.ordinal for x in M.wanted(listing, targets).collect()}
    close = lambda a, b: difflib.SequenceMatcher(None, normal(a), normal(b)).ratio() >= 0.92
    want = {i for i, _, s, n in listed if any(n.replace(" ", "") == g.replace(" ", "") or close(n, g) for _, g, _ in goals)}
    assert got == want and len(want) >= 5
    linked = listing.where("ordinal in (1, 2)").select("provider_id", "raw_slug")
    assert {x.ordinal for x in M.cut_listing(listing, linked, M.wanted(listing, targets), targets=targets).collect()} == want | {1, 2}
    with pytest.raises(ValueError, match="seed"):
        M.cut_listing(listing, linked, M.wanted(listing, targets), targets=targets.where("false"))


def test_reviews_are_queued_once(spark):
    new = M.review_items(spark.createDataFrame([(1, None), (2, "é"), (3, None)], "alias_id long, note string"), "match", "alias_id", "note")
    assert {r.payload for r in new.collect()} == {'{"alias_id":1,"note":null}', '{"alias_id":2,"note":"é"}', '{"alias_id":3,"note":null}'}
    queue = new.where("payload like '%:2,%'").unionByName(new.where("payload like '%:3,%'").withColumn("status", M.F.lit("done")))
    assert {r.payload[:13] for r in M.queue_once(new, queue).collect()} == {'{"alias_id":1', '{"alias_id":3'}
    twice = new.unionByName(M.review_items(spark.createDataFrame([(1, "a"), (7, "z"), (7, "b")], "alias_id long, note string"), "match", "alias_id", "note"))
    none = M.review_items(spark.createDataFrame([("u",), ("u",)], "url string"), "parse_error", "url")
    got = sorted(r.payload for r in M.queue_once(twice.unionByName(none), queue).collect())
    assert got == sorted(['{"alias_id":1,"note":"a"}', '{"alias_id":3,"note":null}', '{"alias_id":7,"note":"b"}', '{"url":"u"}', '{"url":"u"}'])


def in_turn(rows, taken):
    """Slugs handed out one by one: the first free one of base, base-2, base-3 ..."""
    taken, out = set(taken), {}
    for alias, base in sorted(rows):
        slug, n = base, 2
        while slug in taken:
            slug, n = f"{base}-{n}", n + 1
        taken.add(slug)
        out[alias] = slug
    return out


def test_slugs_equal_a_loop_where_bases_meet(spark):
    """Names with numbers at their ends reach each other's slugs, over several lengths, in any order."""
    r = np.random.default_rng(2)
    names = [f"{x}{y}{z}" for x in ("nike", "a") for y in ("", " 2", " 3", " 5") for z in ("", " 2", " 3")]
    for trial in range(3):
        rows = [(i, names[int(k)]) for i, k in enumerate(r.integers(0, len(names), 150 if trial else 40))] + [(900, "nike"), (901, "nike 02"), (902, "nike 99999999999999999999")]
        taken = [] if not trial else [n.replace(" ", "-") for n in names if r.random() < 0.3] + ["nike-7", "a-4", "nike-99999999999999999999"]
        new = spark.createDataFrame(rows, "alias long, name string")
        got = {x.alias: x.slug for x in slugs.allocate_slugs(new, spark.createDataFrame([(t,) for t in taken], "slug string")).collect()}
        assert got == in_turn([(i, n.replace(" ", "-")) for i, n in rows], taken)


def test_slugs_of_one_name(spark):
    """As many rows of one base as there may be, and as many taken slugs of it."""
    new = spark.range(3000).select(M.F.col("id").alias("alias"), M.F.lit("Nike").alias("name"))
    taken = spark.range(2, 2000, 2).select(M.F.concat(M.F.lit("nike-"), "id").alias("slug"))
    got = {x.alias: x.slug for x in slugs.allocate_slugs(new, taken).collect()}
    assert got == in_turn([(i, "nike") for i in range(3000)], [f"nike-{i}" for i in range(2, 2000, 2)])


def test_few_names_are_compared(spark, monkeypatch):
    """Candidates are a small multiple of the pairs found, made once each; all scores take under a tenth of all pairs."""
    r = np.random.default_rng(12)
    word = lambda: "".join(r.choice(list("abcdefghilmnoprstuv"), int(r.integers(4, 9))))
    known = sorted({f"{word()} {word()}" for _ in range(400)})
    written = sorted({k + str(r.choice(["s", " fr", "x", " bis"])) for k in known} | {k[1:] for k in known[:100]} | {word() for _ in range(20)})
    a, b = (spark.createDataFrame([(n,) for n in x], "name string") for x in (written, known))
    for threshold in (0.92, 0.75):
        pairs = [tuple(x) for x in similarity.candidate_pairs(a, b, threshold).collect()]
        found = similarity.scored_pairs(a, b, threshold).count()
        assert len(pairs) == len(set(pairs)) and 0 < found <= len(pairs) <= 5 * found
    compared = []
    scored = similarity.scored_pairs
    monkeypatch.setattr(similarity, "scored_pairs", lambda x, y, t: (compared.append(similarity.candidate_pairs(x, y, t).count()), scored(x, y, t))[1])
    best = {x.l: x.score for x in similarity.best_scores(a, b).collect()}
    assert len(best) == len(written) and sum(compared) < len(written) * len(known) / 10
    some = written[::40]
    assert {n: best[n] for n in some} == {n: max(difflib.SequenceMatcher(None, n, k).ratio() for k in known) for n in some}


def test_resolution_of_many_aliases_of_one_name(spark):
    """Each third alias makes a merchant that the next two join; it isn't looked for among all merchants of the name (213 s before)."""
    n = 120_000
    aliases = spark.range(1, n + 1).select(M.F.col("id").alias("alias"), (M.F.col("id") % 3).cast("int").alias("provider_id"), M.F.lit("Fnac").alias("raw_name"), M.F.lit(None).cast("string").alias("raw_domain"))
    merchants = spark.createDataFrame([], "merchant_id long, name string, canonical_domain string, provider_ids array<int>")
    began = time.monotonic()
    got = {x.alias: (x.action, x.merchant_id) for x in M.resolve_aliases(aliases, merchants).collect()}
    assert got == {i: ("create" if i % 3 == 1 else "link", -(i - (i - 1) % 3)) for i in range(1, n + 1)}
    assert time.monotonic() - began < 60


def test_longer_resolution_equals_a_loop(spark):
    """Many merchants a name, platforms that come late, domains that lead into the midst of a name's merchants, and rows without names."""
    r = np.random.default_rng(5)
    names = [*NAMES[:9], "alpha xxl", "alphb"]
    for _ in range(2):
        merchants = [(i + 1, str(r.choice(names)), f"d{i}.fr" if r.random() < 0.3 else None, [int(x) for x in np.unique(r.integers(0, 4, int(r.integers(0, 3))))]) for i in range(12)]
        aliases = [(i + 1, int(r.integers(0, 2 + i // 150)), str(r.choice(names)), f"d{r.integers(0, 60)}.fr" if r.random() < 0.25 else None) for i in range(600)]
        m = spark.createDataFrame(merchants, "merchant_id long, name string, canonical_domain string, provider_ids array<int>")
        a = spark.createDataFrame([*aliases, (900, 0, None, None), (901, 0, None, "d900.fr"), (902, 1, None, "d900.fr")], "alias long, provider_id int, raw_name string, raw_domain string")
        want = resolved(merchants, aliases) | {900: ("create", -900), 901: ("create", -901), 902: ("link", -901)}
        assert {x.alias: (x.action, x.merchant_id) for x in M.resolve_aliases(a, m).collect()} == want
        assert {x[0] for x in want.values()} == {"link", "create", "review"}


def test_resolution_rounds_and_tells_as_the_loop_does(spark):
    """Half a thousandth goes to the even one, for an alias that is alone too; braces of a name stay as they are."""
    merchants = spark.createDataFrame([(1, "Abcdefghijklmnop", None, []), (2, "Zz{1}tt{2}uu", "a.fr", [])], "merchant_id long, name string, canonical_domain string, provider_ids array<int>")
    aliases = spark.createDataFrame([(1, 0, "abcdefghijklmxyz", None), (2, 0, "zz 1 tt 2 uu", "b.fr")], "alias long, provider_id int, raw_name string, raw_domain string")
    apart = "nom proche de « Zz{1}tt{2}uu » mais domaines différents (b.fr / a.fr)"
    assert {tuple(x) for x in M.resolve_aliases(aliases, merchants).collect()} == {(1, "review", 1, round(13 / 16, 3), "nom ressemblant à « Abcdefghijklmnop »"), (2, "review", 2, 1.0, apart)}
    assert {x.reason for x in M.decide(aliases, merchants).where("alias = 2").collect()} == {apart}
