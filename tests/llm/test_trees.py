"""The Merkle manifest, the mix of sources and ranked search against plain versions and their SQL."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from offerledger.llm import merkle, mixing, ranked_search
from pyspark.sql import functions as F
from tests.llm import cases

sha = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()


def rows_of(df):
    return df.select("doc_id", "source", "lang", "n_chars", "text").collect()


def leaf_of(r, text):
    fields = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def shrunk(nodes):
    """Levels of a tree, the nodes first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        out.append((run[: at % 16], run[at % 16 + 1 :]))
        at //= 16
    return out


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of each row, by definition."""
    by = defaultdict(list)
    for r in rows:
        by[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by[s], key=lambda x: x[:3]),) for s in order}
    trees = {s: (leaves, shrunk([x[2] for x in leaves])) for s, (leaves,) in trees.items()}
    top = shrunk([trees[s][1][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        leaves, levels = trees[s]
        for i, (_, _, leaf, r) in enumerate(leaves):
            path = siblings(levels, i) + siblings(top, k)
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            folded = leaf_of(r, r.text and r.text.translate(cases.LOWER)) if tampered else leaf
            for left, right in path:
                folded = sha(*left, folded, *right)
            out.append((r.doc_id, leaf, levels[-1][0], top[-1][0], sha(*(x for pair in path for side in pair for x in side)), folded, folded == top[-1][0]))
    return out


def proven(df):
    rows = merkle.verify(df, F.crc32(F.col("doc_id").cast("string")) % 5 == 0, {"text": F.translate("text", merkle._UPPER, merkle._LOWER)})
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows.collect()]


key = lambda row: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in row)


def test_manifest_of_odd_rows(spark):
    df = cases.odd_documents(spark)
    assert sorted(proven(df), key=key) == sorted(manifest(rows_of(df)), key=key)
    assert proven(cases.empty_documents(spark)) == []


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4096, 4097, 9000])
def test_manifest_of_sizes(spark, n):
    """A source of n rows, beside a lone one and 17 small ones (so that there are two levels above the subroots)."""
    text = F.concat(F.when(F.col("id") % 3 == 0, "Text ").otherwise("text "), "id")
    big = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("big").alias("source"), F.length(text).cast("long").alias("n_chars"))
    small = spark.range(50).select((F.col("id") + 100_000).alias("doc_id"), text.alias("text"), F.lit(None).cast("string").alias("lang"), F.when(F.col("id") > 0, F.concat(F.lit("s"), F.col("id") % 17)).alias("source"), F.lit(1).cast("long").alias("n_chars"))
    df = big.unionByName(small).repartition(7)
    got = proven(df)
    assert sorted(got) == sorted(manifest(rows_of(df)))
    assert {r[-1] for r in got} == {True, False}


def test_versions_copy_ancestors_alone(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("A").alias("text"), F.lit("x").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    rows = merkle.verify(df, F.col("doc_id") == 4321, {"text": F.lit("a")}).where("n_copied > 0").collect()
    assert [(r.doc_id, r.n_copied, r.verified) for r in rows] == [(4321, 4, False)]  # 5000, 313, 20, 2, 1
    with pytest.raises(ValueError):
        merkle.verify(df, F.lit(True), {"source": F.lit("t")})


def targets_of(sizes: dict):
    """Targets by sharing again and again what is above the limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        each = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if each * weight[s] > 2 * sizes[s] + 1e-9}
        for s in full or open_:
            out[s] = 2.0 * sizes[s] if full else each * weight[s]
            left -= out[s] if full else 0
        open_ -= full or open_
    return out


def mixed(df):
    docs = {}
    for r in df.select("doc_id", "text", "source").collect():
        docs.setdefault(r.doc_id, []).append((len(cases.WHITE.findall(r.text or "")), r.source))
    rows = mixing.taken_words(df).collect()
    sizes = Counter()
    for v in docs.values():
        for n, s in v:
            sizes[s] += n
    return docs, rows, sizes


def check_mix(df, near):
    docs, rows, sizes = mixed(df)
    want, taken = targets_of(sizes), Counter()
    assert len(rows) == sum(map(len, docs.values()))
    for r in rows:
        source = next(s for n, s in docs[r.doc_id] if n == r["size"] and sizes[s] == r.source_size)
        assert r.target == pytest.approx(want[source]) and 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= near, (s, taken[s], t)
    return rows


def test_mix_of_the_sample(spark):
    rows = check_mix(cases.documents(spark), mixing.BLOCK)
    again = mixing.taken_words(cases.documents(spark).repartition(9)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_of_odd_rows(spark):
    check_mix(cases.odd_documents(spark), mixing.BLOCK)
    assert mixing.taken_words(cases.empty_documents(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.target, r.taken) for r in mixing.taken_words(nothing).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_mix_of_a_hot_source_and_a_tiny_one(spark):
    """Several buckets of documents, several shards; a source at its limit takes each word twice."""
    words = F.repeat(F.lit("w "), (F.col("id") % 400 + 1).cast("int"))
    df = spark.range(9000).select(F.col("id").alias("doc_id"), words.alias("text"), F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "a").when(F.col("id") % 100 == 9, "z").alias("source"))
    rows = check_mix(df, mixing.BLOCK)
    full = [r for r in rows if r.target == 2 * r.source_size]
    assert full and all(r.taken == 2 * r["size"] for r in full)


def test_slots_of_the_mix(spark):
    """Shards are full, each block is taken once an epoch at most, and shards' shares are near the targets'."""
    _, plan, slots, _ = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", F.when(F.col("doc_id") % 3 == 0, "x").when(F.col("doc_id") % 3 == 1, "y").alias("source")))
    quota = {r.key: r.quota for r in plan.collect()}
    rows = slots.collect()
    assert Counter(r.key for r in rows) == quota and len({(r.key, r.epoch, r.block) for r in rows}) == len(rows)
    assert all(n == mixing.SHARD for s, n in Counter(r.shard for r in rows).items() if s < max(r.shard for r in rows))


def test_permutations_are_bijections(spark):
    for n in (1, 2, 3, 10, 97, 256):
        keys = F.transform(F.sequence(F.lit(1), F.lit(mixing.ROUNDS)), lambda r: mixing.number(F.lit("k"), r) % n)
        got = [r.p for r in spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), keys, F.lit("t")).alias("p")).orderBy("id").collect()]
        assert sorted(got) == list(range(n)) and (n < 10 or got != list(range(n)))


def ranked(docs, items, top=10):
    """item: [(doc_id, score)] by definition."""
    terms = lambda t: cases.ALNUM.findall((t or "").translate(cases.LOWER))
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    for item, text in items:
        found = []
        for doc, c in counts:
            m = 100 - 75 + ((75 * sum(c.values()) * n_docs) // total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, doc is not None, doc or 0))
        out[item] = [(d if known else None, -s) for s, known, d in sorted(found)[:top]]
    return {i: f for i, f in out.items() if f}


def searched(docs, items, **kind):
    out = defaultdict(list)
    for r in sorted(ranked_search.search(docs, items, **kind).collect(), key=lambda r: r["rank"]):
        out[r.item_id].append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return dict(out)


def test_search_of_the_sample(spark):
    items = spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    assert searched(cases.documents(spark), items) == ranked(list(cases.texts(spark).items()), [(r.item_id, r.text) for r in items.collect()])


def test_search_of_odd_rows(spark):
    docs = cases.odd_documents(spark)
    items = [(1, "wort1 wort1 WORT2 ünd3"), (2, "x"), (3, None), (4, " . "), (None, "some words more"), (5, "日本"), (6, "nowhere"), (7, "x y z one"), (8, "wort1 wort1 WORT2 ünd3")]
    frame = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    assert searched(docs, frame) == ranked([(r.doc_id, r.text) for r in docs.collect()], items)
    assert searched(cases.empty_documents(spark), frame) == {} and searched(docs, frame.where("false")) == {}


def test_search_in_parts(spark, monkeypatch):
    items = spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    whole = searched(cases.documents(spark), items, top=3)
    monkeypatch.setattr(ranked_search, "MAX_ITEMS", 7)
    assert searched(cases.documents(spark), items, top=3) == whole


def test_ties_and_many_copies(spark):
    docs = spark.createDataFrame([(i, "same words here" if i % 2 else "other words") for i in range(200)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "same words"), (2, "words")], "item_id long, text string")
    assert searched(docs, items) == ranked([(i, "same words here" if i % 2 else "other words") for i in range(200)], [(1, "same words"), (2, "words")])


def test_graph_shares_sums():
    """Random queries over few terms: the graph's sums are the queries' own, and beginnings are made once."""
    r = np.random.default_rng(5)
    queries = [Counter({int(t): int(r.integers(1, 3)) for t in r.choice(12, r.integers(0, 9), replace=False)}) for _ in range(60)]
    queries += [Counter({1: 1, 2: 1, 3: 1, 20 + i: 1}) for i in range(8)]
    graph = ranked_search.Graph(queries)
    adds = r.integers(0, 1000, (len(graph.terms), 5))
    want = np.array([sum((n * adds[np.searchsorted(graph.terms, np.uint64(t))] for t, n in q.items()), np.zeros(5, np.int64)) for q in queries])
    assert np.array_equal(graph.scores(adds), want)
    assert len(graph.node_atoms) < sum(len(q) for q in queries)
    assert len(ranked_search.Graph([Counter(), Counter()])) == 0


def test_best_keeps_smallest_ids_of_equal_scores():
    best = ranked_search.Best(1, 2)
    for doc, score in ((9, 5), (7, 5), (8, 5), (1, 4), (2, 6)):
        best.add(np.array([doc]), np.array([[score]]))
    assert list(zip(best.doc.tolist(), best.score.tolist(), strict=True)) == [(2, 6), (7, 5)]


@pytest.mark.parametrize("query", ["op11_merkle_manifest", "op12_source_mixing", "op13_ranked_search"])
def test_sql(spark, query):
    from offerledger.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{cases.SF}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[query])
    got = queries.queries()[query](spark, cases.SF).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


