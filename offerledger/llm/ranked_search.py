"""Ranked lexical search for many queries at once: shared term sets are evaluated once, and combined along a DAG.

The queries are mined for the terms that they share.  Terms that stand in exactly the same queries, equally often,
form one atom.  Each query is a sequence of its atoms, those of most queries first; sequences with equal beginnings share
a path of a prefix tree.  Where two queries part, the tree has a node: a shared set of terms, whose sum is made once
for all queries below.  So the nodes make a directed graph from few-term sums to whole queries, each adding to the
sum of the one above it.

Documents are met in two passes over their texts.  The first counts the documents, the terms and the query terms' document
frequencies.  The second takes blocks of documents: it holds what every query term adds to every document of the block,
sums the atoms (the partial accumulators of the block's documents), then node by node down the graph, and keeps each
query's TOP documents of all blocks of the task.  Tasks leave at most TOP rows a query, which are ranked in parts and
then in all.  Nothing is left out: every query meets every document.

Queries come in parts of at most MAX_ITEMS queries and MAX_CHARS characters (a longer one is a part of its own) with a
pass each, as a part's graph is broadcast.  Terms are compared by 64-bit hashes.

Cases: null and blank texts have no terms: such a document is never found and counts for nothing, such a query finds
nothing; of rows that repeat an item_id the smallest text is the query, and a null item_id is one, too; rows that repeat a
doc_id are documents of their own, and a null doc_id comes first of equal scores; a very long text is scored whole; an
empty table on either side gives an empty result; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerledger.llm import kernel, shared

TOP = 10
MAX_ITEMS = 2000
MAX_CHARS = 4_000_000
#: numbers of a block of documents in memory: query terms and graph nodes, times documents
CELLS = 4_000_000
#: parts in which the tasks' findings of a query are ranked first
PARTS = 64
_NULL = np.iinfo(np.int64).min
FOUND = "item long, doc_id long, score long"


def weight(n_docs: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency + 1)))


class Graph:
    """The shared term sets of a part of the queries, and how queries are made of them.

    terms: hashes, ascending.  atom_terms, atom_starts: the terms (by number) of each atom, one after another.
    Nodes come in levels: each has the node above it (itself at the top), and its own atoms with their repeats.
    The queries are the last nodes of their paths: of_item.
    """

    def __init__(self, queries: list[Counter]):
        holders = defaultdict(list)
        for q, terms in enumerate(queries):
            for term, repeats in terms.items():
                holders[term].append((q, repeats))
        self.terms = np.array(sorted(holders), np.uint64)
        number = {t: i for i, t in enumerate(self.terms.tolist())}
        alike = defaultdict(list)
        for term in self.terms.tolist():
            alike[tuple(holders[term])].append(number[term])
        atoms = sorted(alike.items(), key=lambda x: (-len(x[0]), x[1]))
        self.atom_terms = np.array([t for _, members in atoms for t in members], np.int64)
        self.atom_starts = np.cumsum([0, *(len(members) for _, members in atoms)])[:-1].astype(np.int64)
        paths: list[list[tuple[int, int]]] = [[] for _ in queries]
        for a, (held, _) in enumerate(atoms):  # by falling number of queries
            for q, repeats in held:
                paths[q].append((a, repeats))
        self._share(paths)

    def _share(self, paths: list[list[tuple[int, int]]]) -> None:
        """Nodes where the sorted paths part, and one where each path ends."""
        order = sorted(range(len(paths)), key=lambda q: paths[q])
        ends = [-1] * len(paths)
        nodes: list[tuple[int, int, list[tuple[int, int]]]] = []  # the level, the node above, the own atoms
        # Open nodes of the last path, each with its depth in atoms; the next path goes on from the deepest it shares.
        opened: list[tuple[int, int]] = [(-1, 0)]
        alike = [0, *(self._common(paths[a], paths[b]) for a, b in zip(order[:-1], order[1:], strict=True)), 0]
        for i, q in enumerate(order):
            path, common = paths[q], alike[i]
            if not path:
                continue
            while opened[-1][1] > common:
                opened.pop()
            # The beginnings that this path shares with later ones and not with the last one.
            depths, least, later = {len(path)}, len(path), i + 1
            while (least := min(least, alike[later])) > common:
                depths.add(least)
                later += 1
            for depth in sorted(depths):
                if depth > opened[-1][1]:
                    above, begin = opened[-1]
                    nodes.append((nodes[above][0] + 1 if above >= 0 else 0, above, path[begin:depth]))
                    opened.append((len(nodes) - 1, depth))
            ends[q] = opened[-1][0]
        rank = sorted(range(len(nodes)), key=lambda n: nodes[n][0])
        place = {n: i for i, n in enumerate(rank)}
        self.levels = np.searchsorted([nodes[n][0] for n in rank], np.arange(nodes[rank[-1]][0] + 2)) if nodes else np.zeros(1, np.int64)
        self.above = np.array([place.get(nodes[n][1], place[n]) for n in rank], np.int64)
        self.node_starts = np.cumsum([0, *(len(nodes[n][2]) for n in rank)])[:-1].astype(np.int64)
        self.node_atoms = np.array([a for n in rank for a, _ in nodes[n][2]], np.int64)
        self.node_repeats = np.array([r for n in rank for _, r in nodes[n][2]], np.int64)
        self.of_item = np.array([place.get(n, -1) for n in ends], np.int64)

    @staticmethod
    def _common(a: list, b: list) -> int:
        return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    def __len__(self) -> int:
        return len(self.above)

    def scores(self, adds: np.ndarray) -> np.ndarray:
        """Queries by documents: adds holds what each term adds to each document."""
        out = np.zeros((len(self.of_item), adds.shape[1]), np.int64)
        if not len(self):
            return out
        atoms = np.add.reduceat(adds[self.atom_terms], self.atom_starts, axis=0)
        own = np.add.reduceat(atoms[self.node_atoms] * self.node_repeats[:, None], self.node_starts, axis=0)
        for k in range(1, len(self.levels) - 1):
            level = slice(self.levels[k], self.levels[k + 1])
            own[level] += own[self.above[level]]
        held = self.of_item >= 0
        out[held] = own[self.of_item[held]]
        return out


class Best:
    """Each query's TOP documents so far, by falling score, then by rising doc_id."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.item, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.zeros(n_items, np.int64)

    def add(self, docs: np.ndarray, scores: np.ndarray) -> None:
        item, at = np.nonzero((scores > 0) & (scores >= self.least[:, None]))
        if not len(item):
            return
        item, doc, score = np.r_[self.item, item], np.r_[self.doc, docs[at]], np.r_[self.score, scores[item, at]]
        order = np.lexsort((doc, -score, item))
        item = item[order]
        first = np.searchsorted(item, item, side="left")
        rank = np.arange(len(item)) - first
        keep = rank < self.top
        self.item, self.doc, self.score = item[keep], doc[order][keep], score[order][keep]
        last = rank[keep] == self.top - 1
        self.least[self.item[last]] = self.score[last]


def _counted(batch: pa.RecordBatch, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each row; and of the given terms in it: row, number, occurrences."""
    words = kernel.Words(batch.column("text"), kernel.ALNUM, lower=True)
    if not len(terms) or not len(words.hashes):
        nothing = np.zeros(0, np.int64)
        return words.counts, nothing, nothing, nothing
    number = np.minimum(np.searchsorted(terms, words.hashes), len(terms) - 1)
    at = np.flatnonzero(terms[number] == words.hashes)
    row = np.searchsorted(words.rows, at, side="right") - 1
    key, times = np.unique(row * len(terms) + number[at], return_counts=True)
    return words.counts, key // len(terms), key % len(terms), times


def corpus_counts(texts: DataFrame, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms with repeats, and the document frequency of each given term.

    A task leaves a row per term; the driver gets as many rows as there are terms, which a part of the queries bounds.
    """
    sent = texts.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n_docs, n_terms = np.zeros(len(sent.value), np.int64), 0, 0
        for whole in batches:
            for batch in kernel.slices(whole):
                counts, _, number, _ = _counted(batch, sent.value)
                found += np.bincount(number, minlength=len(found))
                n_docs, n_terms = n_docs + int((counts > 0).sum()), n_terms + int(counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.arange(len(found)), -1, -2]), pa.array(np.r_[found, n_docs, n_terms])], ["term", "n"])

    rows = texts.select("text").mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    told = dict(zip(rows.column("term").to_pylist(), rows.column("n").to_pylist(), strict=True))
    sent.destroy()
    return told.get(-1, 0), told.get(-2, 0), np.array([told.get(i, 0) for i in range(len(terms))], np.int64)


def found_by(texts: DataFrame, graph: Graph, weights: np.ndarray, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """item (its number in the part), doc_id, score: the best documents of each query in each task."""
    sent = texts.sparkSession.sparkContext.broadcast((graph, weights))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights = sent.value
        best = Best(len(graph.of_item), top)
        step = max(1, CELLS // (len(graph.terms) + 2 * len(graph) + len(graph.of_item) + 1))
        for whole in batches:
            for batch in kernel.slices(whole):
                counts, row, number, times = _counted(batch, graph.terms)
                if not len(row):
                    continue
                ids = batch.column("doc_id").fill_null(_NULL).to_numpy(zero_copy_only=False)
                m = 25 + 75 * counts.astype(np.int64) * n_docs // n_terms
                add = weights[number] * (1_000_000_000 * times // (1000 * times + 8 * m[row]))
                for begin in range(0, len(ids), step):
                    low, high = np.searchsorted(row, [begin, begin + step])
                    adds = np.zeros((len(graph.terms), min(step, len(ids) - begin)), np.int64)
                    adds[number[low:high], row[low:high] - begin] = add[low:high]
                    best.add(ids[begin : begin + step], graph.scores(adds))
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.doc, mask=best.doc == _NULL), pa.array(best.score)], ["item", "doc_id", "score"])

    return texts.mapInArrow(work, FOUND)


def _queries(benchmark: DataFrame) -> Iterator[tuple[list[int | None], list[str]]]:
    """Parts of the queries, bounded in number and characters: ids and texts."""
    items = benchmark.where("text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    n_parts = max(1, -(-size["n"] // MAX_ITEMS), -(-size["chars"] // MAX_CHARS))
    for p in range(n_parts if size["n"] else 0):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n_parts)) == p).orderBy("item_id").toArrow()
        yield rows.column("item_id").to_pylist(), rows.column("text").to_pylist()


def _terms_of(texts: list[str]) -> list[Counter]:
    words = kernel.Words(pa.array(texts, pa.string()), kernel.ALNUM, lower=True)
    return [Counter(words.hashes[a:b].tolist()) for a, b in zip(words.rows[:-1], words.rows[1:], strict=True)]


def search(docs: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of every query (item_id, text) with a score above 0."""
    spark, texts, found = docs.sparkSession, shared.keyed_texts(docs), None
    for ids, items in _queries(queries):
        graph = Graph(_terms_of(items))
        n_docs, n_terms, frequency = corpus_counts(texts, graph.terms)
        weights = np.array([weight(n_docs, int(f)) for f in frequency], np.int64)
        part = shared.written(found_by(texts, graph, weights, n_docs, max(1, n_terms), top), "search-found")
        named = spark.createDataFrame(list(enumerate(ids)), "item long, item_id long")
        part = part.join(named, "item").select("item_id", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = [F.desc("score"), F.asc_nulls_first("doc_id")]
    some = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))).withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*best))).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best))).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))


_TERMS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""with d as (select row_number() over () as r, doc_id, {_TERMS_SQL} as t from documents where text is not null),
dn as (select r, doc_id, len(t) as n from d where len(t) > 0),
tot as (select count(*) as nn, cast(sum(n) as bigint) as ll from dn),
tf as (select r, term, count(*) as tf from (select r, unnest(t) as term from d) group by all),
qt as (select item_id, term, count(*) as reps from (select item_id, unnest({_TERMS_SQL}) as term from benchmark where text is not null) group by all),
df as (select term, count(*) as df from tf group by term),
w as (select term, cast(floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1)::double)) as bigint) as w from df, tot),
m as (select r, doc_id, 25 + (75 * n * nn) // ll as m from dn, tot),
s as (select item_id, r, cast(sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score from qt join w using (term) join tf using (term) join m using (r) group by item_id, r)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from s join m using (r) where score > 0 qualify rank <= 10"""
