"""Benchmark decontamination: documents that hold a benchmark item, word for word or nearly.

Words are runs of letters, digits and non-ASCII characters of the lower-cased text.  Windows of a
document that are as long as an item (in words) get a 64-bit SimHash of their weighted 5-word
shingles.  A multi-index over four 16-bit blocks of the items' fingerprints, with all block values
within RADIUS // 4 bits, returns every item within RADIUS bits of a window; candidates are then
verified by the exact weighted Jaccard similarity of the shingle multisets, SIMILARITY or more.
A shingle weighs ln(1 + items / items that hold it).

Only windows are hashed whose shingles from the benchmark weigh enough for the lightest item of that
length to reach SIMILARITY (the bound loses nothing).  The items are broadcast in parts of at most
MAX_ITEMS items and MAX_CHARS characters; a larger benchmark takes several parts, each over all documents,
built, broadcast and released one at a time.  Weights are those of the whole benchmark in every part: a
shingle that one item holds weighs as much as one that none does, so each part carries, besides its own,
only the shingles that several items hold.  The rows don't depend on the parts.

An item of under five words is one shingle, its whole word sequence: windows of its length either equal it
(similarity 1) or have nothing in common with it, so it is looked for by the hash of that sequence.

Cases: null and empty texts hold nothing; null items and items without words are not looked for;
repeated items are items of their own; an item is reported once per document row, at its most similar,
then first, window; rows with a null doc_id keep it; repeated rows are searched each; a very long text is searched
whole; without documents or without items nothing is found and all rows stay; other columns, whatever their names,
are not looked at and stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.llm import kernel, shared

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
MAX_ITEMS = 4000
MAX_CHARS = 8_000_000
#: starts of windows of a text that are hashed at once
SLICE = 1 << 14
_BITS = np.arange(64, dtype=np.uint64)


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each shingle hash."""
    return ((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.float64) * 2 - 1


def fingerprint(sums: np.ndarray) -> np.ndarray:
    """Bits set where the weighted sum is positive."""
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=-1, dtype=np.uint64)


class Benchmark:
    """Items, the weights of their shingles and the multi-index of their fingerprints."""

    def __init__(self, ids: list[int], texts: list[str], k: int = SHINGLE, radius: int = RADIUS, similarity: float = SIMILARITY, whole: tuple[int, np.ndarray, np.ndarray] | None = None):
        """whole: items of the whole benchmark, its shingles of two or more items, and by how many they are held."""
        self.k, self.radius, self.similarity = k, radius, similarity
        words = kernel.Words(pa.array(texts, pa.string()), kernel.ALNUM, lower=True)
        grams, _ = words.grams(k)
        long_enough = np.flatnonzero(words.counts >= k)
        short = np.flatnonzero((words.counts > 0) & (words.counts < k))
        self.ids = [ids[i] for i in (*long_enough, *short)]
        self.lengths = words.counts[np.r_[long_enough, short]]
        long_lengths = words.counts[long_enough]
        #: by length: hashes of the short items, ascending, and their numbers
        self.short = {}
        for m in np.unique(words.counts[short]).tolist():
            at = np.flatnonzero(words.counts[short] == m)
            value = words.grams(m)[0][words.rows[short[at]]]
            order = np.argsort(value, kind="stable")
            self.short[m] = (value[order], len(long_enough) + at[order])
        self.items = [grams[words.rows[i] : words.rows[i + 1] - k + 1] for i in long_enough]
        holders = Counter(s for item in self.items for s in np.unique(item).tolist())
        self.shingles = np.array(sorted(holders), np.uint64)
        n, common, counts = whole or (len(self.items), self.shingles, np.array([holders[s] for s in sorted(holders)], float))
        n = max(n, 1)
        self.foreign = float(np.log(1 + n))
        self.known = np.union1d(self.shingles, common)
        self.own = np.isin(self.known, self.shingles)
        self.weights = np.full(len(self.known), self.foreign)
        self.weights[np.searchsorted(self.known, common)] = np.log(1 + n / counts)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.totals = np.array([self.weigh(item)[0].sum() for item in self.items])
        self.prints = np.array([fingerprint((signs(item) * self.weigh(item)[0][:, None]).sum(axis=0)) for item in self.items], np.uint64)
        self.lightest = {int(m): float(self.totals[long_lengths == m].min()) for m in np.unique(long_lengths)}
        at, owner = self.postings()
        self.lengths_at, self.at = at, owner
        self.blocks = [self._block(b) for b in range(4)]

    def weigh(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each shingle, and whether an item of this part holds it."""
        if not len(self.known):
            return np.full(len(shingles), self.foreign), np.zeros(len(shingles), bool)
        maybe = self.filter[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)]
        weight, held = np.full(len(shingles), self.foreign), np.zeros(len(shingles), bool)
        some = np.flatnonzero(maybe)
        place = np.minimum(np.searchsorted(self.known, shingles[some]), len(self.known) - 1)
        same = self.known[place] == shingles[some]
        held[some[same]] = self.own[place[same]]
        weight[some[same]] = self.weights[place[same]]
        return weight, held

    def postings(self) -> tuple[np.ndarray, np.ndarray]:
        """For each known shingle the distinct lengths of the items that hold it, as offsets and lengths."""
        pairs = sorted({(s, int(m)) for item, m in zip(self.items, self.lengths) for s in item.tolist()})
        owner = np.array([m for _, m in pairs], np.int64)
        at = np.searchsorted(np.array([s for s, _ in pairs], np.uint64), self.shingles) if pairs else np.zeros(0, np.int64)
        return np.r_[at, len(pairs)], owner

    def _block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Items by every value of a 16-bit block that is within radius // 4 bits of theirs."""
        masks = np.array([sum(1 << i for i in c) for r in range(self.radius // 4 + 1) for c in combinations(range(16), r)], np.int64)
        own = ((self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
        value = (own[:, None] ^ masks[None, :]).ravel()
        item = np.repeat(np.arange(len(own)), len(masks))
        order = np.argsort(value, kind="stable")
        return np.searchsorted(value[order], np.arange(0x10001)), item[order].astype(np.int32)

    def within(self, print_: int) -> np.ndarray:
        """Every item whose fingerprint is within radius bits."""
        found = []
        for b, (at, item) in enumerate(self.blocks):
            v = (print_ >> (16 * b)) & 0xFFFF
            found.append(item[at[v] : at[v + 1]])
        near = np.unique(np.concatenate(found))
        return near[np.bitwise_count(self.prints[near] ^ np.uint64(print_)) <= self.radius]

    def likeness(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of two shingle multisets."""
        values, inverse = np.unique(np.concatenate([window, self.items[item]]), return_inverse=True)
        a = np.bincount(inverse[: len(window)], minlength=len(values))
        b = np.bincount(inverse[len(window) :], minlength=len(values))
        w = self.weigh(values)[0]
        return float((np.minimum(a, b) * w).sum() / (np.maximum(a, b) * w).sum())

    def search(self, grams: np.ndarray, weight: np.ndarray, held: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item number, first word, bits apart, similarity) for the items in a document's shingles."""
        k, n = self.k, len(grams)
        hits = np.flatnonzero(held)
        known = np.searchsorted(self.shingles, grams[hits])
        lengths = {int(m) for p in known for m in self.at[self.lengths_at[p] : self.lengths_at[p + 1]]}
        from_items = np.r_[0, np.cumsum(np.where(held, weight, 0))]
        windows, best = [], {}
        for m in sorted(lengths):
            size = m - k + 1
            if size <= n:
                starts = np.flatnonzero(from_items[size:] - from_items[: n - size + 1] >= self.similarity * self.lightest[m] - 1e-9)
                if len(starts):
                    windows.append((m, size, starts))
        # Sums of signs take 64 numbers a shingle, so a long text is hashed slice by slice.
        for begin in range(0, n, SLICE):
            here = [(m, size, starts[slice(*np.searchsorted(starts, [begin, begin + SLICE]))]) for m, size, starts in windows]
            here = [x for x in here if len(x[2])]
            if not here:
                continue
            low, high = min(int(x[2][0]) for x in here), max(int(x[2][-1]) + x[1] for x in here)
            sums = np.zeros((high - low + 1, 64))
            np.cumsum(signs(grams[low:high]) * weight[low:high, None], axis=0, out=sums[1:])
            for m, size, starts in here:
                prints = fingerprint(sums[starts + size - low] - sums[starts - low])
                for s, p in zip(starts.tolist(), prints.tolist(), strict=True):
                    for item in self.within(p):
                        if self.lengths[item] == m and (like := self.likeness(grams[s : s + size], item)) >= self.similarity and like > best.get(int(item), (0, 0, 0.0))[2]:
                            best[int(item)] = (s, int(self.prints[item] ^ np.uint64(p)).bit_count(), like)
        return [(item, *found) for item, found in sorted(best.items())]

    def leaks(self, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, int, float]]]]:
        """(row, findings) of the rows of a text column that hold an item."""
        words = kernel.Words(column, kernel.ALNUM, lower=True)
        grams, whole = words.grams(self.k)
        weight, held = self.weigh(grams)
        held &= whole
        brief = self.short_ones(words)
        for row in np.union1d(np.unique(words.of_row()[held]), np.array(sorted(brief), np.int64)).tolist():
            at = slice(words.rows[row], max(words.rows[row], words.rows[row + 1] - self.k + 1))
            found = self.search(grams[at], weight[at], held[at]) if held[at].any() else []
            if found := found + brief.get(row, []):
                yield row, found

    def short_ones(self, words: kernel.Words) -> dict[int, list[tuple[int, int, int, float]]]:
        """Row: findings of the items that are shorter than a shingle, at their first place."""
        found: dict[int, dict[int, int]] = {}
        for m, (value, item) in self.short.items():
            grams, whole = words.grams(m)
            low, high = np.searchsorted(value, grams, side="left"), np.searchsorted(value, grams, side="right")
            for at in np.flatnonzero(whole & (low < high)).tolist():
                row = int(np.searchsorted(words.rows, at, side="right")) - 1
                for i in item[low[at] : high[at]].tolist():
                    found.setdefault(row, {}).setdefault(i, at - int(words.rows[row]))
        return {row: [(i, start, 0, 1.0) for i, start in sorted(items.items())] for row, items in found.items()}


def _shingles_of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct shingle of each item, and a null for the item itself."""
    for whole in batches:
        for batch in kernel.slices(whole):
            words = kernel.Words(batch.column("text"), kernel.ALNUM, lower=True)
            grams, _ = words.grams(SHINGLE)
            items = [np.unique(grams[words.rows[i] : words.rows[i + 1] - SHINGLE + 1]) for i in np.flatnonzero(words.counts >= SHINGLE)]
            if items:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(kernel.as_long(np.concatenate(items))), pa.nulls(len(items), pa.int64())])], ["shingle"])


def shared_shingles(items: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """How many items there are, the shingles that two or more hold, ascending, and by how many each is held."""
    counted = items.select("text").mapInArrow(_shingles_of_items, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1 or shingle is null").toArrow()
    shingle, n = counted.column("shingle").combine_chunks(), np.asarray(counted.column("n")).astype(float)
    is_item = np.asarray(shingle.is_null())
    found = np.asarray(shingle.drop_null()).astype(np.int64).view(np.uint64)
    order = np.argsort(found)
    return int(n[is_item].sum()), found[order], n[~is_item][order]


def benchmark_parts(benchmark: DataFrame) -> tuple[int, Iterator[Benchmark]]:
    """How many broadcastable parts the items take, and the parts, built one at a time.

    Each part is bounded in items and characters.
    """
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    n_parts = max(1, -(-size["n"] // MAX_ITEMS), -(-size["chars"] // MAX_CHARS))

    def build() -> Iterator[Benchmark]:
        whole = shared_shingles(items) if n_parts > 1 else None
        for p in range(n_parts):
            part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)) == p) if n_parts > 1 else items
            rows = part.orderBy("item_id", "text").toArrow()
            yield Benchmark(rows.column("item_id").to_pylist(), rows.column("text").to_pylist(), whole=whole)

    return n_parts, build()


def _found(texts: DataFrame, sent) -> DataFrame:
    """The findings of a broadcast part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = sent.value
        for whole in batches:
            for batch in kernel.slices(whole):
                rows = [(row, *f) for row, found in part.leaks(batch.column("text")) for f in found]
                if rows:
                    row, item, start, apart, like = zip(*rows, strict=True)
                    columns = [batch.column("doc_id").take(pa.array(row)), pa.array([part.ids[i] for i in item], pa.int64()), pa.array(start, pa.int64()), pa.array([int(part.lengths[i]) for i in item], pa.int64()), pa.array(apart, pa.int32()), pa.array(like)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start_word", "n_words", "bits_apart", "similarity"])

    return texts.mapInArrow(work, "doc_id long, item_id long, start_word long, n_words long, bits_apart int, similarity double")


def _clean(docs: DataFrame, sent) -> DataFrame:
    """docs without the rows that hold an item of a broadcast part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                keep = np.ones(len(batch), bool)
                keep[[row for row, _ in sent.value.leaks(batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

    return docs.mapInArrow(work, docs.schema)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and item found in it: doc_id, item_id, start_word, n_words, bits_apart, similarity."""
    context, texts = docs.sparkSession.sparkContext, shared.keyed_texts(docs)
    n_parts, parts = benchmark_parts(benchmark)
    if n_parts == 1:
        return _found(texts, context.broadcast(next(parts)))
    found = None
    for part in parts:
        sent = context.broadcast(part)
        one = shared.written(_found(texts, sent), "leaks")
        sent.destroy()
        found = one if found is None else found.unionByName(one)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a benchmark item; all columns stay, and with one part nothing is shuffled.

    Several parts leave a table each of the rows to go, by doc_id and text hash.
    """
    context = docs.sparkSession.sparkContext
    n_parts, parts = benchmark_parts(benchmark)
    if n_parts == 1:
        return _clean(docs, context.broadcast(next(parts)))
    keyed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), F.coalesce("text", F.lit("")).alias("text"))
    gone = None
    for part in parts:
        sent = context.broadcast(part)
        one = shared.written(_leaking(keyed, sent), "leaks")
        sent.destroy()
        gone = one if gone is None else gone.unionByName(one)
    gone = gone.distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"]), "left_anti")


def _leaking(keyed: DataFrame, sent) -> DataFrame:
    """_id and _hash of the rows that hold an item of a broadcast part."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                rows = pa.array([row for row, _ in sent.value.leaks(batch.column("text"))], pa.int64())
                yield batch.select(["_id", "_hash"]).take(rows)

    return keyed.mapInArrow(work, keyed.drop("text").schema)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))
