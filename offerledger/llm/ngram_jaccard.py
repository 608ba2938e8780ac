"""N-gram Jaccard join: documents whose word n-gram sets overlap in at least 85 %, as classes.

Words are [^\\x20\\x09-\\x0D]+ of the lower-cased (A-Z) text; a document's set is its distinct 4-word
shingles, or its whole word sequence as one shingle when it has fewer words.

How links are found, none lost and no group expanded to all its pairs:

1. Documents with equal sets are one node, named by a 64-bit signature of the set.
2. Sets are globally ordered, rare shingles first: the top bits of a shingle's number hold how frequent
   its words are in the corpus (at most MAX_FREQUENT words, counted over all documents, have a level),
   the rest is its hash.  Two linked sets share a shingle among the first n - ceil(0.85 n) + 1 of
   both; a set goes to each of these that another set has too, with the shared ones that come after it
   (the next REST, by their upper halves: more would tighten bounds, not change results).
3. The sets of a shingle, sorted by what comes after it, are a prefix tree.  Every set is taken through the tree
   of each of its shingles, all sets of a batch at once and level by level: sets with a common beginning share
   the overlap counted so far, and a subtree is left as soon as that overlap and the shorter of both remaining
   lengths can't reach what a link needs, or if all its sets are in the set's own component.
4. Rounds give components out of verified links, so that few pairs are left for the last one.  In the first only
   neighbours in tree order become candidates, in the second each set's CLOSEST partners of other components, by their
   bitmaps; both look into the trees of a set's FIRST rarest shared shingles (work is linear in the sets).  The last
   round takes whole trees and all their pairs, between different components.
   A shingle of more than BLOCK sets is dealt over blocks, in the last round so that all of them meet: sets of its
   largest component meet only the sets outside it, block by block, so no task holds more than two blocks.
5. Parity bitmaps bound the overlap of what is left, in whole trees and of the candidates (no link is lost), and
   whole sets are compared; a set with many partners is dealt over several tasks.

Cases: null, empty and blank texts have no set (0 shingles) and are classes of their own; copies
share a class; a repeated doc_id gives a row each time; a row with a null doc_id keeps its row and
links others, but names no class (its own class may then be null); a very long text has all its shingles; an
empty table gives an empty result; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerledger.llm import kernel, shared
from offerledger.operators.graph import components

SHINGLE = 4
#: a link needs 100 * intersection >= PERCENT * union
PERCENT = 85
#: words that get a frequency level of their own; the list is broadcast
MAX_FREQUENT = 65_536
#: an Arrow task reports a word as frequent from this count in its own rows
FREQUENT_IN_TASK = 64
#: parity bitmaps of candidates have a power of two of bits, at least this and half the set's size
BITS = 512
#: words of 64 bits of the bitmaps that go with sets into whole trees
COARSE = 16
#: shared shingles that go with a set to each of its shingles
REST = 32
#: shingles of one set that may be equal in their upper halves
TIES = 2
#: sets of a shingle that meet in one task
BLOCK = 512
#: which pairs of a tree become candidates, by round: those of neighbours, of each set's closest partners, all
ROUNDS = ("neighbours", "closest", "all")
#: a set's first shared shingles, in whose trees it meets others in all rounds but the last
FIRST = {"neighbours": 4, "closest": 8}
#: partners of a set in the second round
CLOSEST = 3
#: shingles of candidates verified together, and of one set's partners
CHECKED_AT_ONCE = 1_000_000
#: texts of candidates are found by a broadcast of their keys up to so many (8 MB), beyond by a join
MAX_BROADCAST = 1_000_000
#: shingles looked up at once in a tree
AT_ONCE = 1 << 20
_LEVEL_AT = np.uint64(57)


class Levels:
    """Frequency levels of words: 0 for words that aren't listed, 15 at most; one step doubles the share."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(words)
        level = np.clip(21 + np.floor(np.log2(np.maximum(counts, 1) / max(total, 1))), 0, 15)
        self.words, self.level = words[order], level[order].astype(np.uint64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.uint64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.level[at], np.uint64(0))


def shingle_sets(column: pa.Array, k: int, levels: Levels) -> list[np.ndarray]:
    """The distinct shingle numbers of each row, ascending: the global order."""
    words = kernel.Words(column, kernel.WHITE, lower=True)
    rows, level = words.rows, levels.of(words.hashes)
    total = np.zeros(len(level) + 1, np.uint64)
    np.cumsum(level, out=total[1:])

    def numbers(m: int) -> np.ndarray:
        grams, _ = words.grams(m)
        end = np.minimum(np.arange(len(grams)) + m, len(grams))
        common = (total[end] - total[:-1]) * np.uint64(16) // np.uint64(2 * m + 2) if m else total[:-1]
        return (np.minimum(common, np.uint64(127)) << _LEVEL_AT) | (grams >> np.uint64(7))

    grams, out = numbers(k), []
    short = {m: numbers(m) for m in range(1, k) if (words.counts == m).any()}
    for i, m in enumerate(words.counts):
        at = rows[i]
        out.append(np.unique(grams[at : at + m - k + 1]) if m >= k else short[m][at : at + 1] if m else grams[:0])
    return out


def signature(found: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int(kernel.mix64(np.array([kernel.mix64(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(found))]))[0].view(np.int64))


def parity_bits(found: np.ndarray, size: int | None = None) -> np.ndarray:
    """Parity bitmap: its Hamming distance to another set's is at most the symmetric difference.

    Halving a bitmap by exclusive or gives the bitmap of half the size.
    """
    size = size or max(BITS, 1 << max(len(found) // 2 - 1, 0).bit_length())
    odd = np.bincount((found & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def need(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of sets of n and m that links them."""
    return -((-percent * (n + m)) // (100 + percent))


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1 ... for each begin, size of them, one after another."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


class PrefixTrees:
    """Prefix trees of the sets of several shingles: rows sorted by group (shingle), then by what comes after it.

    Of each row: n and comp (the set's size and component), pos (how many of its shingles come before the group's),
    tokens and places (the upper halves of the shared shingles after it, in the global order, and how many shingles
    come before each), done and upto (the shingles before `upto`, `done` of them, are known: what is shared among
    them is in tokens), side (rows of equal sides aren't paired, but those of side 0 are).  Shingles that are equal in
    their upper halves alone count as shared, which only leaves more pairs for the check.

    A node is a run of rows with the same beginning; those of depth d are told by the rows' common lengths with
    the row before.
    """

    def __init__(self, group, side, n, pos, comp, done, upto, tokens: np.ndarray, places: np.ndarray, sizes: np.ndarray, percent: int, bits: np.ndarray | None = None):
        self.group, self.side, self.n, self.pos, self.comp, self.done, self.upto = group, side, n, pos, comp, done, upto
        self.places, self.sizes, self.percent, self.bits = places, sizes, percent, bits
        self.begin = np.cumsum(sizes) - sizes
        known, self.rank = np.unique(tokens, return_inverse=True)
        self.width = len(known) + 1
        #: (row, shingle) of every shingle of every row, ascending
        self.held = np.repeat(np.arange(len(n)), sizes) * self.width + self.rank
        self.common = self._common()
        #: how often the component changes up to each row
        self.changes = np.cumsum(np.r_[0, comp[1:] != comp[:-1]])

    def _common(self) -> np.ndarray:
        """Length of the beginning that each row has in common with the row before, in the same group."""
        out = np.zeros(len(self.n), np.int64)
        both = np.flatnonzero(self.group[1:] == self.group[:-1]) + 1
        size = np.minimum(self.sizes[both], self.sizes[both - 1])
        out[both] = size
        step = _ranges(np.zeros(len(both), np.int64), size)
        apart = np.flatnonzero(self.rank[np.repeat(self.begin[both], size) + step] != self.rank[np.repeat(self.begin[both - 1], size) + step])
        np.minimum.at(out, np.repeat(both, size)[apart], step[apart])
        return out

    def _level(self, depth: int) -> tuple[np.ndarray, ...]:
        """Nodes of a depth: first row, end, shingle, longest remaining length, smallest set, rows that end here."""
        rows = np.flatnonzero(self.sizes >= depth) if depth else np.arange(len(self.n))
        first = np.flatnonzero(self.common[rows] < depth if depth else np.r_[True, self.group[1:] != self.group[:-1]])
        at = self.begin[rows] + depth - 1
        place = self.places[at] if depth else self.pos
        lows, counts = rows[first], np.diff(np.r_[first, len(rows)])
        over = lambda f, x: f.reduceat(x, first) if len(first) else x[:0]
        return lows, lows + counts, self.rank[at[first]] if depth else first, over(np.maximum, self.n[rows] - place - 1), over(np.minimum, self.n[rows]), over(np.add, (self.sizes[rows] == depth).astype(np.int64))

    def _met(self, row: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the row holds the shingle, and a place not behind its last shingle up to there."""
        key = row * self.width + rank
        at = np.searchsorted(self.held, key)
        met = self.held[np.minimum(at, len(self.held) - 1)] == key if len(self.held) else np.zeros(len(key), bool)
        at = np.where(met, at, at - 1)
        some = at >= self.begin[row]
        return met, np.where(some, self.places[np.maximum(at, 0)], self.pos[row]) if len(self.held) else self.pos[row]

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows next to each other in a tree that may link, of different components."""
        x = np.flatnonzero(self.group[1:] == self.group[:-1]) + 1
        return self._able(x, x - 1)

    def all_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of one tree that may link, of different components."""
        found = []
        low, high, _, remains, smallest, ended = level = self._level(0)
        x = np.arange(len(self.n))
        node = np.repeat(np.arange(len(low)), high - low)
        overlap, depth = np.ones(len(x), np.int64), 0
        while True:
            # Only rows before x: each pair once.
            last_of = np.minimum(high[node], x)
            alone = (last_of - low[node] == 1) | (ended[node] == high[node] - low[node])
            here = np.where(alone, last_of - low[node], np.minimum(ended[node], last_of - low[node]))
            y = _ranges(low[node], np.maximum(here, 0))
            found.append(self._able(np.repeat(x, np.maximum(here, 0)), y))
            x, node, overlap = x[~alone], node[~alone], overlap[~alone]
            if not len(x):
                break
            depth += 1
            below = self._level(depth)
            first, end = np.searchsorted(below[0], low[node]), np.searchsorted(below[0], high[node])
            low, high, token, remains, smallest, ended = level = below
            count = end - first
            x, overlap, node = np.repeat(x, count), np.repeat(overlap, count), _ranges(first, count)
            near = low[node] < x
            near &= (self.changes[high[node] - 1] != self.changes[low[node]]) | (self.comp[low[node]] != self.comp[x])
            x, overlap, node = x[near], overlap[near], node[near]
            met, place = self._met(x, token[node])
            overlap = overlap + met
            able = overlap + np.minimum(self.n[x] - place - 1, remains[node]) >= need(self.n[x], smallest[node], self.percent)
            x, overlap, node = x[able], overlap[able], node[able]
        return tuple(np.concatenate(z) for z in zip(*found, strict=True))

    def _able(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of different components that may link by all that is known of both."""
        n, comp, side = self.n, self.comp, self.side
        keep = (comp[x] != comp[y]) & ((side[x] != side[y]) | (side[x] == 0))
        keep &= 1 + np.minimum(n[x] - self.pos[x], n[y] - self.pos[y]) - 1 >= need(n[x], n[y], self.percent)
        x, y = x[keep], y[keep]
        out, begin, total = [], 0, np.cumsum(self.sizes[y])
        while begin < len(x):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + AT_ONCE, side="right")))
            p, q = x[begin:end], y[begin:end]
            size, begin = self.sizes[q], end
            at, owner = _ranges(self.begin[q], size), np.repeat(np.arange(len(p)), size)
            met, place = self._met(p[owner], self.rank[at])
            overlap = 1 + np.bincount(owner[met], minlength=len(p))
            in_p, in_q = self.pos[p].copy(), self.pos[q].copy()  # places of the last shared shingle
            np.maximum.at(in_p, owner[met], place[met])
            np.maximum.at(in_q, owner[met], self.places[at[met]])
            # The set that is known up to the smaller shingle has no other shared one up to there.
            left = np.where(self.upto[p] <= self.upto[q], n[p] - np.maximum(self.done[p], in_p + 1), n[p] - in_p - 1)
            right = np.where(self.upto[q] <= self.upto[p], n[q] - np.maximum(self.done[q], in_q + 1), n[q] - in_q - 1)
            may = overlap + np.minimum(left, right) >= need(n[p], n[q], self.percent)
            p, q = p[may], q[may]
            if self.bits is not None:
                may = self.apart(p, q) <= n[p] + n[q] - 2 * need(n[p], n[q], self.percent)
                p, q = p[may], q[may]
            out.append((p, q))
        return tuple(np.concatenate(z) for z in zip(*out, strict=True)) if out else (x, y)

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bits in which the bitmaps of the pairs differ."""
        return np.bitwise_count(self.bits[x] ^ self.bits[y]).sum(axis=1, dtype=np.int64)

    def closest(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of a tree that may link and of which one row has the other among its k closest."""
        x, y = self.all_pairs()
        row, far = np.concatenate([x, y]), np.tile(self.apart(x, y), 2)
        order = np.lexsort((np.concatenate([y, x]), far, row))
        first = np.searchsorted(row[order], row[order])
        kept = np.unique(order[np.arange(len(order)) - first < k] % max(len(x), 1))
        return x[kept], y[kept]


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words that are frequent in the task, and of all its words (word null)."""
    words, counts, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    for whole in batches:
        for batch in kernel.slices(whole):
            found = kernel.Words(batch.column("text"), kernel.WHITE, lower=True).hashes
            seen, times = np.unique(found, return_counts=True)
            total += len(found)
            words, counts = np.concatenate([words, seen[times > 1]]), np.concatenate([counts, times[times > 1]])
            if len(words) > 1_000_000:
                words, counts = _summed(words, counts)
    words, counts = _summed(words, counts)
    often = counts >= FREQUENT_IN_TASK
    yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(kernel.as_long(words[often])), pa.nulls(1, pa.int64())]), pa.array(np.r_[counts[often], total])], ["word", "n"])


def word_levels(texts: DataFrame) -> Levels:
    """Levels of the most frequent words of all texts."""
    counts = texts.mapInArrow(_frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.expr("word is not null"), F.desc("n"), "word").limit(MAX_FREQUENT + 1).toArrow()
    if not len(counts):
        return Levels(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0)
    words, n = counts.column("word").slice(1).combine_chunks(), np.asarray(counts.column("n"))
    return Levels(np.asarray(words).astype(np.int64).view(np.uint64), n[1:], int(n[0]))


def _summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(values, return_inverse=True)
    return distinct, np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return kernel.list_array(kernel.as_long(flat), np.array([len(x) for x in arrays], np.int64))


def _scan(k: int, percent: int, levels):
    """Signature, size, bitmap and ordered prefix of each document's set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                sets = shingle_sets(batch.column("text"), k, levels.value)
                names = pa.array([signature(s) if len(s) else None for s in sets], pa.int64())
                prefix = [s[: len(s) + 1 + (-percent * len(s)) // 100] if len(s) else s for s in sets]
                # How far the prefix tells the set: the upper half of its last shingle, and the shingles before that.
                upper = [p >> np.uint64(32) for p in prefix]
                last = [int(u[-1]) if len(u) else 0 for u in upper]
                before = [int(np.searchsorted(u, u[-1])) if len(u) else 0 for u in upper]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), names, *(pa.array(x, pa.int64()) for x in ([len(s) for s in sets], last, before)), _lists([parity_bits(s) for s in sets]), _lists([parity_bits(s, 64 * COARSE) for s in sets]), _lists(prefix)], ["doc_id", "key", "sig", "n", "last", "before_last", "bits", "coarse", "prefix"])

    return work


def _whole_sets(k: int, levels):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                sets = [s for s in shingle_sets(batch.column("text"), k, levels.value) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([signature(s) for s in sets], pa.int64()), _lists(sets)], ["sig", "tokens"])

    return work


_NUMBERS = ("side", "n", "pos", "comp", "done")


def _candidates(percent: int, which: str):
    """Pairs (a < b, with sizes and the bits apart, if known) out of rows sorted by token, blocks and rest."""

    def of_groups(rows: pa.RecordBatch, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        column = lambda c: rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lambda c, kind: np.asarray(rows.column(c).flatten()).view(kind)
        trees = PrefixTrees(group, *(column(c) for c in _NUMBERS), column("upto").astype(np.uint32), flat("rest", np.uint32), flat("places", np.int32).astype(np.int64), np.asarray(rows.column("rest").value_lengths()).astype(np.int64), percent, None if which == "neighbours" else flat("coarse", np.uint64).reshape(-1, COARSE))
        x, y = trees.neighbours() if which == "neighbours" else trees.closest(CLOSEST) if which == "closest" else trees.all_pairs()
        sig = column("sig")
        flip = sig[x] > sig[y]
        x, y = np.where(flip, y, x), np.where(flip, x, y)
        _, once = np.unique(np.stack([sig[x], sig[y]]), axis=1, return_index=True)
        x, y = x[once], y[once]
        if len(once):
            apart = pa.nulls(len(x), pa.int64()) if trees.bits is None else pa.array(trees.apart(x, y))
            yield pa.RecordBatch.from_arrays([*(pa.array(c[z]) for c in (sig, trees.n) for z in (x, y)), pa.array(column("token")[x]), apart], ["a", "b", "na", "nb", "token", "apart"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in chain(batches, [None]):
            parts = [b for b in (held, batch) if b is not None and b.num_rows]
            if not parts:
                continue
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            keys = np.stack([rows.column(c).to_numpy() for c in ("token", "i", "j")])
            starts = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, rows.num_rows]
            sizes = np.diff(starts)
            done = len(sizes) if batch is None else len(sizes) - 1
            work_of, k = np.cumsum(sizes.astype(np.int64) ** 2), 0
            while k < done:
                end = min(done, max(k + 1, int(np.searchsorted(work_of, (work_of[k - 1] if k else 0) + 4 * BLOCK * BLOCK, side="right"))))
                yield from of_groups(rows.slice(starts[k], starts[end] - starts[k]), np.repeat(np.arange(end - k), sizes[k:end]))
                k = end
            held = rows.slice(starts[done])
        kernel.release()

    return work


def _check_block(percent: int):
    """Links among the candidate pairs of a block (rows with b), on the whole sets in it (rows without)."""

    def work(block: pa.Table) -> pa.Table:
        is_set = block.column("b").is_null()
        sets_of, pairs = block.filter(is_set).combine_chunks(), block.filter(pc.invert(is_set))
        known: dict[int, np.ndarray] = {}
        for name, tokens in zip(sets_of.column("a").to_pylist(), sets_of.column("tokens"), strict=True):
            known[name] = np.asarray(tokens.values).view(np.uint64)
        links = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            x, y = known[a], known[b]
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)
            if int((x[at] == y).sum()) >= need(len(x), len(y), percent):
                links.append((a, b))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return work


def ngram_classes(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links), a row per document."""
    # Whole sets are fetched by key: the doc_id, or for a null one a hash of the text.
    texts = shared.keyed_texts(docs).withColumn("key", F.coalesce("doc_id", F.xxhash64("text")))
    levels = docs.sparkSession.sparkContext.broadcast(word_levels(texts))
    members = shared.written(texts.mapInArrow(_scan(k, percent, levels), "doc_id long, key long, sig long, n long, last long, before_last long, bits array<long>, coarse array<long>, prefix array<long>"), "ngram-docs")
    filled = members.where("sig is not null").groupBy("sig")
    postings = filled.agg(F.first("prefix").alias("prefix")).select("sig", F.posexplode("prefix").alias("pos", "token"))
    # Shingles that begin two sets or more; of each set those alone go on, with their places.
    again = postings.groupBy("token").agg(F.count("*").cast("int").alias("holders")).where("holders > 1")
    held = postings.join(again, "token").groupBy("sig").agg(F.sort_array(F.collect_list(F.struct("pos", "token", "holders"))).alias("held"))
    known = filled.agg(*(F.first(c).alias(c) for c in ("n", "last", "before_last", "coarse")))
    parts = [F.col(f"held.{c}").alias(name) for c, name in (("token", "tokens"), ("pos", "places"), ("holders", "holders"))]
    upper = F.transform("held.token", lambda x: F.shiftright(x, 32).cast("int"))
    heads = shared.written(held.join(known, "sig").select("sig", "n", "last", "before_last", "coarse", *parts, upper.alias("uppers")), "ngram-heads")

    links, class_of = None, None
    for which in ROUNDS:
        pairs = shared.written(_paired(heads, class_of, percent, which), "ngram-pairs")
        found = shared.written(_verified(pairs, members, texts, levels, k, percent), "ngram-links")
        shared.dropped(pairs)
        shared.released(pairs.sparkSession)
        if class_of is None or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            class_of = components(links)

    members = members.select("doc_id", "sig", "n")
    nodes = members.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    named = nodes.join(class_of.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_sig = named.join(least, "component").select("sig", "component_id")
    return members.join(of_sig, "sig", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _paired(heads: DataFrame, class_of: DataFrame | None, percent: int, which: str) -> DataFrame:
    """Candidates (a, b, na, nb, and a shingle they share) between different components, from the prefix trees."""
    if class_of is None:
        heads = heads.withColumn("comp", F.col("sig")).withColumn("own", F.sequence(F.lit(0), F.size("tokens") - 1))
    else:
        heads = heads.join(class_of.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("component", "sig"))
        # Only trees of two components or more: light rows are joined, and each set keeps the numbers of those shingles.
        light = heads.select("sig", "comp", F.posexplode("tokens").alias("at", "token"))
        mixed = light.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token")
        some = light.join(mixed, "token", "left_semi").groupBy("sig").agg(F.collect_list("at").alias("own"))
        heads = heads.join(some, "sig")
    if which != "all":
        heads = heads.withColumn("own", F.slice(F.array_sort("own"), 1, FIRST[which]))
    each = heads.withColumn("at", F.explode("own"))
    after = lambda c: F.slice(c, F.col("at") + 2, F.lit(REST))
    here = lambda c, k=1: F.element_at(c, F.col("at") + k)
    whole = F.size("tokens") <= F.col("at") + 1 + REST
    end = F.least(F.col("at") + 1 + REST, F.size("tokens"))
    done = F.when(whole, F.col("before_last")).otherwise(F.element_at("places", end) - TIES)
    upto = F.when(whole, F.col("last")).otherwise(F.shiftrightunsigned(F.element_at("tokens", end), 32))
    rows = each.select(here("tokens").alias("token"), here("holders").alias("holders"), "sig", "n", here("places").alias("pos"), "comp", after("uppers").alias("rest"), after("places").alias("places"), done.alias("done"), upto.alias("upto"), (F.array().cast("array<long>") if which == "neighbours" else F.col("coarse")).alias("coarse"))
    few = rows.where(F.col("holders") <= BLOCK).withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(0)})
    many = rows.where(F.col("holders") > BLOCK)
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    block_of = lambda n: F.pmod(F.xxhash64("sig", "token"), n).cast("int")
    if which != "all":
        many = many.withColumn("i", block_of(blocks("holders"))).withColumns({"j": F.col("i"), "side": F.lit(0)})
    else:
        sizes = many.groupBy("token", "comp").agg(F.count("*").alias("size"))
        main = sizes.groupBy("token").agg(F.max_by("comp", F.struct("size", "comp")).alias("main"), F.max("size").alias("n_main"), F.sum("size").alias("n_all"))
        many = many.join(main, "token").withColumn("out", F.col("comp") != F.col("main"))
        # Blocks of the sets outside the main component: 0 ... n_out - 1; of those in it: n_out ...
        n_out = F.greatest(F.ceil((F.col("n_all") - F.col("n_main")) / BLOCK), F.lit(1)).cast("int")
        many = many.withColumn("n_out", n_out).withColumn("mine", F.when(F.col("out"), block_of(F.col("n_out"))).otherwise(F.col("n_out") + block_of(blocks("n_main"))))
        others = F.when(F.col("out"), F.sequence(F.lit(0), F.col("n_out") + blocks("n_main") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_out") - 1))
        many = many.withColumn("other", F.explode(others)).withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})
        many = many.withColumn("side", F.when(F.col("i") == F.col("j"), 0).when(F.col("mine") == F.col("i"), 1).otherwise(2))
    columns = ["token", "i", "j", "side", "sig", "n", "pos", "comp", "done", "upto", "rest", "places", "coarse"]
    dealt = few.select(columns).unionByName(many.select(columns)).repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "rest")
    found = dealt.mapInArrow(_candidates(percent, which), "a long, b long, na long, nb long, token long, apart long")
    found = found.groupBy("a", "b", "na", "nb").agg(F.min("token").alias("token"), F.min("apart").alias("apart"))
    if which == "closest":
        # Those that one of both sets has among its closest over all its trees.
        of_set = found.withColumn("set", F.explode(F.array("a", "b")))
        near = of_set.withColumn("nth", F.row_number().over(Window.partitionBy("set").orderBy("apart", "a", "b"))).where(F.col("nth") <= CLOSEST)
        found = near.groupBy("a", "b", "na", "nb").agg(F.min("token").alias("token"))
    return found.select("a", "b", "na", "nb", "token")


def _verified(pairs: DataFrame, members: DataFrame, texts: DataFrame, levels, k: int, percent: int) -> DataFrame:
    """The pairs (a, b of set names) that link.  Parity bitmaps tell most of the others apart.  Whole sets are made again
    of one text each, for the candidates that are left, and travel once to each block that needs them.

    Pairs are checked where others of the same shingle are, as these have sets in common; the pairs of a shingle and
    the partners of a set are dealt over as many parts as their sizes need.
    """
    bits = members.where("sig is not null").groupBy("sig").agg(F.first("bits").alias("bits"))
    both = pairs.join(bits.toDF("a", "x"), "a").join(bits.toDF("b", "y"), "b")
    # Linked sets differ in size by less than two (percent is over 50), so their bitmaps by one halving at most.
    halved = "zip_with(slice({0}, 1, size({0}) div 2), slice({0}, size({0}) div 2 + 1, size({0}) div 2), (p, q) -> p ^ q)"
    even = both.withColumn("u", F.expr(f"case when size(x) > size(y) then {halved.format('x')} else x end")).withColumn("v", F.expr(f"case when size(y) > size(x) then {halved.format('y')} else y end"))
    apart = F.expr("aggregate(zip_with(u, v, (p, q) -> bit_count(p ^ q)), 0, (s, d) -> s + d)")
    near = apart <= F.expr(f"na + nb + 2 * floor(-{percent} * (na + nb) / {100 + percent}.0d)")
    pairs = shared.written(even.where(near).select("a", "b", "na", "nb", "token"), "ngram-near")
    weight = F.col("na") + F.col("nb")
    total = pairs.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    n_blocks = max(1, -(-total // CHECKED_AT_ONCE))
    of_token = pairs.groupBy("token").agg(F.sum(weight).alias("of_token"))
    of_set = pairs.groupBy("a").agg(F.sum("nb").alias("of_set"))
    parts = lambda c: F.ceil(F.col(c) * 4 / CHECKED_AT_ONCE)
    part = F.pmod(F.xxhash64("a", F.pmod(F.xxhash64("b"), parts("of_set"))), parts("of_token"))
    blocked = pairs.join(of_token, "token").join(of_set, "a").withColumn("block", F.pmod(F.xxhash64("token", part), F.lit(n_blocks))).select("block", "a", "b")
    wanted = blocked.select("block", F.explode(F.array("a", "b")).alias("sig")).distinct()
    keys = members.select("sig", "key").join(wanted.select("sig").distinct(), "sig", "left_semi").groupBy("sig").agg(F.min("key").alias("key")).select("key").distinct()
    keys = shared.written(keys, "ngram-keys")
    holders = F.broadcast(keys) if keys.count() <= MAX_BROADCAST else keys
    sets = texts.join(holders, "key", "left_semi").mapInArrow(_whole_sets(k, levels), "sig long, tokens array<long>")
    carried = wanted.join(sets.groupBy("sig").agg(F.first("tokens").alias("tokens")), "sig").select("block", F.col("sig").alias("a"), F.lit(None).cast("long").alias("b"), "tokens")
    rows = carried.unionByName(blocked.select("block", "a", "b", F.lit(None).cast("array<long>").alias("tokens")))
    return rows.groupBy("block").applyInArrow(_check_block(percent), "a long, b long")


def one_of_each_class(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs with the document of the smallest doc_id of every class; rows with a null doc_id stay.

    Rows that repeat a doc_id are one document and stay or go together.
    """
    gone = ngram_classes(docs, k, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(shared.table(spark, sf_dir, "documents"))
