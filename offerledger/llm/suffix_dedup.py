"""Suffix-array dedup: passages of MATCH or more words that occur twice in the corpus.

Words are [^\\x20\\x09-\\x0D]+, compared byte for byte.  A word is *repeated* if it lies in a run of
MATCH words that occurs at two or more places of the corpus, and *removable* if it lies in such a run
that occurs at an earlier place (smaller doc_id, then position).  So one copy of everything stays.

The suffix array is sparse: of the suffixes of every document, only those at content-selected
minimiser positions are kept (the leftmost smallest KEY-word hash of each MATCH-word run), about one
word in 13.  Any repeated run holds such a position, its own minimiser, at the same offset in all its places.

1. Suffixes whose first KEY words begin another retained suffix as well are kept.  Each gets its context: up
   to MATCH words to the right and MATCH - KEY to the left.  Suffixes of equal contexts are one entry with a
   count and a first place, so a passage that very many documents share is a few entries.
2. Entries are dealt by their first KEY words and sorted by their words: pieces of the sparse suffix array.  The
   words that an entry has in common with its neighbour delimit the blocks of suffixes that go on alike for
   25, 26 ... 50 words; within each block matches are extended to the left word by word.  So any combination
   of left and right parts is found: a run of MATCH words around its minimiser repeats if another suffix
   shares the left and the right part of it.  Each entry returns the ranges of its runs that repeat, with the
   first place of each.
3. First words with more than BUCKET different contexts aren't sorted in one task: their entries' runs are
   counted by hash, with map-side combination.  The result is the same.
4. Ranges go back to all places, and touching ones are joined.

Copies of whole documents are one suffix source with a count.

Cases: null, empty and short texts (under MATCH words) have no repeated words; overlapping repeats
within one document count; rows that repeat a doc_id with the same text are one document and stay or lose words together,
with another text they are documents of their own; of equal places the smallest doc_id is first; rows with a
null doc_id are left out of the search and stay as they are; a very long text is searched whole, its
suffixes are sent on in batches; an empty table gives an empty result; other columns, whatever their names, are not
looked at and stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.llm import kernel, shared

MATCH = 50
KEY = 25
#: first words with more different contexts than this are counted by run
BUCKET = 4000
#: suffixes sent on at once with their words
AT_ONCE = 4096
SPANS = "array<struct<start:int,end:int>>"


def minimisers(words: kernel.Words, match: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key hash at each word, the starts of all whole match-word runs, and the minimiser of each."""
    value, _ = words.grams(key)
    n, reach = len(value), match - key + 1
    runs = np.flatnonzero(np.repeat(words.rows[1:], words.counts) - np.arange(n) >= match)
    least, at, width = value, np.arange(n), 1

    def joined(by: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[by:] < least[: n - by]
        a, b = least.copy(), at.copy()
        a[: n - by][right] = least[by:][right]
        b[: n - by][right] = at[by:][right]
        return a, b

    while width < reach and width < n:
        by = min(width, reach - width)
        least, at = joined(by)
        width += by
    return value, runs, at[runs]


def signatures(words: kernel.Words) -> np.ndarray:
    """A 64-bit number of each row's whole word sequence."""
    return kernel.as_long(kernel.range_hashes(words.hashes, words.rows[:-1], words.rows[1:]))


def _bounds(words: kernel.Words, at: np.ndarray, match: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and end of the context of the suffixes at words `at`."""
    row = np.searchsorted(words.rows, at, side="right") - 1
    return row, np.maximum(at - (match - key), words.rows[row]), np.minimum(at + match, words.rows[row + 1])


def _suffixes(match: int, key: int):
    """A row per document: its signature, and the first-word keys, places and contexts of its kept suffixes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                words = kernel.Words(batch.column("text"), kernel.WHITE, lower=False)
                value, _, at = minimisers(words, match, key)
                at = np.unique(at)
                per_row = np.diff(np.searchsorted(at, words.rows))
                _, begin, end = _bounds(words, at, match, key)
                # The place of the suffix in its context is part of the context.
                context = kernel.mix64(kernel.range_hashes(words.hashes, begin, end) + (at - begin).astype(np.uint64))
                lists = [kernel.list_array(kernel.as_long(x), per_row) for x in (value[at], context)]
                place = kernel.list_array((at - np.repeat(words.rows[:-1], per_row)).astype(np.int32), per_row)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signatures(words)), pa.array(words.counts.astype(np.int32)), *lists, place], ["doc_id", "sig", "n_words", "keys", "contexts", "places"])

    return work


ENTRY = "key long, context long, n long, n_contexts long, doc_id long, sig long, place int, runs long, left array<long>, right array<long>"
_ENTRY = ["key", "context", "n", "n_contexts", "doc_id", "sig", "place", "runs", "left", "right"]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1 ... for each begin, size of them, one after another."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _entries(match: int, key: int):
    """The words of the wanted contexts of a document: rows of ENTRY.

    runs: bit o is set if the suffix is the minimiser of the run that begins o words before it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                words = kernel.Words(batch.column("text"), kernel.WHITE, lower=False)
                _, starts, at = minimisers(words, match, key)
                owned = np.zeros(len(words.starts), np.int64)
                np.bitwise_or.at(owned, at, np.int64(1) << (at - starts))
                # Only the rows of the text the places are of (a doc_id may repeat with another text).
                mine = np.flatnonzero(signatures(words) == batch.column("sig").to_numpy())
                wanted = batch.column("wanted").take(pa.array(mine))
                sizes, told = np.asarray(wanted.value_lengths()).astype(np.int64), wanted.flatten()
                row, place = np.repeat(mine, sizes), told.field("place").to_numpy()
                doc, sig = (batch.column(c).to_numpy()[row] for c in ("doc_id", "sig"))
                spot = words.rows[row] + place
                _, begin, end = _bounds(words, spot, match, key)
                for k in range(0, len(spot), AT_ONCE):
                    some = slice(k, k + AT_ONCE)
                    g, left, right = spot[some], spot[some] - begin[some], end[some] - spot[some]
                    back = words.hashes[2 * np.repeat(g, left) - 1 - _ranges(g, left)]
                    lists = [kernel.list_array(kernel.as_long(x), n) for x, n in ((back, left), (words.hashes[_ranges(g, right)], right))]
                    yield pa.RecordBatch.from_arrays([*(told.field(c).slice(k, AT_ONCE) for c in _ENTRY[:4]), *(pa.array(x[some]) for x in (doc, sig, place)), pa.array(owned[g]), *lists], _ENTRY)

    return work


def _matrix(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A row per list, filled up with zeros, and the lengths."""
    sizes = np.asarray(lists.value_lengths()).astype(np.int64)
    out = np.zeros((len(sizes), width), np.uint64)
    out[np.arange(width) < sizes[:, None]] = np.asarray(lists.flatten()).view(np.uint64)
    return out, sizes


def repeated_runs(rows: pa.RecordBatch, match: int, key: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, words before the suffix at which the run begins, entry of its first place) of the runs that repeat.

    rows: entries sorted by key, then by their words to the right.
    """
    column = lambda c: rows.column(c).to_numpy(zero_copy_only=False)
    right, size = _matrix(rows.column("right"), match)
    left, _ = _matrix(rows.column("left"), match - key)
    keys, n, runs, order_by = column("key"), column("n"), column("runs"), [column(c) for c in ("place", "sig", "doc_id")]
    # Words in common with the neighbour before.
    differ = (right[1:] != right[:-1]) | (np.arange(match) >= np.minimum(size[1:], size[:-1])[:, None])
    common = np.r_[0, np.where(differ.any(axis=1), differ.argmax(axis=1), match)] if len(keys) else np.zeros(0, np.int64)
    common[1:][keys[1:] != keys[:-1]] = 0
    found, to_left = [], np.zeros(len(keys), np.uint64)
    for o in range(match - key + 1):
        if o:  # one more word to the left
            to_left = kernel.mix64(to_left * np.uint64(31) + left[:, o - 1])
        some = np.flatnonzero((runs >> o) & 1)
        if not len(some):
            continue
        block = np.cumsum(common < match - o)[some]
        order = np.lexsort((*(x[some] for x in order_by), to_left[some], block))
        some, block = some[order], block[order]
        begins = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (to_left[some[1:]] != to_left[some[:-1]])])
        sizes = np.diff(np.r_[begins, len(some)])
        again = np.repeat(np.add.reduceat(n[some], begins) > 1, sizes)
        found.append((some[again], np.full(int(again.sum()), o), np.repeat(some[begins], sizes)[again]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


FOUND = "array<struct<low:int,high:int,first:struct<doc_id:bigint,sig:bigint,place:int>>>"


def _matched(match: int, key: int):
    """key, context and the ranges of repeated runs, from entries in suffix order; whole keys at a time."""

    def ranges(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, context = (rows.column(c).to_numpy() for c in ("key", "context"))
        new = np.r_[True, (keys[1:] != keys[:-1]) | (context[1:] != context[:-1])]  # a repeated row of documents repeats its entries
        rows = rows.filter(pa.array(new))
        entry, o, first = repeated_runs(rows, match, key)
        order = np.lexsort((o, entry))
        entry, o, first = entry[order], o[order], first[order]
        cut = np.flatnonzero(np.r_[True, (entry[1:] != entry[:-1]) | (first[1:] != first[:-1]) | (o[1:] != o[:-1] + 1)][: len(entry)])
        if not len(cut):
            return
        last = np.r_[cut[1:], len(entry)] - 1
        owner, per_entry = np.unique(entry[cut], return_counts=True)
        place = pa.StructArray.from_arrays([rows.column(c).take(pa.array(first[cut])) for c in ("doc_id", "sig", "place")], ["doc_id", "sig", "place"])
        found = pa.StructArray.from_arrays([pa.array(o[cut].astype(np.int32)), pa.array(o[last].astype(np.int32)), place], ["low", "high", "first"])
        offsets = pa.array(np.r_[0, np.cumsum(per_entry)].astype(np.int32))
        yield pa.RecordBatch.from_arrays([rows.column("key").take(pa.array(owner)), rows.column("context").take(pa.array(owner)), pa.ListArray.from_arrays(offsets, found)], ["key", "context", "found"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()
            if not rows:
                continue
            keys = rows[0].column("key").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))
            if whole:
                yield from ranges(rows[0].slice(0, whole))
            held = rows[0].slice(whole)
        if held is not None:
            yield from ranges(held)
        kernel.release()

    return work


def _by_run(match: int, key: int):
    """The runs of entries by hash: run, key, context, n, before (words of the run before the suffix) and its place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["run", "key", "context", "n", "before", "doc_id", "sig", "place"]
        for batch in batches:
            right, _ = _matrix(batch.column("right"), match)
            left, _ = _matrix(batch.column("left"), match - key)
            runs, both = batch.column("runs").to_numpy(), np.concatenate([left[:, ::-1], right], axis=1)
            for o in range(match - key + 1):
                some = np.flatnonzero((runs >> o) & 1)
                if len(some):
                    words = both[some, match - key - o : 2 * match - key - o].ravel()
                    run = kernel.range_hashes(words, np.arange(len(some)) * match, np.arange(1, len(some) + 1) * match)
                    rows = batch.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([pa.array(kernel.as_long(run)), *(rows.column(c) for c in names[1:4]), pa.array(np.full(len(some), o, np.int32)), *(rows.column(c) for c in names[5:])], names)
        kernel.release()

    return work


def spans_of(start: np.ndarray, end: np.ndarray) -> list[dict[str, int]]:
    """Joined spans of the ranges, given in the order of their starts."""
    if not len(start):
        return []
    reach = np.maximum.accumulate(end)
    cut = np.flatnonzero(start[1:] > reach[:-1]) + 1
    return [{"start": int(a), "end": int(b)} for a, b in zip(start[np.r_[0, cut]], reach[np.r_[cut - 1, len(start) - 1]], strict=True)]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        repeated, removed, sources = [], [], []
        for doc, found in zip(batch.column("doc_id").to_pylist(), batch.column("found"), strict=True):
            values = found.values
            start, end, first = (np.asarray(values.field(c)) for c in ("start", "end", "first_doc"))
            order = np.argsort(start, kind="stable")
            later = order[~values.field("is_first").to_numpy(zero_copy_only=False)[order]]
            repeated.append(spans_of(start[order], end[order]))
            removed.append(spans_of(start[later], end[later]))
            sources.append(np.unique(first[first != doc]).tolist())
        yield pa.RecordBatch.from_arrays([batch.column("sig"), pa.array(repeated, kind), pa.array(removed, kind), pa.array(sources, pa.list_(pa.int64()))], ["sig", "repeated", "removed", "first_docs"])
    kernel.release()


def repeated_passages(docs: DataFrame, match: int = MATCH, key: int = KEY) -> DataFrame:
    """A row per document with repeated words.

    doc_id, n_words, n_repeated and n_removed (words), repeated and removed (word spans, end
    excluded), first_docs (the other documents that hold the first place of its repeated runs).
    """
    return _passages(docs, match, key).drop("sig")


def _passages(docs: DataFrame, match: int, key: int) -> DataFrame:
    texts = shared.keyed_texts(docs).where("doc_id is not null")
    listed = shared.written(texts.mapInArrow(_suffixes(match, key), "doc_id long, sig long, n_words int, keys array<long>, contexts array<long>, places array<int>").where(F.col("n_words") >= match), "suffixes")
    members = listed.select("doc_id", "sig", "n_words")
    # The lists of a class of copies are equal, so any one goes with its smallest doc_id.
    classes = listed.groupBy("sig").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("keys", "contexts", "places")))
    suffixes = classes.select("doc_id", "sig", F.explode(F.arrays_zip("keys", "contexts", "places")).alias("s")).select(F.col("s.keys").alias("key"), F.col("s.contexts").alias("context"), "doc_id", "sig", F.col("s.places").alias("place"))
    again = suffixes.groupBy("key").count().where("count > 1").select("key")
    places = shared.written(suffixes.join(again, "key", "left_semi"), "suffix-places")

    entries = places.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "sig", "place")).alias("first"))
    sizes = entries.groupBy("key").agg(F.count("*").alias("n_contexts"))
    wanted = entries.join(sizes, "key").groupBy("first.doc_id", "first.sig").agg(F.collect_list(F.struct("key", "context", "n", "n_contexts", "first.place")).alias("wanted"))
    entries = shared.written(texts.join(wanted, "doc_id").mapInArrow(_entries(match, key), ENTRY), "suffix-entries")
    in_order = entries.where(F.col("n_contexts") <= BUCKET).repartition("key").sortWithinPartitions("key", "right", "left")
    found = in_order.mapInArrow(_matched(match, key), f"key long, context long, found {FOUND}")
    runs = entries.where(F.col("n_contexts") > BUCKET).mapInArrow(_by_run(match, key), "run long, key long, context long, n long, before int, doc_id long, sig long, place int")
    # More than one place: an entry with several, or different ones (a repeated row of documents repeats its entries).
    place = F.struct("doc_id", "sig", "place")
    repeated = runs.groupBy("run").agg(F.max("n").alias("n"), F.min(place).alias("first"), F.max(place).alias("last")).where("n > 1 or first <> last").select("run", "first")
    counted = runs.select("run", "key", "context", "before").join(repeated, "run").groupBy("key", "context").agg(F.collect_set(F.struct(F.col("before").alias("low"), F.col("before").alias("high"), "first")).alias("found"))

    here = F.struct("doc_id", "sig", "place")
    ranges = places.join(found.unionByName(counted), ["key", "context"]).select("doc_id", "sig", "place", here.alias("here"), F.explode("found").alias("f"))
    spans = ranges.select("doc_id", "sig", F.struct((F.col("place") - F.col("f.high")).alias("start"), (F.col("place") - F.col("f.low") + match).alias("end"), (F.col("here") == F.col("f.first")).alias("is_first"), F.col("f.first.doc_id").alias("first_doc")).alias("s"))
    spans = spans.groupBy("sig", "doc_id").agg(F.collect_list("s").alias("found")).mapInArrow(_spans, f"sig long, repeated {SPANS}, removed {SPANS}, first_docs array<long>")

    heads = members.groupBy("sig").agg(F.min("doc_id").alias("head"), (F.min("doc_id") < F.max("doc_id")).alias("copied"))
    placed = members.join(heads, "sig").join(spans, "sig", "left")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end"))).cast(SPANS)
    is_head, none = F.col("doc_id") == F.col("head"), F.array().cast(SPANS)
    repeated = F.when(F.col("copied"), whole).otherwise(F.coalesce("repeated", none))
    removed = F.when(~is_head, whole).otherwise(F.coalesce("removed", none))
    sources = F.when(is_head, F.coalesce("first_docs", F.array().cast("array<long>"))).otherwise(F.array("head"))
    words = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    out = placed.select("doc_id", "sig", F.col("n_words").cast("long").alias("n_words"), repeated.alias("repeated"), removed.alias("removed"), sources.alias("first_docs"))
    return out.where(F.size("repeated") > 0).select("doc_id", "sig", "n_words", words("repeated").alias("n_repeated"), words("removed").alias("n_removed"), "repeated", "removed", "first_docs")


def without_repeats(docs: DataFrame, match: int = MATCH, key: int = KEY) -> DataFrame:
    """docs with removable words cut out of text and n_chars following; rows that lose all their words go.

    Rows with a null doc_id stay as they are; so do texts without removable words.
    """
    spans = _passages(docs, match, key).where("n_removed > 0").groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set(F.struct("sig", "removed")).alias("_cut"))
    joined = docs.join(spans, F.col("doc_id") == F.col("_id"), "left").drop("_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(kernel.slices, batches)):
            cuts, text = batch.column("_cut"), batch.column("text")
            kept, new = np.ones(len(batch), bool), []
            for i in range(len(batch)):
                told = cuts[i].as_py()
                if not told:
                    new.append(text[i].as_py())
                    continue
                words = kernel.Words(text.slice(i, 1), kernel.WHITE, lower=False)
                spans = next((t["removed"] for t in told if t["sig"] == signatures(words)[0]), [])
                raw, begin = words.data.tobytes(), np.r_[words.starts, len(words.data)]
                pieces, at = [], 0
                for s in spans:
                    pieces.append(raw[at : begin[s["start"]]])
                    at = begin[s["end"]]
                left = b"".join([*pieces, raw[at:]]).decode("utf-8")
                kept[i] = bool(left.strip(" \t\n\x0b\x0c\r"))
                new.append(left)
            columns = {c: batch.column(c) for c in batch.schema.names if c != "_cut"} | {"text": pa.array(new, text.type)}
            if "n_chars" in columns:
                old = columns["n_chars"]
                columns["n_chars"] = pa.array([len(t) if cuts[i].is_valid and t is not None else old[i].as_py() for i, t in enumerate(new)], old.type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns)).filter(pa.array(kept))

    return joined.mapInArrow(work, docs.schema)


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(shared.table(spark, sf_dir, "documents"))
