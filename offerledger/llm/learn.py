"""Linear text classifiers: hashed n-gram bags made in Arrow batches, fitted on a bounded sample.

The bag of a text is the set of its hashed n-grams: character n-grams over code points and, on
request, word unigrams and bigrams.  Bags of the training sample are computed by Spark tasks and
gathered; the sample is bounded in rows of each class (a documented parameter of each operator) and in
characters (SAMPLE_CHARS), so driver memory is bounded: a place is four bytes, values are made in blocks.
The fitted weight vector has 2**bits entries whatever the corpus is, and texts are scored where they lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerledger.llm import kernel, shared

#: a training sample holds at most this many bytes of text
SAMPLE_CHARS = 8_000_000
#: places of training rows worked on at once
AT_ONCE = 1 << 20
_M = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Bag:
    """Which n-grams make up the bag of a text, hashed to 2**bits places."""

    chars: tuple[int, ...] = (2, 3, 4)
    words: tuple[int, ...] = ()
    bits: int = 18
    lower: bool = True

    def sets(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The distinct places of each row; none for an empty text."""
        points, rows = kernel.code_points(column)
        if self.lower:
            points = np.where((points >= 65) & (points <= 90), points + 32, points)
        shift = np.uint32(32 - self.bits)
        parts: list[tuple[np.ndarray, np.ndarray, int]] = []
        value = np.zeros(len(points), np.uint32)
        for n in range(1, max(self.chars, default=0) + 1):
            size = max(len(points) - n + 1, 0)
            value = value[:size] * _M + points[n - 1 : n - 1 + size].astype(np.uint32) + np.uint32(n)
            if n in self.chars:
                spread = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                parts.append(((spread ^ (spread >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> shift, rows, n))
        if self.words:
            words = kernel.Words(column, kernel.WHITE, self.lower)
            for n in self.words:
                places = (words.grams(n)[0] >> np.uint64(64 - self.bits)).astype(np.uint32)
                parts.append((places, words.rows, n))
        claim = np.empty(1 << self.bits, np.int32)
        for i in range(len(rows) - 1):
            found = np.concatenate([places[at[i] : max(at[i], at[i + 1] - n + 1)] for places, at, n in parts])
            turn = np.arange(len(found), dtype=np.int32)
            claim[found] = turn  # the last of equal places keeps its claim
            yield found[claim[found] == turn]


def bounded_sample(labelled: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most per_class labelled ids of each class, the same ones whatever the partitioning.

    Ids are taken in the order of their hash, so the sample is spread over the whole table.
    """
    keyed = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    parts = [keyed.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


@dataclass
class Rows:
    """Sparse training rows; a place is four bytes."""

    indptr: np.ndarray
    indices: np.ndarray
    label: np.ndarray
    ids: np.ndarray

    def __len__(self) -> int:
        return len(self.label)

    def take(self, keep: np.ndarray) -> Rows:
        sizes = np.diff(self.indptr)[keep]
        pick = [self.indices[self.indptr[i] : self.indptr[i + 1]] for i in keep]
        return Rows(np.r_[0, np.cumsum(sizes)], np.concatenate(pick) if len(pick) else self.indices[:0], self.label[keep], self.ids[keep])

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of each place, place), at most AT_ONCE places or one row at a time."""
        begin = 0
        while begin < len(self):
            end = max(begin + 1, int(np.searchsorted(self.indptr, self.indptr[begin] + AT_ONCE, side="right")) - 1)
            yield np.repeat(np.arange(begin, end), np.diff(self.indptr[begin : end + 1])), self.indices[self.indptr[begin] : self.indptr[end]]
            begin = end


def rows_of_lists(table: pa.Table, column: str) -> Rows:
    """Training rows of a gathered table (doc_id, label and a list column), in the order of doc_id."""
    ids, label = np.asarray(table.column("doc_id")).astype(np.int64), np.asarray(table.column("label")).astype(float)
    order, bags = np.argsort(ids, kind="stable"), []
    for chunk in table.column(column).chunks:
        flat, cut = np.asarray(chunk.flatten()), np.r_[0, np.cumsum(np.asarray(chunk.value_lengths()).astype(np.int64))]
        bags += [flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    sizes = np.array([len(b) for b in bags], np.int64)[order]
    return Rows(np.r_[0, np.cumsum(sizes)], np.concatenate([bags[i] for i in order]).astype(np.int32, copy=False) if bags else np.zeros(0, np.int32), label[order], ids[order])


def sampled_texts(docs: DataFrame, sample: DataFrame, max_chars: int = SAMPLE_CHARS) -> DataFrame:
    """The rows of docs whose doc_id is sampled, with the sample's label: one per doc_id, max_chars bytes of text in all.

    Of rows that repeat a doc_id the one of the smallest text teaches.  Texts are taken in the order of the id's
    hash while they fit, class by class in turn, so the bound takes from both classes alike.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = F.min(F.struct("text", *others)).alias("one")
    picked = shared.written(docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(one).select("doc_id", "label", "one.*"), "sampled-texts")
    turn = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    sizes = picked.select("doc_id", F.row_number().over(turn).alias("turn"), F.octet_length("text").alias("size")).orderBy("turn", "doc_id").collect()
    fitting, total = [], 0
    for r in sizes:
        if total + r["size"] <= max_chars:
            fitting.append(r["doc_id"])
            total += r["size"]
    if len(fitting) == len(sizes):
        return picked
    return picked.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in fitting], "doc_id long")), "doc_id", "left_semi")


def gather_bags(docs: DataFrame, sample: DataFrame, bag: Bag, max_chars: int = SAMPLE_CHARS) -> Rows:
    """Bags of the sampled documents on the driver; bounded by the sample's rows and by max_chars."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                sets = list(bag.sets(batch.column("text")))
                flat = np.concatenate(sets).astype(np.int32) if sets else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), kernel.list_array(flat, np.array([len(s) for s in sets], np.int64))], ["doc_id", "label", "bag"])

    picked = sampled_texts(docs.select("doc_id", "text"), sample, max_chars)
    return rows_of_lists(picked.select("doc_id", "label", "text").mapInArrow(work, "doc_id long, label int, bag array<int>").toArrow(), "bag")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 60, memory: int = 8, tolerance: float = 1e-4) -> np.ndarray:
    """Limited-memory quasi-Newton descent with a backtracking line search."""
    value, slope = f(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.linalg.norm(slope) < tolerance:
            break
        way, kept = slope.copy(), []
        for s, y, r in reversed(past):
            kept.append(a := r * (s @ way))
            way -= a * y
        if past:
            s, y, _ = past[-1]
            way *= (s @ y) / (y @ y)
        for (s, y, r), a in zip(past, reversed(kept), strict=True):
            way += (a - r * (y @ way)) * s
        way, size = -way, 1.0 if past else min(1.0, 1 / np.linalg.norm(slope))
        down = way @ slope
        for _ in range(25):
            new_value, new_slope = f(x + size * way)
            if new_value <= value + 1e-4 * size * down:
                break
            size /= 2
        else:
            break
        s, y = size * way, new_slope - slope
        if s @ y > 1e-12:
            past = [*past, (s, y, 1 / (s @ y))][-memory:]
        done = value - new_value < 1e-7 * max(1, abs(value))
        x, value, slope = x + s, new_value, new_slope
        if done:
            break
    return x


def place_counts(rows: Rows, dims: int, weight: np.ndarray | None = None) -> np.ndarray:
    """By place: how many rows hold it, or the sum of their weights."""
    out = np.zeros(dims)
    for owner, place in rows.blocks():
        out += np.bincount(place, weights=weight[owner] if weight is not None else None, minlength=dims)
    return out


def _of_common_places(rows: Rows, common: np.ndarray) -> Rows:
    """The rows with the common places alone, renumbered."""
    number, sizes, kept = np.cumsum(common, dtype=np.int32) - 1, np.zeros(len(rows), np.int64), []
    for owner, place in rows.blocks():
        stays = common[place]
        sizes += np.bincount(owner[stays], minlength=len(rows))
        kept.append(number[place[stays]].astype(np.int32))
    return Rows(np.r_[0, np.cumsum(sizes)], np.concatenate(kept) if kept else rows.indices[:0], rows.label, rows.ids)


def fit_logistic(rows: Rows, weight: np.ndarray, dims: int, penalty: float, scale: np.ndarray | None = None, min_rows: int = 1) -> np.ndarray:
    """Weights (dims) and a bias (last) of an L2 logistic regression; weight: of each row.

    The value of a stored place is its scale, divided by the square root of the bag's size.  Places found in
    fewer than min_rows rows get no weight.  Only the places are held; values are made block by block.
    """
    short = 1 / np.sqrt(np.maximum(np.diff(rows.indptr), 1))
    common = place_counts(rows, dims) >= min_rows
    used, own = np.flatnonzero(common), _of_common_places(rows, common)
    size = scale[used] if scale is not None else np.ones(len(used))
    weight = weight / max(weight.sum(), 1e-12)

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, z = p[:-1] * size, np.zeros(len(rows))
        for owner, place in own.blocks():
            z += np.bincount(owner, weights=w[place], minlength=len(rows))
        z = z * short + p[-1]
        err = weight * (sigmoid(z) - rows.label)
        cost = float((weight * (np.logaddexp(0, z) - rows.label * z)).sum() + penalty / 2 * (p[:-1] @ p[:-1]))
        return cost, np.r_[place_counts(own, len(used), err * short) * size + penalty * p[:-1], err.sum()]

    p = minimise(loss, np.zeros(len(used) + 1))
    full = np.zeros(dims + 1)
    full[used], full[-1] = p[:-1] * size, p[-1]
    return full


def margins(rows: Rows, w: np.ndarray) -> np.ndarray:
    z = np.zeros(len(rows))
    for owner, place in rows.blocks():
        z += np.bincount(owner, weights=w[place], minlength=len(rows))
    return z / np.sqrt(np.maximum(np.diff(rows.indptr), 1)) + w[-1]


def margin(found: np.ndarray, w: np.ndarray) -> float:
    """Margin of one bag; scale is already folded into w."""
    return float(w[found].sum() / np.sqrt(len(found)) + w[-1]) if len(found) else float(w[-1])


def fit_platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a calibrated probability sigmoid(a z + b), a >= 0."""
    if len(y) == 0 or y.min() == y.max():
        return 1.0, 0.0
    weight = weight / weight.sum()
    up, n = weight[y == 1].sum(), len(y)
    goal = np.where(y == 1, 1 - 1 / (n * up + 2), 1 / (n * (1 - up) + 2))

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        t = p[0] * z + p[1]
        err = weight * (sigmoid(t) - goal)
        return float((weight * (np.logaddexp(0, t) - goal * t)).sum()) + 1e-4 * float(p @ p), np.array([err @ z, err.sum()]) + 2e-4 * p

    a, b = minimise(loss, np.array([1.0, 0.0]), steps=100, tolerance=1e-7)
    return max(float(a), 1e-3), float(b)


def class_weights(rows: Rows, totals: dict[int, int]) -> np.ndarray:
    """Weights that give the sample the class shares of all labelled rows."""
    have = {y: max(int((rows.label == y).sum()), 1) for y in (0, 1)}
    return np.where(rows.label == 1, totals.get(1, 1) / have[1], totals.get(0, 1) / have[0])
