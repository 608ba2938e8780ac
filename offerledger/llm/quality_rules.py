"""Quality rules: base counts of every text, and a calibrated n-gram classifier with fixed thresholds.

Base: words are [^\\x20\\x09-\\x0D]+.  A text fails the base rule with fewer than 20 words, or when
more than 30 % of its words lie in 8-word windows found twice or more in it.  The method: a
logistic regression over hashed word and character n-grams, fitted on labelled quality rows,
calibrated on a held-out fold of the sample and scored in Arrow batches against KEEP_FROM.

Cases: a null or empty text has no words, zero counts, and fails the base rule; repeated rows
each get their row; a null id is passed through and teaches nothing; of rows that repeat a doc_id the one of the
smallest text teaches; without labels of both classes the verdict is the base rule's alone (probability 1); a very
long text is counted and scored whole, and teaches if the sample's bytes (learn.SAMPLE_CHARS) allow it; an empty
table gives an empty result; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.llm import kernel, learn, shared

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: a text is kept if its calibrated probability of good quality is at least this
KEEP_FROM = 0.4
#: the most labelled rows of each class that the classifier is fitted on
SAMPLE_PER_CLASS = 1200
BAG = learn.Bag(chars=(2, 3, 4), words=(1, 2), bits=18)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: the bytes of #*$%&|<>
SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])


def base_counts(column: pa.Array, window: int = WINDOW) -> dict[str, np.ndarray]:
    """The five counts of each row of a text column."""
    words = kernel.Words(column, kernel.WHITE, lower=False)
    n_rows, data, offsets = len(words.counts), words.data, words.offsets

    def per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[at])

    inside = ~kernel.WHITE[data]
    out = {"n_words": words.counts, "word_chars": per_row(inside & ((data & 0xC0) != 0x80), offsets), "n_symbols": per_row(SYMBOLS[data], offsets)}

    # Lines: the words between two \n, together with the exact bytes of the line.
    up, down = kernel._power_tables(len(data) + 1)
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1])) if len(data) else np.zeros(0, np.int64)
    begin = begin[begin < len(data)]
    bytes_value = kernel._BYTE[data] * up[: len(data)]
    bytes_value[data == 0x0A] = 0
    line_hash = kernel.mix64(np.add.reduceat(bytes_value, begin) * down[begin]) if len(begin) else np.zeros(0, np.uint64)
    end = np.r_[begin[1:], len(data)] if len(begin) else begin
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=filled[1:])
    with_word = filled[end] > filled[begin] if len(begin) else np.zeros(0, bool)
    row = np.searchsorted(offsets, begin, side="right") - 1
    line_hash, row = line_hash[with_word], row[with_word]
    out["n_dup_lines"] = np.bincount(row[~first_in_row(line_hash, row)], minlength=n_rows).astype(np.int64)

    grams, whole = words.grams(window)
    at = np.flatnonzero(whole)
    owner = words.of_row()
    twice = np.zeros(len(words.starts) + 1, np.int64)
    if len(at):
        key, who = grams[at], owner[at]
        order = np.argsort(kernel.mix64(key + who.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
        k, w = key[order], who[order]
        same = (k[1:] == k[:-1]) & (w[1:] == w[:-1])
        again = np.r_[same, False] | np.r_[False, same]
        place = at[order[again]]
        np.add.at(twice, place, 1)
        np.add.at(twice, place + window, -1)
    out["n_repeat_words"] = per_row(np.cumsum(twice[:-1]) > 0, words.rows)
    return out


def first_in_row(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether no earlier entry of the same row has the value; rows ascend."""
    order = np.lexsort((np.arange(len(values)), values, row))
    first = np.ones(len(values), bool)
    if len(values):
        v, r = values[order], row[order]
        first[order[1:]] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return first


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, float, float] | None:
    """Weights and calibration from a bounded sample of labelled rows; None without both classes."""
    totals = {int(r["y"]): int(r["n"]) for r in labels.where("quality is not null").groupBy(F.col("quality").cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    rows = learn.gather_bags(shared.keyed_texts(docs), learn.bounded_sample(labels, "quality", per_class), BAG)
    if len(np.unique(rows.label)) < 2:
        return None
    fold = np.arange(len(rows)) % 5 == 4
    weight = learn.class_weights(rows, totals)
    train, held = np.flatnonzero(~fold), np.flatnonzero(fold)
    w = learn.fit_logistic(rows.take(train), weight[train], 1 << BAG.bits, penalty=1e-4, min_rows=3)
    a, b = learn.fit_platt(learn.margins(rows.take(held), w), rows.label[held], weight[held])
    return w.astype(np.float32), a, b


def _judge(text: pa.Array, model: tuple[np.ndarray, float, float] | None, keep_from: float) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts, base_failed, p_good and kept of each row."""
    counts = base_counts(text)
    p = np.ones(len(text)) if model is None else learn.sigmoid(model[1] * np.array([learn.margin(s, model[0]) for s in BAG.sets(text)]) + model[2])
    failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
    return counts, failed, p, ~failed & (p >= keep_from)


def quality_rules(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, the counts, base_failed, p_good (the calibrated probability) and kept, a row per document."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                counts, failed, p, kept = _judge(batch.column("text"), sent.value, keep_from)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(counts[c].astype(np.int64)) for c in COUNTS), pa.array(failed), pa.array(p), pa.array(kept)], ["doc_id", *COUNTS, "base_failed", "p_good", "kept"])

    return shared.keyed_texts(docs).mapInArrow(work, f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, p_good double, kept boolean")


def kept_documents(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of docs that are kept, with all their columns; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                yield batch.filter(pa.array(_judge(batch.column("text"), sent.value, keep_from)[3]))

    return docs.mapInArrow(work, docs.schema)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))
