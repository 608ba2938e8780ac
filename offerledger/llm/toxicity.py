"""Toxicity: character n-gram linear classifier over naive Bayes log-count ratios.

Bags of character n-grams (2 to 5 code points, A-Z lower-cased) of labelled texts give each n-gram
the log ratio of its smoothed share in toxic and in other texts; a logistic regression is fitted on
bags whose places are scaled by these ratios.  Only rows whose crc32(doc_id as text) mod 4 is not 2
are learnt from; those with 2 are the held-out fold.

Cases: a null or empty text scores the bias of the model; a null id counts as not held out and is
not learnt from; repeated rows each get their row; a doc_id labelled twice takes its largest label, and of rows
that repeat a doc_id the one of the smallest text teaches; with one class only, every score is that class's share
(0 without labels); a very long text is scored whole, and teaches if the sample's bytes (learn.SAMPLE_CHARS) allow
it; an empty table gives an empty result; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.llm import kernel, learn, shared

#: predicted is 1 from this score on
TOXIC_FROM = 0.3
#: the most labelled rows of each class that the classifier is fitted on
SAMPLE_PER_CLASS = 1000
SMOOTHING = 1.0
#: n-grams of fewer sampled rows are not learnt
MIN_ROWS = 5
BAG = learn.Bag(chars=(2, 3, 4, 5), bits=20)


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that is never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def log_count_ratios(rows: learn.Rows, dims: int, smoothing: float = SMOOTHING) -> np.ndarray:
    up, down = learn.place_counts(rows, dims, rows.label), learn.place_counts(rows, dims, 1 - rows.label)
    n1, n0 = max(rows.label.sum(), 1), max((1 - rows.label).sum(), 1)
    return np.log((up + smoothing) / (n1 + 2 * smoothing)) - np.log((down + smoothing) / (n0 + 2 * smoothing))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> np.ndarray:
    """Weights and bias; the ratios are folded into the weights."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out())
    totals = {int(r["y"]): int(r["n"]) for r in known.groupBy(F.col("toxic").cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    rows = learn.gather_bags(shared.keyed_texts(docs), learn.bounded_sample(known, "toxic", per_class), BAG)
    dims = 1 << BAG.bits
    if len(np.unique(rows.label)) < 2:
        w = np.zeros(dims + 1)
        w[-1] = 35.0 if len(rows) and rows.label[0] == 1 else -35.0
        return w.astype(np.float32)
    ratios = log_count_ratios(rows, dims)
    return learn.fit_logistic(rows, learn.class_weights(rows, totals), dims, penalty=1e-5, scale=ratios, min_rows=MIN_ROWS).astype(np.float32)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                score = learn.sigmoid(np.array([learn.margin(s, sent.value) for s in BAG.sets(batch.column("text"))]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= TOXIC_FROM).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = shared.keyed_texts(docs).mapInArrow(work, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))
