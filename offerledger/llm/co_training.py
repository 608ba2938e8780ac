"""Quality classifier by co-training: a text view and a page-metadata view teach each other.

The views see different things.  The text view is a logistic regression over hashed character and word
n-grams of the whole text.  The metadata view is one over categories of lang, source and n_chars, and of the page's
shape (how many lines, how long, and the shares of capitals, digits, signs and blanks); it sees no word.
Both start from labelled rows.  In each of ROUNDS rounds each view scores all
unlabelled documents and hands the ones it is surest of (CONFIDENT or more, at most PER_ROUND, in the
labelled class shares) and that it hasn't handed over yet to the *other* view as pseudo-labelled rows.  The last models' margins are
calibrated and combined by a logistic regression on a fold of labelled rows that neither has learnt
from, and all documents are scored in Arrow batches.

Fitting uses at most SAMPLE_PER_CLASS labelled rows of each class (and learn.SAMPLE_CHARS bytes of text), in the
order of the hash of doc_id, and what was handed over (bounded likewise in each round).  Documents are scored
where they lie; only the bags of those handed over are gathered.

Cases: null and empty texts have an empty text bag and zero sizes; null lang, source and n_chars are
categories of their own; without both classes every score is that class (0.5 without labels);
repeated rows each get a row; of rows that repeat a doc_id the one of the smallest text teaches; a null doc_id
is kept, but teaches nothing; a very long text is scored whole, and teaches if the sample's bytes allow it; an
empty table gives an empty result; missing lang, source or n_chars columns count as null, and other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.llm import kernel, learn, shared

ROUNDS = 3
SAMPLE_PER_CLASS = 900
PER_ROUND = 200
CONFIDENT = 0.9
#: the chance of class 1 from which a document is kept; where nearly all rows are of that class, 0.5 would keep too many others
KEEP_FROM = 0.8
BAG = learn.Bag(chars=(3, 4), words=(1,), bits=18)
META_BITS = 12


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, text and the metadata columns; missing ones are null."""
    have = set(docs.columns)
    column = lambda c, kind: (F.col(c) if c in have else F.lit(None)).cast(kind).alias(c)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), column("lang", "string"), column("source", "string"), column("n_chars", "long"))


def meta_sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Places of the metadata categories of each row, hashed to 2**META_BITS."""
    data, offsets = kernel.utf8(batch.column("text"))

    def counted(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[offsets])

    size = np.maximum(np.diff(offsets), 1)
    lines = counted(data == 10) + 1
    white = kernel.WHITE[data]
    signs = (data < 128) & kernel.ALNUM[data] & ~white & ~((data >= 65) & (data <= 90))
    steps = {
        "lines": np.floor(2 * np.log2(lines)),
        "line": np.floor(2 * np.log2(size / lines)),
        "capitals": np.floor(20 * counted((data >= 65) & (data <= 90)) / size),
        "digits": np.floor(20 * counted((data >= 48) & (data <= 57)) / size),
        "signs": np.floor(30 * counted(signs) / size),
        "blanks": np.floor(30 * counted(white) / size),
        "bytes": np.floor(2 * np.log2(size)),
    }
    chars = pc.fill_null(batch.column("n_chars"), -1).to_numpy(zero_copy_only=False)
    steps["n_chars"] = np.where(chars < 0, -1, np.floor(2 * np.log2(np.maximum(chars, 1))))
    hashed = []
    for i, value in enumerate(steps.values()):
        hashed.append(kernel.mix64((value.astype(np.int64) + 1000).astype(np.uint64) * np.uint64(64) + np.uint64(i)))
    for i, name in enumerate(("lang", "source")):
        words = pa.array([f"{name}={v}" for v in batch.column(name).to_pylist()], pa.string())
        hashed.append(kernel.window_hashes(kernel.Words(words, kernel.separators(), lower=False).hashes, np.arange(len(batch) + 1), 1)[0] + np.uint64(i))
    places = (np.stack(hashed, axis=1) >> np.uint64(64 - META_BITS)).astype(np.int64)
    return [np.unique(row) for row in places]


@dataclass
class View:
    """One view's rows: labelled ones, then those handed over."""

    rows: learn.Rows
    dims: int
    penalty: float

    def fit(self, at: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
        rows = self.rows.take(at)
        rows.label = label
        return learn.fit_logistic(rows, weight, self.dims, self.penalty, min_rows=3)


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    platt: tuple[tuple[float, float], tuple[float, float]]
    combine: np.ndarray
    taught: tuple[dict[int, int], dict[int, int]]  # pseudo-labels that each view has been given, by doc_id


#: (models, slope and shift of each view, (class, at most) pairs, ids given to each view) ->
#: for each view the (doc_id, class) it hands over, and the bags of all of them
Surest = Callable[[list, list, list, list], tuple[list[list[tuple[int, int]]], tuple[learn.Rows, learn.Rows]]]


def gather(docs: DataFrame, sample: DataFrame) -> tuple[learn.Rows, learn.Rows]:
    """Text and metadata bags of the sampled documents (label -1: pool), in the order of doc_id."""
    picked = learn.sampled_texts(docs, sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole):
                bags = [s.astype(np.int32) for s in BAG.sets(batch.column("text"))]
                meta = [s.astype(np.int32) for s in meta_sets(batch)]
                lists = [kernel.list_array(np.concatenate(x), np.array([len(s) for s in x])) for x in (bags, meta)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *lists], ["doc_id", "label", "bag", "meta"])

    got = picked.select("doc_id", "label", "text", "lang", "source", "n_chars").mapInArrow(work, "doc_id long, label int, bag array<int>, meta array<int>").toArrow()
    return learn.rows_of_lists(got, "bag"), learn.rows_of_lists(got, "meta")


def _joined(a: learn.Rows, b: learn.Rows) -> learn.Rows:
    return learn.Rows(np.r_[a.indptr, a.indptr[-1] + b.indptr[1:]], np.concatenate([a.indices, b.indices]), np.concatenate([a.label, b.label]), np.concatenate([a.ids, b.ids]))


def surest_of_rows(text_rows: learn.Rows, meta_rows: learn.Rows) -> Surest:
    """The surest of gathered rows."""
    rows = (text_rows, meta_rows)

    def surest(models, platt, quotas, taught):
        handed = [[], []]
        for v, (a, b) in enumerate(platt):
            p = learn.sigmoid(a * learn.margins(rows[v], models[v]) + b)
            for y, most in quotas:
                sure = p if y else 1 - p
                able = [i for i in np.argsort(-sure, kind="stable") if sure[i] >= CONFIDENT and int(rows[v].ids[i]) not in taught[1 - v]]
                handed[v] += [(int(rows[v].ids[i]), y) for i in able[:most]]
        ids = {i for h in handed for i, _ in h}
        at = np.array([k for k, i in enumerate(text_rows.ids) if int(i) in ids], np.int64)
        return handed, (text_rows.take(at), meta_rows.take(at))

    return surest


def surest_documents(docs: DataFrame, labels: DataFrame) -> Surest:
    """The surest of all documents of metadata() without a label, scored by Spark; ties by doc_id."""
    labelled = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    spark = docs.sparkSession

    def surest(models, platt, quotas, taught):
        sent = spark.sparkContext.broadcast(([m.astype(np.float32) for m in models], platt))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (text, meta), ((a, b), (c, d)) = sent.value
            for whole in batches:
                for batch in kernel.slices(whole):
                    p = learn.sigmoid(a * np.array([learn.margin(s, text) for s in BAG.sets(batch.column("text"))]) + b)
                    q = learn.sigmoid(c * np.array([learn.margin(s, meta) for s in meta_sets(batch)]) + d)
                    sure = np.maximum(np.maximum(p, 1 - p), np.maximum(q, 1 - q)) >= CONFIDENT
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array(q)], ["doc_id", "p0", "p1"]).filter(pa.array(sure))

        scored = docs.where("doc_id is not null").mapInArrow(work, "doc_id long, p0 double, p1 double").join(labelled, "doc_id", "left_anti")
        scored = shared.written(scored, "co-training-scores")
        sent.destroy()
        handed: list[list[tuple[int, int]]] = [[], []]
        for v in (0, 1):
            given = spark.createDataFrame([(i,) for i in taught[1 - v]], "doc_id long")
            fresh = scored.join(F.broadcast(given), "doc_id", "left_anti")
            for y, most in quotas:
                sure = F.col(f"p{v}") if y else 1 - F.col(f"p{v}")
                top = fresh.groupBy("doc_id").agg(F.max(sure).alias("sure")).where(F.col("sure") >= CONFIDENT).orderBy(F.desc("sure"), "doc_id").limit(most)
                handed[v] += [(r["doc_id"], y) for r in top.collect()]
        ids = sorted({i for h in handed for i, _ in h})
        sample = spark.createDataFrame([(i, -1) for i in ids], "doc_id long, label int")
        return handed, gather(docs, sample)

    return surest


def co_train(text_rows: learn.Rows, meta_rows: learn.Rows, totals: dict[int, int], rounds: int = ROUNDS, per_round: int = PER_ROUND, surest: Surest | None = None) -> Model | None:
    """Fit both views on labelled rows, exchange confident pseudo-labels, calibrate and combine.

    Without surest, rows of label -1 are the unlabelled ones.
    """
    label = text_rows.label
    known, pool = np.flatnonzero(label >= 0), np.flatnonzero(label < 0)
    if len(np.unique(label[known])) < 2:
        return None
    surest = surest or surest_of_rows(text_rows.take(pool), meta_rows.take(pool))
    text_rows, meta_rows = text_rows.take(known), meta_rows.take(known)
    label, known = text_rows.label, np.arange(len(known))
    fold = known % 4 == 3
    train, held = known[~fold], known[fold]
    views = (View(text_rows, 1 << BAG.bits, 1e-4), View(meta_rows, 1 << META_BITS, 1e-3))
    weight = learn.class_weights(text_rows, totals)
    share = totals.get(1, 1) / max(totals.get(0, 0) + totals.get(1, 0), 1)
    quotas = [(1, round(per_round * share)), (0, round(per_round * (1 - share)))]
    taught: tuple[dict[int, int], dict[int, int]] = ({}, {})
    usual = float(np.mean(weight[train]))

    def fitted(v: int) -> np.ndarray:
        place = {int(i): len(known) + k for k, i in enumerate(views[v].rows.ids[len(known) :])}
        extra = sorted(i for i in taught[v] if i in place)
        at = np.concatenate([train, np.array([place[i] for i in extra], np.int64)])
        return views[v].fit(at, np.concatenate([label[train], np.array([taught[v][i] for i in extra], float)]), np.concatenate([weight[train], np.full(len(extra), usual / 2)]))

    models = [fitted(0), fitted(1)]
    for _ in range(rounds):
        platt = [learn.fit_platt(learn.margins(views[v].rows.take(held), models[v]), label[held], weight[held]) for v in (0, 1)]
        handed, bags = surest(models, platt, quotas, taught)
        for v in (0, 1):
            for i, y in handed[v]:
                taught[1 - v].setdefault(i, y)
        for view, more in zip(views, bags, strict=True):
            new = np.flatnonzero(~np.isin(more.ids, view.rows.ids[len(known) :]))
            view.rows = _joined(view.rows, more.take(new))
        if not any(handed):
            break
        models = [fitted(0), fitted(1)]
    margins = [learn.margins(views[v].rows.take(held), models[v]) for v in (0, 1)]
    platt = tuple(learn.fit_platt(z, label[held], weight[held]) for z in margins)
    logits = np.stack([a * z + b for z, (a, b) in zip(margins, platt, strict=True)], axis=1)
    logits = np.clip(logits, -8, 8)
    w = weight[held] / weight[held].sum()

    def loss(q: np.ndarray) -> tuple[float, np.ndarray]:
        z = logits @ q[:2] + q[2]
        err = w * (learn.sigmoid(z) - label[held])
        far = q - np.array([0.5, 0.5, 0.0])
        return float((w * (np.logaddexp(0, z) - label[held] * z)).sum()) + 0.01 * float(far @ far), np.r_[logits.T @ err, err.sum()] + 0.02 * far

    combine = learn.minimise(loss, np.array([0.5, 0.5, 0.0]), tolerance=1e-7)
    return Model(models[0].astype(np.float32), models[1].astype(np.float32), platt, combine, taught)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, per_round: int = PER_ROUND) -> Model | None:
    rows = metadata(docs)
    totals = {int(r["y"]): int(r["n"]) for r in labels.where("quality is not null").groupBy(F.col("quality").cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    text_rows, meta_rows = gather(rows, learn.bounded_sample(labels, "quality", per_class))
    model = co_train(text_rows, meta_rows, totals, per_round=per_round, surest=surest_documents(rows, labels))
    if model is None and len(totals) == 1:
        return next(iter(totals)) * 1.0
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, per_round: int = PER_ROUND) -> DataFrame:
    """doc_id, text_score, meta_score, score, predicted and kept of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class, per_round))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for whole in batches:
            for batch in kernel.slices(whole):
                if isinstance(m, Model):
                    z = np.stack([np.array([learn.margin(s, m.text) for s in BAG.sets(batch.column("text"))]), np.array([learn.margin(s, m.meta) for s in meta_sets(batch)])], axis=1)
                    logits = np.clip(z * np.array([m.platt[0][0], m.platt[1][0]]) + np.array([m.platt[0][1], m.platt[1][1]]), -8, 8)
                    text, meta, score = learn.sigmoid(logits[:, 0]), learn.sigmoid(logits[:, 1]), learn.sigmoid(logits @ m.combine[:2] + m.combine[2])
                else:
                    text = meta = score = np.full(len(batch), 0.5 if m is None else m)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text), pa.array(meta), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(score >= KEEP_FROM)], ["doc_id", "text_score", "meta_score", "score", "predicted", "kept"])

    return metadata(docs).mapInArrow(work, "doc_id long, text_score double, meta_score double, score double, predicted int, kept boolean")


def op3_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))
