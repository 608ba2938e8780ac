"""Trained operators: held-out accuracy, folds and odd inputs; and the pipeline against its parts."""

from __future__ import annotations

import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa

import corpus_pipeline
from offerledger.llm import co_training, learn, quality_rules, sentencepiece_agenda, toxicity
from tests.llm import cases
from tests.llm.test_pairs import classes, repeats

SF = "/root/testdata/sf0.01"


def test_toxicity(spark):
    rows = {r.doc_id: r for r in toxicity.op2_toxicity(spark, SF).collect()}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [i for i, r in rows.items() if r.held_out and i in toxic]
    assert np.mean([rows[i].predicted == toxic[i] for i in held]) > 0.9
    assert np.mean([rows[i].predicted for i in held if not toxic[i]]) < 0.03


def test_toxicity_learns_no_held_out_label(spark):
    """Turning the labels of the held-out fold changes nothing."""
    docs, labels = cases.documents(spark), spark.read.parquet(f"{cases.SF}/labels.parquet")
    turned = labels.withColumn("toxic", learn.F.when(toxicity.held_out(), 1 - learn.F.col("toxic")).otherwise(learn.F.col("toxic")))
    score = lambda y: {r.doc_id: r.score for r in toxicity.toxicity(docs, y, 50).collect()}
    assert score(labels) == score(turned)


def test_odd_rows(spark):
    docs = cases.odd_documents(spark)
    for scored in (lambda d, y: toxicity.toxicity(d, y, 5), lambda d, y: quality_rules.quality_rules(d, y, 5), lambda d, y: co_training.quality_scores(d, y, 5, 5)):
        for y in (cases.labels(spark), cases.no_labels(spark), cases.labels(spark).where("quality = 1")):
            rows = scored(docs, y).collect()
            ids = [1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10, None]
            assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i in ids)
            told = [{c: r[c] for c in r.asDict() if c != "doc_id"} for r in rows if r.doc_id in (1, 2)]
            same = lambda c: len({str(t[c]) for t in told}) == 1
            assert all(same(c) for c in told[0] if c not in ("held_out", "score", "meta_score", "p_good"))
            for c in ("score", "p_good"):
                assert all(0 <= r[c] <= 1 for r in rows if c in r)
        assert scored(cases.empty_documents(spark), cases.labels(spark)).count() == 0
    kept = quality_rules.kept_documents(docs, cases.no_labels(spark))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2}


def held_out(spark):
    """A fifth of the labelled rows, by a hash of the id, and the labels without them."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fold = learn.F.crc32(learn.F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return {r.doc_id: r.quality for r in labels.where(fold).collect()}, labels.where(~fold)


def test_quality_rules_on_rows_never_learnt_from(spark):
    docs, (known, labels) = cases.documents(spark, "/root/testdata/sf0.1"), held_out(spark)
    rows = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels).collect()}
    assert len(rows) == docs.count() and all(not r.kept for r in rows.values() if r.base_failed)
    assert np.mean([rows[i].kept for i, y in known.items() if y == 1]) > 0.95
    assert np.mean([rows[i].kept for i, y in known.items() if y == 0]) < 0.05


def test_co_training_on_rows_never_learnt_from(spark, monkeypatch):
    """Good rows stay and bad ones go; each view hands over at least half of its quota of each class."""
    docs, (known, labels) = cases.documents(spark, "/root/testdata/sf0.1"), held_out(spark)
    models, fit = [], co_training.fit
    monkeypatch.setattr(co_training, "fit", lambda *given: models.append(fit(*given)) or models[0])
    rows = {r.doc_id: r for r in co_training.quality_scores(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert np.mean([rows[i].kept for i, y in known.items() if y == 1]) > 0.95
    assert np.mean([rows[i].kept for i, y in known.items() if y == 0]) < 0.05
    assert np.mean([rows[i].predicted == y for i, y in known.items()]) > 0.94
    counts = Counter(int(r.quality) for r in labels.where("quality is not null").collect())
    for given in models[0].taught:
        for y in (0, 1):
            assert sum(v == y for v in given.values()) >= co_training.ROUNDS * co_training.PER_ROUND * counts[y] / sum(counts.values()) / 2
    for view in ("text_score", "meta_score", "score"):
        assert auc([getattr(rows[i], view) for i in known], list(known.values())) > 0.75


def auc(score: list[float], y: list[int]) -> float:
    """The chance that a row of class 1 is scored above one of class 0."""
    rank = np.argsort(np.argsort(score))
    y = np.array(y)
    return float((rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum()))


def test_the_views_see_different_things():
    """The text view sees the whole text; to the metadata view, words of one shape are the same."""
    sets = list(co_training.BAG.sets(pa.array(["Abc de, fgh 12.", "Xyz uv, wst 98."])))
    assert not np.array_equal(*map(np.sort, sets))
    batch = lambda t: pa.RecordBatch.from_arrays([pa.array([t]), pa.array(["en"]), pa.array(["s"]), pa.array([9], pa.int64())], ["text", "lang", "source", "n_chars"])
    (one,), (two,) = co_training.meta_sets(batch("Abc de, fgh 12.")), co_training.meta_sets(batch("Xyz uv, wst 98."))
    assert np.array_equal(one, two)


def test_samples_are_bounded_in_rows_and_bytes(spark):
    """One row per doc_id, and no more text than allowed; from both classes alike."""
    docs = spark.createDataFrame([(i, "x" * (1000 if i < 20 else 10)) for i in range(60)] + [(30, "w"), (30, "x" * 500)], "doc_id long, text string")
    sample = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int")
    whole = learn.sampled_texts(docs, sample).collect()
    assert len(whole) == 60 and {r.text for r in whole if r.doc_id == 30} == {"w"}
    some = learn.sampled_texts(docs, sample, 5000).collect()
    assert sum(len(r.text) for r in some) <= 5000 and 10 <= len(some) < 60 and {r.label for r in some} == {0, 1}
    assert len(learn.gather_bags(docs, sample, learn.Bag(bits=10), 5000)) == len(some)


def test_views_teach_each_other():
    """A view that can't tell alone is taught by the other's confident pseudo-labels."""
    r = np.random.default_rng(0)
    n, known = 900, 80
    y = r.integers(0, 2, n)
    label = np.where(np.arange(n) < known, y, -1).astype(float)
    text = [np.unique(np.r_[r.integers(0, 20, 3) + 30 * t, 5000 + r.integers(0, 400, 6)]) for t in y]
    meta = [np.unique(np.r_[r.integers(0, 3, 1) + 10 * t if r.random() < 0.9 else 5, 50 + r.integers(0, 20, 2)]) for t in y]
    rows = lambda sets: learn.Rows(np.r_[0, np.cumsum([len(s) for s in sets])], np.concatenate(sets), label, np.arange(n))
    model = co_training.co_train(rows(text), rows(meta), {0: 500, 1: 500}, rounds=3, per_round=100)
    alone = co_training.co_train(rows(text), rows(meta), {0: 500, 1: 500}, rounds=0)
    accuracy = lambda m: np.mean((learn.margins(rows(text), m.text)[known:] > 0) == y[known:])
    assert accuracy(model) >= accuracy(alone) and accuracy(model) > 0.9


def test_every_unlabelled_document_may_teach(spark):
    """Each round hands over the surest of all documents that were not handed over before."""
    docs, labels = cases.documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    rare = spark.createDataFrame([(10_000 + i, f"plain words number {i} of a page", "xx", "rare", 30) for i in range(2_000)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = co_training.metadata(docs.unionByName(rare))
    text, meta = co_training.gather(rows, learn.bounded_sample(labels, "quality", 100))
    some = labels.where("quality is not null").select("doc_id")
    every, every_meta = co_training.gather(rows, rows.select("doc_id").join(some, "doc_id", "left_anti").distinct().withColumn("label", learn.F.lit(-1)))
    totals = {0: 500, 1: 500}
    got = co_training.co_train(text, meta, totals, per_round=40, surest=co_training.surest_documents(rows, labels))
    want = co_training.co_train(text, meta, totals, per_round=40, surest=co_training.surest_of_rows(every, every_meta))
    assert len(every) > 2_000
    for v in (0, 1):
        assert len(got.taught[v]) > 40 and len(set(got.taught[v].items()) & set(want.taught[v].items())) >= 0.9 * len(want.taught[v])
        assert not set(got.taught[v]) & {r.doc_id for r in some.collect()}


def test_pipeline_against_its_parts(spark):
    """Every stage's decisions take effect, and columns are those of documents."""
    docs = cases.documents(spark)
    labels = spark.read.parquet(f"{cases.SF}/labels.parquet")
    columns, steps = docs.columns, {}
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard", "suffix_dedup", "decontamination", "sentencepiece"]

    kept = stages["quality_rules"](spark, docs, cases.SF)
    steps["a"] = {r.doc_id: r.text for r in kept.collect()}
    assert set(steps["a"]) == {r.doc_id for r in quality_rules.quality_rules(docs, labels).collect() if r.kept}
    kept = spark.createDataFrame(kept.collect(), docs.schema)
    single = stages["ngram_jaccard"](spark, kept, cases.SF)
    steps["b"] = {r.doc_id: r.text for r in single.collect()}
    assert set(steps["b"]) == {c for _, c in classes(steps["a"]).values()}
    single = spark.createDataFrame(single.collect(), docs.schema)
    cut = stages["suffix_dedup"](spark, single, cases.SF)
    steps["c"] = {r.doc_id: r.text for r in cut.collect()}
    found = repeats(steps["b"])
    assert all(len(cases.WHITE.findall(steps["c"].get(i, ""))) == len(cases.WHITE.findall(t)) - found.get(i, (0, 0))[1] for i, t in steps["b"].items())
    cut = spark.createDataFrame(cut.collect(), docs.schema)
    clean = stages["decontamination"](spark, cut, cases.SF)
    assert clean.columns == columns == cut.columns == single.columns
    last = stages["sentencepiece"](spark, clean, cases.SF)
    assert last.count() == clean.count() <= len(steps["c"])
    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, cases.SF).collect()}
    assert whole == {r.doc_id: r.ids_sha256 for r in last.collect()}


def test_pipeline_stages_on_odd_rows(spark):
    """What each stage keeps of nulls, empty and long texts, ties, repeated rows and further columns."""
    docs, stages = cases.odd_documents(spark), dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())
    keys = lambda *x: sorted((i is None, i or 0) for i in x)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, cases.empty_documents(spark)):
            assert stage(spark, df, cases.SF).columns == docs.columns, name
        assert stage(spark, cases.empty_documents(spark), cases.SF).count() == 0, name
    kept = ids(stages["quality_rules"](spark, docs, cases.SF))
    assert not set(kept) & set(keys(3, 4, 5, 6, 7)) and kept.count((False, 2)) in (0, 2)
    assert ids(stages["ngram_jaccard"](spark, docs, cases.SF)) == keys(1, 3, 4, 5, 6, 7, 8, 9, None)
    cut = stages["suffix_dedup"](spark, docs, cases.SF)
    assert ids(cut) == keys(1, 3, 4, 5, 6, 7, 8, 9, 10, None)
    texts, before = {r.doc_id: r for r in cut.collect()}, {r.doc_id: r for r in docs.collect()}
    assert all(texts[i] == before[i] for i in (1, 3, 4, 5, 6, 8, 9, None))
    assert texts[10].text.split() == "and some words more than before".split() and texts[7].text.split() == ["x", "y", "z"]
    assert ids(stages["decontamination"](spark, docs, cases.SF)) == ids(docs)
    assert ids(stages["sentencepiece"](spark, docs, cases.SF)) == ids(docs)


def test_model_is_loaded_once_per_worker():
    path = sentencepiece_agenda.public_tokenizers.path(sentencepiece_agenda.MODEL)
    assert sentencepiece_agenda.model_of(path) is sentencepiece_agenda.model_of(path)


WORKER = """
import re
import numpy as np
import pyarrow as pa
from offerledger.llm import kernel, quality_rules, suffix_dedup


def held():
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024


def texts():
    words = [f"w{i}" for i in range(3000)]
    for seed in range(3):
        draws = np.random.default_rng(seed).integers(0, 3000, (10_000, 350))
        yield pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array([" ".join([words[i] for i in row]) for row in draws.tolist()])], ["doc_id", "text"])


model = np.zeros((1 << quality_rules.BAG.bits) + 1, np.float32), 1.0, 0.0
for _ in suffix_dedup._suffixes(50, 25)(texts()):
    pass
for whole in texts():
    for batch in kernel.slices(whole):
        quality_rules._judge(batch.column("text"), model, 0.4)
del whole, batch
print(held())
"""


def test_a_worker_gives_back_what_its_batches_took():
    """Workers stay for the pipeline's next stages; what they keep adds up beside the executor's heap."""
    out = subprocess.run([sys.executable, "-c", WORKER], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True, timeout=300)
    assert float(out.stdout) < 140
