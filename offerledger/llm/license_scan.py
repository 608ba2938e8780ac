"""License scan: consecutive base phrases, and a positional index of licence templates by idf weight.

Words are runs of letters, digits and non-ASCII characters of the lower-cased (A-Z) text.

Base: every place where the words of a base phrase stand one after another.

The method: templates (short licence notices, below) are indexed by word, with the word's positions.
The document frequency of every template word is counted over the whole corpus.  Every template word of
a document is looked up, the postings are intersected by relative position (place in the document minus
place in the template), and each alignment is scored by the share of the template's idf weight found
at it.  A template is a label if that share is ALIGNED or more at an alignment and all of its key phrases
stand, word for word, within the aligned stretch; no other notice of the document changes that.

Cases: null and empty texts have no words, labels '' and score 0; repeated rows each get a row; a null
doc_id is kept; a very long text is scanned whole; an empty table gives an empty result; other columns, whatever
their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.llm import kernel, shared

# Phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Licence notices by label, each with the phrases that must stand in it.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

ALIGNED = 0.6


def _hashes(text: str) -> np.ndarray:
    return kernel.Words(pa.array([text]), kernel.ALNUM, lower=True).hashes


class Templates:
    """Word numbers, idf weights and positional postings of the templates."""

    def __init__(self, frequency: dict[int, int] | None = None, n_docs: int = 0):
        self.words = [_hashes(text) for _, text, _ in TEMPLATES]
        self.vocabulary = np.unique(np.concatenate(self.words))
        counts = np.array([(frequency or {}).get(int(w), 0) for w in self.vocabulary.view(np.int64)], float)
        self.idf = np.log((n_docs + 1) / (counts + 1)) + 1e-3
        self.numbers = [np.searchsorted(self.vocabulary, w) for w in self.words]
        self.totals = np.array([self.idf[x].sum() for x in self.numbers])
        pairs = [(w, t, p) for t, x in enumerate(self.numbers) for p, w in enumerate(x)]
        order = sorted(pairs)
        self.at = np.searchsorted(np.array([w for w, _, _ in order]), np.arange(len(self.vocabulary) + 1))
        self.template, self.place = np.array([t for _, t, _ in order]), np.array([p for _, _, p in order])
        self.phrases = [[np.searchsorted(self.vocabulary, _hashes(k)) for k in keys] for _, _, keys in TEMPLATES]
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def number(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of template words among hashes, and their numbers."""
        at = np.flatnonzero(self.filter[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[number] == hashes[at]
        return at[same], number[same]

    def find(self, row: np.ndarray, at: np.ndarray, number: np.ndarray) -> dict[int, dict[str, float]]:
        """Row: {label: best share} of the templates that align with the template words (row, place, number) of a batch."""
        sizes = self.at[number + 1] - self.at[number]
        posting = np.repeat(self.at[number], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        longest, width = max(map(len, self.numbers)), int(at.max(initial=0)) + 1
        shift = np.repeat(at, sizes) - self.place[posting] + longest
        key = (np.repeat(row, sizes) * len(TEMPLATES) + self.template[posting]) * (width + longest) + shift
        key, which = np.unique(key, return_inverse=True)
        weight = np.bincount(which, weights=np.repeat(self.idf[number], sizes), minlength=len(key))
        owner, begin = np.divmod(key, width + longest)
        enough = weight >= ALIGNED * self.totals[owner % len(TEMPLATES)] - 1e-9
        cut, of_place = np.searchsorted(row, np.arange(int(row.max(initial=-1)) + 2)), {}
        found: dict[int, dict[str, float]] = {}
        for r, t, begin in zip((owner[enough] // len(TEMPLATES)).tolist(), (owner[enough] % len(TEMPLATES)).tolist(), (begin[enough] - longest).tolist(), strict=True):
            if r not in of_place:
                of_place = {r: dict(zip(at[cut[r] : cut[r + 1]].tolist(), number[cut[r] : cut[r + 1]].tolist(), strict=True))}
            here, words_of = of_place[r], self.numbers[t]
            match = np.array([here.get(begin + i, -1) == w for i, w in enumerate(words_of)])
            share = float(self.idf[words_of[match]].sum() / self.totals[t])
            if share >= ALIGNED and all(self._stands(p, here, begin, len(words_of)) for p in self.phrases[t]):
                best = found.setdefault(r, {})
                best[TEMPLATES[t][0]] = max(best.get(TEMPLATES[t][0], 0.0), min(share, 1.0))
        return found

    @staticmethod
    def _stands(phrase: np.ndarray, of_place: dict[int, int], begin: int, size: int) -> bool:
        return any(all(of_place.get(begin + s + i, -1) == w for i, w in enumerate(phrase)) for s in range(size - len(phrase) + 1))


def document_frequencies(texts: DataFrame) -> tuple[dict[int, int], int]:
    """In how many documents each template word stands, and how many documents there are.

    A task counts its own documents; a row per template word and task is shuffled.
    """
    vocabulary = Templates().vocabulary

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates, counts, n = Templates(), np.zeros(len(vocabulary), np.int64), 0
        for whole in batches:
            for batch in kernel.slices(whole):
                words = kernel.Words(batch.column("text"), kernel.ALNUM, lower=True)
                at, number = templates.number(words.hashes)
                row = np.searchsorted(words.rows, at, side="right") - 1
                counts += np.bincount(np.unique(row * len(vocabulary) + number) % len(vocabulary), minlength=len(vocabulary))
                n += len(batch)
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(kernel.as_long(vocabulary)), pa.nulls(1, pa.int64())]), pa.array(np.r_[counts, n])], ["word", "n"])

    rows = texts.mapInArrow(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: int(r["n"]) for r in rows}
    return counts, counts.pop(None, 0)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: a row per document."""
    texts = shared.keyed_texts(docs)
    sent = docs.sparkSession.sparkContext.broadcast(Templates(*document_frequencies(texts)))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = sent.value
        phrases = [(_hashes(p), label) for p, label in BASE.items()]
        for whole in batches:
            for batch in kernel.slices(whole):
                words = kernel.Words(batch.column("text"), kernel.ALNUM, lower=True)
                h, rows, n = words.hashes, words.rows, len(batch)
                n_base, first, last = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
                base: list[set[str]] = [set() for _ in range(n)]
                for phrase, label in phrases:
                    size = len(phrase)
                    if len(h) < size:
                        continue
                    start = np.flatnonzero(h[: len(h) - size + 1] == phrase[0])
                    for i in range(1, size):
                        start = start[h[start + i] == phrase[i]]
                    row = np.searchsorted(rows, start, side="right") - 1
                    inside = start + size <= rows[row + 1]
                    for r, s in zip(row[inside].tolist(), (start[inside] - rows[row[inside]]).tolist(), strict=True):
                        n_base[r] += 1
                        first[r] = s if first[r] < 0 else min(first[r], s)
                        last[r] = max(last[r], s)
                        base[r].add(label)
                at, number = templates.number(h)
                row = np.searchsorted(rows, at, side="right") - 1
                aligned = templates.find(row, at - rows[row], number)
                labels, scores = [], []
                for r in range(n):
                    found = aligned.get(r, {})
                    labels.append(",".join(sorted(base[r] | set(found))))
                    scores.append(max([1.0 if base[r] else 0.0, *found.values()]))
                where = [pa.array(np.where(n_base == 0, 0, x), pa.int64(), mask=n_base == 0) for x in (first, last)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.counts.astype(np.int64)), pa.array(n_base), *where, pa.array([",".join(sorted(b)) for b in base], pa.string()), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names)

    return texts.mapInArrow(work, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(shared.table(spark, sf_dir, "documents"))
