"""The corpus pipeline: quality rules, near duplicates, repeated passages, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents.  The stages' results are written and read again by whoever runs them; run() deletes each as soon as
the next one is written.

Cases, by stage (the operators' docstrings say more): null, empty and short texts (under 20 words) go with the quality
rules, and pass the other stages as they are; rows that repeat a doc_id with the same text stay or go together in every
stage, and rows with a null doc_id stay in the second and third (they name no class and no first place) and are judged
by their text in the first and fourth; of equal texts the smallest doc_id stays; a very long text is worked on whole;
an empty table gives an empty table of the same columns; further columns, whatever their names, are kept by all stages
but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from offerledger.llm import decontamination, ngram_jaccard, quality_rules, sentencepiece_agenda, shared, suffix_dedup


# Near duplicates of the corpus: sets of 5-word shingles that overlap in at least 80 %.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs, shared.table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each class of near duplicates."""
    return ngram_jaccard.one_of_each_class(docs, NEAR_WORDS, NEAR_PERCENT)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that occur earlier; the first place keeps them."""
    return suffix_dedup.without_repeats(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminated(docs, shared.table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every remaining document."""
    return sentencepiece_agenda.piece_codec(docs, public_tokenizers.path(sentencepiece_agenda.MODEL))


STAGES = [
    ("quality_rules", rule_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("suffix_dedup", passage_stage),
    ("decontamination", benchmark_stage),
    ("sentencepiece", encoding_stage),
]

#: SQL can't express the trained classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of sf_dir."""
    docs = shared.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            shared.dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
