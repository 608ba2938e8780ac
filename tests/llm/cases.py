"""Small inputs that every operator has to stand, and plain versions of their definitions."""

from __future__ import annotations

import re

WHITE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, sig long, token string, item_id long"


def odd_documents(spark):
    """Nulls in any column, empty and blank texts, a very long one, ties, repeated rows, clashing names."""
    prose = " ".join(f"wort{i % 37} ünd{i % 11}" for i in range(60))
    rows = [
        (1, prose, "de", "s", len(prose)),
        (2, prose, "de", "s", len(prose)),
        (2, prose, "de", "s", len(prose)),
        (3, None, None, None, None),
        (4, "", "en", "s", 0),
        (5, " \t\n\r ", "en", None, 5),
        (6, "one", "en", "s", 3),
        (7, "x y z " * 30_000, "en", "s", 180_000),
        (8, "日本 語の 文章 " + "é" * 5000, None, "s", None),
        (None, prose, "de", "s", 1),
        (9, "a\x00b ▁▁ <s> </s> <|endoftext|> 　 😀", "en", "s", 1),
        (10, prose + " and some words more than before", "de", "s", 1),
    ]
    return spark.createDataFrame([(*r, 7, 8, "t", 9) for r in rows], SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 11)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def documents(spark, sf: str = SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts(spark, sf: str = SF) -> dict[int, str]:
    return {r.doc_id: r.text or "" for r in documents(spark, sf).select("doc_id", "text").collect()}
