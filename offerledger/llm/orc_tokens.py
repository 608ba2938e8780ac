"""Token ids as ORC: run-length encoded integers in stripes, with row indexes and Bloom filters.

Every text is encoded with a byte-level BPE vocabulary of the tokenizers library, ends with END_ID and
is written in ascending doc_id order.  A file is a range of doc_ids, so the table is in order across
files; within a file, stripes are read in parallel, and row indexes and Bloom filters on doc_id let
readers skip stripes and row groups.  `start`, the number of ids before a document, comes from the
files themselves: each row holds the number of ids before it in its file, and files have totals.

Encoding cuts texts where the library's pre-tokenizer always does: before a run of ASCII white space, and
between an ASCII letter and ASCII punctuation (but the apostrophe).  Each distinct unit is encoded once
per worker by the library and remembered under a 64-bit hash.  Texts with other white space or with a
special token's string go to the library whole.

Cases: null and empty texts are END_ID alone; documents that repeat a doc_id follow each other in an
order given by their text; rows with a null doc_id come first; a very long text is one row of one stripe; an empty
table gives no files' rows and an empty result; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from offerledger.llm import kernel, shared, units

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: units remembered by a worker; the memory is emptied when full
REMEMBERED = 3_000_000
#: units handed to the library at once
AT_ONCE = 1000
STRIPE_BYTES = 16 << 20
ROW_GROUP = 10_000
SCHEMA = "doc_id long, place long, n_tokens long, ids array<int>"

_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_PUNCTUATION = np.array([33 <= b < 127 and not chr(b).isalnum() and b != 39 for b in range(256)])


class Encoder:
    """The library's tokenizer, asked once for each unit."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.memory = units.Memory()

    def whole_rows(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows with white space beyond ASCII, or with the string of a special token."""
        at = []
        if len(data) and data.max() >= 128:
            a, b, c = data[:-2], data[1:-1], data[2:]
            two = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
            three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))))
            at = [np.flatnonzero(two), np.flatnonzero(three)]
        raw = data.tobytes()
        for word in self.special:
            place = raw.find(word)
            while place >= 0:
                at.append(np.array([place]))
                place = raw.find(word, place + 1)
        places = np.concatenate(at) if at else np.zeros(0, np.int64)
        return np.unique(np.searchsorted(offsets, places, side="right") - 1)

    def ask(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, one after another, and how many each has."""
        ids, sizes = [], []
        for k in range(0, len(strings), AT_ONCE):
            some = strings[k : k + AT_ONCE]
            found = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.int32))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each row."""
        data, offsets = kernel.utf8(column)
        n = len(offsets) - 1
        if not len(data):
            return [np.zeros(0, np.int32)] * n
        blank, letter, sign = _BLANK[data], _LETTER[data], _PUNCTUATION[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        cut[1:-1] |= (blank[1:] & ~blank[:-1]) | (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
        if len(self.memory) > REMEMBERED:
            self.memory = units.Memory()
        rows = units.rows_of_units(self.memory, data, np.flatnonzero(cut[:-1]), offsets, self.ask)
        for row in self.whole_rows(data, offsets):
            rows[row] = np.array(self.library.encode(data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace"), add_special_tokens=False).ids, np.int32)
        return rows


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder, loaded once per worker; its library runs on the task's own thread."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(texts: DataFrame, path: str) -> DataFrame:
    """doc_id, place (ids before it in its partition), n_tokens and ids (END_ID last) of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = encoder_of(path), 0
        for whole in batches:
            for batch in kernel.slices(whole):
                end = np.array([END_ID], np.int32)
                ids = [x for row in encoder.encode(batch.column("text")) for x in (row, end)]
                sizes = np.array([len(x) + 1 for x in ids[::2]], np.int64)
                place = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(place), pa.array(sizes), kernel.list_array(np.concatenate(ids), sizes)], ["doc_id", "place", "n_tokens", "ids"])

    return texts.mapInArrow(work, SCHEMA)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str) -> None:
    """Write the ORC files of docs to folder, in ascending doc_id order from file to file."""
    texts = shared.keyed_texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        encoded(texts, vocabulary)
        .write.format("orc")
        .option("orc.compress", "ZSTD")
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.row.index.stride", str(ROW_GROUP))
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .save(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the files: doc_id, place, n_tokens, ids, and the number of the file.

    A filter on doc_id reaches the files (stripes and row groups are skipped), as does a selection of columns.
    """
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)-", 1).cast("long")
    return spark.read.schema(SCHEMA).orc(folder).withColumn("file", number)


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = np.ascontiguousarray(np.asarray(ids.flatten()), "<u4")
            cut = np.r_[0, np.cumsum(np.asarray(ids.value_lengths()))]
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("doc_id"), batch.column("place"), pa.array(np.diff(cut)), pa.array(sums, pa.int64())], ["file", "doc_id", "place", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, folder).select("file", "doc_id", "place", "ids").mapInArrow(work, "file long, doc_id long, place long, n_tokens long, ids_crc32 long")
    # One row per file: as many as the writer had partitions, whatever the number of documents.
    files = read_tokens(spark, folder).groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = files.select("file", (F.sum("total").over(Window.orderBy("file")) - F.col("total")).alias("before"))
    return rows.join(before, "file").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared.shared_dir(spark)}/orc-tokens-{uuid.uuid4().hex}"
    write_tokens(shared.table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY))
    return token_index(spark, folder)
