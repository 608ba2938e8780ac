"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding runs a score-ordered agenda of adjacent symbol pairs: the pair whose joined piece has the
highest score is merged first (the leftmost of equal scores), its new neighbours enter the agenda, and
stale entries are skipped.  Symbols that are in no piece fall back to their UTF-8 bytes.  No piece
holds a blank sign after another character, and none a line break (both tested when the model is
loaded), so merges never cross those places and every unit between them is encoded once per worker
and remembered under a 64-bit hash.  Each Arrow batch's new units are checked against the sentencepiece library, which
also decodes; a difference raises an error.

Cases: null and empty texts encode to the begin and end ids alone and decode to ''; rows with a null
doc_id keep it; repeated rows each get a row; a very long text is encoded whole; an empty table gives an empty
result; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from offerledger.llm import kernel, shared, units

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
#: units remembered by a worker; the memory is emptied when full
REMEMBERED = 2_000_000


class Model:
    """The vocabulary of one model file, its agenda encoder and the library's decoder."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        if any(re.search(f"[^{BLANK}]{BLANK}|\n", piece) for piece in self.ids):
            raise ValueError("pieces cross word or line ends: this vocabulary can't be encoded by units")
        if sp.encode("a", out_type=str) != [f"{BLANK}a"]:
            raise ValueError("only models that put a blank before the text are supported")
        self.memory = units.Memory()

    def agenda(self, unit: str) -> tuple[int, ...]:
        """Ids of a unit: merge the best-scored adjacent pair until none is a piece."""
        scores, n = self.scores, len(unit)
        symbols: list[str | None] = list(unit)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            joined = unit[i : i + 2]
            if joined in scores:
                agenda.append((-scores[joined], i, joined))
        heapify(agenda)
        while agenda:
            _, i, joined = heappop(agenda)
            j = after[i]
            if symbols[i] is None or j >= n or len(symbols[i]) + len(symbols[j]) != len(joined):
                continue  # one of the two has been merged elsewhere
            symbols[i], symbols[j] = joined, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = joined + symbols[k]
                if wider in scores:
                    heappush(agenda, (-scores[wider], i, wider))
            h = before[i]
            if h >= 0:
                wider = symbols[h] + joined
                if wider in scores:
                    heappush(agenda, (-scores[wider], h, wider))
        out: list[int] = []
        for symbol in symbols:
            if symbol is not None:
                found = self.ids.get(symbol)
                out += [found] if found is not None else [self.bytes[b] for b in symbol.encode("utf-8")]
        return tuple(out)

    def ask(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units by the agenda, checked against the library, which gets them as lines of one text."""
        found = [self.agenda(u.replace(" ", BLANK)) for u in strings]
        line_end = self.bytes[10]
        lines = [(u, ids) for u, ids in zip(strings, found, strict=True) if u != "\n"]
        if lines:
            theirs = np.array(self.library.encode("\n".join(["x", *(u for u, _ in lines)]), num_threads=1), np.int64)
            ours = np.array(list(chain.from_iterable((line_end, *ids) for _, ids in lines)), np.int64)
            if not np.array_equal(ours, theirs[np.flatnonzero(theirs == line_end)[0] :]):
                raise ValueError("the agenda and the sentencepiece library differ")
        return np.array(list(chain.from_iterable(found)), np.int32), np.array([len(x) for x in found], np.int64)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each row, without begin and end ids."""
        data, offsets = kernel.utf8(column)
        filled = np.flatnonzero(np.diff(offsets))
        if not len(filled):
            return [np.zeros(0, np.int32)] * (len(offsets) - 1)
        # A blank goes before every text that isn't empty; written blank signs are blanks as well.
        data = np.insert(data, offsets[filled], 32)
        offsets = offsets + np.r_[0, np.cumsum(np.diff(offsets) > 0)]
        if (data == 0xE2).any():
            sign = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
            if len(sign):
                data = data.copy()
                data[sign] = 32
                gone = np.concatenate([sign + 1, sign + 2])
                offsets = offsets - np.searchsorted(np.sort(gone), offsets)
                data = np.delete(data, gone)
        blank, line = data == 32, data == 10
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        cut[1:-1] |= (blank[1:] & ~blank[:-1]) | line[1:] | line[:-1]
        if len(self.memory) > REMEMBERED:
            self.memory = units.Memory()
        return units.rows_of_units(self.memory, data, np.flatnonzero(cut[:-1]), offsets, self.ask)


_models: dict[str, Model] = {}


def model_of(path: str) -> Model:
    """The model, loaded once per worker."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def piece_codec(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip and, on request, ids: a row per document.

    round_trip: the decoded text is the text itself (blank signs read as blanks).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(model_path)
        for whole in batches:
            for batch in kernel.slices(whole):
                texts = batch.column("text").to_pylist()
                ends = np.array([model.begin], np.int32), np.array([model.end], np.int32)
                arrays = [np.concatenate([ends[0], x, ends[1]]).astype("<u4") for x in model.encode(batch.column("text"))]
                decoded = model.library.decode([x.tolist() for x in arrays], num_threads=1)
                columns = [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in arrays], pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in arrays]),
                    pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded]),
                    pa.array([d == t.replace(BLANK, " ") for d, t in zip(decoded, texts, strict=True)]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
                if with_ids:
                    columns.append(kernel.list_array(np.concatenate(arrays).astype(np.int32), np.array([len(x) for x in arrays])))
                yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids
    return shared.keyed_texts(docs).mapInArrow(work, schema)


def op6_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec(shared.table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
