"""Name similarity, and candidate pairs that lose no pair above a threshold.

The ratio is 2 M / T: matched characters M in ordered blocks over the total length T.  Two neighbouring blocks are
apart by an unmatched character, so there are at most T - 2M + 1 of them, and of B shared pairs of neighbouring
characters (counted with repeats) at least M minus the number of blocks lie in blocks: M <= (B + T + 1) / 3.  M is at most the number C of
shared characters, too.  So names that reach a ratio share (1.5 ratio - 1) T - 1 pairs of characters or more, and half of
ratio * T characters.

A name is therefore known by its rarest parts: if two sets of parts share k, each holds a shared one among all but its k - 1
most frequent.  Names meet at these parts alone, each pair at the rarest that it shares; a part of many names is dealt
over blocks.  Of the pairs that meet, those are compared whose B and C allow the ratio.
"""

from __future__ import annotations

import difflib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: names of one part that meet in one task
BLOCK = 2000
#: parts whose frequency tells how rare they are; normal names have at most 37 * 37, any others count as rare
COUNTED = 4096
#: from this ratio on, names share enough pairs of characters to meet by them
PAIRS_FROM = 0.7
#: ratios at which best_scores looks for candidates, one after another; below the last, any shared character counts
DESCENT = (0.92, 0.75, 0.6, 0.45, 0.3)
_EPSILON = 1e-9


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matched characters of two normalised names; the order of the arguments matters."""
    matcher, out = difflib.SequenceMatcher(), [None] * len(a)
    left, right = a.tolist(), b.tolist()
    known = [i for i in range(len(left)) if left[i] is not None and right[i] is not None]
    # The matcher prepares its second text: rows of equal ones come one after another.
    for i in sorted(known, key=right.__getitem__):
        if matcher.b != right[i]:
            matcher.set_seq2(right[i])
        matcher.set_seq1(left[i])
        out[i] = matcher.ratio()
    return pd.Series(out, dtype="float64")


def _numbered(parts: list[str], salt: str) -> list[tuple[str, int, int]]:
    """(part, its occurrence, a number for both) of each; numbers that meet by chance only make more candidates."""
    seen: Counter = Counter()
    out = []
    for p in parts:
        seen[p] += 1
        out.append((p, seen[p], zlib.crc32(f"{salt}{p}{seen[p]}".encode()) - (1 << 31)))
    return out


def _parts_of(name: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    return _numbered(list(name), "1"), _numbered([name[i : i + 2] for i in range(len(name) - 1)], "2")


def _kept(parts: list[tuple[str, int, int]], least: float, often: dict[str, int]) -> list[int]:
    """The rarest parts, without the last `least` - 1: later occurrences are rarer than first ones."""
    k = max(1, math.ceil(least - _EPSILON))
    ordered = sorted(parts, key=lambda p: (often.get(p[0], 0) / p[1], p[2]))
    return [number for _, _, number in ordered[: len(ordered) - k + 1]]


def signatures(names: DataFrame, threshold: float, often: dict[str, int]) -> DataFrame:
    """name, kind (1: met by characters, 2: by pairs), its kept parts, and numbers of all its characters and pairs."""
    sent = names.sparkSession.sparkContext.broadcast(often)
    by_pairs = threshold >= PAIRS_FROM
    slope = 1.5 * threshold - 1
    total = 2 / (2 - threshold)  # a partner's length is bounded, so T is at least this times the own one

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name in batch.column("name").to_pylist():
                chars, pairs = _parts_of(name)
                numbers = [p[2] for p in chars], [p[2] for p in pairs]
                if by_pairs and pairs:
                    out.append((name, 2, _kept(pairs, slope * total * len(name) - 1, sent.value), *numbers))
                if chars and (not by_pairs or slope * total * len(name) <= 1):
                    out.append((name, 1, _kept(chars, threshold / 2 * total * len(name), sent.value), *numbers))
            kinds = [pa.string(), pa.int32(), *[pa.list_(pa.int32())] * 3]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["name", "kind", "kept", "chars", "pairs"])

    return names.mapInArrow(work, "name string, kind int, kept array<int>, chars array<int>, pairs array<int>")


def _frequencies(names: DataFrame) -> dict[str, int]:
    """How many names hold each character and each pair of neighbours: the COUNTED most frequent, which tells rare from not."""
    cut = lambda n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - n + 1), lambda i: F.substring(F.col("name"), i, F.lit(n))))
    none = F.array().cast("array<string>")
    parts = F.concat(F.when(F.length("name") >= 1, cut(1)).otherwise(none), F.when(F.length("name") >= 2, cut(2)).otherwise(none))
    rows = names.select(F.explode(parts).alias("part")).groupBy("part").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "part").limit(COUNTED).collect()
    return {r["part"]: r["n"] for r in rows}


def _dealt(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with blocks i and j of each part: BLOCK names of either side meet in a task at most, on average."""
    sizes = lambda df, n: df.groupBy("part").agg(F.count("*").alias(n))
    hot = sizes(left, "n_l").join(sizes(right, "n_r"), "part").where((F.col("n_l") > BLOCK) | (F.col("n_r") > BLOCK))
    blocks = hot.select("part", F.ceil(F.col("n_l") / BLOCK).alias("n_i"), F.ceil(F.col("n_r") / BLOCK).alias("n_j"))
    one = F.lit(1).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(n, one) - 1))
    own = lambda name, n: F.pmod(F.xxhash64(name), F.coalesce(n, one))
    a = left.join(blocks, "part", "left").withColumn("i", own("l", F.col("n_i"))).withColumn("j", every(F.col("n_j"))).drop("n_i", "n_j")
    b = right.join(blocks, "part", "left").withColumn("j", own("r", F.col("n_j"))).withColumn("i", every(F.col("n_i"))).drop("n_i", "n_j")
    return a, b


def candidate_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (l, r) of the distinct names in column `name` of both sides that can reach threshold (above 0).

    Only names are joined, never rows: names are distinct before they are cut into parts.
    """
    distinct = lambda df: df.select("name").where("name is not null").distinct()
    a, b = distinct(left), distinct(right)
    often = _frequencies(a.unionByName(b))
    keyed = lambda df, n: signatures(df, threshold, often).select(F.col("name").alias(n), "kind", F.col("kept").alias(f"{n}_kept"), F.col("chars").alias(f"{n}_chars"), F.col("pairs").alias(f"{n}_pairs"), F.explode("kept").alias("part"))
    x, y = _dealt(keyed(a, "l"), keyed(b, "r"))
    total, slope = F.length("l") + F.length("r"), 1.5 * threshold - 1
    # Each pair is made once: by characters only if its length asks for no shared pair of them, at its rarest shared part.
    by_pairs = slope * total > 1 if threshold >= PAIRS_FROM else F.lit(False)
    met = x.join(y, ["part", "kind", "i", "j"]).where(F.when(F.col("kind") == 2, by_pairs).otherwise(~by_pairs)).where(F.array_intersect("l_kept", "r_kept")[0] == F.col("part"))
    shared = lambda what: F.size(F.array_intersect(f"l_{what}", f"r_{what}"))
    most = F.least(shared("chars").cast("double"), (shared("pairs") + total + 1) / 3)
    near = met.where(2 * most >= threshold * total - _EPSILON).select("l", "r")
    empty = a.where("name = ''").select(F.col("name").alias("l")).join(b.select(F.col("name").alias("r")).where("r = ''"), F.col("l") == F.col("r"))
    return near.unionByName(empty)


def scored_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """l, r, score of every pair of names whose similarity(l, r) is at least threshold."""
    return candidate_pairs(left, right, threshold).withColumn("score", similarity("l", "r")).where(F.col("score") >= threshold)


def best_scores(names: DataFrame, candidates: DataFrame, below: float = 1.0) -> DataFrame:
    """l, r, score: of each distinct name the most similar candidate name (the first of equals), whatever the score.

    below: a ratio that no pair is known to reach.  The threshold descends: names whose best reaches it are done, as all of their pairs from there on are known; the
    rest go on.  A name that shares no character with any candidate is left out: all its scores are 0.
    """
    left = names.select("name").where("name is not null").distinct()
    found, rest = None, left
    for threshold in (*(t for t in DESCENT if t < below), 1e-6):
        pairs = scored_pairs(rest, candidates, threshold)
        top = pairs.groupBy("l").agg(F.min_by(F.struct("r", "score"), F.struct(-F.col("score"), F.col("r"))).alias("b")).select("l", "b.r", "b.score").checkpoint()
        found = top if found is None else found.unionByName(top)
        rest = rest.join(top.select(F.col("l").alias("name")), "name", "left_anti").checkpoint()
        if rest.isEmpty():
            break
    return found
