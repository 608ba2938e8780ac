"""Merkle manifest of a dataset: a persistent, path-copying hash tree per source, and proofs against its root.

A leaf is the digest of a row's fields.  The leaves of a source, in ascending doc_id order, are hashed in runs of FAN
until one node is left, the source's subroot; the subroots, in the order of their sources, are hashed likewise to the root.

The tree is cut into aligned blocks of FAN ** DEPTH consecutive nodes, each held by one row of a table; the blocks'
own digests are the nodes of the table above, until every source has one block.  So a task never holds more than a
block, whatever the size of a source, and places within a source are counted partition by partition.  Proofs come
down the same tables: a block is joined with the siblings of its ancestors, once for all of its leaves.

A tampered leaf makes a version of the tree.  It shares all nodes with the first version but its ancestors, which
are copied: those within the leaf's block by the block, those above it from the siblings that the block was
joined with.  No version is ever stored whole.

Cases: a null field counts as `-`; a null source is a source of its own, before all others; rows with a null doc_id come
first in their source, are leaves like all others and are not tampered with by op11; rows that repeat a doc_id are
leaves of their own, in the order of their digests; a very long text is hashed whole; an empty table has no leaf and gives
an empty result; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerledger.llm import shared

FAN = 16
#: levels of a block
DEPTH = 3
BLOCK = FAN**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NODES = "key string, name string, id long, digest string, changed string, idx long, n long"
BLOCKS = "key string, block long, n long, digest string, names array<string>, ids array<long>, digests array<string>, changed array<string>"
PATHS = "key string, block long, subroot string, root string, before array<string>, after array<string>"
PROOFS = "source_key string, doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, n_copied int"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth_of(n: int) -> int:
    """Levels above n nodes until one is left."""
    depth = 0
    while n > 1:
        n, depth = -(-n // FAN), depth + 1
    return depth


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and its value, or `-` for a null."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string"))) for c in fields.values()]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column, changes: dict[str, Column]) -> DataFrame:
    """key (the source's), name, id (the doc_id), digest, and the digest with `changes` made where `tampered` holds."""
    own = {c: F.col(c) for c in FIELDS}
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    return docs.select(key.alias("key"), F.lit(None).cast("string").alias("name"), F.col("doc_id").cast("long").alias("id"), leaf_digest(own).alias("digest"), F.when(tampered, leaf_digest(own | changes)).alias("changed"))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with idx, their place among the rows of their key in ascending order, and n, the number of those.

    Rows are dealt in ranges, so a key that holds most rows takes many partitions; each counts its own, and a row per
    key and partition tells what comes before it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            codes = np.asarray(pc.dictionary_encode(batch.column("key")).indices)
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            sizes = np.diff(np.r_[starts, n])
            place = np.arange(n) - np.repeat(starts, sizes)
            if batch.column("key")[0].as_py() == last:
                place[: sizes[0]] += seen
            last, seen = batch.column("key")[n - 1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(place)], [*batch.schema.names, "part", "place"])

    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    placed = shared.written(dealt.mapInArrow(work, f"{names}, part long, place long"), "merkle-places")
    every = Window.partitionBy("key")
    before = placed.groupBy("key", "part").agg(F.count("*").alias("_n"))
    before = before.select("key", "part", (F.sum("_n").over(every.orderBy("part")) - F.col("_n")).alias("_before"), F.sum("_n").over(every).alias("n"))
    return placed.join(before, ["key", "part"]).select(*rows.columns, (F.col("_before") + F.col("place")).alias("idx"), "n")


class Block:
    """The first version of the nodes of a block, level by level, and versions that differ in a leaf."""

    def __init__(self, digests: list[str], depth: int):
        self.runs = []
        for _ in range(depth):
            self.runs.append(["".join(digests[i : i + FAN]) for i in range(0, len(digests), FAN)])
            digests = [sha(run) for run in self.runs[-1]]
        self.root = digests[0]

    def path(self, at: int) -> tuple[list[str], list[str]]:
        """The siblings before and after the ancestors of a leaf, from below to the top."""
        before, after = [], []
        for runs in self.runs:
            at, place = divmod(at, FAN)
            before.append(runs[at][: 64 * place])
            after.append(runs[at][64 * place + 64 :])
        return before, after


def version(digest: str, before: list[str], after: list[str]) -> list[str]:
    """The copied ancestors, from below to the root, of a version whose leaf has this digest."""
    copies = []
    for left, right in zip(before, after, strict=True):
        digest = sha(left, digest, right)
        copies.append(digest)
    return copies


def _packed(table: pa.Table) -> pa.Table:
    """A block of nodes as one row: n is the number of blocks of its key."""
    table = table.take(pa.array(np.argsort(table.column("idx").to_numpy(), kind="stable")))
    n, digests = table.column("n")[0].as_py(), table.column("digest").to_pylist()
    root = Block(digests, min(DEPTH, depth_of(n))).root
    row = {"key": table.column("key")[0].as_py(), "block": table.column("idx")[0].as_py() // BLOCK, "n": -(-n // BLOCK), "digest": root}
    lists = {"names": table.column("name").to_pylist(), "ids": table.column("id").to_pylist(), "digests": digests, "changed": table.column("changed").to_pylist()}
    types = {"block": pa.int64(), "n": pa.int64(), "ids": pa.list_(pa.int64()), "names": pa.list_(pa.string()), "digests": pa.list_(pa.string()), "changed": pa.list_(pa.string())}
    return pa.table({c: pa.array([v], types.get(c, pa.string())) for c, v in (row | lists).items()})


def raised(nodes: DataFrame) -> list[DataFrame]:
    """Tables of blocks, from the lowest to the one in which every key has a single block."""
    tables = []
    while True:
        packed = nodes.withColumn("block", F.floor(F.col("idx") / BLOCK)).groupBy("key", "block").applyInArrow(_packed, BLOCKS)
        tables.append(shared.written(packed, "merkle-blocks"))
        # A row per block: the largest number of blocks of a key.
        most = tables[-1].agg(F.max("n")).first()[0]
        if most is None or most == 1:
            return tables
        nothing = F.lit(None).cast("string")
        nodes = tables[-1].select("key", nothing.alias("name"), F.lit(None).cast("long").alias("id"), "digest", nothing.alias("changed"), F.col("block").alias("idx"), "n")


def _unpacked(rows: pa.RecordBatch) -> Iterator[tuple[dict, Block, list[str], list[str]]]:
    """Each block of a batch with its tree and the siblings of its ancestors."""
    for i in range(len(rows)):
        row = rows.slice(i, 1).to_pylist()[0]
        # A key's last block may be small, but has the depth of a full one if there are others.
        yield row, Block(row["digests"], DEPTH if row["n"] > 1 else depth_of(len(row["digests"]))), row["before"], row["after"]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The siblings of the ancestors of every node, as the blocks below need them."""
    kinds = {"key": pa.string(), "block": pa.int64(), "subroot": pa.string(), "root": pa.string(), "before": pa.list_(pa.string()), "after": pa.list_(pa.string())}
    for batch in batches:
        for row, tree, before, after in _unpacked(batch):
            out = []
            for i, (digest, name) in enumerate(zip(row["digests"], row["names"], strict=True)):
                left, right = tree.path(i)
                # A named node is a subroot of the tree of sources, the one block of its key.
                own = {"key": row["key"], "block": row["block"] * BLOCK + i, "subroot": row["subroot"]} if name is None else {"key": name, "block": 0, "subroot": digest}
                out.append(own | {"root": row["root"], "before": left + before, "after": right + after})
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in kinds.items()], list(kinds))


def lowered(tables: list[DataFrame], top: DataFrame) -> DataFrame:
    """The lowest table with the paths of its blocks; top: the paths of the highest table's."""
    for table in reversed(tables[1:]):
        top = table.join(top, ["key", "block"]).mapInArrow(_paths, PATHS)
    return tables[0].join(top, ["key", "block"])


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per leaf: the digest of its siblings, and the root of its version."""
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.int32()]
    names = ["source_key", "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "n_copied"]
    for batch in batches:
        for row, tree, before, after in _unpacked(batch):
            above, out = "".join(x for pair in zip(before, after, strict=True) for x in pair), []
            for i, (leaf, changed) in enumerate(zip(row["digests"], row["changed"], strict=True)):
                left, right = tree.path(i)
                copies = version(leaf if changed is None else changed, left + before, right + after)
                folded = copies[-1] if copies else leaf if changed is None else changed
                out.append((row["key"], row["ids"][i], leaf, row["subroot"], row["root"], sha(*(x for pair in zip(left, right, strict=True) for x in pair), above), folded, folded == row["root"], 0 if changed is None or changed == leaf else len(copies)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)


def verify(docs: DataFrame, tampered: Column, changes: dict[str, Column]) -> DataFrame:
    """A row per document: its leaf, the roots, its proof, and whether its version's root is the root.

    tampered: the rows of which a version is made; changes: what it changes, by field (source and doc_id, which
    place a leaf, can't be changed).  n_copied: the nodes of the version that it doesn't share with the first one.
    """
    if {"doc_id", "source"} & set(changes):
        raise ValueError("a version keeps a leaf's place")
    tables = raised(numbered(shared.written(leaves(docs, tampered, changes), "merkle-leaves"), "id", "digest"))
    subroots = tables[-1].select(F.lit("").alias("key"), F.col("key").alias("name"), F.lit(None).cast("long").alias("id"), "digest", F.lit(None).cast("string").alias("changed"))
    upper = raised(numbered(subroots, "name"))
    nothing = F.array().cast("array<string>")
    top = upper[-1].select("key", "block", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), nothing.alias("before"), nothing.alias("after"))
    sources = lowered(upper, top).mapInArrow(_paths, PATHS)
    return lowered(tables, sources).mapInArrow(_proofs, PROOFS)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = verify(shared.table(spark, sf_dir, "documents"), tampered, {"text": F.translate("text", _UPPER, _LOWER)})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _oracle(levels: int = 8, upper_levels: int = 4) -> str:
    """SQL of op11, for sources of up to FAN ** levels rows and FAN ** upper_levels sources."""
    field = lambda c: f"case when {c} is null then '-' else strlen(cast({c} as varchar)) || ':' || cast({c} as varchar) end"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    parts = [
        "crc as (select list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t)",
        "lf as (select doc_id, source, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 as tampered, lang, n_chars from documents, crc)",
        f"p0 as (select doc_id, coalesce('s' || source, '') as key, {leaf('text')} as leaf, case when tampered then {leaf(lower)} else {leaf('text')} end as f from lf)",
        "n0 as (select *, leaf as d, row_number() over (partition by key order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by key) as n from p0)",
        "l0 as (select key, i, d, n from n0)",
        "q0 as (select doc_id, key, leaf, f, i, '' as proof from n0)",
    ]

    def level(k: int, nodes: str, rows: str) -> list[str]:
        """The next nodes, and the documents' versions and proofs so far."""
        left, right = "substr(r.cat, 1, 64 * (q.i % 16)::bigint)", "substr(r.cat, 64 * (q.i % 16)::bigint + 65)"
        return [
            f"{nodes}r{k} as (select key, i // 16 as run, any_value(n) as n, string_agg(d, '' order by i) as cat from {nodes}{k} group by 1, 2)",
            f"{nodes}{k + 1} as (select key, run as i, case when n > 1 then sha256(cat) else cat end as d, (n + 15) // 16 as n from {nodes}r{k})",
            f"{rows}{k + 1} as (select q.* exclude (i, f, proof), q.i // 16 as i, case when r.n > 1 then sha256({left} || q.f || {right}) else q.f end as f, q.proof || case when r.n > 1 then {left} || {right} else '' end as proof from {rows}{k} q join {nodes}r{k} r on r.key = q.key and r.run = q.i // 16)",
        ]

    for k in range(levels):
        parts += level(k, "l", "q")
    parts += [
        f"sub as (select key, d as subroot, row_number() over (order by key) - 1 as i, count(*) over () as n from l{levels})",
        "u0 as (select '' as key, i, subroot as d, n from sub)",
        f"v0 as (select q.doc_id, '' as key, q.leaf, q.f, q.proof, s.i, s.subroot from q{levels} q join sub s using (key))",
    ]
    for k in range(upper_levels):
        parts += level(k, "u", "v")
    return f"with {', '.join(parts)} select v.doc_id, v.leaf, v.subroot, u.d as root, sha256(v.proof) as proof_sha256, v.f as folded_root, v.f = u.d as verified from v{upper_levels} v, u{upper_levels} u"


OP11_SQL = _oracle()
