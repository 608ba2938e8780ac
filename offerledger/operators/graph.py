"""Connected components by alternating large-star and small-star steps.

Each step keeps the components and points nodes at smaller neighbours, so the number of rounds
grows with the logarithm of the largest component.  A first step contracts the edges of every
partition to stars with a local union-find, which bounds rows by nodes.  Links are never gathered
on the driver: all state is an edge table, cut with checkpoint() once a round.  A table that has
become small (ONE_TASK edges, 4 MB) is finished by one task instead of by rounds of shuffles.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

MAX_ROUNDS = 60
ONE_TASK = 250_000
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only in local mode where it is unset."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "path" not in _own:
        _own["path"] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _own["path"]


def checkpoint_dir_set(df: DataFrame) -> None:
    """Checkpoints go to the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over pairs: all distinct nodes, and the smallest node of the component of each."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(nodes))
    left, right = flat[: len(a)], flat[len(a) :]
    while True:
        pa_, pb = parent[left], parent[right]
        low = np.minimum(pa_, pb)
        before = parent.copy()
        np.minimum.at(parent, pa_, low)
        np.minimum.at(parent, pb, low)
        while not np.array_equal(parent, hop := parent[parent]):
            parent = hop
        if np.array_equal(before, parent):
            return nodes, nodes[parent]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of a partition's edges, contracted batch by batch so that memory follows the nodes."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        nodes, root = roots(np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()]))
        away = nodes != root
        a, b = nodes[away], root[away]
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b", one_task: int = ONE_TASK) -> DataFrame:
    """node, component (the smallest node reachable) of every node on an edge.

    A pair of equal ends or with a null end adds nothing; repeated edges are harmless; no edges
    give an empty table.
    """
    checkpoint_dir_set(edges)
    stars = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null and u <> v").mapInArrow(_contract, "u long, v long").checkpoint()
    was = None
    for _ in range(MAX_ROUNDS):
        if stars.count() <= one_task:
            stars = stars.coalesce(1).mapInArrow(_contract, "u long, v long").checkpoint()
            break
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: every larger neighbour of u now points at the smallest of u and its neighbours.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: u and its smaller neighbours point at the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct().checkpoint()
        now = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if was == now:
            break
        was = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return stars.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _listed(column: pa.Array) -> list:
    """The column's values; an object is made once for equal ones, as their number is what costs."""
    if column.null_count == len(column):
        return [None] * len(column)
    if pa.types.is_nested(column.type):
        return column.to_pylist()
    if pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy().tolist()
    known = column.dictionary_encode()
    values = [*known.dictionary.to_pylist(), None]
    return [values[i] for i in known.indices.fill_null(-1).to_numpy().tolist()]


def replayed(rows: DataFrame, order: list[str], replay: Callable, schema: str, cells: list[str] | None = None) -> DataFrame:
    """Each component's rows in order through an object of its own, many components in a task's stream.

    replay() makes the object: see(row) gives the outcomes (tuples of schema) of a row, a dictionary or, where cells
    names its columns, a tuple of them, and done() those
    that stand at the component's end.  A task holds a batch of rows and what one object remembers.
    """
    dealt = rows.repartition("component").sortWithinPartitions("component", *order)
    empty = rows.sparkSession.createDataFrame([], schema)
    names = empty.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, current, out = None, None, []
        for batch in batches:
            each = zip(*(_listed(batch.column(c)) for c in cells), strict=True) if cells else batch.to_pylist()
            for component, row in zip(_listed(batch.column("component")), each, strict=True):
                if known is None or component != current:
                    out += known.done() if known is not None else []
                    known, current = replay(), component
                out += known.see(row)
            yield told(out)
            out = []
        yield told(known.done() if known is not None else [])

    def told(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    types = to_arrow_schema(empty.schema).types
    return dealt.mapInArrow(work, schema)
