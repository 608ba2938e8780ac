"""Tables kept in parts, changed batch by batch: a batch writes the parts it touches, then one small commit.

Under `path`, rows/batch=<id>/part=<part>/ holds what a batch wrote of a part, and commits/<id>.json the folders that
make up the table after that batch.  A batch goes by the newest commit before its own id, so one that is run again sees
what it saw before and overwrites its own files: it adds nothing twice.  Files of a batch without a commit are never
read.  A commit names folders, so it grows with the parts and never with the rows; it is written aside and renamed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def bucket(column: str | Column, buckets: int) -> Column:
    """A part by hash: equal values are in one part."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("string")


@dataclass(frozen=True)
class PartTable:
    path: str
    schema: str

    def _files(self, spark: SparkSession, path: str):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(spark._jsc.hadoopConfiguration()), where

    def _names(self, spark: SparkSession, path: str) -> list[str]:
        system, where = self._files(spark, path)
        return [x.getPath().getName() for x in system.listStatus(where)] if system.exists(where) else []

    def commits(self, spark: SparkSession, before: int | None = None) -> list[int]:
        """Ids of the batches committed (before one), ascending."""
        ids = [int(n[:-5]) for n in self._names(spark, f"{self.path}/commits") if n.endswith(".json")]
        return sorted(i for i in ids if before is None or i < before)

    def folders(self, spark: SparkSession, before: int | None = None) -> list[tuple[str, str]]:
        """(part, folder) of the table as it is, or as it was before a batch."""
        ids = self.commits(spark, before)
        if not ids:
            return []
        system, where = self._files(spark, f"{self.path}/commits/{ids[-1]}.json")
        stream = system.open(where)
        try:
            told = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return sorted(map(tuple, json.loads(told)))

    def _commit(self, spark: SparkSession, batch: int, folders: list[tuple[str, str]]) -> None:
        system, aside = self._files(spark, f"{self.path}/commits/{batch}.json.new")
        stream = system.create(aside, True)
        stream.write(bytearray(json.dumps(folders).encode()))
        stream.close()
        _, where = self._files(spark, f"{self.path}/commits/{batch}.json")
        system.delete(where, False)
        if not system.rename(aside, where):
            raise OSError(f"{self.path}: batch {batch} wasn't committed")

    def read(self, spark: SparkSession, parts: set[str] | None = None, before: int | None = None) -> DataFrame:
        """The table's rows, of all parts or of some: no file of another part is listed or read."""
        paths = [f"{self.path}/rows/{folder}" for part, folder in self.folders(spark, before) if parts is None or part in parts]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, part: Column, batch: int, keep: list[tuple[str, str]]) -> None:
        spark = rows.sparkSession
        columns = spark.createDataFrame([], self.schema).columns
        rows = rows.select(*columns, part.cast("string").alias("part"))
        folder = f"{self.path}/rows/batch={batch}"
        # Rows of a part lie together; adaptive execution splits a large part by its size and joins small ones.
        rows.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(folder)
        new = [(n[5:], f"batch={batch}/{n}") for n in self._names(spark, folder) if n.startswith("part=")]
        self._commit(spark, batch, keep + new)

    def written(self, spark: SparkSession, batch: int) -> DataFrame:
        """What a committed batch wrote."""
        mine = [f"{self.path}/rows/{f}" for _, f in self.folders(spark, batch + 1) if f.startswith(f"batch={batch}/")]
        return spark.read.schema(self.schema).parquet(*mine) if mine else spark.createDataFrame([], self.schema)

    def append(self, rows: DataFrame, part: Column, batch: int) -> None:
        """Add rows; of a batch that was appended already nothing is added."""
        self._write(rows, part, batch, self.folders(rows.sparkSession, batch))

    def replace(self, rows: DataFrame, part: Column, batch: int, parts: set[str]) -> None:
        """rows are what the given parts hold from now on; all other parts stay."""
        self._write(rows, part, batch, [(p, f) for p, f in self.folders(rows.sparkSession, batch) if p not in parts])

    def compact(self, spark: SparkSession, part: Column, batch: int, most: int = 1) -> None:
        """Parts of more than `most` folders become one folder each, under an id of its own."""
        held: dict[str, int] = {}
        for p, _ in self.folders(spark, batch):
            held[p] = held.get(p, 0) + 1
        if small := {p for p, n in held.items() if n > most}:
            self.replace(self.read(spark, small, batch), part, batch, small)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Delete what none of the last `keep` commits needs."""
        ids = self.commits(spark)
        needed = {f for i in ids[-keep:] for _, f in self.folders(spark, i + 1)}
        written = {n for n in self._names(spark, f"{self.path}/rows") if n.startswith("batch=") and int(n[6:]) <= (ids or [-1])[-1]}
        gone = [f"rows/{b}/{p}" for b in written for p in self._names(spark, f"{self.path}/rows/{b}") if f"{b}/{p}" not in needed]
        for name in gone + [f"commits/{i}.json" for i in ids[:-keep]]:
            system, where = self._files(spark, f"{self.path}/{name}")
            system.delete(where, True)


def touched(keys: DataFrame, part: Column) -> set[str]:
    """The parts of some keys: at most as many as there are parts."""
    return {r["part"] for r in keys.select(part.cast("string").alias("part")).distinct().collect()}
