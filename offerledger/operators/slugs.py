"""Page slugs for new merchants, as a loop over them would hand them out, without the loop.

A row takes the first free one of base, base-2, base-3 ...  Rows of one base take ascending numbers, so a row's
number follows from its turn and from the numbers that are blocked: those of taken slugs, and those that another base
took first.  Two bases meet in one slug alone: where one is the other with a number behind it ("nike" and "nike-2"),
in the longer one's own.  It goes to the longer base's first row if that comes before the row of the shorter base that
would get there.  Which one it is depends on meetings at smaller numbers and of shorter bases only, so rounds over
the meetings settle them one after another; rows are numbered once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerledger.functions import text as T
from offerledger.operators.graph import checkpoint_dir_set


def running(rows: DataFrame, by: str, order: list[str], value: str, name: str) -> DataFrame:
    """rows with the sum of `value` over the rows of `by` up to and with each, in ascending order.

    Rows are dealt in ranges of (by, order), so one that holds most rows takes many partitions; each adds up its own, and a row
    per partition tells what comes before.
    """
    dealt = rows.repartitionByRange(by, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    every = Window.partitionBy(by)
    sums = dealt.groupBy(by, "_part").agg(F.sum(value).alias("_sum"))
    sums = sums.select(F.col(by).alias("_by"), F.col("_part").alias("_p"), (F.sum("_sum").over(every.orderBy("_part")) - F.col("_sum")).alias("_past"))
    own = dealt.withColumn(name, F.sum(value).over(Window.partitionBy(by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    return own.join(sums, (F.col(by) == F.col("_by")) & (F.col("_part") == F.col("_p"))).withColumn(name, F.col(name) + F.col("_past")).drop("_part", "_by", "_p", "_past")


def base_slug(name: Column) -> Column:
    """The normalised name's slug, else the name's, else "marchand"."""
    filled = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(filled(F.replace(T.normalize_name(name), F.lit(" "), F.lit("-"))), filled(T.slugify(name)), F.lit("marchand"))


def _spots(slugs: DataFrame) -> DataFrame:
    """base, n: what a slug blocks; number 1 of itself, and n of what stands before its number."""
    number = F.regexp_extract("slug", "-([1-9][0-9]*)$", 1).try_cast("long")
    stem = F.regexp_replace("slug", "-[1-9][0-9]*$", "")
    return slugs.select(F.col("slug").alias("base"), F.lit(1).cast("long").alias("n")).unionByName(slugs.where(number >= 2).select(stem.alias("base"), number.alias("n")))


def _settled(turns: DataFrame, bases: DataFrame, blocked: DataFrame, taken: DataFrame, order: str) -> DataFrame:
    """base, n: the numbers that are blocked for each base once every meeting of two bases is settled."""
    longer = bases.join(taken.select(F.col("slug").alias("base")), "base", "left_anti").select(F.col("base").alias("slug"), F.col("first").alias("at"))
    met = _spots(longer.select("slug")).where("n > 1").join(bases.select("base"), "base", "left_semi")
    met = met.withColumn("slug", F.concat_ws("-", "base", "n")).join(longer, "slug").withColumn("kept", F.lit(True)).checkpoint()
    if met.isEmpty():
        return blocked
    rows = turns.select("base", F.col("turn").alias("_turn"), F.col(order).alias("_order"))
    while True:
        # The longer base keeps its slug (and blocks the shorter one's number), or has lost it.
        now = blocked.unionByName(met.where("kept").select("base", "n")).unionByName(met.where("not kept").select(F.col("slug").alias("base"), F.lit(1).cast("long").alias("n"))).distinct()
        here = met.select("base", "n", "slug", "at", "kept", F.lit(0).alias("held"))
        line = now.select("base", "n", F.lit(1).alias("held")).unionByName(here, allowMissingColumns=True)
        # Of equal numbers the meeting comes first: what it blocks itself doesn't count for it.
        told = running(line, "base", ["n", "held"], "held", "below").where("slug is not null")
        would = told.join(rows, (told["base"] == rows["base"]) & (F.col("_turn") == F.col("n") - F.col("below")), "left").drop(rows["base"])
        new = would.select("base", "n", "slug", "at", F.coalesce(F.col("at") < F.col("_order"), F.lit(True)).alias("kept"), F.col("kept").alias("_was")).checkpoint()
        if new.where("kept <> _was").isEmpty():
            return now
        met = new.drop("_was")


def allocate_slugs(new: DataFrame, taken: DataFrame, order: str = "alias") -> DataFrame:
    """A free slug for each new merchant (name), in the order of a column without ties."""
    checkpoint_dir_set(new)
    based = new.withColumn("base", base_slug(F.col("name"))).withColumn("_one", F.lit(1))
    turns = running(based, "base", [order], "_one", "turn").drop("_one").checkpoint()
    bases = turns.groupBy("base").agg(F.min(order).alias("first"))
    used = taken.select("slug").where("slug is not null").distinct()
    blocked = _spots(used).join(bases.select("base"), "base", "left_semi").distinct()
    gone = _settled(turns, bases, blocked, used, order)
    # The turn-th free number: every blocked one with fewer free numbers below it than `turn` moves it up by one.
    ranked = running(gone.withColumn("_one", F.lit(1)), "base", ["n"], "_one", "rank").select("base", (F.col("n") - F.col("rank")).alias("free"), F.lit(1).alias("held"))
    line = turns.withColumn("_place", 2 * F.col("turn")).withColumn("held", F.lit(0)).unionByName(ranked.select("base", (2 * F.col("free") + 1).alias("_place"), "held"), allowMissingColumns=True)
    placed = running(line, "base", ["_place", "held"], "held", "up").where("turn is not null").withColumn("n", F.col("turn") + F.col("up"))
    slug = F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", "n"))
    return placed.withColumn("slug", slug).select(*new.columns, "slug")
