"""Mixing sources to target weights, with DataFrame functions alone.

Weights go by a source's place in code point order (a null source is the last).  Targets share RATIO of all words by
weight; a source stops at EPOCHS times its words, and what it can't take is shared again by weight among the others.

The words of a source are packed into blocks of BLOCK consecutive words, its documents in the order of a digest.  The mix
is a row of slots, a block each, cut into shards of SHARD slots.  Every shard draws its sources' counts from the
multinomial distribution of the targets; draws beyond a source's quota of slots are taken back and dealt to those
below theirs, so that the whole mix meets every quota.  The j-th slot of a source takes the block at place j of
a pseudorandom permutation of the source's blocks, one permutation per epoch, and is joined with its block by index.

Permutations swap or don't swap an index with its partner, round by round; they are bijections of any range, so
nothing is sorted or kept.  All pseudorandom numbers are digests of what they belong to: reruns, other partitions
and lost executors give the same mix.  Sums over the rows of a source are made in two steps, over buckets and
within them, so that a source that holds most rows is spread.

Cases: null and empty texts have no words, and nothing of them is taken; a document longer than a block is in many;
rows that repeat a doc_id are documents of their own, with equal counts where their sizes are equal but for their
places; a null doc_id is kept; a source without words has the target 0; an empty table gives an empty mix; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerledger.llm import shared

WEIGHTS = (5, 2, 1)
RATIO = 1.5
EPOCHS = 2
BLOCK = 256
SHARD = 4096
ROUNDS = 24
SEED = "mix"
#: documents of a bucket, and shards of one
BUCKET = 4096
#: slots that one task makes and permutes
SLOTS_PER_TASK = 1 << 17
WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 15


def number(*parts: Column | str) -> Column:
    """60 pseudorandom bits as a long: the first digits of a digest."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), *parts)), 1, _DIGITS), 16, 10).cast("long")


def before(df: DataFrame, by: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """df with the sum of `value` over the rows of `by` that come before: in earlier buckets, and in the own one."""
    earlier = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*by, bucket).agg(F.sum(value).alias("_sum"))
    totals = totals.select(*by, bucket, F.coalesce(F.sum("_sum").over(earlier(Window.partitionBy(*by).orderBy(bucket))), F.lit(0)).alias("_past"))
    within = F.coalesce(F.sum(value).over(earlier(Window.partitionBy(*by, bucket).orderBy(*order))), F.lit(0))
    return df.withColumn(name, within).join(totals, [*by, bucket]).withColumn(name, F.col(name) + F.col("_past")).drop("_past")


def sized(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, key (the source's), size and digest of every document."""
    key = F.coalesce(F.concat(F.lit("s"), source), F.lit("t"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return rows.withColumn("digest", F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "size")))


def targets(sources: DataFrame) -> DataFrame:
    """sources (a row each: key, source_size) with their target in words.

    In ascending order of limit by weight, the sources at their limits come first: each is there if its limit is at most
    what its weight gets of what those before it leave.
    """
    ranked = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(Window.orderBy("key")) - 1) % len(WEIGHTS) + 1))
    ranked = ranked.withColumn("limit", EPOCHS * F.col("source_size"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), "key")
    left = F.lit(RATIO) * F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shared_by = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    told = ranked.withColumn("each", left / shared_by).withColumn("place", F.row_number().over(order))
    told = told.withColumn("full", F.col("limit") / F.col("weight") <= F.col("each"))
    # What a unit of weight gets: told by the first source that isn't at its limit.
    each = F.min_by("each", F.when(~F.col("full"), F.col("place"))).over(every)
    return told.withColumn("target", F.when(F.col("full"), F.col("limit").cast("double")).otherwise(each * F.col("weight"))).drop("weight", "limit", "each", "place", "full")


def planned(sources: DataFrame) -> DataFrame:
    """Targets with blocks, quota (slots), the slots of the sources before, and each epoch's round keys."""
    keyed = lambda e: F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: number(F.lit("key"), F.col("key"), F.lit(e), r) % F.col("blocks"))
    out = targets(sources).withColumn("blocks", F.ceil(F.col("source_size") / BLOCK))
    out = out.withColumn("quota", F.when(F.col("source_size") > 0, F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5)).otherwise(0))
    out = out.withColumn("first", F.sum("quota").over(Window.orderBy("key")) - F.col("quota"))
    return out.withColumn("round_keys", F.when(F.col("blocks") > 0, F.array(*map(keyed, range(EPOCHS)))))


def permuted(index: Column, n: Column, round_keys: Column, *name: Column) -> Column:
    """The place of an index under a pseudorandom permutation of 0 .. n - 1.

    In each round an index may change places with its partner (their sum is the round's key, modulo n); a bit of a
    digest of the larger of the two tells whether they do.
    """

    def turn(x: Column, r: Column) -> Column:
        partner = (F.element_at(round_keys, r) + n - x) % n
        bit = F.md5(F.concat_ws(":", F.lit(SEED), F.lit("bit"), *name, r, F.greatest(x, partner)))
        return F.when(F.substring(bit, 1, 1) >= "8", partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), turn)


def drawn(plan: DataFrame, n_slots: int, n_sources: int) -> DataFrame:
    """shard, key, count: the multinomial draw of every shard, a slot at a time; sources weigh their quotas.

    A draw is a number below n_slots; the sources' ranges of numbers are cut into cells, so that a draw meets
    the sources of its cell alone.
    """
    width = max(1, n_slots // (4 * n_sources + 1024))
    cells = plan.where("quota > 0").select("key", "first", "quota", F.explode(F.sequence(F.floor(F.col("first") / width), F.floor((F.col("first") + F.col("quota") - 1) / width))).alias("cell"))
    draws = plan.sparkSession.range(n_slots).select(F.floor(F.col("id") / SHARD).alias("shard"), (number(F.lit("draw"), F.col("id")) % n_slots).alias("draw"))
    met = draws.withColumn("cell", F.floor(F.col("draw") / width)).join(cells, "cell").where((F.col("draw") >= F.col("first")) & (F.col("draw") < F.col("first") + F.col("quota")))
    return met.groupBy("shard", "key").agg(F.count("*").alias("count"))


def settled(draws: DataFrame, plan: DataFrame) -> DataFrame:
    """shard, key, count with every quota met: what a source draws beyond its quota goes to those below theirs."""
    bucketed = draws.join(plan.select("key", "quota"), "key").withColumn("bucket", F.floor(F.col("shard") / BUCKET))
    told = before(bucketed, ["key"], "bucket", ["shard"], "count", "past")
    kept = F.least(F.col("past") + F.col("count"), "quota") - F.least("past", "quota")
    told = shared.written(told.select("shard", "key", "bucket", "count", kept.alias("kept")), "mix-draws")
    # Slots taken back, and slots wanted, each numbered from 0; there are as many of both.
    numbers = lambda first, n: F.explode(F.sequence(F.col(first), F.col(first) + F.col(n) - 1)).alias("i")
    free = told.groupBy("shard", "bucket").agg(F.sum(F.col("count") - F.col("kept")).alias("free")).withColumn("all", F.lit(0))
    free = before(free, ["all"], "bucket", ["shard"], "free", "first").where("free > 0").select("shard", numbers("first", "free"))
    wanted = plan.select("key", "quota").join(told.groupBy("key").agg(F.sum("kept").alias("kept")), "key", "left")
    wanted = wanted.select("key", (F.col("quota") - F.coalesce("kept", F.lit(0))).alias("wanted"))
    wanted = wanted.withColumn("first", F.sum("wanted").over(Window.orderBy("key")) - F.col("wanted")).where("wanted > 0").select("key", numbers("first", "wanted"))
    dealt = free.join(wanted, "i").groupBy("shard", "key").agg(F.count("*").alias("kept"))
    return told.select("shard", "key", "kept").unionByName(dealt).groupBy("shard", "key").agg(F.sum("kept").alias("count")).where("count > 0")


def slots(counts: DataFrame, plan: DataFrame, n_slots: int) -> DataFrame:
    """The mix: a row per slot with its shard, its source's key, the epoch and the block it takes.

    A count makes up to SHARD slots, so counts are dealt by the slots that there will be and not by their own size.
    """
    rows = before(counts.withColumn("bucket", F.floor(F.col("shard") / BUCKET)), ["key"], "bucket", ["shard"], "count", "first")
    rows = rows.repartition(-(-n_slots // SLOTS_PER_TASK) or 1, "shard", "key")
    rows = rows.select("shard", "key", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("slot"))
    rows = rows.join(plan.select("key", "blocks", "round_keys"), "key").withColumn("epoch", F.floor(F.col("slot") / F.col("blocks")))
    place = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.element_at("round_keys", (F.col("epoch") + 1).cast("int")), F.col("key"), F.col("epoch"))
    return rows.select("shard", "key", "epoch", "slot", place.alias("block"))


def pieces(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The blocks' contents: a row per document and block that it has words in, with their number.

    docs: sized's rows.  `start` is a document's first word in the words of its source.
    """
    spread = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BUCKET))
    # Buckets are ranges of digests, so buckets and what is in them are in one order.
    bucket = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * spread / F.lit(1 << 32))
    filled = docs.where("size > 0").join(plan.select("key", "n_docs"), "key").withColumn("bucket", bucket).drop("n_docs")
    placed = before(filled, ["key"], "bucket", ["digest", "doc_id", "size"], "size", "start").drop("bucket", "digest")
    end = F.col("start") + F.col("size")
    cut = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((end - 1) / BLOCK))))
    return cut.withColumn("words", F.least(end, (F.col("block") + 1) * BLOCK) - F.greatest(F.col("start"), F.col("block") * BLOCK))


def mix(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The documents' sizes, the sources' plan, the mix's slots and the blocks' contents."""
    rows = shared.written(sized(docs), "mix-sizes")
    sources = rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = shared.written(planned(sources), "mix-plan")
    total = plan.agg(F.coalesce(F.sum("quota"), F.lit(0)).alias("slots"), F.count("*").alias("sources")).first()
    counts = shared.written(settled(drawn(plan, total["slots"], total["sources"]), plan), "mix-counts")
    return rows, plan, slots(counts, plan, total["slots"]), pieces(rows, plan)


def taken_words(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    rows, plan, taken, content = mix(docs)
    times = taken.groupBy("key", "block").agg(F.count("*").alias("times"))
    met = content.join(times, ["key", "block"], "left").groupBy("key", "start", "doc_id", "size").agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    empty = rows.where("size = 0").select("key", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    every = met.drop("start").unionByName(empty)
    return every.join(plan.select("key", "source_size", "target"), "key").select("doc_id", "size", "source_size", "target", "taken")


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(shared.table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """SQL of op12: the same draws and permutations."""
    digits = lambda parts: f"cast('0x' || substr(md5(concat_ws(':', '{SEED}', {parts})), 1, {_DIGITS}) as bigint)"
    # An element of the round keys holds the round below the key; the index itself begins the list.
    partner = "((e >> 8) + blocks - x) % blocks"
    turn = f"case when substr(md5(concat_ws(':', '{SEED}', 'bit', key, epoch, e & 255, greatest(x, {partner}))), 1, 1) >= '8' then {partner} else x end"
    round_keys = f"list_transform(range(1, {ROUNDS + 1}), lambda r: (({digits("'key', key, epoch, r")} % blocks) << 8) + r)"
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    parts = [
        f"d as (select doc_id, coalesce('s' || source, 't') as key, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size from documents)",
        f"z as (select *, md5(concat_ws(':', '{SEED}', coalesce(cast(doc_id as varchar), '-'), size)) as digest from d)",
        "so as (select key, cast(sum(size) as bigint) as source_size from z group by key)",
        f"w as (select *, {weights}[(row_number() over (order by key) - 1) % {len(WEIGHTS)} + 1] as weight, {EPOCHS} * source_size as lim from so)",
        f"e as (select *, (cast({RATIO} as double) * sum(source_size) over () - coalesce(sum(lim) over (order by lim / weight, key rows between unbounded preceding and 1 preceding), 0)) / sum(weight) over (order by lim / weight, key rows between current row and unbounded following) as each, row_number() over (order by lim / weight, key) as place from w)",
        "f as (select *, lim / weight <= each as is_full from e)",
        "t as (select *, case when is_full then cast(lim as double) else (select min_by(each, place) from f where not is_full) * weight end as target from f)",
        f"b as (select *, cast(ceil(source_size / {BLOCK}) as bigint) as blocks, case when source_size > 0 then cast(floor(target * ceil(source_size / {BLOCK}) / source_size + 0.5) as bigint) else 0 end as quota from t)",
        "p as (select *, cast(sum(quota) over (order by key) as bigint) - quota as first, cast(sum(quota) over () as bigint) as n_slots from b)",
        f"dr as (select s.i // {SHARD} as shard, s.i, {digits("'draw', s.i")} % s.n as draw from (select unnest(range(n_slots)) as i, n_slots as n from (select max(n_slots) as n_slots from p)) s)",
        "ct as (select shard, key, count(*) as n, any_value(quota) as quota from dr join p on draw >= first and draw < first + quota group by shard, key)",
        "pa as (select *, coalesce(sum(n) over (partition by key order by shard rows between unbounded preceding and 1 preceding), 0) as past from ct)",
        "ke as (select shard, key, n, least(past + n, quota) - least(past, quota) as kept from pa)",
        "fr as (select shard, unnest(range(cast(sum(n - kept) as bigint))) as j from ke group by shard)",
        "fn as (select shard, row_number() over (order by shard, j) as i from fr)",
        "wa as (select p.key, unnest(range(cast(p.quota - coalesce(k.kept, 0) as bigint))) as j from p left join (select key, sum(kept) as kept from ke group by key) k using (key))",
        "wn as (select key, row_number() over (order by key, j) as i from wa)",
        "se as (select shard, key, sum(kept) as n from (select shard, key, kept from ke union all select shard, key, 1 from fn join wn using (i)) group by shard, key)",
        "sl as (select shard, key, unnest(range(cast(n as bigint))) as j from se)",
        "sn as (select key, row_number() over (partition by key order by shard, j) - 1 as slot from sl)",
        "sx as (select sn.key, p.blocks, slot // p.blocks as epoch, slot % p.blocks as x0 from sn join p using (key))",
        f"tk as (select key, list_reduce(list_prepend(x0, {round_keys}), lambda x, e: {turn}) as block, count(*) as times from sx group by all)",
        "pl as (select *, cast(coalesce(sum(size) over (partition by key order by digest, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0) as bigint) as start from z)",
        f"pi as (select key, doc_id, start, size, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) as block from pl where size > 0)",
        f"ta as (select key, doc_id, start, size, sum((least(start + size, (block + 1) * {BLOCK}) - greatest(start, block * {BLOCK})) * coalesce(times, 0)) as taken from pi left join tk using (key, block) group by all)",
    ]
    return f"with {', '.join(parts)} select pl.doc_id, cast(pl.size as bigint) as size, p.source_size, p.target, cast(coalesce(ta.taken, 0) as bigint) as taken from pl join p using (key) left join ta on ta.key = pl.key and ta.start = pl.start and ta.doc_id is not distinct from pl.doc_id and ta.size = pl.size"


OP12_SQL = _oracle()
