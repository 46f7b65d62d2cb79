"""Joins and per-key results when a few keys hold most rows.

Load is estimated exactly and cheaply: rows per key are counted with map-side combine. Keys above the mean load of a
task are split into shards in proportion to their load; all other keys fall into virtual bins by hash, and bins and
shards are packed onto tasks, the fullest first. The matching side is replicated only to the shards of split keys.
Rows are partitioned by the number of the planned task itself, so that the partitions are the planned ones, and the join
is a merge join even where a side is small. The driver sees at most `tasks * 2` split keys and `BINS * tasks` bin loads,
whatever the data.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.scratch import Scratch

BINS = 16
SMALL = 1_000_000


@dataclass
class Plan:
    """Where the rows of each key go: task numbers by bin, and by split key a run of shards with their tasks."""

    tasks: int
    bins: int
    bin_task: DataFrame  # bin, bin_task: BINS a task
    split: DataFrame  # key, shard_tasks array<int>
    loads: list[float]


def _bin(c: Column, bins: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(bins)).cast("int")


def plan_balance(loads: DataFrame, key: str, tasks: int, load: str = "load") -> Plan:
    """A plan from a table of (key, load), one row per key. Keys that are null go to no task."""
    spark = loads.sparkSession
    loads = loads.where(F.col(key).isNotNull() & (F.col(load) > 0)).select(F.col(key).alias("k"), F.col(load).cast("double").alias("w"))
    total = loads.agg(F.sum("w")).first()[0] or 0.0
    fair = max(total / tasks, 1.0)
    # keys above half a task's fair share: fewer than 2 * tasks
    heavy = [(r.k, r.w) for r in loads.where(F.col("w") > fair / 2).collect()]
    bins = BINS * tasks
    light = {r.b: r.w for r in loads.where(F.col("w") <= fair / 2).groupBy(_bin(F.col("k"), bins).alias("b")).agg(F.sum("w").alias("w")).collect()}
    pieces: list[tuple[float, int, object]] = []
    for k, w in heavy:
        shards = max(1, round(w / (fair / 2)))
        pieces += [(w / shards, 1, (k, s)) for s in range(shards)]
    pieces += [(w, 0, b) for b, w in light.items()]
    heap = [(0.0, t) for t in range(tasks)]
    bin_task, shard_tasks = [b % tasks for b in range(bins)], {}
    for w, kind, what in sorted(pieces, key=lambda p: (-p[0], p[1], str(p[2]))):
        at, t = heapq.heappop(heap)
        heapq.heappush(heap, (at + w, t))
        if kind:
            shard_tasks.setdefault(what[0], {})[what[1]] = t
        else:
            bin_task[what] = t
    key_type = loads.schema["k"].dataType.simpleString()
    split = spark.createDataFrame([(k, [by[s] for s in sorted(by)]) for k, by in shard_tasks.items()], f"k {key_type}, shard_tasks array<int>")
    return Plan(tasks, bins, spark.createDataFrame(list(enumerate(bin_task)), "_bin int, bin_task int"), split, sorted(x for x, _ in heap))


def _place(df: DataFrame, key: Column, plan: Plan) -> DataFrame:
    """df with `_k`, `_tasks` (array of the key's shards, or the one task of its bin)."""
    marked = df.withColumn("_k", key).join(F.broadcast(plan.split.select(F.col("k").alias("_k"), "shard_tasks")), "_k", "left")  # under 2 * tasks rows
    marked = marked.withColumn("_bin", F.when(F.col("_k").isNotNull(), _bin(F.col("_k"), plan.bins))).join(F.broadcast(plan.bin_task), "_bin", "left")  # BINS * tasks rows
    return marked.withColumn("_tasks", F.coalesce("shard_tasks", F.array("bin_task"))).drop("shard_tasks", "_bin", "bin_task")


def fragment(df: DataFrame, key: str, plan: Plan, spread: list[str] | None = None) -> DataFrame:
    """df with the `_task` that each row belongs to.

    Rows of a split key are spread by a hash of the columns `spread`, of all columns by default. It must tell rows of
    one key apart; a random number wouldn't do, as a task that is run again must send each row where it went before.
    """
    at = F.pmod(F.xxhash64(*_columns(df, spread)), F.size("_tasks")).cast("int")
    return _place(df, F.col(f"`{key}`"), plan).withColumn("_task", F.get("_tasks", at)).drop("_tasks")


def _columns(df: DataFrame, spread: list[str] | None) -> list[Column]:
    return [F.col(f"`{c}`") for c in spread or [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]]


def _spread(df: DataFrame, plan: Plan, spread: list[str] | None) -> Column:
    """A task for rows without a key."""
    return F.pmod(F.xxhash64(*_columns(df, spread)), F.lit(plan.tasks)).cast("int")


def replicate(df: DataFrame, key: str, plan: Plan) -> DataFrame:
    """df with a copy of each row for every distinct task that holds a shard of its key."""
    return _place(df, F.col(f"`{key}`"), plan).withColumn("_task", F.explode(F.array_distinct("_tasks"))).drop("_tasks")


def balanced_join(left: DataFrame, right: DataFrame, key: str, plan: Plan, how: str = "inner", spread: list[str] | None = None) -> DataFrame:
    """left join right on key (inner, left, left_semi or left_anti), left's rows spread as planned and right's replicated.

    Rows of left with a null key match nothing; they stay in left and left_anti joins. Columns of right that have the
    name of one of left's get the suffix `_right`. Repeated rows keep their multiplicity, as in any join.
    """
    clash = {c.lower() for c in left.columns}
    names = {c: f"{c}_right" if c.lower() in clash else c for c in right.columns if c != key}
    if how in ("inner", "left_semi"):
        left = left.where(F.col(f"`{key}`").isNotNull())
    fragments = fragment(left, key, plan, spread)
    fragments = fragments.withColumn("_task", F.coalesce("_task", _spread(left, plan, spread)))
    copies = replicate(right.where(F.col(f"`{key}`").isNotNull()), key, plan).select("_task", "_k", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return placed(fragments, plan).join(placed(copies, plan).hint("merge"), ["_task", "_k"], how).drop("_task", "_k")


def placed(df: DataFrame, plan: Plan) -> DataFrame:
    """df with `_task`, each row in the partition of that number."""
    return df.repartitionById(plan.tasks, F.col("_task"))


def lookup(left: DataFrame, right: DataFrame, on: str, rows: int | None = None, share: int | None = None) -> DataFrame:
    """Left join with a table of one row per key. The keys with most of left's rows, at most `share` of them, are looked
    up by broadcast, so that no task gets more than 1/share of all rows for one key; share is four a task of the
    session, 256 at least. rows: left has no more than so many; up to SMALL, all of one key would still be a small task,
    and a plain join does."""
    if rows is not None and rows <= SMALL:
        return left.join(right, on, "left")
    share = share or max(256, 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = left.where(F.col(on).isNotNull()).groupBy(on).count()
    # keys above 1/share of all rows are among the first `share` by count
    heavy = counts.where(F.col("count") > 10_000).orderBy(F.desc("count"), on).limit(share).select(on)
    hot = right.join(F.broadcast(heavy), on, "left_semi")
    marked = left.join(F.broadcast(heavy.withColumn("_hot", F.lit(True))), on, "left")
    return marked.where("_hot").drop("_hot").join(F.broadcast(hot), on, "left").unionByName(marked.where("_hot is null").drop("_hot").join(right, on, "left"))


def measure(rows: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(key, load): rows per non-null key, materialised."""
    return scratch.save(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("load")))


def value_counts(rows: DataFrame, key: str, value: str, totals: DataFrame, plan: Plan, spread: list[str] | None = None) -> DataFrame:
    """(key, n_key, value, n): how often each value stands with each key, beside the key's total, made shard by shard.

    rows: key and value, any of them null: null keys count nowhere, null values only in the total. totals: (key, load).
    """
    rows = rows.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(key, value, *(spread or []))
    joined = balanced_join(rows, totals.select(key, F.col("load").alias("n_key")), key, plan, spread=spread)
    return joined.groupBy(key, "n_key", value).agg(F.count("*").alias("n"))
