"""Splits that keep related records together.

Records and the entities they name form a bipartite graph. Each round hands the smallest label in reach of two links on
and contracts what took a new label; labels are ordered by a hash, so the graph shrinks by a constant factor a round
whatever its shape. Entities that no longer connect anything leave the graph at once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.operators.skew import lookup
from loomspan.scratch import Scratch

UNITS = 4096
STRATA = 512
#: The largest units that are also tried in exchange for others.
SWAPPED = 64
#: How much more a split's share of all records counts than its labels.
SHARE_FIRST = 100
#: Numbers held at a time when exchanges are tried.
HELD = 4_000_000


def node(c: Column) -> Column:
    """A label: ordered by hash, equal only for equal keys."""
    return F.concat(F.lpad(F.hex(F.xxhash64(c)), 16, "0"), F.lit(":"), c)


def _linking(edges: DataFrame, scratch: Scratch, old: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Edges of right nodes that still join two or more left ones."""
    more = edges.groupBy("b").agg(F.min("a").alias("m"), F.max("a").alias("x")).where("m != x").select("b", "m")
    return scratch.save(lookup(edges, more, "b", rows).where("m is not null"), old)


def components(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, component) of the left nodes of (a, b) whose component isn't their own label: all others are their own."""
    edges = _linking(pairs.where("a is not null and b is not null").select("a", "b").distinct(), scratch)
    n = edges.count()  # of a written table; there are never more edges or labels to look up than that
    mapping = scratch.save(edges.select("a", F.col("a").alias("component")).distinct())
    while True:
        smallest = scratch.save(edges.groupBy("a").agg(F.min("m").alias("to")))
        if smallest.where("a != to").isEmpty():
            return mapping.where("a != component")
        # two steps of pointers at once
        jump = lookup(smallest, smallest.select(F.col("a").alias("to"), F.col("to").alias("on")), "to", n).select("a", F.coalesce("on", "to").alias("to"))
        jump = scratch.save(jump, smallest)
        mapping = scratch.save(lookup(mapping, jump.select(F.col("a").alias("component"), "to"), "component", n).select("a", F.coalesce("to", "component").alias("component")), mapping)
        moved = lookup(edges.select("a", "b"), jump, "a", n).select(F.coalesce("to", "a").alias("a"), "b").distinct()
        edges = _linking(moved, scratch, edges, n)


def group_keys(records: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Records (id, a, b, ...) with `k` in place of a and b, the key that decides their group, and the table (k, component).

    k is the first entity if known, else the second, else null: the record is a group of its own. A key that isn't in
    the table is its own component. The records are read once.
    """
    keyed = records.withColumn("_a", node(F.concat(F.lit("a"), F.col("a")))).withColumn("_b", node(F.concat(F.lit("b"), F.col("b")))).drop("a", "b")
    keyed = scratch.save(keyed)
    pairs = scratch.save(keyed.select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("b is not null").distinct())
    merged = components(pairs, scratch)
    # a record with only a second entity goes with the first entities that this is named with
    through = pairs.where("a is not null").groupBy("b").agg(F.min("a").alias("a")).join(merged, "a", "left").select(F.col("b").alias("k"), F.coalesce("component", "a").alias("component"))
    table = merged.select(F.col("a").alias("k"), "component").unionByName(through)
    return keyed.withColumn("k", F.coalesce("_a", "_b")).drop("_a", "_b"), scratch.save(table)


def leaking(records: DataFrame, scratch: Scratch) -> DataFrame:
    """The ids of records (id, a, b, split) whose group lies in more than one split; null splits don't count.

    Records are related if they share a non-null a or b, directly or through others. Repeated rows are one id.
    """
    keyed, table = group_keys(records.where("a is not null or b is not null").select("id", "a", "b", "split"), scratch)
    splits = keyed.groupBy("k").agg(F.min("split").alias("low"), F.max("split").alias("high"))
    unit = scratch.save(splits.join(table, "k", "left").select("k", F.coalesce("component", "k").alias("component"), "low", "high"))
    torn = unit.groupBy("component").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l != h").select("component", F.lit(True).alias("torn"))
    keys = scratch.save(lookup(unit, torn, "component").where("torn").select("k", "torn"))
    return lookup(keyed.select("id", "k"), keys, "k").where("torn").select("id").distinct()


def deviation(have: np.ndarray, want: np.ndarray) -> np.ndarray:
    """How far splits are from their shares and from the label distribution, over the last two axes (split, label):
    squares of the share of all records, first of all, and of each label's records, that lie where they shouldn't."""
    whole, each = want.sum((-2, -1)), np.maximum(want.sum(-2), 1e-12)
    rows = ((have - want).sum(-1) ** 2).sum(-1) / max(whole, 1e-12) ** 2
    labels = ((((have - want) / each) ** 2) * (each / max(whole, 1e-12))).sum((-2, -1))
    return SHARE_FIRST * rows + labels


def allot(sizes: np.ndarray, shares: np.ndarray, rounds: int = 50) -> np.ndarray:
    """A split per unit: sizes[unit, label]. The largest units first, each to where it exceeds the need for its records
    and labels least, of equal ones to where most is missing; then units are moved, and the largest ones exchanged, as
    long as that brings the splits nearer to their shares and to the label distribution."""
    n, splits = len(sizes), len(shares)
    total = sizes.sum(0)
    want = shares[:, None] * total[None, :]
    have, out = np.zeros_like(want), np.zeros(n, int)
    order = np.lexsort((np.arange(n), -sizes.sum(1)))
    each = np.maximum(total, 1e-12)
    for u in order:
        over = np.maximum(have + sizes[u] - want, 0) - np.maximum(have - want, 0)
        rows = np.maximum(have.sum(1) + sizes[u].sum() - want.sum(1), 0) - np.maximum(have.sum(1) - want.sum(1), 0)
        cost = rows / max(each.sum(), 1) + (over / each * (each / each.sum())).sum(1)
        least = np.flatnonzero(cost <= cost.min() + 1e-12)
        missing = (want - have).sum(1) / np.maximum(want.sum(1), 1e-12)
        s = int(least[np.argmax(missing[least])])
        out[u], have[s] = s, have[s] + sizes[u]
    now = float(deviation(have, want))
    for _ in range(rounds):
        before = now
        for u in order:
            moved = np.repeat(have[None], splits, 0)
            moved[:, out[u]] -= sizes[u]
            moved[np.arange(splits), np.arange(splits)] += sizes[u]
            then = deviation(moved, want)
            s = int(np.argmin(then))
            if then[s] < now - 1e-15:
                have, out[u], now = moved[s], s, float(then[s])
        for u in order[:SWAPPED]:
            others = np.flatnonzero(out != out[u])[: HELD // have.size + 1]
            if not len(others):
                continue
            shift = sizes[others] - sizes[u]
            swapped = np.repeat(have[None], len(others), 0)
            swapped[:, out[u]] += shift
            swapped[np.arange(len(others)), out[others]] -= shift
            then = deviation(swapped, want)
            i = int(np.argmin(then))
            if then[i] < now - 1e-15:
                v = others[i]
                have, now, out[u], out[v] = swapped[i], float(then[i]), out[v], out[u]
        if before - now <= 1e-12:
            break
    return out


def assign(records: DataFrame, shares: dict[str, float], scratch: Scratch) -> DataFrame:
    """(id, component, stratum, assigned): a split for each of records (id, a, b, stratum), one per group, near the shares.

    Groups above 1/UNITS of all records are units of their own, fewer than UNITS; all others fall into UNITS units by a
    hash of the group: a bundle of small groups is split-assigned as a whole, which moves no share by more than what a
    bundle holds. The driver holds the label counts of these units only: of the STRATA most frequent labels each, of the
    others by STRATA buckets of a hash. Null labels are a label of their own. Records of neither entity are groups of
    their own.
    """
    keyed, table = group_keys(records.select("id", "a", "b", "stratum"), scratch)
    keyed = keyed.withColumn("k", F.coalesce("k", F.concat(F.lit("r:"), F.col("id").cast("string"))))
    label = F.coalesce(F.col("stratum").cast("string"), F.lit(""))
    counts = keyed.groupBy("k", label.alias("label")).agg(F.count("*").alias("n"))
    by = scratch.save(counts.join(table, "k", "left").groupBy(F.coalesce("component", "k").alias("component"), "label").agg(F.sum("n").alias("n")))
    total = by.agg(F.sum("n")).first()[0] or 0
    labels = [r.label for r in by.groupBy("label").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "label").limit(STRATA).collect()]
    own = by.groupBy("component").agg(F.sum("n").alias("all")).where(F.col("all") * UNITS > total).select("component", F.concat(F.lit("c:"), "component").alias("own"))
    hashed = F.concat(F.lit("h:"), F.pmod(F.xxhash64("component"), F.lit(UNITS)).cast("string"))
    unit = scratch.save(lookup(by, own, "component").select("component", "label", "n", F.coalesce("own", hashed).alias("unit")))
    kept = F.when(F.col("label").isin(labels), F.concat(F.lit("l:"), "label")).otherwise(F.concat(F.lit("h:"), F.pmod(F.xxhash64("label"), F.lit(STRATA)).cast("string")))
    held = unit.groupBy("unit", kept.alias("label")).agg(F.sum("n").alias("n")).collect() if labels else []
    units, column = sorted({r.unit for r in held}), {x: i for i, x in enumerate(sorted({r.label for r in held}))}
    at, sizes = {u: i for i, u in enumerate(units)}, np.zeros((len(units), len(column)))
    for r in held:
        sizes[at[r.unit], column[r.label]] += r.n
    names, parts = list(shares), np.array(list(shares.values()), float)
    got = allot(sizes, parts / parts.sum())
    chosen = records.sparkSession.createDataFrame([(u, names[got[i]]) for u, i in at.items()], "unit string, assigned string")
    by_group = unit.select("component", "unit").distinct().join(F.broadcast(chosen), "unit").select("component", "assigned")  # under 2 * UNITS rows
    placed = lookup(keyed.select("id", "stratum", "k"), table, "k").select("id", "stratum", F.coalesce("component", "k").alias("component"))
    return lookup(placed, scratch.save(by_group), "component").select("id", "component", "stratum", "assigned")


def split_report(assigned: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(split, share_wanted, rows, share, label_deviation, torn): of each split its share of the rows, how far the share of
    a label in it is from the split's own at most, weighted by the label's share, and groups that lie in it and in others."""
    spark = assigned.sparkSession
    wanted = spark.createDataFrame([(k, v / sum(shares.values())) for k, v in shares.items()], "split string, share_wanted double")
    counts = assigned.groupBy(F.col("assigned").alias("split"), F.coalesce(F.col("stratum").cast("string"), F.lit("")).alias("label")).agg(F.count("*").alias("n"))  # a row per split and label
    all_rows, of_label, of_split = (F.sum("n").over(Window.partitionBy(*by)) for by in ([], ["label"], ["split"]))
    spread = counts.select("split", "n", all_rows.alias("total"), of_split.alias("rows"), (F.col("n") / of_label).alias("part"), (of_label / all_rows).alias("weight"))
    per = spread.groupBy("split", "rows", "total").agg(F.max(F.abs(F.col("part") - F.col("rows") / F.col("total")) * F.col("weight")).alias("label_deviation"))
    groups = assigned.groupBy("component").agg(F.min("assigned").alias("low"), F.max("assigned").alias("high")).where("low != high")
    torn = groups.select(F.explode(F.array("low", "high")).alias("split")).groupBy("split").agg(F.count("*").alias("torn"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return wanted.join(per, "split", "left").join(torn, "split", "left").select("split", "share_wanted", zero("rows").alias("rows"), zero(F.col("rows") / F.col("total")).alias("share"), zero("label_deviation").alias("label_deviation"), zero("torn").alias("torn"))
