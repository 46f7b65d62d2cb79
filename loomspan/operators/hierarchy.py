"""Parent-child links into paths, depths, roots and descendants by nested-set ranges.

Pointers to ancestors are doubled, so the number of rounds grows with the logarithm of the depth. The same rounds carry
subtree sizes upward: after round k a node has counted its descendants nearer than 2^k. Only nodes that have not met a
root yet are moved and written. Those left when a round finishes none are on circles or below them. Sibling ranges are then allotted by prefix sums, children of a
parent in slices so that no parent with many children is one task's work, and added up downward along the path by the
same doubling. `lo <= x <= hi` on the preorder number tells descendants from then on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from loomspan.operators.skew import lookup
from loomspan.scratch import Scratch

SLICE = 50_000
#: Sizes of the blocks that ranges are cut into, each a multiple of the one before.
BLOCKS = (1, 16, 256, 4096)


def primary_links(links: DataFrame, scope: str, child: str, parent: str) -> DataFrame:
    """(scope, child, parent) with one parent per child, the smallest; links with a null part don't count."""
    whole = links.select(F.col(scope).alias("scope"), F.col(child).alias("child"), F.col(parent).alias("parent")).dropna()
    return whole.groupBy("scope", "child").agg(F.min("parent").alias("parent"))


def hierarchy(links: DataFrame, *, scope: str, child: str, parent: str, scratch: Scratch) -> DataFrame:
    """(scope, node, parent, root, depth, size, lo, hi, cyclic) of every node that links name, by scope.

    size counts the node itself; lo is the preorder number below the root (the root has 0) and hi = lo + size - 1. For
    nodes whose way up never ends, on a circle or below one, cyclic is true and root, depth, size, lo and hi are null. A
    child with several parents hangs below the smallest (`other_links` gives the rest); repeated links count once; a
    link to itself is a circle. Links with nulls are left out; no links, no rows.
    """
    # one key for scope and node, as all joins need both
    ident = lambda c: F.struct(F.col("scope").alias("s"), F.col(c).alias("n"))
    edges = scratch.save(primary_links(links, scope, child, parent).select(ident("child").alias("id"), ident("parent").alias("up")))
    # active: the way up isn't known yet, `up` is `hop` above. Settled: `up` is the root and `hop` the depth
    active, n = edges.select("id", "up", F.lit(1).alias("hop"), F.lit(1).cast("long").alias("size")), edges.count()
    tops = edges.select(F.col("up").alias("id")).distinct().join(edges.select("id"), "id", "left_anti")
    settled, rounds, left = [scratch.save(tops.select("id", F.col("id").alias("up"), F.lit(0).alias("hop")))], [], n
    while left:
        rounds.append(active)
        known = active.select("id", "up", "hop", F.lit(False).alias("done"))
        for part in settled:
            known = known.unionByName(part.select("id", "up", "hop", F.lit(True).alias("done")))
        above = known.select(F.col("id").alias("up"), F.struct("up", "hop", "done").alias("at"))
        risen = lookup(active, above, "up", n).select("id", "at.up", (F.col("hop") + F.col("at.hop")).alias("hop"), F.col("at.done").alias("done"), "size")
        # what lies `hop` below a node adds to what it has below it
        rise = active.groupBy(F.col("up").alias("id")).agg(F.sum("size").alias("more"))
        met = risen.join(rise, "id", "left").select("id", "up", "hop", "done", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"))
        seen = Observation()
        moved = scratch.save(met.observe(seen, F.count_if(~F.col("done")).alias("left")))
        settled.append(moved.where("done").select("id", "up", "hop"))
        active = moved.where("not done").select("id", "up", "hop", "size")
        before, left = left, seen.get["left"]
        if left == before:  # none of them meets a root, however far up
            break
    done = settled[0].withColumn("top", F.lit(True))
    for part in settled[1:]:
        done = done.unionByName(part.withColumn("top", F.lit(False)))
    parents = edges.select("id", F.col("up").alias("parent"))
    below = edges.select(F.col("up").alias("id"), F.lit(0).cast("long").alias("size")).limit(0)
    for part in rounds:
        below = below.unionByName(part.select(F.col("up").alias("id"), "size"))
    below = below.groupBy("id").agg(F.sum("size").alias("below"))
    tree = done.join(below, "id", "left").join(parents, "id", "left")
    tree = scratch.save(tree.select("id", F.coalesce("parent", "id").alias("parent"), F.col("up").alias("root"), F.col("hop").alias("depth"), (F.lit(1) + F.coalesce("below", F.lit(0))).alias("size")))
    ranges = _preorder(tree, n, scratch)
    good = ranges.select("id", "parent", "root", "depth", "size", "lo", (F.col("lo") + F.col("size") - 1).alias("hi"), F.lit(False).alias("cyclic"))
    if left:
        bad = active.select("id").join(parents, "id")
        good = good.unionByName(bad.select("id", "parent", *[F.lit(None).cast(t).alias(c) for c, t in good.dtypes[2:7]], F.lit(True).alias("cyclic")))
    return good.select(
        F.col("id.s").alias("scope"), F.col("id.n").alias("node"), F.when(F.col("parent") != F.col("id"), F.col("parent.n")).alias("parent"),
        F.col("root.n").alias("root"), F.col("depth").cast("int").alias("depth"), "size", "lo", "hi", "cyclic",
    )


def _offsets(below: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, up, own): what the siblings before a node take, in the range below its parent."""
    by_parent = lambda *more: Window.partitionBy("parent", *more)
    wide = scratch.save(below.groupBy("parent").agg(F.ceil(F.count("*") / SLICE).alias("slices")).where("slices > 1"))  # fewer than rows / SLICE parents
    if wide.isEmpty():
        return below.select("id", F.col("parent").alias("up"), "depth", (F.sum("size").over(by_parent().orderBy("id")) - F.col("size")).alias("own"))
    sliced = lookup(below, wide, "parent").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("slices", F.lit(1))))
    totals = sliced.where("slices is not null").groupBy("parent", "part").agg(F.sum("size").alias("all"))
    before = totals.select("parent", "part", (F.sum("all").over(by_parent().orderBy("part")) - F.col("all")).alias("before"))
    within = sliced.withColumn("own", F.sum("size").over(by_parent("part").orderBy("id")) - F.col("size"))
    return within.join(before, ["parent", "part"], "left").select("id", F.col("parent").alias("up"), "depth", (F.col("own") + F.coalesce("before", F.lit(0))).alias("own"))


def _preorder(tree: DataFrame, rows: int, scratch: Scratch) -> DataFrame:
    """tree with lo, the preorder number of each node below its root."""
    steps = _offsets(tree.where("depth > 0"), scratch).select("id", "up", (F.lit(1) + F.col("own")).alias("lo"), "depth")
    state = scratch.save(steps.unionByName(tree.where("depth = 0").select("id", F.col("id").alias("up"), F.lit(0).cast("long").alias("lo"), "depth")))
    most, reach, passed = state.agg(F.max("depth")).first()[0] or 0, 1, []
    while reach < most:
        above = state.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("lo").alias("lo2"))
        for part in passed:  # nodes whose number is known aren't written again
            above = above.unionByName(part.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("lo").alias("lo2")))
        rising = lookup(state.where(f"depth > {reach}"), above, "up", rows).select("id", F.col("up2").alias("up"), (F.col("lo") + F.col("lo2")).alias("lo"), "depth")
        passed.append(state.where(f"depth <= {reach}"))
        state = scratch.save(rising)
        reach *= 2
    for part in passed:
        state = state.unionByName(part)
    return tree.join(state.select("id", "lo"), "id")


def other_links(links: DataFrame, *, scope: str, child: str, parent: str) -> DataFrame:
    """(scope, child, parent): the distinct links beyond the one parent that `hierarchy` uses."""
    whole = links.select(F.col(scope).alias("scope"), F.col(child).alias("child"), F.col(parent).alias("parent")).dropna().distinct()
    return whole.join(primary_links(links, scope, child, parent), ["scope", "child", "parent"], "left_anti")


def descent(nested: DataFrame) -> DataFrame:
    """(scope, ancestor, descendant, distance): every node with each node below it, by nested-set ranges.

    A range is cut into blocks of BLOCKS sizes, a point lies in one block of each size; ranges and points meet on equal
    blocks. So each pair meets exactly once, and no block has more points than the largest size, whatever its root has.
    Nodes on or below circles have none.
    """
    tree = nested.where("not cyclic")
    # as [a, b) in blocks of each size: what no block of the next size covers
    a, b = F.col("lo") + 1, F.col("hi") + 1
    runs, marked = [], lambda level: lambda n: F.struct(F.lit(level).alias("level"), n.alias("block"))
    for i, width in enumerate(BLOCKS):
        low, high = F.ceil(a / width).cast("long"), F.floor(b / width).cast("long")
        if i + 1 == len(BLOCKS):
            parts = [(low, high)]
        else:
            ratio = BLOCKS[i + 1] // width
            upper_low, upper_high = F.ceil(low / ratio).cast("long"), F.floor(high / ratio).cast("long")
            inside = upper_low < upper_high
            parts = [(low, F.when(inside, upper_low * ratio).otherwise(high)), (F.when(inside, upper_high * ratio).otherwise(high), high)]
        empty = F.expr("cast(array() as array<bigint>)")
        for x, y in parts:
            blocks = F.when(x < y, F.sequence(x, F.greatest(x, y - 1))).otherwise(empty)
            runs.append(F.transform(blocks, marked(i)))
    ranges = tree.where("size > 1").select("scope", "root", F.col("node").alias("ancestor"), F.col("depth").alias("d1"), F.explode(F.concat(*runs)).alias("at"))
    points = F.array(*[F.struct(F.lit(i).alias("level"), F.floor(F.col("lo") / width).cast("long").alias("block")) for i, width in enumerate(BLOCKS)])
    below = tree.where("depth > 0").select("scope", "root", F.col("node").alias("descendant"), F.col("depth").alias("d2"), F.explode(points).alias("at"))
    return ranges.join(below, ["scope", "root", "at"]).select("scope", "ancestor", "descendant", (F.col("d2") - F.col("d1")).alias("distance"))


def paths(nested: DataFrame) -> DataFrame:
    """nested with path: the nodes from the root to the node itself, joined by " > "; null for cyclic nodes."""
    up = descent(nested).groupBy("scope", F.col("descendant").alias("node")).agg(F.sort_array(F.collect_list(F.struct((-F.col("distance")).alias("d"), "ancestor"))).alias("up"))
    with_up = nested.join(up, ["scope", "node"], "left")
    names = F.concat(F.transform(F.coalesce("up", F.expr("array()")), lambda x: x["ancestor"]), F.array("node"))
    return with_up.withColumn("path", F.when(~F.col("cyclic"), F.array_join(names, " > "))).drop("up")
