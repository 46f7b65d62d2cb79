"""Long exact spans shared between records, by super-k-mers.

Every window of `length` characters has a minimiser: the piece of `piece` characters with the least hash in it. Windows
next to each other mostly share it and so form one run of text, a super-k-mer. Runs are compared by their minimiser:

1. Each text gives (minimiser, digest of the run, place) - no text yet. Minimisers of one text only drop out here.
2. Runs with equal minimiser, place of it and 128-bit digest of the text are one class: such digests count as the text
   itself. Minimisers with one class are settled: their windows are the same.
3. For the others, one run a class travels as a packed string to its minimiser's bucket, where its windows are sorted
   into groups of equal ones, compared as text. A minimiser with over `crowd` classes isn't put into one task: its
   windows are grouped in a shuffle by their text.

The result is a list of groups of equal text with their places, from which both pairs and shared shares follow. A class
that very many places belong to is cut into shards of places, its few groups copied to each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspan.llm.groups import components, node
from loomspan.operators.skew import lookup
from loomspan.scratch import Scratch

_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 20) - 1)
_STEP = 1 << 19
#: Places of a class that one task joins in any case.
HEAVY = 10_000
_powers: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 14)
        with np.errstate(over="ignore"):
            _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, x, np.uint64)])) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers


def piece_hashes(codes: np.ndarray, piece: int) -> np.ndarray:
    """A mixed hash of every piece of so many characters; equal pieces, equal hashes."""
    up, down = _tables(len(codes))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=total[1:])
    h = (total[piece:] - total[:-piece]) * down[: len(codes) - piece + 1]
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the least hash, the first of equal ones, in every window of so many hashes.

    The places stand in the low 20 bits, so there may be 2^20 hashes; the other bits decide."""
    n = len(h)
    filled = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    filled[:n] = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)
    grid = filled.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[: n - width + 1], left[width - 1 : n]) & _PLACE).astype(np.int64)


def runs(text: str, length: int, piece: int) -> list[tuple[int, int, int, int]]:
    """(minimiser hash, first window, last window, minimiser place) of the super-k-mers of a text, in order.

    Very long texts are taken in overlapping steps; a run may then end where a step does, which no window notices."""
    out = []
    whole = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    for base in range(0, max(1, len(whole) - length + 1), _STEP):
        codes = whole[base : base + _STEP + length - 1].astype(np.uint64)
        if len(codes) < length:
            break
        h = piece_hashes(codes, piece)
        place = window_minima(h, length - piece + 1)
        cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        ends = np.concatenate([cut[1:], [len(place)]]) - 1
        at = place[cut]
        out += zip(h[at].view(np.int64).tolist(), (cut + base).tolist(), (ends + base).tolist(), (at + base).tolist(), strict=True)
    return out


_RUN = pa.schema([("mini", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("id", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("at", pa.int32())])
_RUN_DDL = "mini long, d1 long, d2 long, id long, start int, size int, at int"


def _digest(s: str) -> tuple[int, int]:
    d = xxhash.xxh128_intdigest(s.encode("utf-8", "surrogatepass"))
    return (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)


def _runs(length: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500)):
            cols: list[list] = [[] for _ in _RUN]
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for mini, first, last, at in runs(t, length, piece):
                    size = last - first + length
                    # the place of the minimiser in the run is part of what must be equal
                    d1, d2 = _digest(t[first : first + size])
                    for c, v in zip(cols, (mini, d1 ^ (at - first), d2, i, first, size, at - first), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RUN, strict=True)], schema=_RUN)

    return run


_TEXT = pa.schema([("mini", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("at", pa.int32()), ("body", pa.string())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each class's run, cut from the record it was found in."""
    for batch in batches:
        cols: list[list] = [[] for _ in _TEXT]
        for text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for p in places:
                body = text[p["start"] : p["start"] + p["size"]]
                if (p["d1"] ^ p["at"], p["d2"]) == _digest(body):  # of several rows with one id, the right one
                    for c, v in zip(cols, (p["mini"], p["d1"], p["d2"], p["at"], body), strict=True):
                        c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _TEXT, strict=True)], schema=_TEXT)


_GROUP = pa.schema([("gid", pa.string()), ("mini", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("off", pa.int32()), ("len", pa.int32())])
_GROUP_DDL = "gid string, mini long, d1 long, d2 long, off int, len int"


def bucket_groups(members: list[tuple[int, int, int, str]], length: int) -> list[tuple[str, int, int, int, int]]:
    """(group, d1, d2, offset, length) for the runs (d1, d2, minimiser place, text) of one minimiser.

    Windows are keyed by their text and the minimiser's place in them. Neighbouring windows with the same members make
    one group of longer text.
    """
    holders: dict[tuple[int, str], list[int]] = {}
    for m, (_, _, at, body) in enumerate(members):
        for o in range(len(body) - length + 1):
            holders.setdefault((at - o, body[o : o + length]), []).append(m)
    by_set: dict[tuple[int, ...], list[int]] = {}
    for (rel, _), who in holders.items():
        if len(who) > 1:
            by_set.setdefault(tuple(who), []).append(rel)
    out = []
    for who, rels in by_set.items():
        rels.sort(reverse=True)  # the minimiser late in the window: the window early in the run
        start = 0
        for k in range(1, len(rels) + 1):
            if k == len(rels) or rels[k] != rels[k - 1] - 1:
                d1, d2, at, body = members[who[0]]
                first = at - rels[start]
                n = rels[start] - rels[k - 1] + length
                gid = xxhash.xxh128_hexdigest(f"{rels[start]}|{body[first : first + n]}|{who}|{d1}|{d2}".encode("utf-8", "surrogatepass"))
                out += [(gid, members[m][0], members[m][1], members[m][2] - rels[start], n) for m in who]
                start = k
    return out


def _buckets(length: int):
    """Over rows sorted by minimiser: the groups of each."""

    def emit(mini: int, members: list) -> pa.RecordBatch:
        found = bucket_groups(members, length)
        cols = list(zip(*((g, mini, a, b, o, n) for g, a, b, o, n in found), strict=True)) if found else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _GROUP, strict=True)], schema=_GROUP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mini, members = None, []
        for batch in batches:
            for m, d1, d2, at, body in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if m != mini and members:
                    yield emit(mini, members)
                    members = []
                mini = m
                members.append((d1, d2, at, body))
        if members:
            yield emit(mini, members)

    return run


_WINDOW = pa.schema([("key", pa.string()), ("mini", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("off", pa.int32())])


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m, d1, d2, at, body in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                n = len(body) - length + 1
                keys = [f"{at - o}|{body[o : o + length]}" for o in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), *[pa.array([v] * n, pa.int64()) for v in (m, d1, d2)], pa.array(range(n), pa.int32())], schema=_WINDOW
                )

    return run


def shared_spans(documents: DataFrame, scratch: Scratch, length: int = 300, piece: int = 100, crowd: int = 64) -> DataFrame:
    """(gid, id, start, len): groups of equal text of at least `length` characters, with a row per place.

    Of two records that share a run of at least `length` characters, each window of the run has both in a common group.
    documents: (id long, text string); null ids and texts, and texts shorter than length, share nothing. Equal texts are
    told from repeated ids by the id: rows with the same id count as one record.
    """
    texts = documents.where(F.col("id").isNotNull() & (F.length("text") >= length)).select("id", "text")
    found = scratch.save(texts.mapInArrow(_runs(length, piece), _RUN_DDL))
    shared = found.groupBy("mini").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low != high").select("mini")
    kept = scratch.save(found.join(shared, "mini", "left_semi"), found)
    # one class per (minimiser, digest); its representative is its first place
    classes = scratch.save(kept.groupBy("mini", "d1", "d2").agg(F.min(F.struct("id", "start")).alias("first"), F.first("size").alias("size"), F.first("at").alias("at"), F.count("*").alias("n")))
    several = classes.groupBy("mini").agg(F.count("*").alias("classes")).where("classes > 1")
    open_ = classes.join(several, "mini").select("mini", "d1", "d2", "size", "at", "classes", F.col("first.id").alias("id"), F.col("first.start").alias("start"))
    by_record = open_.groupBy("id").agg(F.collect_list(F.struct("mini", "d1", "d2", "start", "size", "at")).alias("places"))
    packed = texts.join(by_record, "id").select("text", "places").mapInArrow(_pack, "mini long, d1 long, d2 long, at int, body string")
    packed = scratch.save(packed.dropDuplicates(["mini", "d1", "d2"]).join(several, "mini"))
    small = packed.where(f"classes <= {crowd}").drop("classes").repartition("mini").sortWithinPartitions("mini", "d1", "d2")
    groups = small.mapInArrow(_buckets(length), _GROUP_DDL)
    large = packed.where(f"classes > {crowd}").drop("classes").mapInArrow(_windows(length), "key string, mini long, d1 long, d2 long, off int")
    twice = large.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    crowded = large.join(twice, "key", "left_semi").select(F.md5("key").alias("gid"), "mini", "d1", "d2", "off", F.lit(length).alias("len"))
    partial = groups.unionByName(crowded)
    whole = classes.where("n > 1").select(F.concat_ws(":", "mini", "d1", "d2").alias("gid"), "mini", "d1", "d2", F.lit(0).alias("off"), F.col("size").alias("len"))
    out = _placed(partial.unionByName(whole), kept.select("mini", "d1", "d2", "id", "start"), classes, found.sparkSession)
    return scratch.save(out.select("gid", "id", (F.col("start") + F.col("off")).alias("start"), "len").distinct())


def _placed(groups: DataFrame, places: DataFrame, classes: DataFrame, spark) -> DataFrame:
    """groups joined with the places of their class. Classes with over a quarter of a task's places are cut into shards:
    there are at most 4 of them a task."""
    tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fair = max((classes.agg(F.sum("n")).first()[0] or 0) / (4 * tasks), HEAVY)
    heavy = classes.where(F.col("n") > fair).select("mini", "d1", "d2", F.ceil(F.col("n") / fair).cast("int").alias("shards"))
    on = ["mini", "d1", "d2"]
    shards = F.coalesce("shards", F.lit(1))
    left = groups.join(F.broadcast(heavy), on, "left").withColumn("shard", F.explode(F.sequence(F.lit(0), shards - 1))).drop("shards")
    right = places.join(F.broadcast(heavy), on, "left").withColumn("shard", F.pmod(F.xxhash64("id", "start"), shards).cast("int")).drop("shards")
    return left.join(right, [*on, "shard"])


def shared_pairs(spans: DataFrame) -> DataFrame:
    """(a, b): the ids, smaller first, of every two records with a common group. Spelled out, a group gives the square of
    its members; `spans` itself and `shared_classes` say who shares what without it."""
    members = spans.select("gid", "id").distinct()
    # equal sets of members come from many windows: keep one group of each
    sets = members.groupBy("gid").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("h1"), F.sum(F.xxhash64(F.lit("again"), "id").cast("decimal(38,0)")).alias("h2"))
    one = sets.where("n > 1").groupBy("n", "h1", "h2").agg(F.min("gid").alias("gid")).select("gid")
    members = members.join(one, "gid", "left_semi")
    pairs = members.join(members.select("gid", F.col("id").alias("other")), "gid").where("id < other")
    return pairs.select(F.col("id").alias("a"), F.col("other").alias("b")).distinct()


def shared_classes(spans: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, class, n_records, n_groups) of every record that shares a span: the smallest id of the records that it is
    linked to, directly or through others, how many these are, and the groups of equal text that it has a part in."""
    members = scratch.save(spans.select("gid", "id").distinct())
    several = members.groupBy("gid").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low != high").select("gid")
    linked = scratch.save(members.join(several, "gid", "left_semi"))
    label = node(F.col("id").cast("string"))
    merged = components(linked.select(label.alias("a"), F.col("gid").alias("b")), scratch)
    own = linked.groupBy("id", label.alias("a")).agg(F.count("*").alias("n_groups"))
    placed = lookup(own, merged, "a").select("id", F.coalesce("component", "a").alias("class"), "n_groups")
    sizes = placed.groupBy("class").agg(F.count("*").alias("n_records"), F.min("id").alias("first"))
    return lookup(placed, sizes, "class").select("id", F.col("first").alias("class"), "n_records", "n_groups")


def shared_share(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """(id, n_chars, n_shared, share): how much of each record stands in another one too. Null and empty texts share 0."""
    others = spans.groupBy("gid").agg(F.min("id").alias("l"), F.max("id").alias("h")).where("l != h").select("gid")
    places = spans.join(others, "gid", "left_semi").select("id", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    w = W.partitionBy("id").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(w), F.lit(0))
    covered = places.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), reached))).groupBy("id").agg(F.sum("new").alias("n_shared"))
    sizes = documents.where("id is not null").groupBy("id").agg(F.max(F.coalesce(F.length("text"), F.lit(0))).alias("n_chars"))
    out = sizes.join(covered, "id", "left").select("id", F.col("n_chars").cast("long").alias("n_chars"), F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"))
    return out.withColumn("share", F.when(F.col("n_chars") > 0, F.col("n_shared") / F.col("n_chars")).otherwise(0.0))
