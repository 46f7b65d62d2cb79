"""Same or almost the same records in different splits: a weighted cosine join with exact verification.

Texts become vectors of term weights. Equal texts are one class first. All vectors order their terms alike, the rarest
first, and put only a prefix into the inverted lists: the shortest one whose rest can't reach the threshold alone, by
the rest's norm or by the rest's weights times the greatest weights they can meet. The first term that two similar
vectors share stands in both prefixes. A term whose two lists are very long is split by the second shared term, which
stands in prefixes that are as much longer as one more term needs; lists that stay long are cut
into a grid of parts, so that no task looks at much more than `crowd` pairs of a key. Where two lists meet, the norms of what follows
and, for plain counts, a bit signature of the terms, else a sketch of norms by classes of terms, bound the dot product
from above; what is left gets its exact dot product.

A pair counts if dot(x, y) >= t * max(|x|^2, |y|^2). With `unit_weight`, plain counts, it means that t of the longer
text's words are shared, which every pair within 1 - t word edits fulfils: no such pair is lost. With `idf_weight`
vectors have norm 1, and it is cosine >= t of the inverse document frequencies.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions.text import words
from loomspan.operators.skew import lookup
from loomspan.scratch import Scratch

FLUSH = 200_000
BINS = 64
SLACK = 1e-9


def numbered(w: list[str]) -> list[str]:
    """The words, a word's second occurrence told from its first, so that a text is a set of terms."""
    if len(set(w)) == len(w):
        return w
    seen: Counter[str] = Counter()
    out = []
    for x in w:
        k = seen[x]
        out.append(f"{x} {k}" if k else x)
        seen[x] = k + 1
    return out


def _keys(least: int):
    schema = pa.schema([("id", pa.int64()), ("side", pa.int8()), ("text_key", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [words(t) for t in batch.column("text").to_pylist()]
            keys = pa.array([" ".join(w) if len(w) >= least else None for w in split], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("side"), keys], schema=schema).filter(keys.is_valid())

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term counts of each batch. Words and their numbers are counted in Arrow; only repeated words of a text are looked
    at one by one."""
    for batch in (b.slice(k, FLUSH // 20) for b in batches for k in range(0, b.num_rows, FLUSH // 20)):
        lists = pc.split_pattern(batch.column(0), " ")
        each = pa.table({"text": pc.list_parent_indices(lists), "w": pc.list_flatten(lists)}).group_by(["text", "w"]).aggregate([([], "count_all")])
        once = pc.value_counts(each["w"].combine_chunks())
        more: Counter[str] = Counter()
        often = each.filter(pc.greater(each["count_all"], 1))
        for w, n in zip(often["w"].to_pylist(), often["count_all"].to_pylist(), strict=True):
            more.update(f"{w} {k}" for k in range(1, n))
        terms = pa.concat_arrays([once.field("values"), pa.array(list(more), pa.string())])
        yield pa.RecordBatch.from_arrays([terms, pa.concat_arrays([once.field("counts"), pa.array(list(more.values()), pa.int64())])], ["term", "n"])


def _hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term) - (1 << 63)


def prefix_length(weights: list[float], most: list[float], t: float, spare: float = 0.0, longest: float | None = None) -> int:
    """How many of the first terms must be indexed. most[i]: the greatest weight that term i can meet; spare: what terms
    of the prefix may add to the rest without reaching the threshold; longest: the greatest norm a vector that qualifies
    can have. Above len(weights) if even no rest is too much."""
    square = sum([w * w for w in weights])
    need, norm, n = t * square * (1 - SLACK) - spare, math.sqrt(square), len(weights)
    if need <= 0:
        return n + 1
    # a vector that qualifies has at most norm / t
    longest = norm / t if longest is None else min(longest, norm / t)
    rest, meet, p = square, sum(map(operator.mul, weights, most)), 0
    # the first terms are few: what follows them falls below the need soon
    while p < n and rest > 0 and math.sqrt(rest) * longest >= need - SLACK and meet >= need - SLACK:
        w = weights[p]
        rest, meet, p = rest - w * w, meet - w * most[p], p + 1
    return p


_LIST = pa.schema([("term", pa.int64()), ("rep", pa.int64()), ("train", pa.bool_()), ("held", pa.bool_()), ("w", pa.float32()), ("rest", pa.float32()), ("square", pa.float32()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64())])
_LIST_DDL = "term long, rep long, train boolean, held boolean, w float, rest float, square float, n int, s1 long, s2 long"
_COLUMNS = ("rep", "w", "rest", "square", "n", "s1", "s2")


class Weights:
    """Term weights of a text's vector: weigh(count, term) of each term, count being the texts that have it as far as that
    is known, 0 for rare ones; brought to norm 1 if `unit`. most(count, term): the greatest weight it has in any vector,
    as far as that is known."""

    def __init__(self, weigh, unit: bool = False) -> None:
        self.weigh, self.unit = weigh, unit

    def vector(self, terms: list[tuple[int, str]]) -> list[float]:
        weigh = self.weigh
        out = [weigh(c, x) for c, x in terms]
        if self.unit:
            norm = math.sqrt(sum([w * w for w in out])) or 1.0
            out = [w / norm for w in out]
        return out

    def most(self, terms: list[tuple[int, str]], own: list[float], greatest: dict[str, float]) -> list[float]:
        # in vectors of norm 1 a term's weight differs from text to text, but is 1 at most
        return [greatest.get(x, 1.0) for _, x in terms] if self.unit else own


def _prefixes(frequent, t: float, weights: Weights, twice: bool = False):
    """Rows of the inverted lists: a row per term of the prefix, or, `twice`, per term and a later one of the longer
    prefix, with `first`, the term itself, whose weight and rest bound the dot product."""
    plain = weights.weigh is unit_weight and not weights.unit
    schema = pa.schema([*_LIST, *([] if plain else [("sketch", pa.binary())]), *([("first", pa.int64())] if twice else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, greatest = frequent.value
        known: dict[str, tuple[int, int, int]] = {}
        shapes: dict[int, tuple[list[float], int, list[float]]] = {}
        get, norm = counts.get, 1.0 if weights.unit else None

        def code(x: str) -> tuple[int, int, int]:
            """A term's hash, and its bit in the two halves of a signature."""
            if len(known) > FLUSH:
                known.clear()
            h = _hash(x)
            bit = 1 << (h & 63)
            known[x] = out = (h, bit, 0) if h & 64 else (h, 0, bit)
            return out

        def shape(terms: list[tuple[int, str]]) -> tuple[list[float], int, list[float]]:
            """Weights, prefix, and the norm of what follows each of its terms; with plain counts the same for all texts of
            a length."""
            if plain and len(terms) in shapes:
                return shapes[len(terms)]
            own = weights.vector(terms)
            after, p, rest = sum([w * w for w in own]), prefix_length(own, weights.most(terms, own, greatest), t, longest=norm), []
            for w in own[:p]:
                after -= w * w
                rest.append(math.sqrt(max(after, 0.0)))
            if plain and len(shapes) < FLUSH:
                shapes[len(terms)] = own, p, rest
            return own, p, rest

        for batch in (b.slice(k, 2000) for b in batches for k in range(0, b.num_rows, 2000)):
            keys, firsts, ws, rests, sizes, texts, sketches = [], [], [], [], [], [], []
            for text in batch.column("text_key").to_pylist():
                terms = sorted([(get(x, 0), x) for x in numbered(text.split(" "))])
                own, p, rest = shape(terms)
                coded = [known.get(x) or code(x) for _, x in terms]
                s1 = s2 = 0
                for _, b1, b2 in coded:
                    s1 |= b1
                    s2 |= b2
                made = len(keys)
                if twice:
                    most = weights.most(terms, own, greatest)
                    far = prefix_length(own, most, t, max(map(operator.mul, own, most)), norm)
                    for i in range(min(p, len(terms))):
                        h = coded[i][0]
                        here = [_hash(f"{h} {x[0]}") for x in coded[i + 1 : far]]
                        if far > len(terms):  # one shared term may do
                            here.append(_hash(f"{h} alone"))
                        keys += here
                        firsts += [h] * len(here)
                        ws += [own[i]] * len(here)
                        rests += [rest[i]] * len(here)
                else:
                    keys += [x[0] for x in coded[:p]]
                    ws += own[:p]
                    rests += rest
                sizes.append(len(keys) - made)
                square = sum([w * w for w in own])
                if not plain:
                    sketches.append(sketch([x[0] for x in coded], own, square))
                texts.append((square, len(terms), s1 - (1 << 64) if s1 >> 63 else s1, s2 - (1 << 64) if s2 >> 63 else s2))
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            square, n, s1, s2 = (pa.array(x, k).take(at) for x, k in zip(zip(*texts, strict=True), (pa.float32(), pa.int32(), pa.int64(), pa.int64()), strict=True))
            same = [batch.column(c).take(at) for c in ("rep", "train", "held")]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *same, pa.array(ws, pa.float32()), pa.array(rests, pa.float32()), square, n, s1, s2, *([] if plain else [pa.array(sketches, pa.binary()).take(at)]), *([pa.array(firsts, pa.int64())] if twice else [])], schema=schema)

    return run


def sketch(hashes: list[int], weights: list[float], square: float) -> bytes:
    """A vector's share of its norm in each of BINS classes of terms, rounded up to 255ths."""
    held: dict[int, float] = {}
    for h, w in zip(hashes, weights, strict=True):
        held[h % BINS] = held.get(h % BINS, 0.0) + w * w
    out = bytearray(BINS)
    for k, x in held.items():
        out[k] = min(255, int(255 * math.sqrt(x / square)) + 1)
    return bytes(out)


def _near():
    """(x, y) of the rows (x, y, need, sketch_x, sketch_y) whose sketches don't rule a dot product of `need`, as a share of both
    norms, out: class by class it is at most the product of the shares."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.float32) for c in (3, 4))
            bound = np.einsum("ij,ij->i", a, b) / (255.0 * 255.0)
            keep = pa.array(bound >= batch.column(2).to_numpy() - 1e-5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(keep)

    return run


def unit_weight(count: int, term: str) -> float:
    return 1.0


def idf_weight(total: int, floor: float):
    """The inverse document frequency; terms of no more than `floor` texts, whose counts aren't kept, weigh alike."""
    top, known = math.log(1 + total / max(floor, 1.0)), {}

    def weigh(count: int, term: str) -> float:
        if count <= floor:
            return top
        w = known.get(count)
        if w is None:
            w = known[count] = math.log(1 + total / count)
        return w

    return weigh


def word_edits(a: list[str], b: list[str], most: int) -> int:
    """Word edits that turn a into b, or most + 1 if it takes more; only the band that `most` allows is filled."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far, last = most + 1, {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        row = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            if j == 0:
                row[0] = i
                continue
            row[j] = min(last.get(j - 1, far) + (x != b[j - 1]), last.get(j, far) + 1, row.get(j - 1, far) + 1)
        if min(row.values()) > most:
            return most + 1
        last = row
    return min(last.get(len(b), far), far)


def _verify(frequent, t: float, weights: Weights, edits: float | None):
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("cosine", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = frequent.value[0]

        def vector(w: list[str]) -> dict[str, float]:
            terms = [(counts.get(k, 0), k) for k in numbered(w)]
            return {k: x for (_, k), x in zip(terms, weights.vector(terms), strict=True)}

        for batch in batches:
            xs, ys, cs = [], [], []
            for x, y, a, b in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "text_x", "text_y")), strict=True):
                wa, wb = a.split(" "), b.split(" ")
                va, vb = vector(wa), vector(wb)
                dot = sum(w * vb[k] for k, w in va.items() if k in vb)
                na, nb = sum(w * w for w in va.values()), sum(w * w for w in vb.values())
                if dot < t * max(na, nb) * (1 - SLACK):
                    continue
                if edits is not None:
                    most = math.floor(edits * max(len(wa), len(wb)) + SLACK)
                    if word_edits(wa, wb, most) > most:
                        continue
                xs.append(x), ys.append(y), cs.append(dot / math.sqrt(na * nb))
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64()), pa.array(cs, pa.float64())], schema=schema)

    return run


def _greatest(frequent, weights: Weights):
    """(term, w): the greatest weights of frequent terms in a part of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, most = frequent.value, {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                terms = [(counts.get(x, 0), x) for x in numbered(text.split(" "))]
                for (c, x), w in zip(terms, weights.vector(terms)):
                    if c and w > most.get(x, 0.0):
                        most[x] = w
        yield pa.RecordBatch.from_arrays([pa.array(list(most), pa.string()), pa.array(list(most.values()), pa.float64())], ["term", "w"])

    return run


class Overlap:
    """The join between the rows with `side` 0 (training) and those with `side` 1 (held out) of (id, side, text).

    `members` has (id, side, rep), `pairs` (x, y, cosine) with x the class of a training text and y of a held-out one: the
    form that grows with the texts and not with the square of a class. A class on both sides is a pair with itself. Null
    texts, texts of fewer than `least` words and null sides are left out; repeated rows are members of one class. weigh:
    unit_weight, "idf", or a function of a term's count (0 where it is rare) and the term.
    """

    def __init__(self, rows: DataFrame, scratch: Scratch, *, threshold: float = 0.8, least: int = 1, edits: float | None = None, weigh=unit_weight, frequent_share: float = 0.0005, crowd: int = 20_000_000) -> None:
        spark, sc = rows.sparkSession, rows.sparkSession.sparkContext
        keyed = rows.where("id is not null and side is not null and text is not null").select("id", F.col("side").cast("byte").alias("side"), "text")
        keyed = keyed.mapInArrow(_keys(max(least, 1)), "id long, side byte, text_key string")
        by_key = scratch.save(keyed.select("id", "side", F.unhex(F.md5("text_key")).alias("digest"), "text_key"))
        classes = by_key.groupBy("digest").agg(
            F.min("id").alias("rep"), F.first("text_key").alias("text_key"), F.max(F.col("side") == 0).alias("train"), F.max(F.col("side") == 1).alias("held")
        )
        self.classes = scratch.save(classes)
        self.members = scratch.save(lookup(by_key.select("id", "side", "digest"), self.classes.select("digest", "rep"), "digest").select("id", "side", "rep"))
        vectors = self.classes.select("rep", "text_key", "train", "held")
        total = vectors.count()
        floor = max(20, total * frequent_share)
        # only the order and the weights of frequent terms matter; there are at most (terms a text / frequent_share) of them
        df = vectors.select("text_key").mapInArrow(_count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
        counts = {r.term: r.n for r in df.where(F.col("n") > floor).collect()}
        weights = Weights(idf_weight(total, floor), True) if weigh == "idf" else Weights(weigh)
        greatest = {}
        if weights.unit:
            most = vectors.select("text_key").mapInArrow(_greatest(sc.broadcast(counts), weights), "term string, w double").groupBy("term").agg(F.max("w").alias("w"))
            greatest = {r.term: r.w for r in most.collect()}  # a row per frequent term
        shared = sc.broadcast((counts, greatest))
        plain = weigh is unit_weight
        ddl, columns = (_LIST_DDL, _COLUMNS) if plain else (f"{_LIST_DDL}, sketch binary", (*_COLUMNS, "sketch"))
        lists = scratch.save(vectors.mapInArrow(_prefixes(shared, threshold, weights), ddl))

        def crowded(of: DataFrame) -> DataFrame:
            both = of.groupBy("term").agg(F.count_if("train").alias("a"), F.count_if("held").alias("b"))
            return scratch.save(both.where(F.col("a") * F.col("b") > crowd).select("term", *[F.ceil(F.col(c) / math.sqrt(max(crowd, 1))).cast("int").alias(f"parts_{c}") for c in "ab"]))

        # terms of which so many pairs would be looked at are split by a second shared term
        hot = crowded(lists)
        again = not hot.isEmpty()
        if again:
            first = hot.select(F.col("term").alias("first"))
            of_hot = lists.join(hot, "term", "left_semi").select("rep").distinct()
            split = vectors.join(of_hot, "rep", "left_semi").mapInArrow(_prefixes(shared, threshold, weights, twice=True), f"{ddl}, first long")
            lists = scratch.save(lists.join(hot, "term", "left_anti").unionByName(split.join(first, "first", "left_semi").select(lists.columns)), lists)
            hot = crowded(lists)
            again = not hot.isEmpty()
        x = lists.where("train").select("term", *[F.col(c).alias(f"{c}_x") for c in columns])
        y = lists.where("held").select("term", *[F.col(c).alias(f"{c}_y") for c in columns])
        on = ["term"]
        if again:  # what is still long is cut into a grid of parts, each of them copied to all that it must meet

            def cut(rows: DataFrame, own: str, other: str, rep: str) -> DataFrame:
                one = lambda c: F.coalesce(f"parts_{c}", F.lit(1))
                placed = lookup(rows, hot, "term").withColumn(own, F.pmod(F.xxhash64(rep), one(own)).cast("int"))
                return placed.withColumn(other, F.explode(F.sequence(F.lit(0), one(other) - 1))).drop("parts_a", "parts_b")

            x, y, on = cut(x, "a", "b", "rep_x"), cut(y, "b", "a", "rep_y"), ["term", "a", "b"]
        t = F.lit(threshold * (1 - 1e-5))
        need = t * F.greatest("square_x", "square_y")
        close = x.join(y, on).where(F.col("rep_x") != F.col("rep_y"))
        close = close.where((F.least("square_x", "square_y") >= need * t) & (F.col("w_x") * F.col("w_y") + F.col("rest_x") * F.col("rest_y") >= need))
        if plain:  # terms on one side only: at least the signatures' different bits
            differ = F.bit_count(F.col("s1_x").bitwiseXOR(F.col("s1_y"))) + F.bit_count(F.col("s2_x").bitwiseXOR(F.col("s2_y")))
            close = close.where(differ <= F.col("n_x") + F.col("n_y") - 2 * need)
        candidates = close.select(F.col("rep_x").alias("x"), F.col("rep_y").alias("y"))
        if not plain:
            share = (need / F.sqrt(F.col("square_x") * F.col("square_y"))).cast("double").alias("need")
            candidates = close.select("rep_x", "rep_y", share, "sketch_x", "sketch_y").mapInArrow(_near(), "x long, y long")
        candidates = candidates.distinct()
        texts = self.classes.select("rep", "text_key")
        pairs = candidates.join(texts.select(F.col("rep").alias("x"), F.col("text_key").alias("text_x")), "x").join(texts.select(F.col("rep").alias("y"), F.col("text_key").alias("text_y")), "y")
        exact = pairs.select("x", "y", "text_x", "text_y").mapInArrow(_verify(shared, threshold, weights, edits), "x long, y long, cosine double")
        same = self.classes.where("train and held").select(F.col("rep").alias("x"), F.col("rep").alias("y"), F.lit(1.0).alias("cosine"))
        self.pairs = scratch.save(exact.unionByName(same))

    def member_pairs(self) -> DataFrame:
        """(a, b): ids of a training and a held-out text of each pair of classes, the smaller first, distinct. Spelled out,
        a pair of classes gives the product of their sizes; `pairs` and `members` say the same without it."""
        train = self.members.where("side = 0").select(F.col("rep").alias("x"), F.col("id").alias("i"))
        held = self.members.where("side = 1").select(F.col("rep").alias("y"), F.col("id").alias("j"))
        out = self.pairs.select("x", "y").join(train, "x").join(held, "y")
        return out.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).distinct()

    def links(self, side: int = 1) -> DataFrame:
        """(id, rep, n_links) of every text of a side: its class and the number of the other side's texts it overlaps with."""
        own, other = ("y", "x") if side else ("x", "y")
        size = self.members.where(F.col("side") == 1 - side).groupBy(F.col("rep").alias(other)).agg(F.count("*").alias("size"))
        n = self.pairs.join(size, other).groupBy(F.col(own).alias("rep")).agg(F.sum("size").alias("n_links"))
        return lookup(self.members.where(F.col("side") == side), n, "rep").select("id", "rep", F.coalesce("n_links", F.lit(0)).alias("n_links"))
