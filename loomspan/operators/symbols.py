"""Entity symbols: two immutable tables, candidates (alias, qid, score) and entities (qid, title, eid), with lookups and
edits. Each edit returns new symbols."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.operators.candidates import ranked, top_k
from loomspan.operators.knowledge import dense_ids

ENTITY = "qid string, title string, eid long"


@dataclass(frozen=True)
class EntitySymbols:
    candidates: DataFrame
    entities: DataFrame
    most: int = 30
    editable: bool = False

    @classmethod
    def build(cls, candidates: DataFrame, titles: DataFrame, most: int = 30) -> EntitySymbols:
        """Candidates cut to the top `most`; entities numbered from 1 in order of id."""
        kept = top_k(candidates, most).select("alias", "qid", "score")
        names = titles.where("qid is not null").groupBy("qid").agg(F.min("title").alias("title"))
        ents = kept.select("qid").distinct().join(names, "qid", "left").select("qid", F.coalesce("title", "qid").alias("title"))
        return cls(kept, dense_ids(ents, [F.col("qid")], 1, "eid").select("qid", "title", "eid"), most)

    # lookups

    def ranked(self) -> DataFrame:
        """(alias, qid, score, rank): candidates in order."""
        return ranked(self.candidates)

    def alias_ids(self) -> DataFrame:
        """(alias, alias_id): from 0 in order of alias."""
        return dense_ids(self.candidates.select("alias").distinct(), [F.col("alias")], 0, "alias_id")

    def mentions_of(self, qid: str) -> DataFrame:
        """(alias, score) of an entity, by score and alias descending."""
        return self.candidates.where(F.col("qid") == qid).select("alias", "score").orderBy(F.desc("score"), F.desc("alias"))

    def eids(self) -> DataFrame:
        """(alias, qid, eid, rank)."""
        return self.ranked().join(self.entities.select("qid", "eid"), "qid").select("alias", "qid", "eid", "rank")

    # edits

    def edit(self) -> EntitySymbols:
        return replace(self, editable=True)

    def _guard(self, qid: str | None = None) -> None:
        if not self.editable:
            raise ValueError("these symbols aren't in edit mode")
        if qid is not None and self.entities.where(F.col("qid") == qid).isEmpty():
            raise ValueError(f"entity {qid} isn't known")

    def set_score(self, qid: str, alias: str, score: int) -> EntitySymbols:
        self._guard(qid)
        hit = (F.col("qid") == qid) & (F.col("alias") == alias)
        if self.candidates.where(hit).isEmpty():
            raise ValueError(f"{alias} doesn't name {qid}")
        return replace(self, candidates=self.candidates.withColumn("score", F.when(hit, F.lit(score)).otherwise(F.col("score")).cast("long")))

    def add_mention(self, qid: str, alias: str, score: int) -> EntitySymbols:
        """A new pair; a known one stays as it is. A full alias loses its last candidate, whatever the new score."""
        self._guard(qid)
        return replace(self, candidates=self._added([(qid, alias, score)]))

    def _added(self, new: list[tuple[str, str, int]]) -> DataFrame:
        c = self.candidates
        spark = c.sparkSession
        rows = spark.createDataFrame(new, "qid string, alias string, score long").join(c.select("qid", "alias"), ["qid", "alias"], "left_anti")
        room = rows.groupBy("alias").agg(F.count("*").alias("added"))
        kept = ranked(c).join(F.broadcast(room), "alias", "left").where((F.col("added").isNull()) | (F.col("rank") <= self.most - F.col("added")))
        return kept.select("alias", "qid", "score").unionByName(rows.select("alias", "qid", "score"))

    def remove_mention(self, qid: str, alias: str) -> EntitySymbols:
        self._guard(qid)
        return replace(self, candidates=self.candidates.where((F.col("qid") != qid) | (F.col("alias") != alias)))

    def add_entity(self, qid: str, title: str, mentions: list[tuple[str, int]]) -> EntitySymbols:
        """An entity with the next number, and its mentions (alias, score)."""
        self._guard()
        if not self.entities.where(F.col("qid") == qid).isEmpty():
            raise ValueError(f"entity {qid} is known")
        eid = (self.entities.agg(F.max("eid")).first()[0] or 0) + 1
        ents = self.entities.unionByName(self.entities.sparkSession.createDataFrame([(qid, title, eid)], ENTITY))
        out = replace(self, entities=ents)
        return replace(out, candidates=out._added([(qid, a, s) for a, s in mentions])) if mentions else out

    def reidentify(self, old: str, new: str) -> EntitySymbols:
        """An entity under a new id, number kept."""
        self._guard(old)
        if not self.entities.where(F.col("qid") == new).isEmpty():
            raise ValueError(f"entity {new} is known")
        moved = lambda df: df.withColumn("qid", F.when(F.col("qid") == old, F.lit(new)).otherwise(F.col("qid")))
        return replace(self, candidates=moved(self.candidates), entities=moved(self.entities))

    def prune(self, qids: DataFrame) -> EntitySymbols:
        """Only the entities of qids (qid), numbered anew."""
        self._guard()
        ents = self.entities.join(qids.select("qid").distinct(), "qid", "left_semi").select("qid", "title")
        return replace(self, candidates=self.candidates.join(ents.select("qid"), "qid", "left_semi").select("alias", "qid", "score"), entities=dense_ids(ents, [F.col("qid")], 1, "eid").select("qid", "title", "eid"))

    # storage

    def save(self, path: str) -> None:
        self.candidates.write.mode("overwrite").parquet(f"{path}/candidates")
        self.entities.write.mode("overwrite").parquet(f"{path}/entities")
        self.entities.sparkSession.createDataFrame([(self.most,)], "most int").write.mode("overwrite").parquet(f"{path}/config")

    @classmethod
    def load(cls, spark, path: str) -> EntitySymbols:
        most = spark.read.parquet(f"{path}/config").first()[0]
        return cls(spark.read.parquet(f"{path}/candidates"), spark.read.parquet(f"{path}/entities"), most)


def record_store(pairs: DataFrame, key: str, value: str, order: str, most: int) -> DataFrame:
    """key -> values in order, cut at most: the fixed-width records of a store, without padding."""
    packed = pairs.where(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, value))).alias("v"))
    return packed.select(key, F.slice(F.transform("v", lambda x: x[value]), 1, most).alias("values"))


@dataclass(frozen=True)
class SliceSymbols:
    """What slices of a corpus are made by: mention counts (qid, n), candidates (alias, qid, rank), typings by name (qid,
    type_ids), neighbours (qid, neighbour), relations (head, tail, rel) and word bags of types (type_id, word, n)."""

    counts: DataFrame
    candidates: DataFrame
    typings: dict[str, DataFrame]
    neighbours: DataFrame
    relations: DataFrame
    bags: DataFrame

    @classmethod
    def build(cls, mentions: DataFrame, candidates: DataFrame, typings: dict[str, DataFrame], neighbours: DataFrame, relations: DataFrame, words: DataFrame, most: int = 50) -> SliceSymbols:
        """mentions: (qid), one row each. typings: name -> (qid, type, rank); a typing without rows leaves an empty one.
        words: (qid, word) as they stand near mentions; a type's bag has its `most` words by count, then word. The first
        typing that has rows names the types of the bags."""
        counts = mentions.where("qid is not null").groupBy("qid").agg(F.count("*").alias("n"))
        packed = {name: record_store(t, "qid", "type", "rank", most) for name, t in typings.items()}
        first = next((t for t in typings.values() if not t.isEmpty()), next(iter(typings.values())))
        each = words.where("word is not null").groupBy("qid", "word").agg(F.count("*").alias("n")).join(first.select("qid", "type"), "qid").groupBy("type", "word").agg(F.sum("n").alias("n"))
        bags = top_k(each, most, key="type", score="n", item="word").select("type", "word", "n")
        return cls(counts, ranked(candidates).select("alias", "qid", "rank"), packed, neighbours, relations, bags)

    def qid_counts(self, qids: DataFrame) -> DataFrame:
        """(qid, n): 0 for entities without mentions."""
        return qids.select("qid").distinct().join(self.counts, "qid", "left").select("qid", F.coalesce("n", F.lit(0)).alias("n"))

    def types(self, qids: DataFrame, typing: str) -> DataFrame:
        """(qid, types): empty for entities without types and typings that aren't known."""
        of = self.typings.get(typing)
        asked = qids.select("qid").distinct()
        empty = F.expr("cast(array() as array<string>)")
        return asked.withColumn("types", empty) if of is None else asked.join(of, "qid", "left").select("qid", F.coalesce("values", empty).alias("types"))

    def is_typed(self, qids: DataFrame) -> DataFrame:
        """qid and, for each typing, whether the entity is in it."""
        out = qids.select("qid").distinct()
        for name, of in self.typings.items():
            out = out.join(of.select("qid", F.lit(True).alias(f"in_{name}")), "qid", "left").withColumn(f"in_{name}", F.coalesce(f"in_{name}", F.lit(False)))
        return out

    def relation(self, pairs: DataFrame) -> DataFrame:
        """(a, b, rel, n): the first relation by name from a to b, else from b to a, and how many there are either way."""
        one = pairs.join(self.relations.select(F.col("head").alias("a"), F.col("tail").alias("b"), "rel", F.lit(0).alias("way")), ["a", "b"])
        two = pairs.join(self.relations.select(F.col("tail").alias("a"), F.col("head").alias("b"), "rel", F.lit(1).alias("way")), ["a", "b"])
        both = one.unionByName(two).groupBy("a", "b").agg(F.min(F.struct("way", "rel")).alias("first"), F.countDistinct("rel").alias("n"))
        return both.select("a", "b", F.col("first.rel").alias("rel"), "n")

    def save(self, path: str) -> None:
        for name, df in self._tables().items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")

    def _tables(self) -> dict[str, DataFrame]:
        tables = {k: getattr(self, k) for k in ("counts", "candidates", "neighbours", "relations", "bags")}
        return tables | {f"typing={k}": v for k, v in self.typings.items()}

    @classmethod
    def load(cls, spark, path: str, typings: list[str]) -> SliceSymbols:
        read = lambda name: spark.read.parquet(f"{path}/{name}")
        return cls(read("counts"), read("candidates"), {k: read(f"typing={k}") for k in typings}, read("neighbours"), read("relations"), read("bags"))
