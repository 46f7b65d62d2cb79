"""The knowledge base: staging tables from dump records, relations, types, descriptions, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.languages import ALIAS_PROPERTIES, IGNORED_DATATYPES, TYPE_PROPERTIES
from loomspan.scratch import Scratch

TABLES = ("labels", "descriptions", "aliases", "external_ids", "entity_values", "qualifiers", "wikipedia_links", "entity_rels")
PLAIN = ("string", "external-id", "url")


def snak_value(datatype: Column, datavalue: Column, language: str) -> Column:
    """A snak's value by datatype, from its raw JSON; null for ignored and unknown datatypes and other languages."""
    at = lambda path: F.get_json_object(datavalue, path)
    return (
        F.when(datatype.isin(*PLAIN), at("$.value"))
        .when((datatype == "monolingualtext") & (at("$.value.language") == language), at("$.value.text"))
        .when(datatype == "quantity", at("$.value.amount"))
        .when(datatype == "time", at("$.value.time"))
        .when(datatype == "wikibase-item", at("$.value.id"))
    )


def staging(records: DataFrame, language: str = "en", ignored: tuple[str, ...] = IGNORED_DATATYPES) -> dict[str, DataFrame]:
    """The eight staging tables of dump records; properties are skipped, as are snaks that aren't values.

    `errors` holds the datatypes that are neither read nor among the ignored ones."""
    items = records.where("id is not null and not (type <=> 'property')")
    label = items.select(F.col("id").alias("qid"), F.get(F.array(F.col("labels")[language]["value"]), F.lit(0)).alias("label")).where("label is not null")
    claims = items.select(F.col("id").alias("qid"), F.explode("claims").alias("property_id", "list")).select("qid", "property_id", F.explode("list").alias("c"))
    claims = claims.where("c.mainsnak.snaktype = 'value'").select("qid", "property_id", F.col("c.id").alias("claim_id"), F.col("c.mainsnak.datatype").alias("datatype"), F.col("c.mainsnak.datavalue").alias("datavalue"), F.col("c.qualifiers").alias("qualifiers"))
    valued = claims.withColumn("value", snak_value(F.col("datatype"), F.col("datavalue"), language))
    good = valued.where("value is not null")
    four = ("claim_id", "qid", "property_id", "value")
    values = good.where(~F.col("datatype").isin("wikibase-item", "external-id"))
    qualifiers = good.select("claim_id", F.explode("qualifiers").alias("property_id", "list")).select("claim_id", "property_id", F.explode("list").alias("q"))
    qualifiers = qualifiers.where("q.snaktype = 'value'").select(F.col("q.hash").alias("qualifier_id"), "claim_id", "property_id", snak_value(F.col("q.datatype"), F.col("q.datavalue"), language).alias("value"))
    listed = items.select(F.col("id").alias("qid"), F.explode(F.col("aliases")[language]).alias("a")).select("qid", F.col("a.value").alias("alias")).where("alias is not null")
    named = values.where(F.col("property_id").isin(*ALIAS_PROPERTIES)).select("qid", F.col("value").alias("alias"))
    return {
        "labels": label,
        "descriptions": items.select(F.col("id").alias("qid"), F.col("descriptions")[language]["value"].alias("description")).where("description is not null"),
        "aliases": label.select("qid", F.col("label").alias("alias")).unionByName(listed).unionByName(named),
        "external_ids": good.where("datatype = 'external-id'").select(*four),
        "entity_values": values.select(*four),
        "entity_rels": good.where("datatype = 'wikibase-item'").select(*four),
        "qualifiers": qualifiers.where("value is not null"),
        "wikipedia_links": items.select(F.col("id").alias("qid"), F.col("sitelinks")[f"{language}wiki"]["title"].alias("wiki_title")).where("wiki_title is not null"),
        "errors": valued.where(~F.col("datatype").isin(*PLAIN, "monolingualtext", "quantity", "time", "wikibase-item", *ignored)).select("qid", "property_id", "datatype"),
    }


def with_relation(rels: DataFrame, properties: tuple[str, ...] | list[str], values: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    """(qid): entities with one of the relations, to one of the values if given."""
    hit = rels.where(F.col("property_id").isin(*properties))
    return (hit.where(F.col("value").isin(*values)) if values else hit).select("qid").distinct()


def triples(rels: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """(head, rel, tail), repeated ones kept; heads (qid) restricts them, None doesn't, an empty table leaves none."""
    t = rels.select(F.col("qid").alias("head"), F.col("property_id").alias("rel"), F.col("value").alias("tail"))
    return t if heads is None else t.join(heads.select(F.col("qid").alias("head")).distinct(), "head", "left_semi")


def nested_triples(t: DataFrame) -> DataFrame:
    """head -> map rel -> sorted tails."""
    lists = t.groupBy("head", "rel").agg(F.sort_array(F.collect_list("tail")).alias("tails"))
    return lists.groupBy("head").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rel", "tails")))).alias("rels"))


def typed(rels: DataFrame, most: int, properties: tuple[str, ...] = TYPE_PROPERTIES) -> DataFrame:
    """(qid, type, freq, rank): an entity's distinct types by global frequency, then id; the first `most`."""
    pairs = rels.where(F.col("property_id").isin(*properties)).select("qid", F.col("value").alias("type")).dropna().distinct()
    freq = pairs.groupBy("type").agg(F.count("*").alias("freq"))
    w = Window.partitionBy("qid").orderBy(F.desc("freq"), "type")
    return pairs.join(freq, "type").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def dense_ids(df: DataFrame, order: list[Column], first: int, name: str, slices: int | None = None) -> DataFrame:
    """df with consecutive numbers in a total order. Rows are range-partitioned by it, slices are numbered apart and
    shifted by the sizes of those before: no task sees all rows. The slices are written once, as their bounds come from
    a sample that another run of the plan might draw otherwise. slices: by default the session's shuffle partitions."""
    slices = slices or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = Scratch(df.sparkSession, "ids").save(df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()))
    local = cut.withColumn("_row", F.row_number().over(Window.partitionBy("_slice").orderBy(*order)))
    sizes = local.groupBy("_slice").agg(F.count("*").alias("_n"))
    shift = sizes.select("_slice", (F.sum("_n").over(Window.orderBy("_slice")) - F.col("_n")).alias("_before"))  # a row per slice
    return local.join(F.broadcast(shift), "_slice").withColumn(name, F.col("_row") + F.col("_before") + (first - 1)).drop("_slice", "_row", "_before")


def unique_titles(df: DataFrame, title: str, key: str) -> DataFrame:
    """df with titles told apart: all but the first of each title, by key, get _key appended."""
    n = F.row_number().over(Window.partitionBy(title).orderBy(key))
    return df.withColumn("_n", n).withColumn(title, F.when(F.col("_n") > 1, F.concat_ws("_", title, key)).otherwise(F.col(title))).drop("_n")


def symmetric(t: DataFrame, entities: DataFrame, most: int) -> DataFrame:
    """(qid, neighbour): edges between known entities in both directions, distinct, the first `most` by id of each."""
    known = entities.select("qid").distinct()
    inside = t.select("head", "tail").dropna().distinct().join(known.withColumnRenamed("qid", "head"), "head", "left_semi").join(known.withColumnRenamed("qid", "tail"), "tail", "left_semi")
    both = inside.select(F.col("head").alias("qid"), F.col("tail").alias("neighbour")).unionByName(inside.select(F.col("tail").alias("qid"), F.col("head").alias("neighbour"))).distinct()
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("neighbour"))).where(F.col("rank") <= most).drop("rank")


def pair_relations(pairs: DataFrame, t: DataFrame) -> DataFrame:
    """(a, b, rel): relations between the two of each pair, either way: two equi-joins, no OR."""
    one = pairs.join(t.select(F.col("head").alias("a"), F.col("tail").alias("b"), "rel"), ["a", "b"])
    two = pairs.join(t.select(F.col("tail").alias("a"), F.col("head").alias("b"), "rel"), ["a", "b"])
    return one.unionByName(two).select("a", "b", "rel").distinct()


def descriptions(first_sentences: DataFrame, described: DataFrame) -> DataFrame:
    """(qid, description): a page's first sentence, else the knowledge base's description; of several the first."""
    a = first_sentences.where("qid is not null").groupBy("qid").agg(F.min("sentence").alias("s"))
    b = described.where("qid is not null").groupBy("qid").agg(F.min("description").alias("d"))
    return a.join(b, "qid", "full").select("qid", F.coalesce("s", "d").alias("description")).where("description is not null")


def profile(entities: DataFrame, t: DataFrame, names: DataFrame, types: DataFrame, most_relations: int = 50, excluded: tuple[str, ...] = ("P31", "P279")) -> DataFrame:
    """Per entity its relations, (name, tails cut at most_relations) without the excluded ones, and its type ids."""
    kept = t.where(~F.col("rel").isin(*excluded)).join(names.select(F.col("property_id").alias("rel"), "label"), "rel", "left").select("head", F.coalesce("label", "rel").alias("rel"), "tail")
    lists = kept.groupBy("head", "rel").agg(F.slice(F.sort_array(F.collect_set("tail")), 1, most_relations).alias("tails"))
    rel = lists.groupBy(F.col("head").alias("qid")).agg(F.sort_array(F.collect_list(F.struct("rel", "tails"))).alias("relations"))
    of = types.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "type"))).alias("ts"))
    out = entities.select("qid").distinct().join(rel, "qid", "left").join(of, "qid", "left")
    return out.select("qid", F.coalesce("relations", F.expr("array()")).alias("relations"), F.coalesce(F.transform("ts", lambda x: x["type"]), F.expr("cast(array() as array<string>)")).alias("types"))
