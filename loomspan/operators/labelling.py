"""Weak labels: pronouns, page votes, aliases found in sentences, more ambiguous aliases, splits."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.languages import ENGLISH, GENDERS, UNKNOWN, Language
from loomspan.functions.normal import normal_alias, sha1_bucket, span_overlap, word_spans


def pronoun_tokens(sents: DataFrame, keep: list[str], text: str, language: Language = ENGLISH) -> DataFrame:
    """A row per pronoun: keep, start, end, word, cls, possessive. Punctuation at a word's end doesn't count."""
    table = F.create_map(*[F.lit(x) for kv in language.pronouns.items() for x in kv])
    words = sents.select(*keep, F.explode(word_spans(F.col(text))).alias("w"))
    bare = F.lower(F.rtrim(F.regexp_replace("w.word", r"[\p{Punct}]+$", "")))
    found = words.select(*keep, F.col("w.start").alias("start"), bare.alias("word"))
    return found.withColumn("cls", F.try_element_at(table, F.col("word"))).where("cls is not null").select(*keep, "start", (F.col("start") + F.length("word")).alias("end"), "word", "cls", F.col("word").isin(*language.possessive).alias("possessive"))


def leading_pronoun(tokens: DataFrame, doc: str) -> DataFrame:
    """(doc, cls): the class most pronouns of a document have; UNKNOWN below 5 of them or if the second has over 0.9 as many."""
    n = tokens.groupBy(doc, "cls").agg(F.count("*").alias("n"))
    w = Window.partitionBy(doc).orderBy(F.desc("n"), "cls")
    top = n.withColumn("r", F.row_number().over(w)).withColumn("second", F.coalesce(F.lead("n").over(w), F.lit(0))).where("r = 1")
    return top.select(doc, F.when((F.col("n") < 5) | (F.col("second") > 0.9 * F.col("n")), UNKNOWN).otherwise(F.col("cls")).alias("cls"))


def person_gender(pages: DataFrame, persons: DataFrame, genders: DataFrame) -> DataFrame:
    """(qid, gender): 1 or 2 by the gender map, 5 for others, -1 persons without a gender, -2 no person."""
    mapped = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in GENDERS.items() for x in kv]), F.col("gender_qid")), F.lit(UNKNOWN))
    one = genders.groupBy("qid").agg(F.max("value").alias("gender_qid"))
    out = pages.select("qid").distinct().join(persons.select("qid", F.lit(True).alias("person")).distinct(), "qid", "left").join(one, "qid", "left")
    return out.select("qid", F.when(F.col("person").isNull(), -2).when(F.col("gender_qid").isNull(), -1).otherwise(mapped).alias("gender"))


def conflict_aliases(ranked: DataFrame, first: int = 30) -> DataFrame:
    """(qid, alias): of the aliases that have the entity among their first candidates, the one with most candidates;
    of equally many, the greatest alias. ranked: (alias, qid, rank)."""
    size = ranked.groupBy("alias").agg(F.count("*").alias("n"))
    near = ranked.where(F.col("rank") <= first).select("alias", "qid").join(size, "alias")
    return near.groupBy("qid").agg(F.max_by("alias", F.struct("n", "alias")).alias("alias"))


def pronoun_mentions(tokens: DataFrame, gender: DataFrame, aliases: DataFrame, doc_qid: str) -> DataFrame:
    """Mentions for the pronouns that agree with the gender, 1 or 2, of the page's person: gold false, source prn."""
    of = gender.where("gender in (1, 2)").select(F.col("qid").alias(doc_qid), "gender")
    return tokens.join(of, doc_qid).where("cls = gender").join(aliases.select(F.col("qid").alias(doc_qid), "alias"), doc_qid).select(*tokens.columns, "alias", F.lit(False).alias("gold"), F.lit("prn").alias("mention_source"))


def choose_aliases(mentions: DataFrame, ranked: DataFrame, k: int) -> DataFrame:
    """mentions (id, alias, qid) with `new_alias`: unknown entities keep theirs, as do those among the first k of an
    ambiguous alias; others take the alias of the entity with most candidates among whose first k it is; else one that
    lists it among its first k, by the first 32 bits of the SHA-1 of `id|qid`; else their own."""
    size = ranked.groupBy("alias").agg(F.count("*").alias("n"))
    near = ranked.where(F.col("rank") <= k).select("alias", "qid").join(size, "alias")
    best = near.where("n > 1").groupBy("qid").agg(F.max_by("alias", F.struct("n", "alias")).alias("best"))
    spare = near.groupBy("qid").agg(F.sort_array(F.collect_set("alias")).alias("spare"))
    own = near.where("n > 1").select("alias", "qid", F.lit(True).alias("fits"))
    out = mentions.join(own, ["alias", "qid"], "left").join(best, "qid", "left").join(spare, "qid", "left")
    number = F.conv(F.substring(F.sha1(F.concat_ws("|", F.col("id").cast("string"), "qid")), 1, 8), 16, 10).cast("long")
    pick = F.get("spare", F.pmod(number, F.size("spare")).cast("int"))
    return out.withColumn("new_alias", F.when(F.col("qid").isNull() | F.col("fits"), F.col("alias")).otherwise(F.coalesce("best", pick, "alias"))).drop("fits", "best", "spare")


def page_votes(mentions: DataFrame, qid_aliases: DataFrame, doc: str, doc_qid: str) -> DataFrame:
    """(doc, doc_qid, alias, qid, votes): each linked mention votes for all aliases of its entity; the page's own
    aliases begin with one vote."""
    cast = mentions.where("qid is not null").select(doc, doc_qid, "qid").join(qid_aliases.select("qid", "alias"), "qid").select(doc, doc_qid, "alias", "qid")
    seed = mentions.select(doc, doc_qid).where(F.col(doc_qid).isNotNull()).distinct().join(qid_aliases.select(F.col("qid").alias(doc_qid), "alias"), doc_qid).select(doc, doc_qid, "alias", F.col(doc_qid).alias("qid"))
    return cast.unionByName(seed).groupBy(doc, doc_qid, "alias", "qid").agg(F.count("*").alias("votes"))


def pruned_votes(votes: DataFrame, doc: str, doc_qid: str) -> DataFrame:
    """(doc, alias, qid): an alias of one entity stays; of several, the page's entity weighs a fifth of all votes of the
    page, at least 1, and the first stays if it has over five times the second's."""
    total = votes.groupBy(doc).agg(F.sum("votes").alias("total"))
    both = votes.join(total, doc)
    n = F.count("*").over(Window.partitionBy(doc, "alias"))
    both = both.withColumn("n", n).withColumn("weight", F.when((F.col("n") > 1) & (F.col("qid") == F.col(doc_qid)), F.greatest(0.2 * F.col("total"), F.lit(1.0))).otherwise(F.col("votes").cast("double")))
    w = Window.partitionBy(doc, "alias").orderBy(F.desc("weight"), "qid")
    top = both.withColumn("r", F.row_number().over(w)).withColumn("second", F.lead("weight").over(w))
    return top.where("r = 1 and (n = 1 or weight > 5 * second)").select(doc, "alias", "qid")


def _grams(most_words: int, avoid: frozenset[str], plain: frozenset[str], form: str):
    bare_table = str.maketrans(dict.fromkeys(string.punctuation))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, bool, bool]] = {}

        def word(w: str) -> tuple[str, bool, bool]:
            """Its normal form; whether it may stand at an end; whether it counts as a noun."""
            if w not in known:
                if len(known) > 100_000:
                    known.clear()
                bare = w.translate(bare_table).strip()
                known[w] = normal_alias(w, form=form), w not in avoid and bare != "", bare != "" and bare.lower() not in plain
            return known[w]

        for batch in (b.slice(k, 1000) for b in batches for k in range(0, b.num_rows, 1000)):
            at, n, start, end, alias = [], [], [], [], []
            for row, t in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                found = [(m.start(), m.end(), *word(m.group())) for m in re.finditer(r"\S+", t or "")]
                # what lies between two words is a blank, or, without one, nothing in the normal form
                glue = [" " if " " in t[a[1] : b[0]] else "" for a, b in zip(found, found[1:])]
                for i, (s, _, _, opens, _) in enumerate(found):
                    if not opens:
                        continue
                    noun, text = False, ""
                    for j in range(i, min(i + most_words, len(found))):
                        _, e, norm, closes, is_noun = found[j]
                        text += (glue[j - 1] if j > i else "") + norm
                        noun = noun or is_noun
                        if closes and noun and (name := " ".join(text.split())):
                            at.append(row), n.append(j - i + 1), start.append(s), end.append(e), alias.append(name)
            index = pa.array(at, pa.int32())
            keep = [batch.column(c).take(index) for c in range(batch.num_columns - 1)]
            numbers = [pa.array(x, pa.int32()) for x in (n, start, end)]
            yield pa.RecordBatch.from_arrays([*keep, *numbers, pa.array(alias, pa.string())], [*batch.schema.names[:-1], "n", "start", "end", "alias"])

    return run


def candidate_grams(sents: DataFrame, keep: list[str], text: str, most_words: int, language: Language = ENGLISH) -> DataFrame:
    """A row per n-gram of up to most_words words that may be a mention: keep, n, start, end, alias in normal form.

    Neither end is a word to avoid or mere punctuation. A tagger is a plug-in; without one, a word counts as a noun if
    it isn't a stop word, so a single word must not be one and a longer n-gram must hold one that isn't. Null and empty
    texts have none. An Arrow function, as n-grams with places take quadratic time in built-in ones."""
    types = dict(sents.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keep) + ", n int, start int, end int, alias string"
    plain = frozenset(language.stop) | frozenset(language.avoid)
    return sents.select(*keep, text).mapInArrow(_grams(most_words, frozenset(language.avoid), plain, language.form), schema)


def greedy_spans(candidates: DataFrame, keep: list[str], taken: DataFrame | None = None) -> DataFrame:
    """Of the candidate spans (keep, n, start, end, alias) of each sentence, those picked from the longest n-gram down
    and from left to right, none overlapping another or one that is taken (keep, start, end)."""
    kind = "array<struct<k:int,start:int,end:int,alias:string>>"
    lists = candidates.groupBy(*keep).agg(F.sort_array(F.collect_set(F.struct((-F.col("n")).alias("k"), "start", "end", "alias"))).alias("c"))
    if taken is not None:
        lists = lists.join(taken.groupBy(*keep).agg(F.collect_list(F.struct(F.lit(0).alias("k"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.lit("").alias("alias"))).alias("used")), keep, "left")
    else:
        lists = lists.withColumn("used", F.expr(f"cast(array() as {kind})"))
    meets = lambda a, x: F.exists(a, lambda y: span_overlap(y["start"], y["end"], x["start"], x["end"]) > 0)
    picked = F.aggregate("c", F.coalesce("used", F.expr(f"cast(array() as {kind})")), lambda a, x: F.when(meets(a, x), a).otherwise(F.concat(a, F.array(x))))
    return lists.select(*keep, F.explode(picked).alias("p")).where("p.k < 0").select(*keep, (-F.col("p.k")).alias("n"), "p.start", "p.end", "p.alias")


def hash_split(key: Column, percent: int) -> Column:
    """test, dev or train by the SHA-1 bucket of a key: the first percent, the next, the rest."""
    b = sha1_bucket(key)
    return F.when(b < percent, "test").when(b < 2 * percent, "dev").otherwise("train")


def unswapped(aliases: Column, unswap: Column, gold: Column) -> Column:
    """Gold mentions get the alias they had before it was swapped, where that is known."""
    zipped = F.arrays_zip(aliases.alias("a"), unswap.alias("u"), gold.alias("g"))
    return F.transform(zipped, lambda m: F.when(m["g"] & m["u"].isNotNull(), m["u"]).otherwise(m["a"]))


@dataclass(frozen=True)
class Labelling:
    """What labelling functions see: the sentences' n-grams (sent, doc, n, start, end, alias), the aliases that each page's
    votes give to its own entity (doc, alias, qid), and the mentions so far (sent, start, end, alias, qid, source)."""

    grams: DataFrame
    own: DataFrame
    mentions: DataFrame


#: Labelling functions by name: Labelling -> new mentions (sent, start, end, alias, qid).
LABELLERS: dict[str, object] = {}


def labelling_function(f):
    """Register a labelling function under its name, which becomes its mentions' source; `gold` is taken."""
    if f.__name__ == "gold":
        raise ValueError("gold is the source of the mentions given")
    LABELLERS[f.__name__] = f
    return f


@labelling_function
def golds(given: Labelling) -> DataFrame:
    """Nothing beyond the mentions given."""
    return given.mentions.select("sent", "start", "end", "alias", "qid").limit(0)


@labelling_function
def aka(given: Labelling) -> DataFrame:
    """N-grams that are aliases of the page's entity and for which the page's votes name it, the longest first, none
    overlapping another or a mention."""
    hit = given.grams.join(given.own, ["doc", "alias"])
    picked = greedy_spans(hit.select("sent", "n", "start", "end", F.concat_ws("\t", "qid", "alias").alias("alias")), ["sent"], given.mentions.where("start is not null and end is not null").select("sent", "start", "end"))
    return picked.select("sent", "start", "end", F.substring_index("alias", "\t", -1).alias("alias"), F.substring_index("alias", "\t", 1).alias("qid"))


def weak_labels(sents: DataFrame, mentions: DataFrame, own: DataFrame, ranked: DataFrame, *, most_words: int, k: int = 30, permute: bool = True, names: list[str] | None = None, language: Language = ENGLISH) -> DataFrame:
    """(sent, aliases, unswap_aliases, char_spans, qids, gold, sources): the sentences with their mentions and those that
    the labelling functions, all or the named ones in turn, find.

    sents: (sent, doc, sentence), mentions: (sent, start, end, alias, qid), own: (doc, alias, qid), ranked: (alias, qid,
    rank). Each function sees what those before it found. Mentions are sorted by span, null spans first. With `permute`
    each gets a more ambiguous alias by choose_aliases, unswap_aliases keeps the one before. Sentences without mentions
    have empty arrays; null sentences only their own mentions."""
    grams = candidate_grams(sents.where("sentence is not null"), ["sent", "doc"], "sentence", most_words, language)
    grams = grams.join(own.select("doc", "alias").distinct(), ["doc", "alias"], "left_semi")
    every = mentions.select("sent", "start", "end", "alias", "qid", F.lit("gold").alias("source"))
    for name in names or list(LABELLERS):
        every = every.unionByName(LABELLERS[name](Labelling(grams, own, every)).withColumn("source", F.lit(name)))
    every = every.withColumn("unswap", F.col("alias"))
    if permute:
        identified = every.withColumn("id", F.concat_ws(":", "sent", "start", "end", "source"))
        every = choose_aliases(identified, ranked, k).withColumn("alias", F.col("new_alias"))
    packed = every.groupBy("sent").agg(F.sort_array(F.collect_list(F.struct("start", "end", "source", "qid", "alias", "unswap"))).alias("m"))
    at = lambda f: F.coalesce(F.transform("m", f), F.expr("array()"))
    out = sents.select("sent").join(packed, "sent", "left")
    return out.select(
        "sent", at(lambda x: x["alias"]).alias("aliases"), at(lambda x: x["unswap"]).alias("unswap_aliases"), at(lambda x: F.array(x["start"], x["end"])).alias("char_spans"),
        at(lambda x: x["qid"]).alias("qids"), at(lambda x: x["source"] == "gold").alias("gold"), at(lambda x: x["source"]).alias("sources"),
    )


def swap_pronouns(sents: DataFrame, swaps: DataFrame, key: str, text: str, mentions: str) -> DataFrame:
    """sents with pronouns replaced by names, and the spans of all their mentions moved along.

    swaps: (key, start, end, name), none overlapping; possessive ones should end in " 's". mentions: a column of
    array<struct<start, end, ..>>; a mention that is itself replaced spans its name. Sentences without swaps stay."""
    lists = swaps.groupBy(key).agg(F.sort_array(F.collect_set(F.struct("start", "end", "name"))).alias("_s"))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,name:string>>)")
    both = sents.join(lists, key, "left").withColumn("_s", F.coalesce(F.col("_s").cast("array<struct<start:int,end:int,name:string>>"), empty))
    built = F.aggregate(
        "_s", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, x: F.struct(F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, x["start"] - a["at"]), x["name"]).alias("out"), x["end"].alias("at")),
        lambda a: F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, F.length(text))),
    )
    grown = lambda p, before: F.aggregate(F.filter("_s", lambda x: before(x, p)), F.lit(0), lambda a, x: a + F.length(x["name"]) - (x["end"] - x["start"]))
    start = lambda m: m["start"] + grown(m["start"], lambda x, p: x["start"] < p)
    end = lambda m: m["end"] + grown(m["end"], lambda x, p: x["start"] < p)
    moved = F.transform(mentions, lambda m: m.withField("start", start(m)).withField("end", end(m)))
    return both.withColumn("_m", moved).withColumn(text, built).withColumn(mentions, F.col("_m")).drop("_s", "_m")


def first_pronouns(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """Only the first pronoun of each sentence."""
    return tokens.withColumn("_r", F.row_number().over(Window.partitionBy(*keep).orderBy("start"))).where("_r = 1").drop("_r")


def label_tables(ranked: DataFrame, own: DataFrame, most: int = 100) -> dict[str, DataFrame]:
    """What weak labelling looks up: alias_qids and qid_aliases, the first `most` of each by score, and qid_own, the
    entity's own aliases (qid, alias)."""
    w = Window.partitionBy("qid").orderBy(F.desc("score"), "alias")
    return {
        "alias_qids": ranked.where(F.col("rank") <= most).select("alias", "qid", "rank"),
        "qid_aliases": ranked.withColumn("r", F.row_number().over(w)).where(F.col("r") <= most).select("qid", "alias", F.col("r").alias("rank")),
        "qid_own": own.select("qid", "alias").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("alias"))).where(F.col("rank") <= most),
    }
