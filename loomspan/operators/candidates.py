"""Alias-candidate maps: counting with support, merging, ranking, top-k, closure and pruning. Long tables throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def alias_title_counts(mentions: DataFrame, normal, alias: str = "alias", title: str = "title") -> DataFrame:
    """(alias, title, cnt) over mentions with a title and an alias that isn't empty once normalised by normal(name).

    Equal pairs are counted before they are normalised, as that may take Python."""
    raw = mentions.where(F.col(title).isNotNull() & F.col(alias).isNotNull()).groupBy(F.col(alias).alias("alias"), F.col(title).alias("title")).agg(F.count("*").alias("n"))
    return raw.select(normal("alias").alias("alias"), "title", "n").groupBy("alias", "title").agg(F.sum("n").alias("cnt")).where("length(alias) > 0")


def min_support(counts: DataFrame, least: int, cnt: str = "cnt") -> DataFrame:
    return counts.where(F.col(cnt) >= least)


def title_support(counts: DataFrame, titles: DataFrame, own: DataFrame) -> DataFrame:
    """(alias, qid, cnt): one for each distinct supported title that leads to the qid, and one for each of its own titles.

    counts: (alias, title, ...), titles: (title, qid), own: (alias, qid), distinct."""
    by_title = counts.join(titles, "title").select("alias", "qid")
    return by_title.unionByName(own.select("alias", "qid")).groupBy("alias", "qid").agg(F.count("*").alias("cnt"))


def merge_pairs(counts: DataFrame, extra: DataFrame) -> DataFrame:
    """Full outer merge of (alias, qid, cnt) with pairs (alias, qid): known pairs keep their count, new ones get 1."""
    new = extra.select("alias", "qid").dropna().distinct().withColumn("added", F.lit(1))
    return counts.join(new, ["alias", "qid"], "full").select("alias", "qid", F.coalesce("cnt", "added").cast("long").alias("cnt"), F.col("cnt").isNull().alias("is_new"))


def ranked(candidates: DataFrame, key: str = "alias", score: str = "score", item: str = "qid") -> DataFrame:
    """candidates with rank, from 1, by score and then item, both descending, within each key."""
    return candidates.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), F.desc(item))))


def top_k(candidates: DataFrame, k: int, key: str = "alias", score: str = "score", item: str = "qid") -> DataFrame:
    """The first k of each key. The limit reaches below the shuffle, so that a large key isn't sorted whole in one task."""
    return ranked(candidates, key, score, item).where(F.col("rank") <= k)


def deduplicated(candidates: DataFrame) -> DataFrame:
    """One row per (alias, qid), the highest score; rows with a null part are left out, null scores count as 0."""
    return candidates.where("alias is not null and qid is not null").groupBy("alias", "qid").agg(F.max(F.coalesce("score", F.lit(0))).alias("score"))


def invert(pairs: DataFrame, key: str, item: str) -> DataFrame:
    """key -> sorted distinct items."""
    return pairs.where(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(item)).alias(f"{item}s"))


def closure(candidates: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Top-k lists of the aliases that have any candidate among wanted (qid)."""
    hit = candidates.join(wanted.select("qid").distinct(), "qid", "left_semi").select("alias").distinct()
    return top_k(candidates.join(hit, "alias", "left_semi"), k)


def normalised(counts: DataFrame, key: str, cnt: str = "cnt") -> DataFrame:
    """counts with `share` of the key's total. The totals are joined, so that no key is gathered in one window."""
    totals = counts.groupBy(key).agg(F.sum(cnt).alias("_total"))
    return counts.join(totals, key).withColumn("share", F.col(cnt) / F.col("_total")).drop("_total")


def prune_common(candidates: DataFrame, alias_counts: DataFrame, text_counts: DataFrame, keep_base: bool = False) -> DataFrame:
    """(alias, n_candidates, in_text, reason): common phrases among aliases; reason is null for those to keep.

    An alias that no mention has: kept if texts hold it under 500 times or it has one candidate, else `never_alias`. An
    alias that texts hold over 500 times and mentions under 10,000 times, in under 1.7 % of cases: `rarely_alias`.
    """
    size = candidates.groupBy("alias").agg(F.count("*").alias("n_candidates"))
    both = size.join(alias_counts.select("alias", F.col("cnt").alias("as_alias")), "alias", "left").join(text_counts.select("alias", F.col("cnt").alias("in_text")), "alias", "left")
    seen, used = F.coalesce("in_text", F.lit(0)), F.coalesce("as_alias", F.lit(0))
    never = (used == 0) & (seen >= 500) & (F.col("n_candidates") > 1) & F.lit(not keep_base)
    rarely = (used > 0) & (seen > 500) & (used < 10000) & (used / seen < 0.017)
    return both.select("alias", "n_candidates", seen.alias("in_text"), F.when(never, "never_alias").when(rarely, "rarely_alias").alias("reason"))


def padded(candidates: DataFrame, k: int, filler: str = "-1") -> DataFrame:
    """alias -> exactly k qids in rank order, filled with a sentinel."""
    from loomspan.functions.normal import pad

    packed = top_k(candidates, k).groupBy("alias").agg(F.sort_array(F.collect_list(F.struct("rank", "qid"))).alias("c"))
    return packed.select("alias", pad(F.transform("c", lambda x: x["qid"]), k, F.lit(filler)).alias("qids"))
