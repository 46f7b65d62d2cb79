"""Candidate generators and how well they do: lookups, back-off to parts of an alias, context re-ranking, recall."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loomspan.functions.normal import partial_ratio
from loomspan.operators.candidates import top_k

#: Query names and concept names that meet in one call of the tf-idf join, and the scores it holds at a time.
NAMES_AT_ONCE, CONCEPTS_AT_ONCE, SCORES_AT_ONCE = 4096, 20_000, 4_000_000


def judged(golds: DataFrame, candidates: DataFrame) -> DataFrame:
    """golds (.., alias, qid) with `outcome`: `no_alias`, `no_candidate` (the alias lacks the qid) or `found`."""
    known = candidates.select("alias").distinct().withColumn("_a", F.lit(1))
    pairs = candidates.select("alias", "qid").distinct().withColumn("_p", F.lit(1))
    out = golds.join(known, "alias", "left").join(pairs, ["alias", "qid"], "left")
    return out.withColumn("outcome", F.when(F.col("_a").isNull(), "no_alias").when(F.col("_p").isNull(), "no_candidate").otherwise("found")).drop("_a", "_p")


def recall(judgements: DataFrame, by: list[str]) -> DataFrame:
    """Per group: mentions, those whose alias is known, those found, and the share found."""
    out = judgements.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(F.col("outcome") != "no_alias").alias("alias_known"), F.count_if(F.col("outcome") == "found").alias("found"))
    return out.withColumn("recall", F.col("found") / F.col("total"))


def recall_at(ranked_golds: DataFrame, cuts: list[int]) -> DataFrame:
    """(k, hits, total, recall) of golds with the rank of the right candidate, null if there is none."""
    counts = ranked_golds.groupBy("rank").agg(F.count("*").alias("n"))  # a row per rank
    each = counts.select("rank", "n", F.explode(F.array(*map(F.lit, cuts))).alias("k"))
    summed = each.groupBy("k").agg(F.sum(F.when(F.col("rank") <= F.col("k"), F.col("n")).otherwise(0)).alias("hits"), F.sum("n").alias("total"))
    return summed.withColumn("recall", F.col("hits") / F.col("total"))


def sub_phrases(aliases: DataFrame, alias: str = "alias") -> DataFrame:
    """(alias, phrase, n_words): all runs of words of each distinct alias, and the alias without blanks as its longest."""
    a = aliases.select(alias).where(F.col(alias).isNotNull()).distinct()
    words = F.split(alias, " ")
    n = F.size(words)
    runs = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda k: F.transform(F.sequence(F.lit(0), n - k), lambda i: F.struct(F.array_join(F.slice(words, i + 1, k), " ").alias("phrase"), k.alias("n_words")))))
    joined = F.array(F.struct(F.replace(F.col(alias), F.lit(" "), F.lit("")).alias("phrase"), n.alias("n_words")))
    return a.select(alias, F.explode(F.array_distinct(F.concat(runs, joined))).alias("p")).select(alias, "p.*")


def backed_off(aliases: DataFrame, candidates: DataFrame) -> DataFrame:
    """(alias, qid, score): an alias's own candidates, else those of it without blanks, else those of its longest known
    runs of words, scores summed."""
    phrases = sub_phrases(aliases)
    exact = F.when(F.col("phrase") == F.col("alias"), 0).when(F.col("phrase") == F.replace("alias", F.lit(" "), F.lit("")), 1)
    level = phrases.withColumn("level", F.coalesce(exact, 2 + F.size(F.split("alias", " ")) - F.col("n_words")))
    hits = level.join(candidates.select(F.col("alias").alias("phrase"), "qid", "score"), "phrase")
    best = hits.groupBy("alias").agg(F.min("level").alias("level"))
    return hits.join(best, ["alias", "level"]).groupBy("alias", "qid").agg(F.sum("score").alias("score"))


def context_scores(cands: DataFrame, contexts: DataFrame, terms: DataFrame) -> DataFrame:
    """(mention, qid, hits): for each candidate, the proper names of the mention's sentence that its page contains, each
    counted at most 5 times and weighted by its words. cands: (mention, qid), contexts: (qid, sentence), terms: (mention, term)."""
    # a sentence that has a term has its first word: they meet there, and a large page isn't crossed with all terms
    asked = cands.select("mention", "qid").distinct().join(terms.select("mention", "term").where("term is not null").distinct(), "mention").withColumn("word", F.get(F.split("term", " "), F.lit(0)))
    held = contexts.where("sentence is not null").join(asked.select("qid").distinct(), "qid", "left_semi")
    pages = held.select("qid", "sentence", F.explode(F.array_distinct(F.split("sentence", " "))).alias("word")).join(asked, ["qid", "word"])
    seen = pages.where(F.contains(F.concat(F.lit(" "), "sentence", F.lit(" ")), F.concat(F.lit(" "), "term", F.lit(" "))))
    each = seen.groupBy("mention", "qid", "term").agg(F.least(F.count("*"), F.lit(5)).alias("n"))
    return each.groupBy("mention", "qid").agg(F.sum(F.col("n") * F.size(F.split("term", " "))).alias("hits"))


@F.arrow_udf(DoubleType())
def title_ratio(title: pa.Array, alias: pa.Array) -> pa.Array:
    """Best partial match, 0 to 1, of title and alias; null if either is."""
    return pa.array([None if t is None or a is None else partial_ratio(t, a) / 100 for t, a in zip(title.to_pylist(), alias.to_pylist(), strict=True)], pa.float64())


def jaccard(a, b):
    """Share of the words of either text that both have; 0 for two empty ones."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(0.0)


def merged_ranking(prior: DataFrame, context: DataFrame, key: str, k: int, first: int = 5) -> DataFrame:
    """(key, qid, rank): the first few by prior, then by context score up to k, none twice. prior: (key, qid, prior),
    context: (key, qid, context)."""
    by = Window.partitionBy(key)
    p = prior.withColumn("p", F.row_number().over(by.orderBy(F.desc("prior"), F.desc("qid")))).select(key, "qid", "p")
    c = context.withColumn("c", F.row_number().over(by.orderBy(F.desc("context"), F.desc("qid")))).select(key, "qid", "c")
    both = p.join(c, [key, "qid"], "full")
    lead = F.when(F.col("p") <= first, F.col("p"))
    out = both.where((F.col("p") <= first) | F.col("c").isNotNull()).withColumn("rank", F.row_number().over(by.orderBy(F.asc_nulls_last(lead), F.asc_nulls_last("c"), "qid")))
    return out.where(F.col("rank") <= k).select(key, "qid", "rank")


def char_grams(df: DataFrame, keep: list[str], text: str, n: int) -> DataFrame:
    """keep, gram, tf: the character n-grams of a text with a blank at both ends."""
    t = F.concat(F.lit(" "), F.col(text), F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - n + 1, F.lit(1))), lambda i: F.substring(t, i, F.lit(n)))
    return df.select(*keep, F.explode(grams).alias("gram")).groupBy(*keep, "gram").agg(F.count("*").alias("tf"))


def _nearest(k: int):
    def run(queries: pa.Table, concepts: pa.Table) -> pa.Table:
        """The k nearest qids of each alias, and those as near as the last of them. queries: alias, gram, w, rare, concepts: qid, name, gram, w."""
        q, c = queries.sort_by([("alias", "ascending"), ("gram", "ascending")]).combine_chunks(), concepts.sort_by([(x, "ascending") for x in ("qid", "name", "gram")]).combine_chunks()
        codes = {x: t[x].combine_chunks().dictionary_encode() for t, x in ((q, "alias"), (c, "qid"), (c, "name"))}
        place = {x: v.indices.to_numpy() for x, v in codes.items()}
        new = (np.diff(place["qid"], prepend=-1) != 0) | (np.diff(place["name"], prepend=-1) != 0)
        unit, qid = np.cumsum(new) - 1, place["qid"][new]  # a unit is a name of a qid
        n, units = len(codes["alias"].dictionary), len(qid)

        def unit_length(w: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
            return w / np.sqrt(np.bincount(at, w * w, size))[at]

        qw, cw = unit_length(q["w"].to_numpy(), place["alias"], n), unit_length(c["w"].to_numpy(), unit, units)
        grams = pc.unique(q["gram"])
        at = pc.index_in(q["gram"], grams).to_numpy()
        order = np.argsort(at, kind="stable")
        lists = np.split(order, np.cumsum(np.bincount(at, minlength=len(grams)))[:-1])
        rare = q["rare"].to_numpy()
        known = pc.fill_null(pc.index_in(c["gram"], grams), -1).to_numpy()
        top, found, held = np.zeros((n, k)), [], None
        step = max(1, SCORES_AT_ONCE // max(n, 1))
        for low in range(0, units if n else 0, step):
            high = min(low + step, units)
            rows = np.arange(*np.searchsorted(unit, [low, high]))
            rows = rows[known[rows] >= 0]
            rows = rows[np.argsort(known[rows], kind="stable")]
            scores, seen = np.zeros((n, high - low)), np.zeros((n, high - low), bool)
            for r in np.split(rows, np.flatnonzero(np.diff(known[rows])) + 1) if len(rows) else []:
                of = lists[known[r[0]]]
                scores[np.ix_(place["alias"][of], unit[r] - low)] += np.outer(qw[of], cw[r])
                seen[np.ix_(place["alias"][of[rare[of]]], unit[r] - low)] = True
            scores[~seen] = 0
            first = np.flatnonzero(np.diff(qid[low:high], prepend=-1))
            ids, best = qid[low:high][first], np.maximum.reduceat(scores, first, axis=1)
            if held:  # the last qid may go on in this slice
                if ids[0] == held[0]:
                    best[:, 0] = np.maximum(best[:, 0], held[1])
                else:
                    ids, best = np.append(held[0], ids), np.column_stack([held[1], best])
            if high < units:
                held, ids, best = (ids[-1], best[:, -1].copy()), ids[:-1], best[:, :-1]
            top = np.partition(np.column_stack([top, best]), -k, axis=1)[:, -k:]
            a, i = np.nonzero((best > 0) & (best >= top.min(1, keepdims=True)))
            found.append((a, ids[i], best[a, i]))
        a, i, s = (np.concatenate([x[j] for x in found] or [np.zeros(0)]) for j in range(3))
        keep = s >= top.min(1, initial=np.inf)[a.astype(int)] if len(a) else np.zeros(0, bool)
        pick = lambda name, x: codes[name].dictionary.take(pa.array(x[keep].astype(int), pa.int64()))
        return pa.table({"alias": pick("alias", a), "qid": pick("qid", i), "similarity": pa.array(s[keep].astype(float))})

    return run


def tfidf_candidates(queries: DataFrame, concepts: DataFrame, k: int, n: int = 3, top_grams: int | None = None) -> DataFrame:
    """(alias, qid, similarity, rank): the k nearest concepts (alias, qid) of each distinct query alias by cosine of
    tf-idf over character n-grams, the best of a concept's aliases. All concepts that share an n-gram are scored; with
    `top_grams` only those that share one of so many of the query's rarest, which may lose near ones.

    Query names and concepts are cut into parts, and an Arrow function scores part against part."""
    concepts = concepts.select(F.col("alias").alias("name"), "qid").where("name is not null and qid is not null").distinct()
    docs = char_grams(concepts.select("name").distinct(), ["name"], "name", n)
    total = concepts.select("name").distinct().count()
    idf = docs.groupBy("gram").agg((F.log(F.lit((1 + total) * 1.0) / (1 + F.count("*"))) + 1).alias("idf"))
    w = (F.col("tf") * F.col("idf")).alias("w")
    names = queries.select("alias").where("alias is not null").distinct()
    parts, buckets = -(-names.count() // NAMES_AT_ONCE) or 1, -(-total // CONCEPTS_AT_ONCE) or 1
    part = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    q = char_grams(names, ["alias"], "alias", n).join(idf, "gram")
    rare = F.lit(True) if top_grams is None else F.row_number().over(Window.partitionBy("alias").orderBy(F.desc("idf"), "gram")) <= top_grams
    q = q.select(part("alias", parts).alias("part"), "alias", "gram", w, rare.alias("rare")).select("*", every(buckets).alias("bucket"))
    d = docs.join(idf, "gram").select("name", "gram", w).join(concepts, "name").select(part("qid", buckets).alias("bucket"), "qid", "name", "gram", "w").select("*", every(parts).alias("part"))
    near = q.groupBy("part", "bucket").cogroup(d.groupBy("part", "bucket")).applyInArrow(_nearest(k), "alias string, qid string, similarity double")
    by = Window.partitionBy("alias").orderBy(F.desc("similarity"), "qid")
    return near.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


@dataclass
class RecallRun:
    """What a recall run leaves behind: the mentions kept, the errors, the figures, and the alias map that it needs."""

    kept: DataFrame
    errors: DataFrame
    figures: DataFrame
    aliases: DataFrame


def recall_run(golds: DataFrame, candidates: DataFrame, sentence: str = "sent_idx_unq", by: list[str] | None = None) -> RecallRun:
    """Golds (sentence, pos, alias, qid, gold, ...) against candidates (alias, qid, score).

    kept: found mentions of sentences of which at least one golden mention is found. errors: the others with their
    outcome. figures: totals, by the columns given. aliases: the candidates of the aliases of what is kept."""
    all_ = judged(golds, candidates)
    found = all_.where("outcome = 'found'")
    good = found.where("gold").select(sentence).distinct()
    kept = found.join(good, sentence, "left_semi")
    names = candidates.join(kept.select("alias").distinct(), "alias", "left_semi").select("alias", "qid", "score")
    return RecallRun(kept.drop("outcome"), all_.where("outcome != 'found'"), recall(all_, by or []), names)


#: Candidate generators by name: (asked (mention, alias), candidates, k) -> (mention, qid, rank).
GENERATORS: dict[str, object] = {}


def generator(f):
    GENERATORS[f.__name__] = f
    return f


@generator
def standard(asked: DataFrame, candidates: DataFrame, k: int = 30) -> DataFrame:
    """The first k candidates of the alias itself."""
    return asked.select("mention", "alias").join(top_k(candidates, k), "alias").select("mention", "qid", "rank")


@generator
def backoff(asked: DataFrame, candidates: DataFrame, k: int = 30) -> DataFrame:
    """The first k of the alias or of its longest known parts."""
    return asked.select("mention", "alias").join(top_k(backed_off(asked, candidates), k), "alias").select("mention", "qid", "rank")


def contextual_scores(cands: DataFrame, hits: DataFrame) -> DataFrame:
    """cands (mention, alias, qid, title, prior) with the context score: the prior, page hits, how well the title matches
    the alias, and their shared words, each weighted far above the one before it."""
    both = cands.join(hits, ["mention", "qid"], "left")
    ratio = F.coalesce(title_ratio("title", "alias"), F.lit(0.0))
    words = F.coalesce(jaccard(F.lower("title"), F.lower("alias")), F.lit(0.0))
    return both.withColumn("context", F.col("prior") + 10_000 * F.coalesce("hits", F.lit(0)) + 100_000 * ratio + 10_000 * words).drop("hits")


def split_by_start(documents: DataFrame, order: str, starts: dict[str, int]) -> DataFrame:
    """documents in order with `split`: each split begins at its document number."""
    out = F.lit(None).cast("string")
    for name, first in sorted(starts.items(), key=lambda x: x[1]):
        out = F.when(F.col(order) >= first, name).otherwise(out)
    return documents.withColumn("split", out)


def split_counts(documents: DataFrame, expected: dict[str, int]) -> DataFrame:
    """(split, n, is_expected): documents of each split, and whether they are as many as expected."""
    want = documents.sparkSession.createDataFrame(list(expected.items()), "split string, want long")
    n = documents.groupBy("split").agg(F.count("*").alias("n"))
    return n.join(want, "split", "full").select("split", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n", F.lit(0)).eqNullSafe(F.col("want")).alias("is_expected"))
