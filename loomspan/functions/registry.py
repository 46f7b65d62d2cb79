"""Sentence filters by name. A filter is a function from a table of sentences (and side tables) to the rows to keep; it
replaces code given as text and evaluated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS: dict[str, Callable[..., DataFrame]] = {}


def sentence_filter(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    FILTERS[f.__name__] = f
    return f


@sentence_filter
def keep_all(s: DataFrame) -> DataFrame:
    return s


@sentence_filter
def keep_none(s: DataFrame) -> DataFrame:
    return s.where(F.lit(False))


@sentence_filter
def short(s: DataFrame, most: int = 100) -> DataFrame:
    """At most so many pieces at single blanks; null sentences go."""
    return s.where(F.size(F.split("sentence", " ")) <= most)


@sentence_filter
def with_qids(s: DataFrame, keep: DataFrame) -> DataFrame:
    """Short sentences that mention one of keep (qid)."""
    hit = s.select("sent_idx_unq", F.explode("qids").alias("qid")).join(keep.select("qid").distinct(), "qid", "left_semi").select("sent_idx_unq").distinct()
    return short(s).join(hit, "sent_idx_unq", "left_semi")


@sentence_filter
def with_parent(s: DataFrame, keep: DataFrame) -> DataFrame:
    return short(s).join(keep.select(F.col("qid").alias("parent_qid")).distinct(), "parent_qid", "left_semi").select(s.columns)


@sentence_filter
def with_either(s: DataFrame, keep: DataFrame) -> DataFrame:
    ids = with_qids(s, keep).select("sent_idx_unq").unionByName(with_parent(s, keep).select("sent_idx_unq")).distinct()
    return s.join(ids, "sent_idx_unq", "left_semi")


@sentence_filter
def with_aliases(s: DataFrame, aliases: list[str]) -> DataFrame:
    return short(s).where(F.arrays_overlap("aliases", F.array(*map(F.lit, aliases))))


#: Loaders of the side tables that filters need, by name.
PREPS: dict[str, Callable[..., DataFrame]] = {}


def prep_function(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    PREPS[f.__name__] = f
    return f


@prep_function
def qids_of_relation(triples: DataFrame, relation: str) -> DataFrame:
    """(qid): heads of a relation."""
    return triples.where(F.col("rel") == relation).select(F.col("head").alias("qid")).where("qid is not null").distinct()


@prep_function
def qids_of_pairs(triples: DataFrame, relation: str) -> DataFrame:
    """(qid): heads and tails of a relation."""
    t = triples.where(F.col("rel") == relation)
    return t.select(F.col("head").alias("qid")).unionByName(t.select(F.col("tail").alias("qid"))).where("qid is not null").distinct()


def filtered(sentences: DataFrame, name: str, prep: str | None = None, *args: object) -> DataFrame:
    """A filter by name, its side table made by a prep function by name."""
    return FILTERS[name](sentences, PREPS[prep](*args)) if prep else FILTERS[name](sentences, *args)
