"""Titles to entity ids: title rows, redirects, the resolution map and lookups by several keys in turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.normal import convert_title, escape, unescape


def title_rows(links: DataFrame, labels: DataFrame, page_ids: DataFrame) -> DataFrame:
    """(qid, id, title, wikidata_title, wikipedia_title): page links (qid, wiki_title) with all labels (qid, label; the
    title in lower case if none) and the page id (title, id; -1 if none)."""
    return (
        links.join(labels, "qid", "left").join(page_ids.withColumnRenamed("title", "wiki_title"), "wiki_title", "left")
        .select("qid", F.coalesce("id", F.lit(-1)).alias("id"), F.col("wiki_title").alias("title"), F.coalesce("label", F.lower("wiki_title")).alias("wikidata_title"), F.col("wiki_title").alias("wikipedia_title"))
        .distinct()
    )


def expand_redirects(rows: DataFrame, redirects: DataFrame) -> DataFrame:
    """rows and, for each redirect (source, target) to a known page, a copy of one of its rows with the source as title.

    A target is looked for as written, then URL-decoded and unescaped. Of several rows of a page the first in order of
    (qid, id, wikidata_title) is copied."""
    w = Window.partitionBy("wikipedia_title").orderBy("qid", "id", "wikidata_title")
    one = rows.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n", "title")
    found = lookup_chain(redirects, [F.col("target"), convert_title(F.col("target"))], one.select(F.col("wikipedia_title").alias("k"), F.struct("qid", "id", "wikidata_title", "wikipedia_title").alias("v")))
    copies = found.where("v is not null").select("v.qid", "v.id", F.col("source").alias("title"), "v.wikidata_title", "v.wikipedia_title")
    return rows.select(*copies.columns).unionByName(copies).distinct()


def resolution_map(rows: DataFrame) -> DataFrame:
    """(title, qid): a page's own title beats a redirect; of several entities the smallest id, so that no file order
    counts. Unknown entities (-1, null) and null titles are left out."""
    known = rows.where("qid is not null and qid != '-1'")
    keys = known.select(F.col("wikipedia_title").alias("title"), "qid", F.lit(0).alias("prio")).unionByName(known.select("title", "qid", F.lit(1).alias("prio")))
    return keys.where("title is not null").groupBy("title").agg(F.min(F.struct("prio", "qid")).alias("best")).select("title", F.col("best.qid").alias("qid"))


def lookup_chain(df: DataFrame, keys: list[Column], table: DataFrame, value: str = "v") -> DataFrame:
    """df with `value` of the first of the keys that the table (k, v) knows; null if it knows none."""
    out, found = df, []
    for i, key in enumerate(keys):
        out = out.withColumn(f"_k{i}", key).join(table.select(F.col("k").alias(f"_k{i}"), F.col("v").alias(f"_v{i}")), f"_k{i}", "left")
        found.append(f"_v{i}")
    return out.withColumn(value, F.coalesce(*found)).drop(*found, *[f"_k{i}" for i in range(len(keys))])


def resolve_titles(mentions: DataFrame, mapping: DataFrame, title: str = "title", default: str | None = None) -> DataFrame:
    """mentions with the qid of their title: as written, unescaped, or escaped, whichever is known first."""
    t = F.col(title)
    found = lookup_chain(mentions, [t, unescape(t), escape(t)], mapping.select(F.col("title").alias("k"), F.col("qid").alias("v")), "resolved_qid")
    return found.withColumn("resolved_qid", F.coalesce("resolved_qid", F.lit(default))) if default is not None else found


def cascade(df: DataFrame, reasons: list[tuple[str, Column]], name: str = "reason") -> DataFrame:
    """df with the first reason whose condition holds (null conditions don't), null if none does."""
    out = F.lit(None).cast("string")
    for reason, condition in reversed(reasons):
        out = F.when(condition, reason).otherwise(out)
    return df.withColumn(name, out)


def allowed_qids(linked: DataFrame, pages: DataFrame, benchmark: DataFrame | None, disambiguation: DataFrame) -> DataFrame:
    """(qid): entities linked or with a page or in a benchmark, without disambiguation pages and unknown ones."""
    parts = [linked.select("qid"), pages.select("qid"), *([benchmark.select("qid")] if benchmark is not None else [])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("qid is not null and qid != '-1'").distinct().join(disambiguation.select("qid"), "qid", "left_anti")
