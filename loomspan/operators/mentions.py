"""Mentions: from marked-up pages, by sentences, flattened, filtered."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspan.functions.normal import link_title, match_spans

ANCHOR = r'(?s)<a\b([^>]*)>(.*?)</a>'


def anchor_mentions(pages: DataFrame, page_id: str, text: str) -> DataFrame:
    """(page_id, plain, mentions array<struct<alias, href, start, end>>): link mark-up taken out of each text.

    Runs of line ends become one and the text is trimmed; each anchor is replaced by what it holds, other tags stay. A
    mention needs text and an href; its span counts characters of the plain text. Null texts give null.
    """
    body = F.btrim(F.regexp_replace(text, r"\n+", "\n"), F.lit(" \n\t\r"))
    rows = pages.select(F.col(page_id), body.alias("body"))
    attributes, inner = F.regexp_extract_all("body", F.lit(ANCHOR), F.lit(1)), F.regexp_extract_all("body", F.lit(ANCHOR), F.lit(2))
    rows = rows.select("*", attributes.alias("attrs"), inner.alias("inner"), F.split("body", r"(?s)<a\b[^>]*>.*?</a>").alias("between"))
    # the text up to an anchor: the pieces between anchors and the inner texts before it
    kind = "array<struct<alias:string,href:string,start:int,end:int>>"
    href = lambda a: F.nullif(F.regexp_extract(a, r'href="([^"]*)"', 1), F.lit(""))
    walked = F.aggregate(
        F.arrays_zip("attrs", "inner", "between"),
        F.struct(F.expr(f"cast(array() as {kind})").alias("done"), F.lit("").alias("plain")),
        lambda acc, x: F.when(x["inner"].isNull(), F.struct(acc["done"].alias("done"), F.concat(acc["plain"], F.coalesce(x["between"], F.lit(""))).alias("plain"))).otherwise(
            F.struct(
                F.concat(acc["done"], F.array(F.struct(
                    x["inner"].alias("alias"), href(x["attrs"]).alias("href"),
                    F.length(F.concat(acc["plain"], x["between"])).alias("start"), F.length(F.concat(acc["plain"], x["between"], x["inner"])).alias("end"),
                ))).alias("done"),
                F.concat(acc["plain"], x["between"], x["inner"]).alias("plain"),
            )
        ),
    )
    walked = rows.select(page_id, walked.alias("w"))
    return walked.select(page_id, F.col("w.plain").alias("plain"), F.filter("w.done", lambda m: (m["alias"] != "") & m["href"].isNotNull()).alias("mentions"))


def with_titles(mentions: DataFrame) -> DataFrame:
    """Exploded mentions with the title that their href names; titles are decoded once per distinct href of a batch."""
    flat = mentions.select("*", F.posexplode("mentions").alias("pos", "m")).select(*[c for c in mentions.columns if c not in ("mentions", "plain")], "pos", "m.*")
    return flat.withColumn("title", link_title("href")).drop("href")


def sentence_spans(text: Column | str, end: str = r"[.!?]+(?=\s|$)") -> Column:
    """array<struct<word, start, end>> of the sentences of a text, blanks between left out."""
    return match_spans(text, rf"(?s)\S.*?(?:{end}|\Z)")


def sentences(pages: DataFrame, page_id: str, text: str, end: str = r"[.!?]+(?=\s|$)") -> DataFrame:
    """(page_id, sent, start, end): the sentences of each text with their places in it, blanks between left out."""
    return pages.select(page_id, F.posexplode(sentence_spans(text, end)).alias("sent", "s")).select(page_id, "sent", "s.start", "s.end")


BUCKETS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("hits", T.ArrayType(T.IntegerType()))]))


def buckets(spans: list[tuple[int, int]], mentions: list[tuple[int | None, int | None]]) -> list[tuple[int, int, list[int]]]:
    """(start, end, numbers of its mentions) of the sentences of a page, in order, merged where a mention goes past the end of
    the one it begins in; an open last one is dropped."""
    order = sorted((m[0], i) for i, m in enumerate(mentions) if m[0] is not None)
    out, k, opened, hits = [], 0, None, []
    for start, end in spans:
        first = start if opened is None else opened
        bad = False
        while k < len(order) and order[k][0] < end:
            at, i = order[k]
            k += 1
            if at >= first:
                hits.append(i)
                bad = bad or (at >= start and (mentions[i][1] or 0) > end)
        if bad:
            opened = first
        else:
            out.append((first, end, hits))
            opened, hits = None, []
    return out


@F.arrow_udf(BUCKETS)
def _buckets(starts: pa.Array, ends: pa.Array, m_starts: pa.Array, m_ends: pa.Array) -> pa.Array:
    rows = zip(*(x.to_pylist() for x in (starts, ends, m_starts, m_ends)), strict=True)
    made = [[{"start": s, "end": e, "hits": h} for s, e, h in buckets(list(zip(a or [], b or [], strict=True)), list(zip(c or [], d or [], strict=True)))] for a, b, c, d in rows]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("hits", pa.list_(pa.int32()))]))
    return pa.array(made, kind)


def bucketed(pages: DataFrame, page_id: str, spans: Column, mentions: str, fields: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """(page_id, doc_sent_idx, start, end, mentions): a page's sentences, array<struct<start, end, ..>> in order, merged so that
    no mention of its array straddles an end, with the mentions that begin in each: (s, e, fields), spans rebased, by place.

    Page by page, without a shuffle. A sentence in which a mention begins that goes on past its end is merged with the next; if
    the last one does so, its text is dropped. Null arrays are empty ones; mentions without a start are left out."""
    whole = pages.select(page_id, spans.alias("_s"), F.coalesce(F.col(mentions), F.expr("array()")).alias("_m"))
    made = whole.select(page_id, "_m", F.posexplode(_buckets(F.col("_s.start"), F.col("_s.end"), F.col(f"_m.{start}"), F.col(f"_m.{end}"))).alias("doc_sent_idx", "b"))
    at = lambda i: F.get("_m", i)
    rebased = F.transform("b.hits", lambda i: F.struct((at(i)[start] - F.col("b.start")).alias("s"), (at(i)[end] - F.col("b.start")).alias("e"), *[at(i)[c].alias(c) for c in fields]))
    return made.select(page_id, "doc_sent_idx", "b.start", "b.end", F.sort_array(rebased).alias("mentions"))


def bucket_mentions(sents: DataFrame, mentions: DataFrame, page_id: str) -> DataFrame:
    """`bucketed` for sentences (page_id, sent, start, end) and mentions (page_id, m_start, m_end, ...) in tables of their own;
    those of a page are brought together first. Mentions of pages without sentences are left out."""
    cols = [c for c in mentions.columns if c not in (page_id, "m_start", "m_end")]
    lists = sents.groupBy(page_id).agg(F.sort_array(F.collect_list(F.struct("sent", "start", "end"))).alias("_spans"))
    packed = mentions.groupBy(page_id).agg(F.collect_list(F.struct("m_start", "m_end", *cols)).alias("_mentions"))
    return bucketed(lists.join(packed, page_id, "left"), page_id, F.col("_spans"), "_mentions", cols, "m_start", "m_end")


FIELDS = ("aliases", "titles", "qids", "char_spans", "gold", "sources", "unswap_aliases")


def exploded(sents: DataFrame, keep: list[str]) -> DataFrame:
    """A row per mention: the parallel arrays side by side, unswap_alias and source filled where missing.

    A null array counts as one of nulls; there are as many mentions as aliases. Sentences without mentions have no row.
    """
    at = sents.select(*keep, *FIELDS, F.posexplode("aliases").alias("pos", "alias"))
    get = lambda c: F.get(F.col(c), F.col("pos"))
    return at.select(
        *keep, "pos", "alias", get("titles").alias("title"), get("qids").alias("qid"),
        F.get(get("char_spans"), F.lit(0)).alias("span_start"), F.get(get("char_spans"), F.lit(1)).alias("span_end"),
        F.coalesce(get("gold"), F.lit(True)).alias("gold"), F.coalesce(get("sources"), F.lit("gold")).alias("mention_source"),
        F.coalesce(get("unswap_aliases"), F.col("alias")).alias("unswap_alias"),
    )


def keep_mentions(condition) -> Column:
    """Of a sentence's parallel arrays, the mentions for which condition(struct) holds, as array<struct>."""
    return F.filter(F.arrays_zip(*FIELDS), condition)


def sort_by_span(mentions: Column) -> Column:
    """Mentions as structs that begin with (start, end), in order."""
    return F.array_sort(mentions)


def char_to_word(text: Column, at: Column) -> Column:
    """The number of the whitespace-separated word that begins at, or after, a character offset."""
    return F.size(F.filter(F.split(F.substring(text, F.lit(1), at), r"\s+"), lambda w: w != ""))


def find_in_order(text: Column, aliases: Column) -> Column:
    """array<struct<alias, start, end>>, in words: each alias in turn at its first place in the text that no earlier one
    took, punctuation blanked; start null where it isn't found."""
    blank = lambda c: F.regexp_replace(F.regexp_replace(c, r"\p{Punct}", " "), r"\s+", " ")
    padded = F.concat(F.lit(" "), F.trim(blank(text)), F.lit(" "))
    kind = "array<struct<alias:string,start:int,end:int>>"

    def step(a, alias):
        name = F.trim(blank(alias))
        at = F.call_function("locate", F.concat(F.lit(" "), name, F.lit(" ")), a["left"])
        found = (at > 0) & (name != "")
        words = F.size(F.split(name, " "))
        start = F.size(F.split(F.substring(a["left"], F.lit(1), at), " ")) - 2
        mask = F.array_join(F.array_repeat(F.lit("|"), words), " ")
        left = F.concat(F.substring(a["left"], F.lit(1), at), mask, F.substring(a["left"], at + F.length(name) + 1, F.length(a["left"])))
        hit = F.struct(alias.alias("alias"), F.when(found, start).cast("int").alias("start"), F.when(found, start + words).cast("int").alias("end"))
        return F.struct(F.concat(a["done"], F.array(hit)).alias("done"), F.when(found, left).otherwise(a["left"]).alias("left"))

    return F.aggregate(aliases, F.struct(F.expr(f"cast(array() as {kind})").alias("done"), padded.alias("left")), step)["done"]


def renamed_by_document(mentions: DataFrame, doc: str, order: list[str]) -> DataFrame:
    """mentions with alias `alias_{doc}_{i}`, i from 0 in the order given; documents are named by their leading number."""
    name = F.coalesce(F.nullif(F.regexp_extract(doc, r"^(\d+)", 1), F.lit("")), F.col(doc).cast("string"))
    i = F.row_number().over(Window.partitionBy(doc).orderBy(*order)) - 1
    return mentions.withColumn("alias", F.concat_ws("_", F.lit("alias"), name, i))
