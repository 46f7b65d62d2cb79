"""Readers of entity-linking corpora into one shape: documents, sentences and mentions with word or character spans.

IOB files are read block by block, and what is counted in each block is moved on by the blocks before it. The readers of
candidate lists read whole files, one document group a file, and number the lines inside; boundaries are found with
running counts over that order, so a file is never walked by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.scratch import Scratch


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, line) of text files, numbered within each file."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("n", "line"))
    return whole


def _running(mark: Column, by: list[str], name: str = "n") -> Column:
    return F.sum(F.when(mark, 1).otherwise(0)).over(Window.partitionBy(*by).orderBy(name))


def _token(t: Column) -> Column:
    """Tokens in capitals, by their second character, in lower case."""
    return F.when(F.substring(t, 2, 1).rlike(r"\p{Lu}"), F.lower(t)).otherwise(t)


_PIECES = "file string, block long, at long, docs long, sents long, number string, whole boolean, lines array<string>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, block, line, start, mark, number) in order to pieces of sentences: the lines between two marks, cut also
    where a batch or a block ends. docs, sents and number are counted and carried within the block."""
    chunk, at, docs, sents, number = None, 0, 0, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes, blocks = batch["file"].dictionary_encode().indices.to_numpy(), batch["block"].to_numpy()
        edges = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for low, high in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            t = batch.slice(low, high - low)
            if (here := (t["file"][0].as_py(), t["block"][0].as_py())) != chunk:
                chunk, at, docs, sents, number = here, 0, 0, 0, None
            start, mark = (t[c].to_numpy(zero_copy_only=False) for c in ("start", "mark"))
            opens = mark.copy()
            opens[0] = True
            first = np.flatnonzero(opens)
            head = np.maximum.accumulate(np.where(start, np.arange(len(start)), -1))
            numbers = t["number"].take(pa.array(head[first], mask=head[first] < 0))
            if number is not None:
                numbers = numbers.fill_null(number)
            bounds = np.append(np.cumsum(~mark) - ~mark, np.sum(~mark))[[*first, len(mark)]].astype(np.int32)
            lines = pa.ListArray.from_arrays(pa.array(bounds), t["line"].filter(pa.array(~mark)))
            whole = mark[first]
            whole[-1] = False  # it may go on
            n = len(first)
            yield pa.RecordBatch.from_arrays(
                [t["file"].take(pa.array(first)), t["block"].take(pa.array(first)), pa.array(at + first), pa.array(docs + np.cumsum(start)[first]), pa.array(sents + np.cumsum(mark)[first]), numbers, pa.array(whole), lines],
                names=["file", "block", "at", "docs", "sents", "number", "whole", "lines"],
            )
            at, docs, sents, number = at + len(mark), docs + int(start.sum()), sents + int(mark.sum()), numbers[n - 1].as_py()


def _sentences(spark: SparkSession, path: str) -> DataFrame:
    """(file, doc_id, sent, lines) of IOB files, read in blocks as Spark splits them, never a file at once; sent is numbered
    in the file, by its marks: blank lines and beginnings of documents.

    Only sentences cut by the end of a block or batch are shuffled. The pieces are saved, so that all that is read from
    them sees the same blocks; a row per block, with the counts before it, is broadcast."""
    value = F.col("value")
    line = F.when(value.endswith("\r"), F.substring(value, F.lit(1), F.length(value) - 1)).otherwise(value)
    rows = spark.read.text(path, lineSep="\n").select(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), line.alias("line"))
    start = F.col("line").startswith("-DOCSTART-")
    rows = rows.select("file", "block", "line", start.alias("start"), (start | (F.trim("line") == "")).alias("mark"), F.when(start, F.regexp_extract("line", r"\((\d+)", 1)).alias("number"))
    pieces = Scratch(spark, "iob").save(rows.mapInArrow(_cut, _PIECES))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("file", "block").agg(F.max("docs").alias("docs"), F.max("sents").alias("sents"), F.max_by("number", "at").alias("number"))
    count = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
    blocks = blocks.select("file", "block", count("docs"), count("sents"), F.last("number", ignorenulls=True).over(before).alias("number_before"))
    placed = pieces.where(F.size("lines") > 0).join(F.broadcast(blocks), ["file", "block"])
    doc, number = (F.col("docs") + F.col("docs_before")).cast("string"), F.coalesce("number", "number_before")
    doc_id = F.when(number.isNull(), F.col("file")).when(number == "", doc).otherwise(number)
    placed = placed.select("file", doc_id.alias("doc_id"), (F.col("sents") + F.col("sents_before")).alias("sent"), "whole", "block", "at", "lines")
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "lines"))), lambda x: x["lines"]))
    cut = placed.where(~F.col("whole")).groupBy("file", "doc_id", "sent").agg(joined.alias("lines"))
    return placed.where("whole").select("file", "doc_id", "sent", "lines").unionByName(cut)


def iob(spark: SparkSession, path: str, url_column: int = 4, skip_nil: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sentences, mentions) of IOB files: -DOCSTART- lines begin documents, blank lines end sentences.

    sentences: (doc_id, sent, tokens). mentions: (doc_id, sent, alias, start, end, url, al, qid), spans in words, al
    numbered within the document. A B line that has the URL column opens a mention and I lines that follow belong to it.
    skip_nil: the URL stands one column before, --NME-- mentions are left out, and a column behind it, where there is
    one, holds the entity's id, which beats the URL; else qid is null. The files are read at once, into a scratch table.
    """
    body = _sentences(spark, path)
    sents = body.select("doc_id", "sent", F.transform("lines", lambda x: _token(F.substring_index(x, "\t", 1))).alias("tokens"))
    least = url_column - 1 if skip_nil else url_column
    words = F.transform("lines", lambda x, i: F.struct(i.alias("w"), F.split(x, "\t").alias("c")))
    tagged = body.select("doc_id", "sent", F.filter(words, lambda x: F.size(x["c"]) > least).alias("tagged"))
    opens = F.filter(F.transform("tagged", lambda x, i: F.struct(i.alias("i"), x["w"].alias("w"), x["c"].alias("c"))), lambda x: F.get(x["c"], F.lit(1)) == "B")
    end = lambda m: F.get("tagged", F.coalesce(F.get("opens", m + 1)["i"], F.size("tagged")) - 1)["w"] + 1
    spans = F.transform("opens", lambda x, m: F.struct(m.alias("m"), x["w"].alias("start"), end(m).alias("end"), x["c"].alias("c")))
    found = tagged.withColumn("opens", opens).select("doc_id", "sent", F.explode(spans).alias("x")).select("doc_id", "sent", "x.m", "x.start", "x.end", F.get("x.c", F.lit(2)).alias("alias"), F.get("x.c", F.lit(least)).alias("url"), (F.get("x.c", F.lit(url_column)) if skip_nil else F.lit(None).cast("string")).alias("qid"))
    if skip_nil:
        found = found.where(~F.col("url").startswith("--NME--"))
    al = F.row_number().over(Window.partitionBy("doc_id").orderBy("sent", "m")) - 1
    return sents, found.select("doc_id", "sent", F.lower("alias").alias("alias"), "start", "end", "url", al.alias("al"), F.nullif("qid", F.lit("")).alias("qid"))


def with_title_scope(sents: DataFrame, first: int = 1, delimiter: str = "[SEP]", anchors: DataFrame | None = None) -> DataFrame:
    """(doc_id, sent, text): each sentence after the document's first ones and a delimiter; the first ones as they are.
    anchors: (doc_id, sent) of mentions; sentences without any have no row, though they still scope others."""
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("sent"))
    numbered = sents.select("doc_id", "sent", F.array_join("tokens", " ").alias("line")).withColumn("n", n)
    head = numbered.where(F.col("n") <= first).groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), " ").alias("head"))
    out = numbered.join(head, "doc_id")
    if anchors is not None:
        out = out.join(anchors.select("doc_id", "sent").distinct(), ["doc_id", "sent"], "left_semi")
    return out.select("doc_id", "sent", F.when(F.col("n") <= first, F.col("line")).otherwise(F.concat_ws(f" {delimiter} ", "head", "line")).alias("text"))


def document_scope(sents: DataFrame, mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sentences (doc_id, sent, tokens) and mentions (doc_id, sent, start, end, ...) with each document as one sentence 0,
    the spans moved along."""
    before = F.sum("_n").over(Window.partitionBy("doc_id").orderBy("sent")) - F.col("_n")
    placed = sents.select("doc_id", "sent", F.size("tokens").alias("_n")).select("doc_id", "sent", before.alias("_before"))
    whole = sents.groupBy("doc_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("sent", "tokens"))), lambda x: x["tokens"])).alias("tokens"))
    moved = mentions.join(placed, ["doc_id", "sent"]).withColumn("start", (F.col("start") + F.col("_before")).cast("int")).withColumn("end", (F.col("end") + F.col("_before")).cast("int"))
    return whole.select("doc_id", F.lit(0).cast("long").alias("sent"), "tokens"), moved.withColumn("sent", F.lit(0).cast("long")).drop("_before")


def records(sents: DataFrame, mentions: DataFrame, key: list[str], text: str = "sentence") -> DataFrame:
    """key, text, aliases, qids, spans ("start:end"), gold, sent_idx: a record per sentence with mentions, in parallel arrays
    by place; gold is true where mentions have no such column. sent_idx is dense text from 0 in order of key."""
    from loomspan.operators.knowledge import dense_ids

    gold = F.col("gold") if "gold" in mentions.columns else F.lit(True)
    packed = mentions.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("start", "end", "alias", "qid", gold.alias("gold")))).alias("m"))
    at = lambda f: F.transform("m", lambda x: x[f])
    out = sents.select(*key, text).join(packed, key).select(*key, text, at("alias").alias("aliases"), at("qid").alias("qids"), F.transform("m", lambda x: F.concat_ws(":", x["start"], x["end"])).alias("spans"), at("gold").alias("gold"))
    return dense_ids(out, [F.col(k) for k in key], 0, "sent_idx").withColumn("sent_idx", F.col("sent_idx").cast("string"))


def referenced_lines(lines: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts as lines (file, n, line) and references (file, alias, offset, qid) to (sentences (file, n, sentence), mentions
    (file, n, alias, start, end, qid)), spans in words.

    Punctuation is blanked. A reference belongs to the line in which its character offset falls, the lengths of all lines
    added up, and is looked for there in order; those that aren't found, or have no qid, are left out, as are blank lines."""
    from loomspan.operators.mentions import find_in_order

    end = F.sum(F.length("line")).over(Window.partitionBy("file").orderBy("n"))
    placed = lines.where("line is not null").withColumn("to", end).withColumn("from", F.col("to") - F.length("line"))
    plain = F.trim(F.regexp_replace(F.regexp_replace("line", r"\p{Punct}", " "), r"\s+", " "))
    kept = placed.where(F.trim("line") != "").select("file", "n", "from", "to", plain.alias("sentence"))
    met = references.where("alias is not null").join(kept, "file").where("offset >= from and offset < to")
    lists = met.groupBy("file", "n", "sentence").agg(F.sort_array(F.collect_list(F.struct("offset", "alias", "qid"))).alias("r"))
    found = lists.select("file", "n", F.arrays_zip(find_in_order(F.col("sentence"), F.transform("r", lambda x: x["alias"])).alias("f"), F.col("r").alias("r")).alias("z"))
    marks = found.select("file", "n", F.explode("z").alias("z")).select("file", "n", F.lower("z.f.alias").alias("alias"), F.col("z.f.start").alias("start"), F.col("z.f.end").alias("end"), "z.r.qid")
    return kept.select("file", "n", "sentence"), marks.where("start is not null and qid is not null")


def annotated_urls(mentions: DataFrame) -> DataFrame:
    """(url): the distinct addresses that mentions name, NIL marks and blanks left out."""
    return mentions.select(F.trim("url").alias("url")).where("url is not null and url != '' and not startswith(url, '--')").distinct()


def refreshed_titles(asked: DataFrame, current: DataFrame, redirects: DataFrame) -> DataFrame:
    """(title, id, now, how): what a page of an old dump is called now. asked: (title, id), current: (id, title), redirects:
    (source, target). `id`: by the page's number; else `same`: a page of that title; else `redirect`, if its target is a
    page; else `deleted`, now is null."""
    by_id = current.where("id is not null and title is not null").groupBy("id").agg(F.min("title").alias("_by_id"))
    titles = current.where("title is not null").select("title").distinct()
    red = redirects.join(titles.withColumnRenamed("title", "target"), "target", "left_semi").groupBy(F.col("source").alias("title")).agg(F.min("target").alias("_target"))
    out = asked.select("title", "id").distinct().join(by_id, "id", "left").join(titles.withColumn("_same", F.col("title")), "title", "left").join(red, "title", "left")
    how = F.when(F.col("_by_id").isNotNull(), "id").when(F.col("_same").isNotNull(), "same").when(F.col("_target").isNotNull(), "redirect").otherwise("deleted")
    return out.select("title", "id", F.coalesce("_by_id", "_same", "_target").alias("now"), how.alias("how"))


def type_dump(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities (doc, pos, qid, types) to (types (type, type_id from 0 in order of first appearance), entity types (qid,
    type_ids) as the last mention of each entity has them)."""
    from loomspan.operators.knowledge import dense_ids

    each = entities.select("doc", "pos", "qid", F.posexplode("types").alias("i", "type")).where("type is not null")
    first = each.groupBy("type").agg(F.min(F.struct("doc", "pos", "i")).alias("at"))
    ids = dense_ids(first, [F.col("at"), F.col("type")], 0, "type_id").select("type", F.col("type_id").cast("long").alias("type_id"))
    last = entities.groupBy("qid").agg(F.max_by("types", F.struct("doc", "pos")).alias("types"))
    listed = last.select("qid", F.posexplode_outer("types").alias("i", "type")).join(ids, "type", "left")
    packed = listed.groupBy("qid").agg(F.transform(F.sort_array(F.collect_list(F.when(F.col("type_id").isNotNull(), F.struct("i", "type_id")))), lambda x: x["type_id"]).alias("type_ids"))
    return ids, packed


def concept_alias_counts(mentions: DataFrame, concepts_: DataFrame, train: DataFrame) -> DataFrame:
    """(alias, qid, n): how often each alias names a concept: once per mention of the concept for each of the concept's own
    aliases, and once per mention, in the documents of train (pmid) only, for what it is called there. mentions: (pmid,
    alias, cid), concepts: (concept_id, aliases). Aliases in normal form; blank ones don't count."""
    from loomspan.functions.normal import lnrm

    qid = F.concat(F.lit("Q"), F.trim("cid")).alias("qid")
    m = mentions.where("cid is not null").withColumn("cid", F.trim("cid"))
    times = m.groupBy("cid").agg(F.count("*").alias("n"))
    own = times.join(concepts_.select(F.col("concept_id").alias("cid"), F.explode("aliases").alias("alias")), "cid").select("alias", qid, "n")
    called = m.join(train.select("pmid").distinct(), "pmid", "left_semi").groupBy("alias", qid).agg(F.count("*").alias("n"))
    both = own.unionByName(called).where("alias is not null").groupBy("alias", "qid").agg(F.sum("n").alias("n"))
    return both.select(lnrm("alias").alias("alias"), "qid", "n").where("alias != ''").groupBy("alias", "qid").agg(F.sum("n").alias("n"))


def ntriples(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """(key, range, anchorOf, beginIndex, endIndex, isString, taIdentRef): annotations in N-Triples, a row per character
    range of each text whose subject begins with prefix."""
    rows = spark.read.text(path).select(F.regexp_extract("value", r"^<([^>]*)>\s+<([^>]*)>\s+(.*?)\s*\.\s*$", 1).alias("s"), F.regexp_extract("value", r"^<([^>]*)>\s+<([^>]*)>\s+(.*?)\s*\.\s*$", 2).alias("p"), F.regexp_extract("value", r"^<([^>]*)>\s+<([^>]*)>\s+(.*?)\s*\.\s*$", 3).alias("o"))
    rows = rows.where(F.col("s").startswith(prefix))
    text = F.coalesce(F.nullif(F.regexp_extract("o", r'^"(.*)"(?:\^\^<[^>]*>|@\S+)?$', 1), F.lit("")), F.regexp_extract("o", r"^<(.*)>$", 1))
    rows = rows.select(F.regexp_extract("s", r"/(\d+)#", 1).cast("long").alias("key"), F.regexp_extract("s", r"#char=(.*)$", 1).alias("range"), F.regexp_extract("p", r"#(.*)$", 1).alias("part"), text.alias("v"))
    return rows.groupBy("key", "range").pivot("part", ["anchorOf", "beginIndex", "endIndex", "isString", "taIdentRef"]).agg(F.min("v"))


def annotated_sentences(annotations: DataFrame, keep_unlinked: bool = True, unlinked: str = "-2") -> DataFrame:
    """(key, sentence, aliases, qids, spans): the annotations (with a `qid`, null if unlinked) gathered per text, in order
    of place; spans in words, "s:e". Texts of only unlinked mentions are dropped if those aren't kept."""
    texts = annotations.where("isString is not null").groupBy("key").agg(F.min("isString").alias("sentence"))
    marks = annotations.where("anchorOf is not null").join(texts, "key")
    word = lambda i: F.size(F.filter(F.split(F.substring(F.col("sentence"), F.lit(1), i), r"\s+"), lambda w: w != ""))
    s, e = F.col("beginIndex").try_cast("int"), F.col("endIndex").try_cast("int")
    marks = marks.withColumn("s", s).withColumn("e", e).withColumn("qid", F.coalesce("qid", F.lit(unlinked)))
    if not keep_unlinked:
        marks = marks.where(F.col("qid") != unlinked)
    marks = marks.withColumn("span", F.concat_ws(":", word(F.col("s")), word(F.col("e"))))
    packed = marks.groupBy("key", "sentence").agg(F.sort_array(F.collect_list(F.struct("s", "e", "anchorOf", "qid", "span"))).alias("m"))
    at = lambda f: F.transform("m", lambda x: x[f])
    return packed.select("key", "sentence", at("anchorOf").alias("aliases"), at("qid").alias("qids"), at("span").alias("spans"))


def pubtator(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents (pmid, title, abstract), mentions (pmid, start, end, text, types, cid)) of PubTator files, gz or not."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).where("line != ''")
    part = F.regexp_extract("line", r"^(\d+)\|([ta])\|(.*)$", 2)
    texts = lines.where(part != "").select(F.regexp_extract("line", r"^(\d+)\|", 1).alias("pmid"), part.alias("part"), F.trim(F.regexp_extract("line", r"^\d+\|[ta]\|(.*)$", 1)).alias("text"))
    documents = texts.groupBy("pmid").agg(F.min(F.when(F.col("part") == "t", F.col("text"))).alias("title"), F.min(F.when(F.col("part") == "a", F.col("text"))).alias("abstract"))
    c = F.split("line", "\t")
    mentions = lines.where((part == "") & (F.size(c) == 6)).select(
        F.get(c, F.lit(0)).alias("pmid"), F.get(c, F.lit(1)).try_cast("int").alias("start"), F.get(c, F.lit(2)).try_cast("int").alias("end"), F.get(c, F.lit(3)).alias("text"), F.split(F.get(c, F.lit(4)), ",").alias("types"), F.get(c, F.lit(5)).alias("cid")
    )
    return documents, mentions


def word_aligned(documents: DataFrame, mentions: DataFrame) -> DataFrame:
    """(pmid, text, start, end): character spans of title and abstract as word spans; those that don't begin and end with
    words are left out."""
    from loomspan.functions.normal import word_spans

    text = documents.select("pmid", F.concat_ws(" ", "title", "abstract").alias("t"))
    words = text.select("pmid", F.posexplode(word_spans(F.col("t"))).alias("i", "w")).select("pmid", "i", F.col("w.start").alias("ws"), F.col("w.end").alias("we"))
    first = words.select("pmid", F.col("ws").alias("start"), F.col("i").alias("from"))
    last = words.select("pmid", F.col("we").alias("end"), (F.col("i") + 1).alias("to"))
    return mentions.join(first, ["pmid", "start"]).join(last, ["pmid", "end"]).select("pmid", "text", F.col("from").alias("start"), F.col("to").alias("end"))


def split_by_list(documents: DataFrame, lists: DataFrame, key: str = "pmid") -> DataFrame:
    """documents with the split that lists (key, split) names."""
    return documents.join(lists.select(key, "split").distinct(), key, "left")


def pershina(spark: SparkSession, path: str) -> DataFrame:
    """(alias, alias_name, candidate, wpid, prior): candidate lists of ENTITY and CANDIDATE lines; entities without a page
    (NIL) have none. Repeated candidates keep their greatest prior."""
    rows = _lines(spark, path).where("line != ''").withColumn("is_e", F.col("line").startswith("ENTITY"))
    field = lambda name: F.regexp_extract("line", rf"\t{name}:([^\t]*)", 1)
    rows = rows.withColumn("m", _running(F.col("is_e"), ["file"]))
    heads = rows.where("is_e").select("file", "m", F.lower(field("docId")).alias("doc"), F.lower(field("origText")).alias("alias_name"), field("url").alias("url")).where("url != 'NIL'")
    al = F.row_number().over(Window.partitionBy("file").orderBy("m")) - 1
    heads = heads.withColumn("alias", F.concat_ws("_", F.lit("alias"), "doc", al))
    cand = rows.where(F.col("line").startswith("CANDIDATE")).select("file", "m", F.lower(field("name")).alias("candidate"), field("id").alias("wpid"), field("inCount").try_cast("long").alias("prior"))
    return heads.join(cand, ["file", "m"]).groupBy("alias", "alias_name", "candidate", "wpid").agg(F.max("prior").alias("prior"))


def ganea(spark: SparkSession, path: str, k: int = 30) -> DataFrame:
    """(alias, wpid, title, score, rank): candidate lists of TSV lines `.. alias .. CANDIDATES id,score,title .. GT: ..`;
    of several lines of an alias the last."""
    rows = _lines(spark, path).where("line != ''").withColumn("c", F.split("line", "\t"))
    last = rows.select(F.lower(F.get("c", F.lit(2))).alias("alias"), F.struct("file", "n").alias("at"), F.slice("c", 7, F.size("c") - 8).alias("items")).groupBy("alias").agg(F.max_by("items", "at").alias("items"))
    one = last.select("alias", F.explode("items").alias("i")).select("alias", F.substring_index("i", ",", 1).alias("wpid"), F.get(F.split("i", ","), F.lit(1)).try_cast("double").alias("score"), F.regexp_extract("i", "^[^,]*,[^,]*,(.*)$", 1).alias("title"))
    w = Window.partitionBy("alias").orderBy(F.desc("score"), "wpid")
    return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def msnbc_references(spark: SparkSession, path: str) -> DataFrame:
    """(file, alias, offset, url) of the reference XML files."""
    schema = "SurfaceForm string, Offset int, Length int, ChosenAnnotation string"
    rows = spark.read.format("xml").option("rowTag", "ReferenceInstance").schema(schema).load(path)
    return rows.select(F.input_file_name().alias("file"), F.trim("SurfaceForm").alias("alias"), F.col("Offset").alias("offset"), F.trim("ChosenAnnotation").alias("url"))


def concepts(spark: SparkSession, path: str) -> DataFrame:
    """(concept_id, canonical_name, aliases, types) of concept JSON lines."""
    return spark.read.schema("concept_id string, canonical_name string, aliases array<string>, types array<string>").json(path)


def concept_relations(rows: DataFrame) -> DataFrame:
    """Relations (head, rela, tail) that have a name and aren't loops."""
    return rows.where("rela is not null and trim(rela) != '' and head != tail")
