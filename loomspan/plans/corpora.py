"""Queries of readers and writers by round trip, of corpus records, weak labels, recall runs and slice symbols.

Each reader's file is written from the test tables first, in the format that the reader is for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import normal as N
from loomspan.functions import registry
from loomspan.functions.text import fold_alias
from loomspan.operators import benchmarks as B
from loomspan.operators import candidates as C
from loomspan.operators import knowledge as K
from loomspan.operators import labelling as L
from loomspan.operators.symbols import EntitySymbols, SliceSymbols
from loomspan.plans.catalog import Catalog
from loomspan.plans.reference import CANDS, FOLD, KNOWN, LNRM, ONE, RANKED, cands, mentions, titles
from loomspan.scratch import Scratch
from loomspan.sources import corpora, files

CATALOG = Catalog()
query = CATALOG.query
queries = lambda: CATALOG.found
oracle_sql = lambda: CATALOG.sql


def _folder(t, name: str) -> str:
    return Scratch(t.spark, name).root


def _lines(t, name: str, df: DataFrame) -> str:
    """The path of a text file with the rows of a column as lines, or as several lines each."""
    path = _folder(t, name)
    df.write.text(path)
    return path


# dumps, pages and small files


@query("""select id, coalesce(sum(len(a)), 0)::bigint as n_claims, any_value(coalesce(cardinality(labels), 0))::bigint as n_labels from (select line_no, id, labels, unnest(case when cardinality(claims) > 0 then map_values(claims) else [null] end) as a from preprocess_dump)
    group by line_no, id union all select '(broken)', 0, 3""")
def sc03_dump(t):
    """A dump written as one JSON array with an object a line, with broken lines in it, and read again (sc01, sc02)."""
    d = t.preprocess_dump.drop("line_no", "modified")
    lines = d.select(F.concat(F.to_json(F.struct("*")), F.lit(",")).alias("value"))
    broken = t.spark.createDataFrame([("[",), ("]",), ('{"id": "Q1", ',), ("not json",), ('["Q1"',), ("",)], "value string")
    good, bad = files.dump(t.spark, _lines(t, "sc03", lines.unionByName(broken)))
    sizes = F.aggregate(F.map_values("claims"), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.size(x), F.lit(0)))
    read = good.select("id", F.coalesce(sizes, F.lit(0)).alias("n_claims"), F.coalesce(F.size("labels"), F.lit(0)).cast("long").alias("n_labels"))
    return read.unionByName(bad.agg(F.lit("(broken)").alias("id"), F.lit(0).cast("long").alias("n_claims"), F.count("*").alias("n_labels")))


@query("select doc_id::varchar as id, title, text from documents")
def sc05_pages(t):
    """Extracted pages in folders below folders, read with their HTML entities undone (sc04)."""
    path = _folder(t, "sc05")
    pages = t.documents.select(F.col("doc_id").cast("string").alias("id"), "title", N.escape(F.col("text")).alias("text"))
    for i, name in enumerate(("AA", "AB/deeper")):
        pages.where(F.col("id").cast("long") % 2 == i).write.json(f"{path}/{name}")
    return files.pages(t.spark, path)


@query("select distinct trim(title) as source, trim(wikipedia_title) as target from title_map where title <> wikipedia_title and trim(title) <> '' and trim(wikipedia_title) <> ''")
def sc07_redirects(t):
    """Redirects of an XML dump; pages without one have none."""
    pages = t.title_map.where("trim(title) != '' and trim(wikipedia_title) != ''").select(F.trim("title").alias("title"), F.trim("wikipedia_title").alias("to")).distinct()
    red = F.when(F.col("title") != F.col("to"), F.struct(F.col("to").alias("_title"), F.lit("").alias("_VALUE")))
    path = _folder(t, "sc07")
    pages.select("title", red.alias("redirect"), F.struct(F.lit("2020-01-02T03:04:05Z").alias("timestamp")).alias("revision")).write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(path)
    return files.redirects(t.spark, path).where("ts is not null").select("source", "target").distinct()


@query("select property_id as qid from property_defs union select property_id || 'x' from property_defs")
def sc09_qid_filter(t):
    """Ids from a JSON list and from the keys of a JSON object."""
    listed = t.property_defs.agg(F.to_json(F.collect_list("property_id")).alias("value"))  # a fixed, small table
    keyed = t.property_defs.agg(F.to_json(F.map_from_arrays(F.collect_list(F.concat("property_id", F.lit("x"))), F.collect_list("label"))).alias("value"))
    return files.qid_filter(t.spark, _lines(t, "sc09a", listed)).unionByName(files.qid_filter(t.spark, _lines(t, "sc09b", keyed)))


@query("select property_id as key, label as value from property_defs where label is not null")
def sk02_json_map(t):
    """A dictionary written as JSON and loaded again (sk11)."""
    path = _folder(t, "sk02")
    files.write_json_map(t.property_defs.where("label is not null"), path, "property_id", "label")
    return files.load_json_map(t.spark, path)


@query("select title as url, title, min(case when id = -1 then null else id end) as id from (select title, id from title_map where trim(title) <> '' and not regexp_matches(title, '\\s\\s')) group by title")
def sc24_title_file(t):
    """A side map of addresses, titles and page numbers."""
    m = t.title_map.where("trim(title) != '' and not title rlike '\\\\s\\\\s'").groupBy("title").agg(F.min(F.nullif("id", F.lit(-1))).alias("id"))
    path = _lines(t, "sc24", m.select(F.concat_ws("\t", "title", "title", F.coalesce("id", F.lit(-1))).alias("value")))
    return files.title_map_file(t.spark, path)


# writers


@query("select qid || '|' || coalesce(array_to_string(aliases, '~*~'), '') as value from (select qid, list_sort(list(distinct alias)) as aliases from candidate where qid is not null and alias is not null group by qid)")
def sk10_delimited(t):
    """Rows as text, arrays inside fields."""
    path = _folder(t, "sk10")
    files.write_delimited(C.invert(t.candidate.where("qid is not null and alias is not null"), "qid", "alias"), path)
    return t.spark.read.text(path)


@query("select sent_idx_unq, true as in_size from sentences where sentence is not null")
def sk04_by_size(t):
    """Sentences in files of about 64K each: all are there, and no file is over twice as large (fn16)."""
    path = _folder(t, "sk04b")
    files.write_by_size(t.sentences.where("sentence is not null").select("sent_idx_unq", "sentence"), path, "64K")
    rows = t.spark.read.schema("sent_idx_unq long, sentence string").json(path).select("sent_idx_unq", F.col("_metadata.file_size").alias("n"))
    return rows.select("sent_idx_unq", (F.col("n") <= 2 * N.byte_size("64K")).alias("in_size"))


@query("select count(*) as n, 1::bigint as n_files from property_defs")
def sk09_one_file(t):
    """A table in one file."""
    path = _folder(t, "sk09")
    files.write_one(t.property_defs, path)
    return t.spark.read.schema("property_id string").json(path).select(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n"), F.countDistinct("f").alias("n_files"))


@query("select * from (values ('k', '30'), ('name', 'run')) v(name, value)")
def sk07_run_config(t):
    """Settings of a run."""
    return files.run_config(t.spark, {"name": "run", "k": 30}).where("started_at is not null").select("name", "value")


@query(f"with {RANKED}, s as (select alias, qid, score from r where rank <= 30) select alias, qid, score, e.eid from s join (select qid, row_number() over (order by qid)::bigint as eid from (select distinct qid from s)) e using (qid)")
def sk05_saved_symbols(t):
    """Entity symbols saved and loaded."""
    path = _folder(t, "sk05")
    EntitySymbols.build(cands(t), titles(t)).save(path)
    s = EntitySymbols.load(t.spark, path)
    return s.candidates.join(s.entities, "qid").select("alias", "qid", "score", F.col("eid").cast("long").alias("eid"))


# corpora


_TWO = "select sent_idx_unq, string_split_regex(trim(sentence), '\\s+') as w from sentences where sent_idx_unq is not null and trim(sentence) <> ''"


def _iob(t, name: str, url: list, **how) -> tuple[DataFrame, DataFrame]:
    """Sentences as documents of two lines each, the second the same again; its first two words are a mention. The files
    go as soon as they have been read."""
    w = t.sentences.where("trim(sentence) != ''").select("sent_idx_unq", F.split(F.trim("sentence"), r"\s+").alias("w")).where("size(w) > 1")
    mention = F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1)))
    line = lambda x, i: F.when(i < 2, F.concat_ws("\t", x, F.when(i == 0, "B").otherwise("I"), mention, *url)).otherwise(x)
    body = F.array_join(F.transform("w", line), "\n")
    text = F.concat(F.lit("-DOCSTART- ("), F.col("sent_idx_unq"), F.lit(" X)\n"), F.array_join("w", "\n"), F.lit("\n\n"), body, F.lit("\n"))
    folder = Scratch(t.spark, name)
    w.select(text.alias("value")).write.text(folder.root)
    read = corpora.iob(t.spark, folder.root, **how)
    folder.close()
    return read


_LOWER = "case when regexp_matches(substring(x, 2, 1), '\\p{Lu}') then lower(x) else x end"


@query(f"with d as ({_TWO}) select sent_idx_unq::varchar as doc_id, array_to_string(list_transform(w, lambda x: {_LOWER}), ' ') as line, lower(w[1] || ' ' || w[2]) as alias, 0::bigint as start_, 2::bigint as end_, 'http://x/' || sent_idx_unq as url from d where len(w) > 1")
def sc12_iob(t):
    """Documents with word-level marks: the second line of each has a mention (pj13)."""
    sents, found = _iob(t, "sc12", [F.lit("x"), F.concat(F.lit("http://x/"), "sent_idx_unq")])
    both = found.where("al = 0").join(sents.select("doc_id", "sent", F.array_join("tokens", " ").alias("line")), ["doc_id", "sent"])
    return both.select("doc_id", "line", "alias", F.col("start").cast("long").alias("start_"), F.col("end").cast("long").alias("end_"), "url")


@query(f"with d as ({_TWO}) select sent_idx_unq::varchar as doc_id, lower(w[1] || ' ' || w[2]) as alias, 'Q' || sent_idx_unq as qid from d where len(w) > 1 and sent_idx_unq % 3 <> 0")
def pj15_iob_with_ids(t):
    """The variant whose mentions may be --NME-- and have the entity's id in a further column."""
    nil = F.when(F.col("sent_idx_unq") % 3 == 0, "--NME--").otherwise("u")
    _, found = _iob(t, "pj15", [nil, F.concat(F.lit("Q"), "sent_idx_unq")], skip_nil=True)
    return found.select("doc_id", "alias", "qid")


@query(f"with d as ({_TWO}), l as (select sent_idx_unq, array_to_string(list_transform(w, lambda x: {_LOWER}), ' ') as line from d where len(w) > 1) select sent_idx_unq::varchar as doc_id, line || ' [SEP] ' || line as text from l")
def pj14_title_scope(t):
    """Sentences behind their document's first one; those without a mention are dropped."""
    sents, found = _iob(t, "pj14", [F.lit("x"), F.lit("u")])
    return corpora.with_title_scope(sents, anchors=found).select("doc_id", "text")


@query(f"with d as ({_TWO}), l as (select sent_idx_unq, w, list_transform(w, lambda x: {_LOWER}) as v from d where len(w) > 1) select sent_idx_unq::varchar as doc_id, array_to_string(list_concat(v, v), ' ') as text, lower(w[1] || ' ' || w[2]) as aliases, len(w) || ':' || (len(w) + 2) as spans, 'u' as qids from l")
def pj23_document_scope(t):
    """Each document as one record, the spans moved along (pj20, pj21)."""
    whole, found = corpora.document_scope(*_iob(t, "pj23", [F.lit("x"), F.lit("u")]))
    out = corpora.records(whole.withColumn("text", F.array_join("tokens", " ")), found.drop("qid").withColumnRenamed("url", "qid"), ["doc_id", "sent"], "text")
    return out.select("doc_id", "text", *[F.array_join(c, "|").alias(c) for c in ("aliases", "spans", "qids")])


@query(f"with {ONE} select distinct coalesce(qid, 'NIL') as url from m where coalesce(qid, '') <> '' and alias is not null")
def sc25_distinct_urls(t):
    """The addresses that mentions name, each once."""
    return corpora.annotated_urls(mentions(t).where("alias is not null").select(F.col("qid").alias("url")))


_MARKED = f"select sent_idx_unq as key, sentence, alias, qid, s, e, len(list_filter(string_split_regex(substring(sentence, 1, s), '\\s+'), lambda w: w <> '')) || ':' || len(list_filter(string_split_regex(substring(sentence, 1, e), '\\s+'), lambda w: w <> '')) as span from m where pos = 0 and s is not null and e is not null and trim(alias) <> '' and trim(sentence) <> '' and sentence = trim(sentence)"


def _marked(t) -> DataFrame:
    m = mentions(t).where("pos = 0 and span_start is not null and span_end is not null and trim(alias) != '' and trim(sentence) != '' and sentence = trim(sentence)")
    return m.select(F.col("sent_idx_unq").alias("key"), "sentence", "alias", "qid", F.col("span_start").alias("s"), F.col("span_end").alias("e"), "parent_title")


@query(f"with {ONE} select key, sentence, alias, coalesce(qid, '-2') as qid, span from ({_MARKED})")
def sc14_ntriples(t):
    """Annotations in N-Triples: texts, and a mention of each with its places (pj19)."""
    at = F.concat(F.lit("<http://x.org/N3/RSS-500/"), "key", F.lit("#char="), "s", F.lit(","), "e", F.lit(">"))
    fact = lambda name, value: F.concat(at, F.lit(f" <http://n/nif#{name}> "), value, F.lit(" ."))
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    number = lambda c: F.concat(F.lit('"'), c, F.lit('"^^<http://www.w3.org/2001/XMLSchema#int>'))
    facts = F.array(fact("isString", text("sentence")), fact("anchorOf", text("alias")), fact("beginIndex", number("s")), fact("endIndex", number("e")), F.when(F.col("qid").isNotNull(), fact("taIdentRef", F.concat(F.lit("<"), "qid", F.lit(">")))))
    path = _lines(t, "sc14", _marked(t).select(F.explode(F.array_compact(facts)).alias("value")))
    rows = corpora.ntriples(t.spark, path, "http://x.org/N3/RSS-500/").withColumn("qid", F.col("taIdentRef"))
    out = corpora.annotated_sentences(rows)
    first = lambda c: F.get(c, F.lit(0))
    return out.select("key", "sentence", first("aliases").alias("alias"), first("qids").alias("qid"), first("spans").alias("span"))


@query(f"with {ONE}, k as ({_MARKED}), p as (select sent_idx_unq as key, coalesce(trim(parent_title), '') as title from sentences) select key::varchar as pmid, title, k.sentence as abstract, (length(title) + 1 + s)::integer as start_, (length(title) + 1 + e)::integer as end_, alias as text, 'T1|T2' as types from k join p using (key)")
def sc15_pubtator(t):
    """Abstracts with character-level marks."""
    k = _marked(t).withColumn("title", F.coalesce(F.trim("parent_title"), F.lit("")))
    n = F.length("title") + 1
    lines = F.concat_ws("\n", F.concat_ws("|", "key", F.lit("t"), "title"), F.concat_ws("|", "key", F.lit("a"), "sentence"), F.concat_ws("\t", "key", n + F.col("s"), n + F.col("e"), "alias", F.lit("T1,T2"), F.coalesce("qid", F.lit("-"))), F.lit(""))
    docs, marks = corpora.pubtator(t.spark, _lines(t, "sc15", k.select(lines.alias("value"))))
    return docs.join(marks, "pmid").select("pmid", F.coalesce("title", F.lit("")).alias("title"), "abstract", F.col("start").alias("start_"), F.col("end").alias("end_"), "text", F.array_join("types", "|").alias("types"))


@query(f"with {CANDS} select lower(alias) as alias_name, lower(alias) as candidate, qid as wpid, max(score) as prior from c where alias = trim(alias) and alias <> '' group by all")
def sc16_pershina(t):
    """Candidate lists of ENTITY and CANDIDATE lines; entities without a page have none (bm05)."""
    c = cands(t).where("alias = trim(alias) and alias != ''")
    one = lambda *x: F.concat_ws("\t", *x)
    listed = F.array_join(F.collect_list(one(F.lit("CANDIDATE"), F.concat(F.lit("id:"), "qid"), F.concat(F.lit("inCount:"), "score"), F.lit("url:u"), F.concat(F.lit("name:"), "alias"), F.lit("normalName:n"))), "\n")
    head = lambda url: one(F.lit("ENTITY"), F.lit("text:x"), F.lit("docId:9"), F.concat(F.lit("origText:"), "alias"), F.lit(f"url:{url}"))
    nil = F.concat_ws("\n", head("NIL"), F.lit("CANDIDATE\tid:0\tinCount:1\tname:lost"))
    lines = c.groupBy("alias").agg(listed.alias("list")).select(F.concat_ws("\n", nil, head("u"), "list").alias("value"))
    return corpora.pershina(t.spark, _lines(t, "sc16", lines)).select("alias_name", "candidate", "wpid", "prior").distinct()


@query(f"with {CANDS}, l as (select alias, qid, score, row_number() over (partition by alias order by score desc, qid)::integer as rank from c where alias = lower(alias) and alias <> '') select alias, qid as wpid, score::double as score, rank from l where rank <= 30")
def sc17_ganea(t):
    """Candidate lists of one line an alias."""
    c = cands(t).where("alias = lower(alias) and alias != ''")
    items = F.array_join(F.collect_list(F.concat_ws(",", "qid", "score", "alias")), "\t")
    lines = c.groupBy("alias").agg(items.alias("items")).select(F.concat_ws("\t", F.lit("d"), F.lit("x"), "alias", F.lit("l"), F.lit("r"), F.lit("CANDIDATES"), "items", F.lit("GT:"), F.lit("1")).alias("value"))
    return corpora.ganea(t.spark, _lines(t, "sc17", lines)).select("alias", "wpid", "score", "rank")


def _concepts(t) -> DataFrame:
    path = _folder(t, "sc18")
    C.invert(t.candidate.where("qid is not null and alias is not null"), "qid", "alias").select(F.col("qid").alias("concept_id"), F.get("aliass", F.lit(0)).alias("canonical_name"), F.col("aliass").alias("aliases"), F.array(F.substring("qid", 1, 4)).alias("types")).write.json(path)
    return corpora.concepts(t.spark, path)


@query("select qid as concept_id, min(alias) as canonical_name, count(distinct alias) as n_aliases, substring(qid, 1, 4) as type from candidate where qid is not null and alias is not null group by qid")
def sc18_concepts(t):
    """Concepts of a terminology from JSON lines."""
    return _concepts(t).select("concept_id", "canonical_name", F.size("aliases").cast("long").alias("n_aliases"), F.get("types", F.lit(0)).alias("type"))


@query("select qid as head, property_id as rela, value as tail from entity_rels where trim(property_id) <> '' and qid <> value")
def fl21_concept_relations(t):
    """Relations with a name that aren't loops."""
    return corpora.concept_relations(t.entity_rels.select(F.col("qid").alias("head"), F.col("property_id").alias("rela"), F.col("value").alias("tail")))


_CONCEPT_MENTIONS = f"k as (select sent_idx_unq::varchar as pmid, alias, qid as cid, split from m where {KNOWN} and alias is not null), ca as (select distinct qid as cid, alias from candidate where qid is not null and alias is not null)"


@query(f"""with {ONE}, {_CONCEPT_MENTIONS}, n as (select cid, count(*) as n from k group by cid),
    named as (select alias, cid, n from ca join n using (cid) union all select alias, cid, 1 from k where split = 'train'),
    x as (select {LNRM.format('alias')} as alias, 'Q' || cid as qid, n from named) select alias, qid, sum(n)::bigint as n from x where alias <> '' group by alias, qid""")
def ag22_concept_aliases(t):
    """Alias counts of concepts: their own names with every mention, what mentions call them in training documents only."""
    m = mentions(t).where(f"{KNOWN} and alias is not null").select(F.col("sent_idx_unq").cast("string").alias("pmid"), "alias", F.col("qid").alias("cid"))
    train = t.sentences.where("split = 'train'").select(F.col("sent_idx_unq").cast("string").alias("pmid"))
    return corpora.concept_alias_counts(m, _concepts(t), train)


@query(f"""with {ONE}, e as (select sent_idx_unq as doc, pos, qid, [substring(qid, 1, 3), right(qid, 1)] as types from m where {KNOWN}),
    f as (select type, min(struct_pack(doc := doc, pos := pos, i := i)) as seen from (select doc, pos, i - 1 as i, types[i] as type from (select *, unnest([1, 2]) as i from e)) group by type),
    ids as (select type, row_number() over (order by seen, type) - 1 as id from f)
    select qid, a.id || '|' || b.id as type_ids from (select distinct qid, types from e) x join ids a on a.type = types[1] join ids b on b.type = types[2]""")
def bm06_types(t):
    """Types numbered from 0 in order of first appearance, and those of each entity."""
    e = mentions(t).where(KNOWN).select(F.col("sent_idx_unq").alias("doc"), "pos", "qid", F.array(F.substring("qid", 1, 3), F.right("qid", F.lit(1))).alias("types"))
    return corpora.type_dump(e)[1].select("qid", F.array_join("type_ids", "|").alias("type_ids"))


@query("""with cur as (select id, min(wikipedia_title) as title from title_map where id <> -1 and wikipedia_title is not null and id % 3 <> 0 group by id), asked as (select distinct title, case when id % 2 = 0 then id end as id from title_map where title is not null),
    red as (select title, min(wikipedia_title) as to_ from title_map where title <> wikipedia_title and wikipedia_title in (select title from cur) group by title)
    select a.title, a.id, coalesce(c.title, s.title, r.to_) as now, case when c.title is not null then 'id' when s.title is not null then 'same' when r.to_ is not null then 'redirect' else 'deleted' end as how
    from asked a left join cur c on c.id = a.id left join (select distinct title from cur) s on s.title = a.title left join red r on r.title = a.title""")
def j20_title_refresh(t):
    """Titles of an old dump as they are now: by number, by title, by redirect, or deleted. A third of the pages is taken as
    gone and half of the numbers as lost."""
    current = t.title_map.where("id != -1 and wikipedia_title is not null and id % 3 != 0").groupBy("id").agg(F.min("wikipedia_title").alias("title"))
    asked = t.title_map.where("title is not null").select("title", F.when(F.col("id") % 2 == 0, F.col("id")).alias("id"))
    red = t.title_map.where("title != wikipedia_title").select(F.col("title").alias("source"), F.col("wikipedia_title").alias("target"))
    return corpora.refreshed_titles(asked, current, red)


@query("select sent_idx_unq, coalesce(array_to_string(flatten(list_filter(char_spans, lambda x: x is not null)), ','), '') as flat from sentences")
def fn18_flatten(t):
    """Nested arrays made flat."""
    return t.sentences.select("sent_idx_unq", F.coalesce(F.array_join(F.flatten(F.filter("char_spans", lambda x: x.isNotNull())), ","), F.lit("")).alias("flat"))


@query(f"""with {ONE}, keep as (select distinct qid from entity_rels where property_id = 'P106' and qid is not null), short as (select * from sentences where len(string_split(sentence, ' ')) <= 100), hit as (select distinct sent_idx_unq from m where qid in (select qid from keep))
    select 'keep_all' as name, count(*) as n from sentences union all select 'keep_none', 0 union all select 'short', count(*) from short union all select 'with_qids', count(*) from short where sent_idx_unq in (select * from hit)
    union all select 'with_parent', count(*) from short where parent_qid in (select qid from keep) union all select 'with_either', count(*) from short where parent_qid in (select qid from keep) or sent_idx_unq in (select * from hit)
    union all select 'with_aliases', count(*) from short where list_has_any(aliases, ['Kesruthrol', 'Drokram'])""")
def fl08_filters(t):
    """Sentences that each registered filter keeps, their side tables made by a prep function."""
    s, rels, parts = t.sentences, K.triples(t.entity_rels), []
    for name in registry.FILTERS:
        if name in ("with_qids", "with_parent", "with_either"):
            kept = registry.filtered(s, name, "qids_of_relation", rels, "P106")
        else:
            kept = registry.filtered(s, name, None, *([["Kesruthrol", "Drokram"]] if name == "with_aliases" else []))
        parts.append(kept.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("select distinct qid from (select qid from entity_rels where property_id = 'P7104' union select value from entity_rels where property_id = 'P7104') where qid is not null")
def fl08_prep_pairs(t):
    """What a prep function loads: both sides of a relation."""
    return registry.PREPS["qids_of_pairs"](K.triples(t.entity_rels), "P7104")


# recall runs, weak labels, slices


_RUN = f"{CANDS}, {ONE}, g as (select sent_idx_unq, pos::integer as pos, {FOLD.format('alias')} as alias, qid, gold from m where alias is not null and {KNOWN}), j as (select g.*, case when g.alias not in (select alias from c) then 'no_alias' when c.qid is null then 'no_candidate' else 'found' end as outcome from g left join c on c.alias = g.alias and c.qid = g.qid), kept as (select * from j where outcome = 'found' and sent_idx_unq in (select sent_idx_unq from j where outcome = 'found' and gold))"


def _run(t) -> B.RecallRun:
    return B.recall_run(mentions(t).where(f"alias is not null and {KNOWN}").select("sent_idx_unq", "pos", fold_alias("alias").alias("alias"), "qid", "gold"), cands(t))


@query(f"with {_RUN} select sent_idx_unq, pos, alias, qid from kept")
def bm04_kept(t):
    """Mentions of the sentences that a recall run keeps."""
    return _run(t).kept.select("sent_idx_unq", "pos", "alias", "qid")


@query(f"with {_RUN} select sent_idx_unq, pos, alias, qid, outcome from j where outcome <> 'found'")
def bm04_errors(t):
    """The errors of the run."""
    return _run(t).errors.select("sent_idx_unq", "pos", "alias", "qid", "outcome")


@query(f"with {_RUN} select alias, qid, score from c where alias in (select alias from kept)")
def bm04_alias_map(t):
    """The alias map that the run leaves behind."""
    return _run(t).aliases


@query(f"""with {RANKED}, {ONE}, a as (select distinct {FOLD.format('alias')} as alias from m where alias is not null) select 'standard' as name, count(*) as n, count(distinct alias)::bigint as n_aliases from a join r using (alias) where rank <= 5""")
def bm05_generators(t):
    """Candidates that a generator, chosen by name, has for the aliases of all mentions."""
    asked = mentions(t).where("alias is not null").select(fold_alias("alias").alias("alias")).distinct().withColumn("mention", F.col("alias"))
    got = B.GENERATORS["standard"](asked, cands(t), 5)
    return got.agg(F.count("*").alias("n"), F.countDistinct("mention").alias("n_aliases")).select(F.lit("standard").alias("name"), "n", "n_aliases")


@query()
def lb03_weak_labels(t):
    """Sentences with their mentions and those found by the aliases of the page's entity, aliases made more ambiguous;
    tested against a loop."""
    m = mentions(t).where("alias is not null")
    votes = L.page_votes(m.where("parent_title is not null and parent_qid is not null").select(F.col("parent_title").alias("doc"), F.col("parent_qid").alias("doc_qid"), "qid"), t.candidate.where("alias is not null and qid is not null").select("qid", "alias").distinct(), "doc", "doc_qid")
    pages = t.sentences.select(F.col("parent_title").alias("doc"), F.col("parent_qid").alias("qid")).dropna().distinct()
    own = L.pruned_votes(votes, "doc", "doc_qid").join(pages, ["doc", "qid"], "left_semi")
    longest = own.agg(F.max(F.size(F.split("alias", " ")))).first()[0] or 1
    given = m.select(F.col("sent_idx_unq").alias("sent"), F.col("span_start").alias("start"), F.col("span_end").alias("end"), fold_alias("alias").alias("alias"), "qid")
    sents = t.sentences.select(F.col("sent_idx_unq").alias("sent"), F.col("parent_title").alias("doc"), "sentence")
    return L.weak_labels(sents, given, own, C.ranked(cands(t)).select("alias", "qid", "rank"), most_words=longest + 1)


@query(f"with {ONE} select count(*) as n_sentences, (select count(*) from m where alias is not null) as n_gold, true as parallel from sentences")
def lb03_weak_label_counts(t):
    """What weak labelling must keep: every sentence, every mention given, and arrays of one length."""
    w = lb03_weak_labels(t)
    n = F.size("aliases")
    even = (F.size("unswap_aliases") == n) & (F.size("char_spans") == n) & (F.size("qids") == n) & (F.size("gold") == n) & (F.size("sources") == n)
    return w.agg(F.count("*").alias("n_sentences"), F.sum(F.size(F.filter("gold", lambda g: g))).alias("n_gold"), F.every(even).alias("parallel"))


_SLICE = f"""ty as (select *, row_number() over (partition by qid order by type)::integer as rank from (select distinct qid, value as type from entity_rels where property_id = '{{}}' and qid is not null and value is not null))"""


def _typing(t, property_id: str) -> DataFrame:
    p = t.entity_rels.where(F.col("property_id") == property_id).select("qid", F.col("value").alias("type")).dropna().distinct()
    return p.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("type")))


def _slices(t) -> SliceSymbols:
    known = t.title_map.where("qid is not null").select("qid").distinct()
    m = mentions(t).where(KNOWN)
    words = m.select("qid", F.explode(F.array_distinct(F.split("sentence", " "))).alias("word")).where("word != ''")
    e = t.entity_rels.where("qid is not null and property_id is not null and value is not null").select(F.col("qid").alias("head"), F.col("value").alias("tail"), F.col("property_id").alias("rel")).distinct()
    relations = e.join(known.withColumnRenamed("qid", "head"), "head", "left_semi").join(known.withColumnRenamed("qid", "tail"), "tail", "left_semi")
    typings = {"class": _typing(t, "P31"), "work": _typing(t, "P106"), "none": _typing(t, "P0")}
    return SliceSymbols.build(m.select("qid"), cands(t), typings, K.symmetric(K.triples(t.entity_rels), known, 50), relations, words)


@query(f"with {ONE}, {_SLICE.format('P31')}, n as (select qid, count(*) as n from m where {KNOWN} group by qid), a as (select distinct qid from title_map where qid is not null), l as (select qid, string_agg(type, '|' order by rank) as types from ty where rank <= 50 group by qid) select qid, coalesce(n, 0) as n, coalesce(types, '') as types, types is not null as in_class, qid in (select qid from entity_rels where property_id = 'P106' and value is not null and qid is not null) as in_work, false as in_none, 0 as n_unknown from a left join n using (qid) left join l using (qid)")
def es04_slice_lookups(t):
    """Per known entity its mentions, types and which typings it is in, by symbols saved and loaded (sc27, es05)."""
    path = _folder(t, "es04")
    _slices(t).save(path)
    s = SliceSymbols.load(t.spark, path, ["class", "work", "none"])
    asked = t.title_map.where("qid is not null").select("qid").distinct()
    out = s.qid_counts(asked).join(s.types(asked, "class"), "qid").join(s.is_typed(asked), "qid").join(s.types(asked, "no such typing").withColumnRenamed("types", "other"), "qid")
    return out.select("qid", "n", F.array_join("types", "|").alias("types"), "in_class", "in_work", "in_none", F.size("other").alias("n_unknown"))


@query("""with k as (select distinct qid from title_map where qid is not null), e as (select distinct qid as h, value as t, property_id as rel from entity_rels where qid in (select qid from k) and value in (select qid from k) and property_id is not null),
    p as (select distinct t as a, h as b from e), w as (select p.a, p.b, e.rel, 0 as way from p join e on e.h = p.a and e.t = p.b union all select p.a, p.b, e.rel, 1 from p join e on e.t = p.a and e.h = p.b)
    select a, b, arg_min(rel, struct_pack(way := way, rel := rel)) as rel, count(distinct rel) as n from w group by a, b""")
def es04_relations(t):
    """The relation between two entities, looked for the other way round first."""
    s = _slices(t)
    return s.relation(s.relations.select(F.col("tail").alias("a"), F.col("head").alias("b")).distinct())


@query(f"with {ONE}, {_SLICE.format('P31')}, w as (select qid, unnest(list_distinct(list_filter(string_split(sentence, ' '), lambda x: x <> ''))) as word from m where {KNOWN} and sentence is not null), n as (select type, word, count(*) as n from w join (select qid, type from ty) using (qid) group by all) select type, word, n from n qualify row_number() over (partition by type order by n desc, word desc) <= 50")
def es05_word_bags(t):
    """The words that stand in sentences with entities of a type, the 50 most frequent of each."""
    return _slices(t).bags
