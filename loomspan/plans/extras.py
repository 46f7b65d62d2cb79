"""Queries of set operations, smaller functions, readers by round trip, and benchmark records."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.functions import normal as N
from loomspan.functions.languages import ENGLISH
from loomspan.functions.text import fold_alias, key
from loomspan.operators import benchmarks as B
from loomspan.operators import candidates as C
from loomspan.operators import labelling as L
from loomspan.operators import mentions as M
from loomspan.operators import resolve as R
from loomspan.plans.catalog import Catalog
from loomspan.plans.reference import CANDS, FOLD, KNOWN, ONE, RANKED, TITLES, cands, mentions, titles
from loomspan.scratch import Scratch
from loomspan.sources import corpora, files

CATALOG = Catalog()
query = CATALOG.query
queries = lambda: CATALOG.found
oracle_sql = lambda: CATALOG.sql


@query(f"with {ONE}, a as (select alias, qid from candidate union all select alias, qid from m union all select wikidata_title, qid from title_map) select alias, qid, count(*) as n from a where alias is not null and {KNOWN} group by all")
def st01_union_sources(t):
    """Aliases of three sources, repeated ones kept."""
    m = mentions(t).select("alias", "qid")
    both = t.candidate.select("alias", "qid").unionByName(m).unionByName(t.title_map.select(F.col("wikidata_title").alias("alias"), "qid"))
    return both.where(f"alias is not null and {KNOWN}").groupBy("alias", "qid").agg(F.count("*").alias("n"))


@query(f"with {ONE} select qid from m where {KNOWN} union select qid from candidate where {KNOWN} union select qid from entity_rels where {KNOWN}")
def st02_union_distinct(t):
    q = lambda df: df.select("qid").where(KNOWN)
    return q(mentions(t)).unionByName(q(t.candidate)).unionByName(q(t.entity_rels)).distinct()


@query(f"with {ONE} select qid from m where {KNOWN} intersect select qid from entity_rels")
def st03_intersect(t):
    return mentions(t).where(KNOWN).select("qid").distinct().join(t.entity_rels.select("qid").distinct(), "qid", "left_semi")


@query(f"select qid from candidate where {KNOWN} except select qid from entity_rels where qid is not null")
def st04_except(t):
    return t.candidate.where(KNOWN).select("qid").distinct().join(t.entity_rels.where("qid is not null").select("qid").distinct(), "qid", "left_anti")


@query("select qid, value from entity_rels where property_id = 'P7104' and value is not null and qid is not null union select value, qid from entity_rels where property_id = 'P7104' and value is not null and qid is not null")
def st05_symmetric(t):
    e = t.entity_rels.where("property_id = 'P7104' and value is not null and qid is not null").select("qid", "value")
    return e.unionByName(e.select(F.col("value").alias("qid"), F.col("qid").alias("value"))).distinct()


@query(f"select qid, count(distinct {FOLD.format('alias')}) as n from candidate where alias is not null and {KNOWN} group by qid")
def ag11_alias_sets(t):
    """Distinct normalised aliases per entity."""
    return t.candidate.where(f"alias is not null and {KNOWN}").select("qid", fold_alias("alias").alias("alias")).distinct().groupBy("qid").agg(F.count("*").alias("n"))


@query("select title, qid, case when title = w then 0 when title = l then 1 else 2 end::integer as which from (select title, qid, wikipedia_title as w, wikidata_title as l from title_map where title is not null) where title = w or title = l or lower(title) = l")
def fn20_case_variants(t):
    """Titles by the spelling they match first."""
    which = F.when(F.col("title") == F.col("wikipedia_title"), 0).when(F.col("title") == F.col("wikidata_title"), 1).when(F.lower("title") == F.col("wikidata_title"), 2)
    return t.title_map.where("title is not null").select("title", "qid", which.alias("which")).where("which is not null")


@query("select distinct v as token, regexp_matches(substring(v, 2, 1), '\\p{Lu}') as is_upper from (select unnest(string_split(sentence, ' ')) as v from sentences) where v is not null")
def fn15_all_upper(t):
    """Tokens whose second character is a capital."""
    return t.sentences.select(F.explode(F.split("sentence", " ")).alias("token")).distinct().select("token", F.substring("token", 2, 1).rlike(r"\p{Lu}").alias("is_upper"))


@query("select line_no, array_to_string(list_sort(map_keys(labels)), '|') as langs, coalesce(labels['fr'].value, 'none') as fr from preprocess_dump where labels is not null")
def fn23_map_access(t):
    d = t.preprocess_dump.where("labels is not null")
    return d.select("line_no", F.array_join(F.sort_array(F.map_keys("labels")), "|").alias("langs"), F.coalesce(F.try_element_at("labels", F.lit("fr"))["value"], F.lit("none")).alias("fr"))


@query("select sent_idx_unq, array_to_string(list_sort(list_distinct(list_filter(list_concat(coalesce(aliases, []), coalesce(unswap_aliases, [])), lambda x: x is not null))), '|') as names, case when unswap_aliases[1] is null then -1 else coalesce(list_position(aliases, unswap_aliases[1]) - 1, -1) end::bigint as at from sentences")
def fn21_arrays(t):
    """Concatenation, filter and position in arrays."""
    e = F.expr("cast(array() as array<string>)")
    names = F.array_sort(F.array_distinct(F.array_compact(F.concat(F.coalesce("aliases", e), F.coalesce("unswap_aliases", e)))))
    return t.sentences.select("sent_idx_unq", F.array_join(names, "|").alias("names"), F.coalesce(F.nullif(F.array_position("aliases", F.get("unswap_aliases", F.lit(0))), F.lit(0)) - 1, F.lit(-1)).cast("long").alias("at"))


@query("select distinct title, replace(title, '_', ' ') as plain from title_map where title is not null")
def pj10_url_title(t):
    """Titles from page addresses."""
    u = F.concat(F.lit("http://en.wikipedia.org/wiki/"), F.replace("title", F.lit(" "), F.lit("_")))
    return t.title_map.select("title").dropna().distinct().select("title", N.url_title(u).alias("plain"))


@query(f"with {ONE} select sent_idx_unq, pos::integer as pos, 'alias_' || sent_idx_unq || '_' || (row_number() over (partition by sent_idx_unq order by pos) - 1) as alias from m")
def pj11_alias_rename(t):
    """Aliases renamed by their document and place (pj12)."""
    return M.renamed_by_document(mentions(t).select("sent_idx_unq", "pos", "alias"), "sent_idx_unq", ["pos"]).select("sent_idx_unq", "pos", "alias")


@query(f"with {ONE} select sent_idx_unq, pos::integer as pos, len(list_filter(string_split_regex(substring(sentence, 1, s), '\\s+'), lambda w: w <> ''))::integer as word from m where s is not null and sentence is not null")
def pj17_char_to_word(t):
    """Word offsets of mentions."""
    m = mentions(t).where("span_start is not null and sentence is not null")
    return m.select("sent_idx_unq", "pos", M.char_to_word(F.col("sentence"), F.col("span_start")).alias("word"))


@query()
def pj16_find_in_order(t):
    """Aliases found again in their sentences, word by word; tested against a loop."""
    s = t.sentences.where("sentence is not null and aliases is not null")
    return s.select("sent_idx_unq", F.posexplode(M.find_in_order(F.col("sentence"), F.array_compact("aliases"))).alias("pos", "m")).select("sent_idx_unq", "pos", "m.alias", "m.start", "m.end")


@query(f"with {TITLES}, p as (select wikipedia_title as t, min(qid) as q from title_map where {KNOWN} and wikipedia_title is not null group by 1) select b.title, coalesce(a.q, tm.qid, c.q) as qid from (select distinct title from (select unnest(titles) as title from sentences) where title is not null) b left join p a on a.t = b.title left join tm on tm.title = b.title left join p c on c.t = replace(b.title, '_', ' ')")
def j19_resolution_chain(t):
    """Titles by page, by redirect, by page without underscores: the first that is known (j20)."""
    pages = t.title_map.where(f"{KNOWN} and wikipedia_title is not null").groupBy(F.col("wikipedia_title").alias("k")).agg(F.min("qid").alias("v"))
    ask = t.sentences.select(F.explode("titles").alias("title")).where("title is not null").distinct()
    one = R.lookup_chain(ask, [F.col("title")], pages, "a")
    two = R.lookup_chain(one, [F.col("title")], titles(t).select(F.col("title").alias("k"), F.col("qid").alias("v")), "b")
    three = R.lookup_chain(two, [F.replace("title", F.lit("_"), F.lit(" "))], pages, "c")
    return three.select("title", F.coalesce("a", "b", "c").alias("qid"))


@query(f"with {RANKED} select 'alias_qids' as kind, alias, qid from r where rank <= 100 union all select 'qid_aliases', alias, qid from (select *, row_number() over (partition by qid order by score desc, alias) as k from c) where k <= 100")
def lb04_label_tables(t):
    """What weak labelling looks up, each list cut at 100."""
    tables = L.label_tables(C.ranked(cands(t)), cands(t).select("qid", "alias"))
    return tables["alias_qids"].select(F.lit("alias_qids").alias("kind"), "alias", "qid").unionByName(tables["qid_aliases"].select(F.lit("qid_aliases").alias("kind"), "alias", "qid"))


@query()
def lb05_swapped(t):
    """Sentences with their pronouns replaced by the page's title, all spans moved along; tested against a loop."""
    s = t.sentences.where("sentence is not null and parent_title is not null")
    prn = L.first_pronouns(L.pronoun_tokens(s, ["sent_idx_unq", "parent_title"], "sentence"), ["sent_idx_unq"])
    swaps = prn.select("sent_idx_unq", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.concat("parent_title", F.when(F.col("possessive"), " 's").otherwise("")).alias("name"))
    m = mentions(t).where("span_start is not null and span_end is not null").groupBy("sent_idx_unq").agg(F.sort_array(F.collect_list(F.struct(F.col("span_start").alias("start"), F.col("span_end").alias("end"), "alias"))).alias("ms"))
    out = L.swap_pronouns(s.select("sent_idx_unq", "sentence").join(m, "sent_idx_unq", "left"), swaps, "sent_idx_unq", "sentence", "ms")
    return out.select("sent_idx_unq", "sentence", F.explode_outer("ms").alias("m")).select("sent_idx_unq", "sentence", "m.*")


@query()
def bm02_contextual(t):
    """Candidates of benchmark names, or of their longest known parts, re-ranked by context: five by prior, the rest by
    score. A name without candidates has a row without qid and rank."""
    names = t.benchmark_items.where("sentence is not null").select("item_id", F.explode(N.proper_phrases(F.split("sentence", " "), ENGLISH.stop)).alias("term")).distinct()
    asked = names.select(F.concat_ws("_", fold_alias("term"), "item_id").alias("mention"), fold_alias("term").alias("alias"), "item_id").distinct()
    titled = titles(t).groupBy("qid").agg(F.min("title").alias("title"))
    prior = asked.join(B.backed_off(asked, cands(t)).withColumnRenamed("score", "prior"), "alias").join(titled, "qid", "left")
    pages = t.sentences.where("parent_qid is not null and sentence is not null").select(F.col("parent_qid").alias("qid"), "sentence")
    terms = asked.select("mention", "item_id").join(names, "item_id").select("mention", "term")
    scored = B.contextual_scores(prior.select("mention", "alias", "qid", "title", "prior"), B.context_scores(prior.select("mention", "qid").distinct(), pages, terms))
    ranked = B.merged_ranking(scored.select("mention", "qid", "prior"), scored.select("mention", "qid", "context"), "mention", 10)
    return asked.select("mention").join(ranked, "mention", "left")


_STARTS = "b as (select min(doc_id) + (7 * (max(doc_id) - min(doc_id))) // 10 as a, min(doc_id) + (9 * (max(doc_id) - min(doc_id))) // 10 as b from documents)"


def _by_start(t):
    low, high = t.documents.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = low or 0, high or 0
    return B.split_by_start(t.documents.select("doc_id"), "doc_id", {"train": low, "testa": low + 7 * (high - low) // 10, "testb": low + 9 * (high - low) // 10})


@query(f"with {_STARTS} select doc_id, case when doc_id >= b then 'testb' when doc_id >= a then 'testa' else 'train' end as split from documents, b")
def bm08_split_by_start(t):
    """A fixed split by document number: seven tenths, two and one."""
    return _by_start(t)


@query(f"with {_STARTS}, s as (select case when doc_id >= b then 'testb' when doc_id >= a then 'testa' else 'train' end as split from documents, b), n as (select split, count(*) as n from s group by split) select split, n, n = (case split when 'train' then n else 0 end) as is_expected from n")
def bm08_split_counts(t):
    """Documents of each split against the counts that they must have: right for train, wrong ones for the others."""
    train = _by_start(t).where("split = 'train'").count()
    return B.split_counts(_by_start(t), {"train": train, "testa": 0, "testb": 0})


@query("with l as (select doc_id % 7 as pmid, case when doc_id % 7 < 2 then 'dev' when doc_id % 7 = 2 then 'test' end as split from documents group by all) select doc_id, l.split from documents d left join l on l.pmid = d.doc_id % 7")
def bm07_split_by_list(t):
    """Documents with the split that lists of numbers name; null for those in none."""
    lists = t.spark.createDataFrame([("0", "dev"), ("1", "dev"), ("2", "test"), ("2", "test")], "pmid string, split string")
    return corpora.split_by_list(t.documents.select("doc_id", (F.col("doc_id") % 7).cast("string").alias("pmid")), lists).select("doc_id", "split")


# readers and writers by round trip


def _folder(t, name: str) -> str:
    return Scratch(t.spark, name).root


@query("select distinct upper(trim(qid)) as head, upper(trim(property_id)) as rel, value as tail from entity_rels where trim(qid) <> '' and trim(property_id) <> '' and value is not null")
def sc10_space_triples(t):
    """Triples written and read again as text with blanks between, whatever stands in the value (sc11)."""
    path = _folder(t, "sc10")
    e = t.entity_rels.select(key("qid").alias("head"), key("property_id").alias("rel"), "value").dropna()
    e.select(F.concat_ws(" ", "head", "rel", "value")).distinct().write.text(path)
    return files.space_triples(t.spark, path)


@query("select wikipedia_title as title, max(id) as id from title_map where wikipedia_title is not null group by 1")
def sc08_page_ids(t):
    return files.page_ids(t.title_map.select(F.col("wikipedia_title").alias("title"), "id"))


@query("select distinct qid, id, title, wikidata_title, wikipedia_title from title_map")
def sc22_distinct_title_rows(t):
    """Title rows by way of JSON lines, each once (sc06)."""
    from loomspan.schemas import TITLE_ROW

    path = _folder(t, "sc22")
    t.title_map.select("qid", "id", "title", "wikidata_title", "wikipedia_title").write.json(path)
    good, _ = files.json_lines(t.spark, path, TITLE_ROW)
    return good.distinct()


@query("select sent_idx_unq as old_idx, row_number() over (order by sent_idx_unq) - 1 as sent_idx_unq from sentences")
def sc26_numbered(t):
    """Rows numbered in order."""
    rows = t.sentences.select(F.col("sent_idx_unq").alias("old_idx"))
    return files.numbered_sentences(rows, "old_idx").select("old_idx", F.col("sent_idx_unq").cast("long").alias("sent_idx_unq"))


@query("select sent_idx_unq, sentence, aliases[1] as first_alias from sentences where sentence is not null")
def sk04_rolled_files(t):
    """Sentences written in files of at most 1000 rows and read again (sk01, sk08, sk09)."""
    path = _folder(t, "sk04")
    files.write_rolled(t.sentences.where("sentence is not null").select("sent_idx_unq", "sentence", F.get("aliases", F.lit(0)).alias("first_alias")), path, 1000)
    return t.spark.read.schema("sent_idx_unq long, sentence string, first_alias string").json(path)


@query("select qid, arg_max_null(parent_title, sent_idx_unq) as parent_title from (select parent_qid as qid, parent_title, sent_idx_unq from sentences where parent_qid is not null) group by qid")
def sc23_latest(t):
    """The last title of each page (sc24)."""
    s = t.sentences.where("parent_qid is not null").select(F.col("parent_qid").alias("qid"), "parent_title", "sent_idx_unq")
    return files.latest(s, "qid", "sent_idx_unq").select("qid", "parent_title")
