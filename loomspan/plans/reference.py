"""Queries of the entity-linking operators: titles, aliases, candidates, filters, joins, counts and ranks.

Names begin with the id of the operator they exercise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions import normal as N
from loomspan.functions.text import fold_alias
from loomspan.operators import candidates as C
from loomspan.operators import mentions as M
from loomspan.operators import resolve as R
from loomspan.plans.catalog import Catalog

CATALOG = Catalog()
query = CATALOG.query
queries = lambda: CATALOG.found
oracle_sql = lambda: CATALOG.sql

FOLD = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"
LNRM = "trim(regexp_replace(regexp_replace(strip_accents(lower({})), '[^\\p{{L}}\\p{{N}} ]', '', 'g'), ' +', ' ', 'g'))"
#: HTML entities, and how SQL undoes them.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&"))


def _unescaped(c: str) -> str:
    for name, plain in ENTITIES:
        c = f"replace({c}, '{name}', '{plain}')"
    return c


#: A row per mention.
ONE = f"""m as (
  select sent_idx_unq, parent_qid, parent_title, sentence, split, source, i - 1 as pos, aliases[i] as alias, titles[i] as title, qids[i] as qid, char_spans[i][1] as s, char_spans[i][2] as e,
    coalesce(gold[i], true) as gold, coalesce(sources[i], 'gold') as mention_source, coalesce(unswap_aliases[i], aliases[i]) as unswap_alias
  from (select *, unnest(range(1, len(aliases) + 1)) as i from sentences))"""
#: (title, qid), a page's own title before a redirect, the smallest id of several.
TITLES = """tm as (
  select title, qid from (
    select wikipedia_title as title, qid, 0 as p from title_map union all select title, qid, 1 from title_map)
  where qid is not null and qid <> '-1' and title is not null qualify row_number() over (partition by title order by p, qid) = 1)"""
#: One row per (alias, qid), the highest score.
CANDS = "c as (select alias, qid, max(coalesce(score, 0)) as score from candidate where alias is not null and qid is not null group by alias, qid)"
RANKED = CANDS + ", r as (select *, row_number() over (partition by alias order by score desc, qid desc) as rank from c)"
KNOWN = "qid is not null and qid <> '-1'"


def mentions(t) -> DataFrame:
    return M.exploded(t.sentences, ["sent_idx_unq", "parent_qid", "parent_title", "sentence", "split", "source"])


def titles(t) -> DataFrame:
    return R.resolution_map(t.title_map)


def cands(t) -> DataFrame:
    return C.deduplicated(t.candidate)


# scalar functions


@query(f"select distinct v as alias, {LNRM.format('v')} as lnrm from (select unnest(aliases) as v from sentences) where v is not null")
def fn01_lnrm(t):
    """The normal form of every distinct alias."""
    return t.sentences.select(F.explode("aliases").alias("alias")).where("alias is not null").distinct().select("alias", N.lnrm("alias").alias("lnrm"))


@query("select sent_idx_unq, len(string_split_regex(trim(sentence), '\\s+')) as n_words, list_sum(list_transform(string_split_regex(trim(sentence), '\\s+'), lambda w: length(w)))::bigint as n_letters from sentences where trim(sentence) <> ''")
def fn03_word_offsets(t):
    """Words with their offsets; each lies where its offsets say."""
    w = t.sentences.where("trim(sentence) != ''").select("sent_idx_unq", N.word_spans(F.col("sentence")).alias("w"))
    return w.select("sent_idx_unq", F.size("w").cast("long").alias("n_words"), F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]).alias("n_letters"))


@query("select gram, count(*) as n from (select array_to_string(w[i : i + 1], ' ') as gram from (select w, unnest(range(1, len(w))) as i from (select string_split(sentence, ' ') as w from sentences where sentence is not null))) group by gram")
def fn04_ngrams(t):
    """Word bigrams of all sentences, counted."""
    return t.sentences.select(F.explode(N.ngrams(F.split("sentence", " "), 2)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


@query(f"""with t as (select distinct v as title from (select unnest(titles) as v from sentences) where v is not null)
    select form, title, trim(split_part(case form when 'plain' then {_unescaped("url_decode(replace(title, '+', '%2B'))")} else title end, '#', 1)) as link_title from t cross join (select unnest(['plain', 'percent', 'entities', 'both']) as form)""")
def fn07_link_title(t):
    """Titles as links name them, decoded and cut at #: as they stand, percent-encoded, with HTML entities for every `e`,
    and both."""
    title = F.col("title")
    percent = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    entities = F.replace(F.replace(N.escape(title), F.lit("e"), F.lit("&#101;")), F.lit("é"), F.lit("&eacute;"))
    forms = {"plain": title, "percent": percent(title), "entities": entities, "both": percent(entities)}
    rows = t.sentences.select(F.explode("titles").alias("title")).where("title is not null").distinct()
    each = rows.select("title", F.explode(F.array(*[F.struct(F.lit(k).alias("form"), c.alias("href")) for k, c in forms.items()])).alias("f"))
    return each.select("f.form", "title", N.link_title("f.href").alias("link_title"))


@query("""with k as (select distinct parent_qid, parent_title, '(''' || parent_qid || ''', ' || case when contains(parent_title, '''') and not contains(parent_title, '"') then '"' || parent_title || '"' else '''' || replace(parent_title, '''', '\\''') || '''' end || ')' as key
      from sentences where parent_qid is not null and parent_title is not null)
    select parent_qid, parent_title, ((76 * list_sum(list_transform(range(0, 7), lambda i: ('0x' || substr(sha1(key), 5 * i + 1, 5))::bigint)) + ('0x' || substr(sha1(key), 36, 5))::bigint) % 100)::integer as bucket from k""")
def fn09_hash_bucket(t):
    """The SHA-1 bucket of each page."""
    pages = t.sentences.select("parent_qid", "parent_title").dropna().distinct()
    return pages.withColumn("bucket", N.sha1_bucket(N.tuple_key(N.quoted(F.col("parent_qid")), N.quoted(F.col("parent_title")))))


@query(f"with {ONE} select sent_idx_unq, pos, least(e, length(sentence))::integer - s as n_inside from m where s is not null and e is not null and s < length(sentence) and alias is not null")
def fn08_span_overlap(t):
    """Characters that each span and its sentence share."""
    m = mentions(t).where("span_start < length(sentence) and span_end is not null and alias is not null")
    return m.select("sent_idx_unq", F.col("pos").cast("long").alias("pos"), N.span_overlap(F.col("span_start"), F.col("span_end"), F.lit(0), F.length("sentence")).alias("n_inside"))


@query("select distinct title, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') as escaped from title_map where title is not null")
def fn25_escape(t):
    """Titles with HTML entities."""
    return t.title_map.select("title").dropna().distinct().select("title", N.escape(F.col("title")).alias("escaped"))


# projections


@query("with a as (select alias, qid from candidate where alias is not null and qid is not null) select qid, array_to_string(list_sort(list(distinct alias)), '|') as aliases from a group by qid")
def pj09_invert(t):
    """Entity to its aliases."""
    return C.invert(t.candidate.where("alias is not null and qid is not null"), "qid", "alias").select("qid", F.array_join("aliass", "|").alias("aliases"))


@query(f"with {ONE} select sent_idx_unq, pos::integer as pos, alias, title, qid, s as span_start, e as span_end, gold, mention_source, unswap_alias from m")
def pj07_zip(t):
    """Parallel arrays to a row per mention, defaults filled in (also pj06, pj08)."""
    return mentions(t).drop("parent_qid", "parent_title", "sentence", "split", "source")


@query("""select doc_id, length(regexp_replace(x, '(?s)<a\\b[^>]*>(.*?)</a>', '\\1', 'g'))::integer as n_plain, len(regexp_extract_all(x, '(?s)<a\\b[^>]*href="[^"]+"[^>]*>(.+?)</a>'))::integer as n_mentions
    from (select doc_id, trim(regexp_replace(text, '\\n+', chr(10), 'g'), ' ' || chr(10) || chr(9) || chr(13)) as x from documents where text is not null)""")
def pj04_anchor_mentions(t):
    """Links taken out of page texts: length of the plain text and number of mentions."""
    found = M.anchor_mentions(t.documents.where("text is not null"), "doc_id", "text")
    return found.select("doc_id", F.length("plain").alias("n_plain"), F.size("mentions").alias("n_mentions"))


@query(f"""select m[1] as alias, m[2] as title, count(*) as n from (
    select list_value(regexp_extract(a, '(?s)>(.*?)</a>', 1), trim(split_part({_unescaped("url_decode(replace(regexp_extract(a, 'href=" + chr(34) + "([^" + chr(34) + "]*)" + chr(34) + "', 1), '+', '%2B'))")}, '#', 1))) as m
    from (select unnest(regexp_extract_all(text, '(?s)<a\\b[^>]*href="[^"]+"[^>]*>.+?</a>')) as a from documents)) group by 1, 2""")
def pj04_mention_titles(t):
    """Aliases with the titles their links name, counted (ag01 over page texts)."""
    m = M.with_titles(M.anchor_mentions(t.documents.where("text is not null"), "doc_id", "text"))
    return m.groupBy("alias", "title").agg(F.count("*").alias("n"))


@query()
def pj05_sentence_buckets(t):
    """Page texts cut into sentences that no mention straddles; tested against a loop."""
    plain = M.anchor_mentions(t.documents.where("text is not null"), "doc_id", "text")
    out = M.bucketed(plain, "doc_id", M.sentence_spans(F.col("plain")), "mentions", ["alias"])
    return out.select("doc_id", "doc_sent_idx", "start", "end", F.size("mentions").alias("n_mentions"))


# filters


@query("select alias, qid, score from candidate where alias = 'kesruthrol'")
def fl01_name_lookup(t):
    return t.candidate.where(F.col("alias") == "kesruthrol").select("alias", "qid", "score")


@query("select claim_id, qid from entity_rels where property_id = 'P31' and value = 'Q5001'")
def fl02_rel_value(t):
    return t.entity_rels.where("property_id = 'P31' and value = 'Q5001'").select("claim_id", "qid")


@query(f"select alias, title, count(*) as cnt from (select {FOLD.format('v')} as alias, w as title from (select unnest(aliases) as v, unnest(titles) as w from sentences)) where alias <> '' and title is not null group by all having count(*) >= 4")
def fl05_min_support(t):
    """(alias, title) pairs that stand at least 4 times (ag01, fl06)."""
    return C.min_support(C.alias_title_counts(mentions(t), fold_alias), 4)


_CASCADE = f"""{ONE}, {TITLES},
    known as (select distinct alias, qid from c), names as (select distinct alias from c),
    judged as (select m.*, tm.qid as found, {FOLD.format('m.alias')} as norm from m left join tm on tm.title = m.title where m.alias is not null),
    reasons as (select j.*, case when j.found is null then 'no_qid' when norm = '' then 'len_zero_alias' when s >= length(sentence) or e > length(sentence) then 'span_issue'
      when n.alias is null then 'no_alias' when k.alias is null then 'not_in_filter' when j.found = '-1' then 'qid_neg_one' when d.qid is not null then 'disambig_qid' end as reason
      from judged j left join names n on n.alias = norm left join known k on k.alias = norm and k.qid = j.found
      left join (select distinct qid from entity_rels where property_id = 'P31' and value = 'Q5001') d on d.qid = j.found)"""


def cascaded(t) -> DataFrame:
    """Mentions with the first reason to reject them. Class Q5001 stands in for disambiguation pages."""
    c = cands(t)
    m = mentions(t).where("alias is not null").drop("qid")
    m = m.join(titles(t).withColumnRenamed("qid", "found"), "title", "left").withColumn("norm", fold_alias("alias"))
    m = m.join(c.select(F.col("alias").alias("norm")).distinct().withColumn("has_alias", F.lit(1)), "norm", "left")
    m = m.join(c.select(F.col("alias").alias("norm"), F.col("qid").alias("found")).distinct().withColumn("has_pair", F.lit(1)), ["norm", "found"], "left")
    m = m.join(t.entity_rels.where("property_id = 'P31' and value = 'Q5001'").select(F.col("qid").alias("found"), F.lit(1).alias("disambig")).distinct(), "found", "left")
    n = F.length("sentence")
    return R.cascade(m, [
        ("no_qid", F.col("found").isNull()), ("len_zero_alias", F.col("norm") == ""), ("span_issue", (F.col("span_start") >= n) | (F.col("span_end") > n)),
        ("no_alias", F.col("has_alias").isNull()), ("not_in_filter", F.col("has_pair").isNull()), ("qid_neg_one", F.col("found") == "-1"), ("disambig_qid", F.col("disambig").isNotNull()),
    ])


@query(f"with {CANDS}, {_CASCADE} select sent_idx_unq, pos::integer as pos, reason from reasons")
def fl07_reject_cascade(t):
    """Each mention with the first reason to reject it, if any (j04, j05)."""
    return cascaded(t).select("sent_idx_unq", "pos", "reason")


@query(f"with {CANDS}, {_CASCADE} select coalesce(reason, 'kept') as reason, count(*) as n from reasons group by 1")
def ag05_reason_counts(t):
    return cascaded(t).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"with {CANDS}, {_CASCADE} select norm as alias, found as qid, count(*) as n from reasons where reason is null group by 1, 2")
def ag05_kept_pairs(t):
    return cascaded(t).where("reason is null").groupBy(F.col("norm").alias("alias"), F.col("found").alias("qid")).agg(F.count("*").alias("n"))


@query("select sent_idx_unq, len(string_split(sentence, ' ')) > 25 as is_long from sentences where sentence is not null")
def fl09_long_sentence(t):
    """Sentences of over 25 pieces at single blanks."""
    return t.sentences.where("sentence is not null").select("sent_idx_unq", (F.size(F.split("sentence", " ")) > 25).alias("is_long"))


_KEEP = "k as (select distinct qid from entity_rels where property_id = 'P106' and qid is not null)"


@query(f"with {_KEEP}, {ONE} select distinct sent_idx_unq from m where qid in (select qid from k)")
def fl10_overlap(t):
    """Sentences with a mention of one of a set of entities."""
    keep = t.entity_rels.where("property_id = 'P106'").select("qid").distinct()
    return mentions(t).join(keep, "qid", "left_semi").select("sent_idx_unq").distinct()


@query(f"with {_KEEP} select sent_idx_unq from sentences where parent_qid in (select qid from k)")
def fl11_parent(t):
    keep = t.entity_rels.where("property_id = 'P106'").select(F.col("qid").alias("parent_qid")).distinct()
    return t.sentences.join(keep, "parent_qid", "left_semi").select("sent_idx_unq")


@query(f"with {_KEEP}, {ONE} select sent_idx_unq from sentences where parent_qid in (select qid from k) union select sent_idx_unq from m where qid in (select qid from k)")
def fl12_either(t):
    """Sentences of or about the entities: two semi-joins and a union in place of an OR."""
    return fl11_parent(t).unionByName(fl10_overlap(t)).distinct()


@query("select sent_idx_unq from sentences where list_has_any(aliases, ['Kesruthrol', 'Drokram'])")
def fl13_aliases(t):
    return t.sentences.where(F.arrays_overlap("aliases", F.array(F.lit("Kesruthrol"), F.lit("Drokram")))).select("sent_idx_unq")


@query(f"""with {ONE}, p as (select distinct upper(trim(qid)) as head, upper(regexp_extract(value, '[Qq][0-9]+')) as tail from entity_rels where regexp_matches(value, '[Qq][0-9]+') and qid is not null),
    q as (select sent_idx_unq, qid from m where {KNOWN} union select sent_idx_unq, parent_qid from sentences where parent_qid is not null and parent_qid <> '-1')
    select distinct a.sent_idx_unq from q a join p on p.head = a.qid join q b on b.sent_idx_unq = a.sent_idx_unq and b.qid = p.tail and b.qid <> a.qid""")
def fl14_partners(t):
    """Sentences that name both partners of a relation, the page's own entity counting as named. The pairs come from the
    relation, not from the sentence."""
    p = t.entity_rels.select(F.upper(F.trim("qid")).alias("head"), F.nullif(F.upper(F.regexp_extract("value", "[Qq][0-9]+", 0)), F.lit("")).alias("tail")).dropna().distinct()
    q = mentions(t).where(KNOWN).select("sent_idx_unq", "qid").unionByName(t.sentences.select("sent_idx_unq", F.col("parent_qid").alias("qid")).where(KNOWN)).distinct()
    heads = q.join(p, F.col("qid") == F.col("head")).where("head != tail").select("sent_idx_unq", F.col("tail").alias("qid"))
    return heads.join(q, ["sent_idx_unq", "qid"], "left_semi").select("sent_idx_unq").distinct()


@query(f"with {ONE} select sent_idx_unq, count(*) as n, count(*) filter (gold) as n_gold from m where alias is not null group by 1")
def fl15_gold_only(t):
    """Mentions, and golden ones, of each sentence (fl16: sentences of none have no row)."""
    return mentions(t).where("alias is not null").groupBy("sent_idx_unq").agg(F.count("*").alias("n"), F.count_if("gold").alias("n_gold"))


@query(f"with {CANDS}, {ONE} select sent_idx_unq, pos::integer as pos from m where exists (select 1 from c where c.alias = {FOLD.format('m.alias')} and c.qid = m.qid)")
def fl17_in_candidates(t):
    """Mentions whose entity is a candidate of their alias."""
    m = mentions(t).select("sent_idx_unq", "pos", fold_alias("alias").alias("alias"), "qid")
    return m.join(cands(t), ["alias", "qid"], "left_semi").select("sent_idx_unq", "pos")


@query(f"with {CANDS} select alias, qid, score from c where qid in (select qid from title_map where {KNOWN})")
def fl18_known_entities(t):
    return cands(t).join(t.title_map.where(KNOWN).select("qid").distinct(), "qid", "left_semi").select("alias", "qid", "score")


@query(f"""with {CANDS}, a as (select {FOLD.format('v')} as alias, count(*) as cnt from (select unnest(aliases) as v from sentences) where v is not null group by 1),
    d as (select string_split(lower(text), ' ') as ws from documents where text is not null), longest as (select max(len(string_split(alias, ' ')))::bigint as n from c),
    g as (select array_to_string(ws[i : i + k - 1], ' ') as alias from (select ws, k, unnest(range(1, len(ws) - k + 2)) as i from (select ws, unnest(range(1, n + 1)) as k from d, longest))),
    w as (select alias, count(*) as cnt from g where alias in (select alias from c) group by 1), n as (select alias, count(*) as n_candidates from c group by alias)
    select n.alias, n_candidates, coalesce(w.cnt, 0) as in_text, case when a.cnt is null and coalesce(w.cnt, 0) >= 500 and n_candidates > 1 then 'never_alias'
      when a.cnt is not null and coalesce(w.cnt, 0) > 500 and a.cnt < 10000 and a.cnt / w.cnt < 0.017 then 'rarely_alias' end as reason
    from n left join a using (alias) left join w using (alias)""")
def fl19_alias_prune(t):
    """Common phrases among the aliases: text is counted in runs of words up to the longest alias, of the aliases only."""
    a = t.sentences.select(F.explode("aliases").alias("a")).where("a is not null").groupBy(fold_alias("a").alias("alias")).agg(F.count("*").alias("cnt"))
    c = cands(t)
    longest = c.agg(F.max(F.size(F.split("alias", " ")))).first()[0] or 1
    grams = t.documents.select(F.explode(F.flatten(F.get(F.transform(F.array(F.split(F.lower("text"), " ")), lambda w: F.array(*[N.ngrams(w, k) for k in range(1, longest + 1)])), F.lit(0)))).alias("alias"))
    w = grams.join(c.select("alias").distinct(), "alias", "left_semi").groupBy("alias").agg(F.count("*").alias("cnt"))
    return C.prune_common(c, a, w)


# joins


@query(f"with {TITLES} select title, qid from tm")
def j01_title_map(t):
    return titles(t)


@query(f"""with {ONE}, {TITLES}, amp as (select replace(title, ' ', ' & ') as title, min(qid) as qid from tm group by 1)
    select form, m.sent_idx_unq, m.pos::integer as pos, case when form = 'plain' then coalesce(a.qid, b.qid, c.qid) else d.qid end as resolved_qid
    from m cross join (select unnest(['plain', 'entities', 'map_entities']) as form) left join tm a on a.title = m.title left join tm b on b.title = {_unescaped("m.title")}
      left join tm c on c.title = replace(replace(replace(replace(replace(m.title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') left join amp d on d.title = replace(m.title, ' ', ' & ')""")
def j02_fallback_lookup(t):
    """Mentions resolved by title as written, unescaped or escaped. As the titles have nothing to escape, they are also
    asked with an ampersand at every blank: with entities in the mentions, and with entities in the map."""
    m, tm = mentions(t).select("sent_idx_unq", "pos", "title"), titles(t)
    amp = F.replace("title", F.lit(" "), F.lit(" & "))
    tm_amp = tm.groupBy(amp.alias("title")).agg(F.min("qid").alias("qid"))
    asked = {
        "plain": (m, tm),
        "entities": (m.withColumn("title", N.escape(amp)), tm_amp),
        "map_entities": (m.withColumn("title", amp), tm_amp.withColumn("title", N.escape(F.col("title")))),
    }
    parts = [R.resolve_titles(a, b).select(F.lit(form).alias("form"), "sent_idx_unq", "pos", "resolved_qid") for form, (a, b) in asked.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"with {TITLES} select sent_idx_unq, coalesce(tm.qid, '-1') as page_qid from sentences s left join tm on tm.title = s.parent_title")
def j03_default_lookup(t):
    """Page titles to entities, -1 by default."""
    s = t.sentences.select("sent_idx_unq", F.col("parent_title").alias("title")).join(titles(t), "title", "left")
    return s.select("sent_idx_unq", F.coalesce("qid", F.lit("-1")).alias("page_qid"))


@query(f"with {_KEEP}, {ONE} select sent_idx_unq, pos::integer as pos from m where qid is null or qid not in (select qid from k)")
def j05_anti(t):
    return mentions(t).join(t.entity_rels.where("property_id = 'P106'").select("qid").distinct(), "qid", "left_anti").select("sent_idx_unq", "pos")


_DUMP_LINKS = "links as (select id as qid, sitelinks['enwiki'].title as wiki_title from preprocess_dump where type = 'item' and sitelinks['enwiki'].title is not null), labels as (select id as qid, labels['en'].value as label from preprocess_dump where labels['en'].value is not null), ids as (select wikipedia_title as wiki_title, max(id) as id from title_map where wikipedia_title is not null group by 1)"


def _title_rows(t) -> DataFrame:
    d = t.preprocess_dump
    links = d.where("type = 'item'").select(F.col("id").alias("qid"), F.col("sitelinks")["enwiki"]["title"].alias("wiki_title")).where("wiki_title is not null")
    labels = d.select(F.col("id").alias("qid"), F.col("labels")["en"]["value"].alias("label")).where("label is not null")
    ids = t.title_map.where("wikipedia_title is not null").groupBy(F.col("wikipedia_title").alias("title")).agg(F.max("id").alias("id"))
    return R.title_rows(links, labels, ids)


@query(f"with {_DUMP_LINKS} select distinct l.qid, coalesce(ids.id, -1) as id, l.wiki_title as title, coalesce(labels.label, lower(l.wiki_title)) as wikidata_title, l.wiki_title as wikipedia_title from links l left join labels using (qid) left join ids using (wiki_title)")
def j06_left_fanout(t):
    """Page links with labels and page ids (sc08, sc21)."""
    return _title_rows(t)


@query(f"""with {_DUMP_LINKS}, rows as (select distinct l.qid, coalesce(ids.id, -1) as id, l.wiki_title as title, coalesce(labels.label, lower(l.wiki_title)) as wikidata_title, l.wiki_title as wikipedia_title from links l left join labels using (qid) left join ids using (wiki_title)),
    one as (select * from rows qualify row_number() over (partition by wikipedia_title order by qid, id, wikidata_title) = 1),
    red as (select distinct title as source, wikipedia_title as target from title_map where title <> wikipedia_title)
    select * from rows union select qid, id, source as title, wikidata_title, wikipedia_title from one join red on red.target = one.wikipedia_title""")
def j07_redirect_expand(t):
    """Title rows and their copies under redirect titles."""
    red = t.title_map.where("title != wikipedia_title").select(F.col("title").alias("source"), F.col("wikipedia_title").alias("target")).distinct()
    return R.expand_redirects(_title_rows(t), red)


_COUNTS = f"k as (select {FOLD.format('alias')} as alias, qid, count(*) as cnt from (select unnest(aliases) as alias, unnest(qids) as qid from sentences) where alias is not null and {KNOWN} group by all)"


def pair_counts(t) -> DataFrame:
    return mentions(t).where(f"alias is not null and {KNOWN}").groupBy(fold_alias("alias").alias("alias"), "qid").agg(F.count("*").alias("cnt"))


@query(f"with {_COUNTS}, n as (select distinct alias, qid from candidate where alias is not null and qid is not null) select coalesce(k.alias, n.alias) as alias, coalesce(k.qid, n.qid) as qid, coalesce(k.cnt, 1) as cnt, k.cnt is null as is_new from k full join n on k.alias = n.alias and k.qid = n.qid")
def j08_full_outer_merge(t):
    """Observed counts merged with the candidate list."""
    return C.merge_pairs(pair_counts(t), t.candidate)


@query(f"with {CANDS}, {_COUNTS}, tot as (select qid, sum(cnt)::bigint as n from k group by qid) select alias, c.qid, coalesce(tot.n, 1) as cnt from c left join tot on tot.qid = c.qid where c.qid in (select qid from title_map)")
def j09_allowed_counts(t):
    """Candidates among allowed entities, with the entity's observed count or 1."""
    total = pair_counts(t).groupBy("qid").agg(F.sum("cnt").alias("n"))
    kept = cands(t).join(t.title_map.select("qid").distinct(), "qid", "left_semi")
    return kept.join(total, "qid", "left").select("alias", "qid", F.coalesce("n", F.lit(1)).alias("cnt"))


@query(f"with {ONE}, {_KEEP} select qid from (select qid from m union select parent_qid from sentences) where {KNOWN} and qid not in (select qid from k)")
def j10_allowed_qids(t):
    """Linked and page entities without a set of them (st01-st04)."""
    return R.allowed_qids(mentions(t), t.sentences.select(F.col("parent_qid").alias("qid")), None, t.entity_rels.where("property_id = 'P106'"))


@query(f"with {RANKED}, {_KEEP} select alias, qid, score, rank::integer as rank from r where rank <= 3 and alias in (select alias from c where qid in (select qid from k))")
def j11_closure(t):
    """Top lists of the aliases with a candidate among given entities."""
    return C.closure(cands(t), t.entity_rels.where("property_id = 'P106' and qid is not null"), 3)


@query(f"""with {ONE} select a.sent_idx_unq, a.pos::integer as pos_a, b.pos::integer as pos_b, (least(a.e, b.e) - greatest(a.s, b.s))::integer as n_shared from m a join m b on a.sent_idx_unq = b.sent_idx_unq and a.pos < b.pos where least(a.e, b.e) - greatest(a.s, b.s) > 0""")
def j22_span_overlap(t):
    """Mentions of one sentence that overlap."""
    m = mentions(t).where("span_start is not null and span_end is not null").select("sent_idx_unq", "pos", "span_start", "span_end")
    a = m.toDF("sent_idx_unq", "pos_a", "s1", "e1")
    b = m.toDF("sent_idx_unq", "pos_b", "s2", "e2")
    shared = N.span_overlap(F.col("s1"), F.col("e1"), F.col("s2"), F.col("e2"))
    return a.join(b, "sent_idx_unq").where((F.col("pos_a") < F.col("pos_b")) & (shared > 0)).select("sent_idx_unq", "pos_a", "pos_b", shared.alias("n_shared"))


@query(f"""with {ONE}, w as (select sent_idx_unq, sentence, unnest(string_split(sentence, ' ')) as word, generate_subscripts(string_split(sentence, ' '), 1) as i from sentences),
    o as (select sent_idx_unq, i, word, sum(length(word) + 1) over (partition by sent_idx_unq order by i) - length(word) - 1 as at from w)
    select m.sent_idx_unq, m.pos::integer as pos, o.word from m join o on o.sent_idx_unq = m.sent_idx_unq and m.s = o.at where word <> ''""")
def j21_token_starts(t):
    """Mentions that begin where a word does (pj22)."""
    w = t.sentences.where("sentence is not null").select("sent_idx_unq", F.explode(N.word_spans(F.col("sentence"))).alias("w"))
    m = mentions(t).select("sent_idx_unq", "pos", F.col("span_start").alias("at"))
    return m.join(w.select("sent_idx_unq", F.col("w.start").alias("at"), "w.word"), ["sent_idx_unq", "at"]).select("sent_idx_unq", "pos", "word")


# aggregates


@query(f"select alias, title, count(*) as cnt from (select {LNRM.format('v')} as alias, w as title from (select unnest(aliases) as v, unnest(titles) as w from sentences)) where alias <> '' and title is not null group by all")
def ag01_alias_title_count(t):
    """(alias, title) counts of the normalised aliases."""
    return C.alias_title_counts(mentions(t), N.lnrm)


_SUPPORT = f"""{TITLES}, k as (select {FOLD.format('v')} as alias, w as title, count(*) as cnt from (select unnest(aliases) as v, unnest(titles) as w from sentences) where v is not null and w is not null group by all having count(*) >= 2),
    own as (select distinct {FOLD.format('t')} as alias, qid from (select qid, unnest([title, wikidata_title, wikipedia_title]) as t from title_map) where t is not null and {KNOWN}),
    sup as (select alias, qid, count(*) as cnt from (select k.alias, tm.qid from k join tm using (title) where k.alias <> '' union all select alias, qid from own where alias <> '') group by all)"""


def supported(t) -> DataFrame:
    counts = C.min_support(C.alias_title_counts(mentions(t), fold_alias), 2)
    three = F.array("title", "wikidata_title", "wikipedia_title")
    own = t.title_map.where(KNOWN).select("qid", F.explode(three).alias("x")).where("x is not null").select(fold_alias("x").alias("alias"), "qid").where("alias != ''").distinct()
    return C.title_support(counts, titles(t), own)


@query(f"with {_SUPPORT} select alias, qid, cnt from sup")
def ag03_support(t):
    """(alias, qid) by the number of titles that speak for it."""
    return supported(t)


@query(f"with {_SUPPORT} select alias, qid, cnt, row_number() over (partition by alias order by cnt desc, qid desc)::integer as rank from sup qualify rank <= 30")
def curate_aliases(t):
    """The curated alias map: counts, support, own titles, the top 30 of each alias."""
    return C.top_k(supported(t), 30, score="cnt")


@query(f"with {ONE}, {TITLES} select count(*) as mentions, count(distinct alias) as aliases, count(distinct title) as titles, count(*) filter (title is not null and title not in (select title from tm)) as unresolved from m where alias is not null")
def ag04_stats(t):
    """Figures of a run in one row."""
    m = mentions(t).where("alias is not null").join(titles(t).select("title", F.lit(1).alias("known")), "title", "left")
    return m.agg(F.count("*").alias("mentions"), F.countDistinct("alias").alias("aliases"), F.countDistinct("title").alias("titles"), F.count_if(F.col("title").isNotNull() & F.col("known").isNull()).alias("unresolved"))


@query(f"with {ONE}, k as (select distinct {FOLD.format('alias')} as a, title from m) select title, count(*) as cnt from m where title is not null and title not in (select title from (select wikipedia_title as title from title_map where {KNOWN} union select title from title_map where {KNOWN}) where title is not null) group by title")
def ag04_unresolved(t):
    """Unresolved titles with their mentions."""
    return mentions(t).where("title is not null").join(titles(t), "title", "left_anti").groupBy("title").agg(F.count("*").alias("cnt"))


@query(f"with {ONE} select mention_source, qid, count(*) as n from m where qid is not null group by all")
def ag06_source_counts(t):
    return mentions(t).where("qid is not null").groupBy("mention_source", "qid").agg(F.count("*").alias("n"))


@query(f"with {ONE} select alias, qid, count(*) as n_all, count(*) filter (gold) as n_gold from m where alias is not null and {KNOWN} group by all")
def ag07_with_and_without_weak(t):
    return mentions(t).where(f"alias is not null and {KNOWN}").groupBy("alias", "qid").agg(F.count("*").alias("n_all"), F.count_if("gold").alias("n_gold"))


@query(f"with {ONE} select qid, count(*) as n, count(*) filter (gold) as n_gold from m where split = 'train' and {KNOWN} group by qid")
def ag08_train_counts(t):
    return mentions(t).where(f"split = 'train' and {KNOWN}").groupBy("qid").agg(F.count("*").alias("n"), F.count_if("gold").alias("n_gold"))


@query(f"with {_COUNTS} select alias, qid, cnt, cnt / sum(cnt) over (partition by alias) as share from k")
def ag12_normalise(t):
    return C.normalised(pair_counts(t), "alias")


@query(f"with {CANDS} select max(n)::bigint as max_candidates, max(len(string_split(alias, ' ')))::bigint as max_alias_len from (select alias, count(*) as n from c group by alias)")
def ag13_max_lens(t):
    n = cands(t).groupBy("alias").agg(F.count("*").alias("n"))
    return n.agg(F.max("n").alias("max_candidates"), F.max(F.size(F.split("alias", " "))).cast("long").alias("max_alias_len"))


@query(f"with {CANDS} select alias, qid, score from c")
def ag23_dedup_max(t):
    return cands(t)


@query(f"with {CANDS} select qid, sum(score)::bigint as total from c group by qid")
def ag24_qid_totals(t):
    return cands(t).groupBy("qid").agg(F.sum("score").alias("total"))


@query(f"with {CANDS}, n as (select alias, count(*) as n from c group by alias) select avg(n) as mean, quantile_cont(n, 0.9) as p90, quantile_cont(n, 0.999) as p999 from n")
def ag25_percentile(t):
    n = cands(t).groupBy("alias").agg(F.count("*").alias("n"))
    return n.agg(F.avg("n").alias("mean"), F.percentile("n", 0.9).alias("p90"), F.percentile("n", 0.999).alias("p999"))


# ranks


@query(f"with {RANKED} select alias, qid, score, rank::integer as rank from r")
def wn01_order(t):
    return C.ranked(cands(t))


@query(f"with {RANKED} select alias, qid, score, rank::integer as rank from r where rank <= 5")
def wn02_topk(t):
    return C.top_k(cands(t), 5)


@query(f"with {RANKED}, {ONE} select m.sent_idx_unq, m.pos::integer as pos, (r.rank - 1)::integer as cand_pos, n.n as n_cands from m join (select alias, count(*) as n from c group by alias) n on n.alias = {FOLD.format('m.alias')} left join r on r.alias = n.alias and r.qid = m.qid")
def wn03_position(t):
    """Where the entity stands among the candidates of the mention's alias, and how many there are."""
    r = C.ranked(cands(t))
    m = mentions(t).select("sent_idx_unq", "pos", fold_alias("alias").alias("alias"), "qid")
    out = m.join(r.groupBy("alias").agg(F.count("*").alias("n_cands")), "alias").join(r.select("alias", "qid", (F.col("rank") - 1).alias("cand_pos")), ["alias", "qid"], "left")
    return out.select("sent_idx_unq", "pos", "cand_pos", "n_cands")


@query(f"with {ONE} select sent_idx_unq, string_agg(alias, '|' order by s, e, alias) as in_order from m where alias is not null and s is not null and e is not null group by 1")
def wn11_span_sort(t):
    m = mentions(t).where("alias is not null and span_start is not null and span_end is not null")
    packed = m.groupBy("sent_idx_unq").agg(F.sort_array(F.collect_list(F.struct("span_start", "span_end", "alias"))).alias("ms"))
    return packed.select("sent_idx_unq", F.array_join(F.transform("ms", lambda x: x["alias"]), "|").alias("in_order"))


@query()
def wn12_permutation(t):
    """All rows in an order that a hash decides, numbered from 0."""
    from loomspan.operators.knowledge import dense_ids

    return dense_ids(t.sentences.select("sent_idx_unq"), [F.xxhash64("sent_idx_unq", F.lit(1234)), F.col("sent_idx_unq")], 0, "new_idx")


@query("select trim(lower(source)) as source, count(*) as n, count(distinct trim(lower(lang))) as langs from documents group by 1")
def documents_by_source(t):
    return t.documents.groupBy(F.lower(F.trim("source")).alias("source")).agg(F.count("*").alias("n"), F.countDistinct(F.lower(F.trim("lang"))).alias("langs"))
