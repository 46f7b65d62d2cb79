"""Queries over the knowledge base, weak labels, splits, symbol tables and candidate evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions import normal as N
from loomspan.functions.languages import ENGLISH, ENGLISH_PRONOUNS
from loomspan.functions.languages import TITLES as NAME_TITLES
from loomspan.functions.text import fold_alias
from loomspan.operators import benchmarks as B
from loomspan.operators import candidates as C
from loomspan.operators import knowledge as K
from loomspan.operators import labelling as L
from loomspan.operators.symbols import EntitySymbols, record_store
from loomspan.plans.catalog import Catalog
from loomspan.plans.reference import CANDS, FOLD, KNOWN, ONE, RANKED, cands, mentions, pair_counts, titles

CATALOG = Catalog()
query = CATALOG.query
queries = lambda: CATALOG.found
oracle_sql = lambda: CATALOG.sql

# staging tables from the dump

_CLAIMS = """items as (select * from preprocess_dump where id is not null and type is distinct from 'property'),
    cl as (select id as qid, p as property_id, unnest(claims[p]) as c from (select id, claims, unnest(map_keys(claims)) as p from items)),
    v as (select qid, property_id, c.id as claim_id, c.mainsnak.datatype as datatype, c.qualifiers as qualifiers, {snak} as value from cl where c.mainsnak.snaktype = 'value')"""


def _snak(at: str) -> str:
    j = f"try_cast({at}.datavalue as json)"
    return (
        f"case when {at}.datatype in ('string', 'external-id', 'url') then json_extract_string({j}, '$.value')"
        f" when {at}.datatype = 'monolingualtext' then case when json_extract_string({j}, '$.value.language') = 'en' then json_extract_string({j}, '$.value.text') end"
        f" when {at}.datatype = 'quantity' then json_extract_string({j}, '$.value.amount') when {at}.datatype = 'time' then json_extract_string({j}, '$.value.time')"
        f" when {at}.datatype = 'wikibase-item' then json_extract_string({j}, '$.value.id') end"
    )


_V = _CLAIMS.format(snak=_snak("c.mainsnak"))


@query("select id as qid, labels['en'].value as label from preprocess_dump where id is not null and type is distinct from 'property' and labels['en'].value is not null")
def pj01_labels(t):
    return K.staging(t.preprocess_dump)["labels"]


@query("select id as qid, descriptions['en'].value as description from preprocess_dump where id is not null and type is distinct from 'property' and descriptions['en'].value is not null")
def pj01_descriptions(t):
    return K.staging(t.preprocess_dump)["descriptions"]


@query(f"""with {_V} select qid, alias from (
    select id as qid, labels['en'].value as alias from items union all select id, a.value from (select id, unnest(aliases['en']) as a from items)
    union all select qid, value from v where property_id in ('P138', 'P734', 'P735', 'P742', 'P1448', 'P1449', 'P1477')) where alias is not null""")
def pj01_aliases(t):
    return K.staging(t.preprocess_dump)["aliases"]


@query("select id as qid, sitelinks['enwiki'].title as wiki_title from preprocess_dump where id is not null and type is distinct from 'property' and sitelinks['enwiki'].title is not null")
def pj01_wikipedia_links(t):
    return K.staging(t.preprocess_dump)["wikipedia_links"]


@query(f"with {_V} select claim_id, qid, property_id, value from v where datatype = 'wikibase-item' and value is not null")
def pj02_entity_rels(t):
    return K.staging(t.preprocess_dump)["entity_rels"]


@query(f"with {_V} select claim_id, qid, property_id, value from v where datatype not in ('wikibase-item', 'external-id') and value is not null")
def pj02_entity_values(t):
    return K.staging(t.preprocess_dump)["entity_values"]


@query(f"with {_V} select claim_id, qid, property_id, value from v where datatype = 'external-id' and value is not null")
def pj02_external_ids(t):
    return K.staging(t.preprocess_dump)["external_ids"]


@query(f"with {_V}, q as (select claim_id, p as property_id, unnest(qualifiers[p]) as q from (select claim_id, qualifiers, unnest(map_keys(qualifiers)) as p from v where value is not null)) select qualifier_id, claim_id, property_id, value from (select q.hash as qualifier_id, claim_id, property_id, {_snak('q')} as value from q where q.snaktype = 'value') where value is not null")
def pj03_qualifiers(t):
    return K.staging(t.preprocess_dump)["qualifiers"]


@query(f"with {_V} select qid, property_id, datatype from v where datatype not in ('string', 'external-id', 'url', 'monolingualtext', 'quantity', 'time', 'wikibase-item', 'math', 'tabular-data')")
def sk03_unknown_datatypes(t):
    """Snaks of datatypes that aren't known, coordinates among them as most of the ignored ones aren't ignored here."""
    return K.staging(t.preprocess_dump, ignored=("math", "tabular-data"))["errors"]


# relations and types


@query("select distinct qid from entity_rels where property_id = 'P31' and value in ('Q5001', 'q5001')")
def fl03_with_relation(t):
    """Entities of some classes (fl04)."""
    return K.with_relation(t.entity_rels, ["P31"], ["Q5001", "q5001"])


@query("select qid, lower(value) as alias from entity_rels where property_id in ('P7401', 'P7402') and value is not null")
def fl23_alias_properties(t):
    """Values of naming properties as aliases, in lower case (fl24)."""
    return t.entity_rels.where("property_id in ('P7401', 'P7402') and value is not null").select("qid", F.lower("value").alias("alias"))


_T = "t as (select qid as head, property_id as rel, value as tail from entity_rels where qid in (select qid from title_map))"


def _triples(t) -> DataFrame:
    return K.triples(t.entity_rels, t.title_map.where("qid is not null"))


@query(f"with {_T} select * from t")
def j12_triples_semi(t):
    return _triples(t)


@query(f"with {_T} select head, rel, array_to_string(list_sort(list(tail) filter (tail is not null)), '|') as tails from t group by head, rel having count(tail) > 0")
def ag10_kg_nested(t):
    """Nested relations of an entity, a row for each."""
    nested = K.nested_triples(_triples(t).where("tail is not null and rel is not null"))
    return nested.select("head", F.explode("rels").alias("rel", "tails")).select("head", "rel", F.array_join("tails", "|").alias("tails"))


@query("select head, rel, tail from (select qid as head, property_id as rel, value as tail from entity_rels) where rel not in ('P31', 'P279')")
def fl20_excluded_relations(t):
    return K.triples(t.entity_rels).where("rel not in ('P31', 'P279')")


_TYPES = """p as (select distinct qid, value as type from entity_rels where property_id in ('P106', 'P31', 'P279') and qid is not null and value is not null),
    f as (select type, count(*) as freq from p group by type), ty as (select p.qid, p.type, f.freq, row_number() over (partition by p.qid order by f.freq desc, p.type)::integer as rank from p join f using (type) qualify rank <= 3)"""


@query(f"with {_TYPES} select type, freq from f")
def ag09_type_frequency(t):
    return K.typed(t.entity_rels, 1 << 30).select("type", "freq").distinct()


@query(f"with {_TYPES} select qid, type, freq, rank from ty")
def wn06_type_rank(t):
    """The three most frequent types of each entity (j13)."""
    return K.typed(t.entity_rels, 3)


@query(f"with {_TYPES} select type, row_number() over (order by freq desc, type)::bigint as type_id from f")
def wn07_dense_ids(t):
    """Types numbered from 1 in order of frequency."""
    f = K.typed(t.entity_rels, 1 << 30).select("type", "freq").distinct()
    return K.dense_ids(f, [F.desc("freq"), F.col("type")], 1, "type_id").select("type", F.col("type_id").cast("long").alias("type_id"))


@query("select qid, case when row_number() over (partition by label order by qid) > 1 then label || '_' || qid else label end as label from (select id as qid, min(labels['en'].value) as label from preprocess_dump where labels['en'].value is not null group by id)")
def wn07_unique_titles(t):
    """Labels told apart by the entity id."""
    d = t.preprocess_dump.select(F.col("id").alias("qid"), F.col("labels")["en"]["value"].alias("label")).where("label is not null").groupBy("qid").agg(F.min("label").alias("label"))
    return K.unique_titles(d, "label", "qid")


@query(f"with {CANDS}, e as (select distinct qid from c) select qid, row_number() over (order by qid)::bigint as eid from e")
def wn08_eids(t):
    """Entities numbered from 1 in order of id."""
    return K.dense_ids(cands(t).select("qid").distinct(), [F.col("qid")], 1, "eid").select("qid", F.col("eid").cast("long").alias("eid"))


@query("""with k as (select distinct qid from title_map where qid is not null), e as (select distinct qid as h, value as t from entity_rels where qid in (select qid from k) and value in (select qid from k)),
    b as (select h as qid, t as neighbour from e union select t, h from e) select qid, neighbour from b qualify row_number() over (partition by qid order by neighbour) <= 50""")
def j17_adjacency(t):
    """Neighbours of known entities, both ways, the first 50 (st05)."""
    return K.symmetric(K.triples(t.entity_rels), t.title_map.where("qid is not null"), 50)


@query("""with k as (select distinct qid from title_map where qid is not null), e as (select distinct qid as head, property_id as rel, value as tail from entity_rels where qid in (select qid from k) and value in (select qid from k) and property_id is not null)
    select head, tail, (dense_rank() over (order by rel) - 1)::bigint as rel_id from e""")
def j18_context_relations(t):
    """Relations between known entities with dense relation ids."""
    known = t.title_map.where("qid is not null").select("qid").distinct()
    e = K.triples(t.entity_rels, known).where("rel is not null").join(known.withColumnRenamed("qid", "tail"), "tail", "left_semi").select("head", "rel", "tail").distinct()
    ids = K.dense_ids(e.select("rel").distinct(), [F.col("rel")], 0, "rel_id").select("rel", F.col("rel_id").cast("long").alias("rel_id"))
    return e.join(ids, "rel").select("head", "tail", "rel_id")


@query(f"""with {ONE}, q as (select distinct parent_qid as page, qid from m where parent_qid is not null and {KNOWN}), e as (select distinct upper(trim(qid)) as h, upper(regexp_extract(value, '[Qq][0-9]+')) as t, property_id as rel from entity_rels where regexp_matches(value, '[Qq][0-9]+') and property_id is not null),
    p as (select distinct least(a.qid, b.qid) as a, greatest(a.qid, b.qid) as b from q a join e on e.h = a.qid join q b on b.page = a.page and b.qid = e.t where a.qid <> b.qid)
    select distinct p.a, p.b, e.rel from p join e on (e.h = p.a and e.t = p.b) or (e.h = p.b and e.t = p.a)""")
def j16_pair_relation(t):
    """Relations, either way, between entities that a page names together."""
    q = mentions(t).where(f"parent_qid is not null and {KNOWN}").select(F.col("parent_qid").alias("page"), "qid").distinct()
    tail = F.nullif(F.upper(F.regexp_extract("tail", "[Qq][0-9]+", 0)), F.lit(""))
    e = K.triples(t.entity_rels).select(F.upper(F.trim("head")).alias("head"), "rel", tail.alias("tail")).dropna().distinct()
    hit = q.join(e.select(F.col("head").alias("qid"), "tail").distinct(), "qid").where("qid != tail").select("page", "qid", "tail")
    both = hit.join(q.withColumnRenamed("qid", "tail"), ["page", "tail"], "left_semi")
    pairs = both.select(F.least("qid", "tail").alias("a"), F.greatest("qid", "tail").alias("b")).distinct()
    return K.pair_relations(pairs, e)


@query("""with s as (select parent_qid as qid, min(sentence) as s from sentences where doc_sent_idx = 0 and parent_qid is not null and parent_qid <> '-1' group by 1),
    d as (select id as qid, min(descriptions['en'].value) as d from preprocess_dump where id is not null and type is distinct from 'property' group by 1)
    select coalesce(s.qid, d.qid) as qid, coalesce(s, d) as description from s full join d on s.qid = d.qid where coalesce(s, d) is not null""")
def j14_descriptions(t):
    """A page's first sentence, else the description of the entity."""
    first = t.sentences.where("doc_sent_idx = 0 and parent_qid != '-1'").select(F.col("parent_qid").alias("qid"), "sentence")
    return K.descriptions(first, K.staging(t.preprocess_dump)["descriptions"])


@query("select e.claim_id, coalesce(d.label, e.property_id) as rel from entity_rels e left join property_defs d on d.property_id = e.property_id")
def j15_name_lookup(t):
    """Relation names, the id where there is none."""
    names = t.property_defs.select("property_id", "label")
    return t.entity_rels.join(names, "property_id", "left").select("claim_id", F.coalesce("label", "property_id").alias("rel"))


@query(f"""with {_TYPES}, k as (select distinct e.qid, coalesce(d.label, e.property_id) as rel, e.value from entity_rels e left join property_defs d on d.property_id = e.property_id where e.property_id not in ('P31', 'P279') and e.value is not null),
    n as (select qid, count(distinct rel) as n_relations, count(*) as n_tails from k group by qid), ents as (select distinct qid from title_map where qid is not null), tn as (select qid, string_agg(type, '|' order by rank) as types from ty group by qid)
    select qid, coalesce(n_relations, 0) as n_relations, coalesce(n_tails, 0) as n_tails, coalesce(types, '') as types from ents left join n using (qid) left join tn using (qid)""")
def wn09_profile(t):
    """Entity profiles: numbers of relations and tails, types in order (es06)."""
    p = K.profile(t.title_map.where("qid is not null"), K.triples(t.entity_rels).where("tail is not null"), t.property_defs, K.typed(t.entity_rels, 3))
    tails = F.aggregate("relations", F.lit(0).cast("long"), lambda a, r: a + F.size(r["tails"]))
    return p.select("qid", F.size("relations").cast("long").alias("n_relations"), tails.alias("n_tails"), F.array_join("types", "|").alias("types"))


# aliases of people


_TITLED = ", ".join(f"'{x}'" for x in sorted(NAME_TITLES))
_STOP = ", ".join(f"'{x}'" for x in sorted(ENGLISH.stop))


@query(f"""with h as (select distinct qid from entity_rels where property_id = 'P31' and value = 'Q5001'), a as (select distinct lower(title) as name, qid from title_map where title is not null and qid in (select qid from h)),
    w as (select qid, name, list_filter(string_split_regex(regexp_replace(name, '\\([^)]*\\)', ' ', 'g'), '\\s+'), lambda x: x <> '') as ws from a),
    k as (select qid, name, case when len(list_filter(ws, lambda x: rtrim(x, '.') not in ({_TITLED}))) > 0 then list_filter(ws, lambda x: rtrim(x, '.') not in ({_TITLED})) else ws end as ws from w)
    select distinct qid, alias from (select qid, name as alias from k union select qid, ws[1] from k where ws[1] not in ({_STOP}) union select qid, ws[-1] from k where len(ws) > 1 and ws[-1] not in ({_STOP})) where alias <> ''""")
def fn06_name_augment(t):
    """Names of one class of entities with their first and last parts, stop words left out (fn05)."""
    h = K.with_relation(t.entity_rels, ["P31"], ["Q5001"])
    a = t.title_map.where("title is not null").join(h, "qid", "left_semi").select("qid", F.lower("title").alias("name")).distinct()
    n = N.first_last(F.col("name"))
    parts = F.concat(F.array("name"), F.filter(F.array(n["first"], n["last"]), lambda x: ~x.isin(*sorted(ENGLISH.stop))))
    return a.select("qid", F.explode(parts).alias("alias")).where("alias != ''").distinct()


# weak labels

_PRN = ", ".join(f"'{x}'" for x in ENGLISH_PRONOUNS)
_TOKENS = f"""w as (select sent_idx_unq, parent_qid, unnest(string_split_regex(trim(sentence), '\\s+')) as x from sentences where sentence is not null), tk as (select sent_idx_unq, parent_qid, lower(regexp_replace(x, '[!-/:-@\\[-`{{-~]+$', '')) as word from w where lower(regexp_replace(x, '[!-/:-@\\[-`{{-~]+$', '')) in ({_PRN})),
    cl as (select *, case when word in ('him', 'he', 'his', 'himself') then 1 when word in ('her', 'she', 'herself') then 2 when word in ('it', 'its', 'itself') then 3 else 4 end as cls from tk)"""


def _tokens(t) -> DataFrame:
    return L.pronoun_tokens(t.sentences.where("sentence is not null"), ["sent_idx_unq", "parent_qid"], "sentence")


@query(f"with {_TOKENS} select sent_idx_unq, word, cls, word in ('his', 'her') as possessive, count(*) as n from cl group by all")
def fn10_pronouns(t):
    return _tokens(t).groupBy("sent_idx_unq", "word", "cls", "possessive").agg(F.count("*").alias("n"))


@query(f"""with {_TOKENS}, n as (select parent_qid, cls, count(*) as n from cl where parent_qid is not null group by all), r as (select *, row_number() over (partition by parent_qid order by n desc, cls) as k, coalesce(lead(n) over (partition by parent_qid order by n desc, cls), 0) as second from n)
    select parent_qid, case when n < 5 or second > 0.9 * n then 5 else cls end as cls from r where k = 1""")
def ag14_leading_pronoun(t):
    return L.leading_pronoun(_tokens(t).where("parent_qid is not null"), "parent_qid")


@query("""with g as (select qid, max(case when d < '4' then 'Q6581097' when d < '7' then 'Q6581072' else 'Q1097630' end) as g from (select qid, right(value, 1) as d from entity_rels where property_id = 'P7101' and regexp_matches(value, '^Q[0-9]+$')) group by qid),
    p as (select distinct qid from entity_rels where property_id = 'P31' and qid is not null)
    select e.qid, case when p.qid is null then -2 when g is null then -1 when g = 'Q6581097' then 1 when g = 'Q6581072' then 2 else 5 end as gender from (select distinct parent_qid as qid from sentences where parent_qid is not null) e left join p using (qid) left join g using (qid)""")
def j24_person_gender(t):
    """Pages of persons and their gender: entities with a class stand in for persons, and the last digit of what a relation
    names for one of the genders of the map, or one that isn't in it."""
    persons = K.with_relation(t.entity_rels, ["P31"]).where("qid is not null")
    digit = F.right("value", F.lit(1))
    gender = F.when(digit < "4", "Q6581097").when(digit < "7", "Q6581072").otherwise("Q1097630")
    genders = t.entity_rels.where("property_id = 'P7101' and value rlike '^Q[0-9]+$'").select("qid", gender.alias("value"))
    return L.person_gender(t.sentences.where("parent_qid is not null").select(F.col("parent_qid").alias("qid")), persons, genders)


@query(f"with {RANKED}, n as (select alias, count(*) as n from c group by alias) select qid, arg_max(alias, struct_pack(n := n, alias := alias)) as alias from (select r.qid, r.alias, n.n from r join n using (alias) where rank <= 30) group by qid")
def wn05_conflict_alias(t):
    """Of the aliases that may name an entity, the most ambiguous one."""
    return L.conflict_aliases(C.ranked(cands(t)))


@query(f"""with {RANKED}, n as (select alias, count(*) as n from c group by alias), near as (select r.alias, r.qid, n.n from r join n using (alias) where rank <= 30),
    best as (select qid, arg_max(alias, struct_pack(n := n, alias := alias)) as best from near where n > 1 group by qid), spare as (select qid, list_sort(list(distinct alias)) as spare from near group by qid), {ONE},
    a as (select sent_idx_unq, pos, {FOLD.format('alias')} as alias, qid, sent_idx_unq || ':' || (pos::integer) as id from m where alias is not null)
    select a.sent_idx_unq, a.pos::integer as pos, case when a.qid is null or own.alias is not null then a.alias
      else coalesce(best.best, spare.spare[(('0x' || substr(sha1(a.id || '|' || a.qid), 1, 8))::bigint % len(spare.spare)) + 1], a.alias) end as new_alias
    from a left join near own on own.alias = a.alias and own.qid = a.qid and own.n > 1 left join best on best.qid = a.qid left join spare on spare.qid = a.qid""")
def wn04_choose_alias(t):
    """Every mention with its more ambiguous alias, also where the choice is by hash."""
    m = mentions(t).where("alias is not null").select("sent_idx_unq", "pos", F.concat_ws(":", "sent_idx_unq", "pos").alias("id"), fold_alias("alias").alias("alias"), "qid")
    return L.choose_aliases(m, C.ranked(cands(t)).select("alias", "qid", "rank"), 30).select("sent_idx_unq", "pos", "new_alias")


_VOTES = f"""qa as (select distinct alias, qid from candidate where alias is not null and qid is not null), {ONE},
    lm as (select parent_title as doc, parent_qid as doc_qid, qid from m where parent_title is not null and parent_qid is not null),
    cast_ as (select doc, doc_qid, qa.alias, lm.qid from lm join qa on qa.qid = lm.qid union all select distinct doc, doc_qid, qa.alias, doc_qid from lm join qa on qa.qid = lm.doc_qid),
    vo as (select doc, doc_qid, alias, qid, count(*) as votes from cast_ group by all)"""


def _votes(t) -> DataFrame:
    m = mentions(t).where("parent_title is not null and parent_qid is not null").select(F.col("parent_title").alias("doc"), F.col("parent_qid").alias("doc_qid"), "qid")
    return L.page_votes(m, t.candidate.where("alias is not null and qid is not null").select("qid", "alias").distinct(), "doc", "doc_qid")


@query(f"with {_VOTES} select doc, doc_qid, alias, qid, votes from vo")
def ag15_votes(t):
    return _votes(t)


@query(f"""with {_VOTES}, tot as (select doc, sum(votes) as total from vo group by doc), wt as (select vo.*, count(*) over (partition by vo.doc, alias) as n, total from vo join tot using (doc)),
    ww as (select *, case when n > 1 and qid = doc_qid then greatest(0.2 * total, 1) else votes end::double as weight from wt),
    rr as (select *, row_number() over (partition by doc, alias order by weight desc, qid) as r, lead(weight) over (partition by doc, alias order by weight desc, qid) as second from ww)
    select doc, alias, qid from rr where r = 1 and (n = 1 or weight > 5 * second)""")
def ag16_vote_prune(t):
    return L.pruned_votes(_votes(t), "doc", "doc_qid")


def _grams(t) -> DataFrame:
    known = cands(t).select(N.lnrm("alias").alias("alias")).where("alias != ''").distinct()
    longest = known.agg(F.max(F.size(F.split("alias", " ")))).first()[0] or 1
    return L.candidate_grams(t.sentences, ["sent_idx_unq"], "sentence", longest + 1).join(known, "alias", "left_semi")


@query()
def lb01_greedy_match(t):
    """Aliases found in sentences, the longest first, none overlapping another or a given mention."""
    taken = mentions(t).where("span_start is not null and span_end is not null").select("sent_idx_unq", F.col("span_start").alias("start"), F.col("span_end").alias("end"))
    return L.greedy_spans(_grams(t), ["sent_idx_unq"], taken)


@query()
def lb05_pronoun_mentions(t):
    """Pronouns that agree with the page's person; here persons are those of one class, taken as of gender 1."""
    gender = K.with_relation(t.entity_rels, ["P31"], ["Q5001"]).select("qid", F.lit(1).alias("gender"))
    return L.pronoun_mentions(_tokens(t), gender, L.conflict_aliases(C.ranked(cands(t))), "parent_qid")


@query(f"with {ONE} select sent_idx_unq, string_agg(case when gold and unswap_alias is not null then unswap_alias else alias end, '|' order by pos) as aliases from m where alias is not null group by 1")
def lb06_unswap(t):
    m = mentions(t).where("alias is not null").groupBy("sent_idx_unq").agg(F.sort_array(F.collect_list(F.struct("pos", "alias", "unswap_alias", "gold"))).alias("m"))
    got = lambda f: F.transform("m", lambda x: x[f])
    return m.select("sent_idx_unq", F.array_join(L.unswapped(got("alias"), got("unswap_alias"), got("gold")), "|").alias("aliases"))


@query("""with k as (select distinct parent_qid, '(''' || parent_qid || ''', ''' || sent_idx_unq || ''')' as key, sent_idx_unq from sentences where parent_qid is not null),
    b as (select sent_idx_unq, (76 * list_sum(list_transform(range(0, 7), lambda i: ('0x' || substr(sha1(key), 5 * i + 1, 5))::bigint)) + ('0x' || substr(sha1(key), 36, 5))::bigint) % 100 as b from k)
    select sent_idx_unq, case when b < 10 then 'test' when b < 20 then 'dev' else 'train' end as assigned from b""")
def lb07_split(t):
    """Train, dev and test by the hash of a key."""
    s = t.sentences.where("parent_qid is not null")
    return s.select("sent_idx_unq", L.hash_split(N.tuple_key(N.quoted(F.col("parent_qid")), N.quoted(F.col("sent_idx_unq").cast("string"))), 10).alias("assigned"))


@query("select distinct parent_title from sentences where parent_title is not null and (parent_qid is null or parent_qid = '-1')")
def lb08_pages_without_entity(t):
    return t.sentences.where("parent_title is not null and (parent_qid is null or parent_qid = '-1')").select("parent_title").distinct()


# symbols


def _symbols(t) -> EntitySymbols:
    return EntitySymbols.build(cands(t), titles(t)).edit()


_SYM = RANKED + ", s as (select alias, qid, score from r where rank <= 30), f as (select alias as fa, qid as fq from s order by alias, qid limit 1)"


def _first(s: EntitySymbols) -> tuple[str, str]:
    """The first pair by alias and entity: one that every table has."""
    r = s.candidates.agg(F.min(F.struct("alias", "qid")).alias("f")).first().f
    return r.qid, r.alias


@query(f"with {_SYM} select alias, qid, score from s")
def es01_candidates(t):
    return _symbols(t).candidates


@query(f"with {_SYM} select qid, row_number() over (order by qid)::bigint as eid from (select distinct qid from s)")
def es02_entity_ids(t):
    return _symbols(t).entities.select("qid", F.col("eid").cast("long").alias("eid"))


@query(f"with {_SYM} select alias, (row_number() over (order by alias) - 1)::bigint as alias_id from (select distinct alias from s)")
def es02_alias_ids(t):
    return _symbols(t).alias_ids().select("alias", F.col("alias_id").cast("long").alias("alias_id"))


@query(f"with {RANKED} select alias, array_to_string(list(qid order by rank) || list_resize([]::varchar[], (5 - count(*))::bigint, '-1'), '|') as qids from r where rank <= 5 group by alias")
def es03_padding(t):
    """Candidate lists of exactly five."""
    return C.padded(cands(t), 5).select("alias", F.array_join("qids", "|").alias("qids"))


@query(f"with {_TYPES} select qid, string_agg(type, '|' order by rank) as types from ty group by qid")
def es07_record_store(t):
    return record_store(K.typed(t.entity_rels, 3), "qid", "type", "rank", 3).select("qid", F.array_join("values", "|").alias("types"))


@query(f"with {_SYM} select alias, qid, case when alias = fa and qid = fq then 7 else score end as score from s, f")
def ed01_set_score(t):
    s = _symbols(t)
    return s.set_score(*_first(s), 7).candidates


@query(f"with {_SYM}, n as (select count(*) as n from s, f where alias = fa), k as (select s.*, row_number() over (partition by alias order by score desc, qid desc) as rk from s) select alias, qid, score from k, f, n where alias <> fa or rk <= 30 - 1 union all select fa, (select max(qid) from s), 1 from f where not exists (select 1 from s where alias = fa and qid = (select max(qid) from s))")
def ed02_add_mention(t):
    """A pair more for an alias, whose last candidate goes if it is full."""
    s = _symbols(t)
    other = s.candidates.agg(F.max("qid")).first()[0]
    return s.add_mention(other, _first(s)[1], 1).candidates


@query(f"with {_SYM} select alias, qid, score from s, f where not (alias = fa and qid = fq)")
def ed03_remove_mention(t):
    s = _symbols(t)
    return s.remove_mention(*_first(s)).candidates


@query(f"with {_SYM} select alias, qid, score from s union all select 'a new name', 'Q999999999', 5")
def ed04_add_entity(t):
    """An entity with a mention (ed02)."""
    return _symbols(t).add_entity("Q999999999", "A new name", [("a new name", 5)]).candidates


@query(f"with {_SYM} select alias, case when qid = fq then 'Q999999999' else qid end as qid, score from s, f")
def ed05_reidentify(t):
    s = _symbols(t)
    return s.reidentify(_first(s)[0], "Q999999999").candidates


@query(f"with {_SYM} select qid, row_number() over (order by qid)::bigint as eid from (select distinct qid from s where qid in (select qid from entity_rels where property_id = 'P106'))")
def ed06_prune(t):
    return _symbols(t).prune(t.entity_rels.where("property_id = 'P106' and qid is not null").select("qid")).entities.select("qid", F.col("eid").cast("long").alias("eid"))


@query(f"with {_SYM} select alias, score from s, f where qid = fq")
def ed07_mentions(t):
    s = _symbols(t)
    return s.mentions_of(_first(s)[0])


# candidate generation and recall

_JUDGED = f"{CANDS}, {ONE}, g as (select sent_idx_unq, pos, {FOLD.format('alias')} as alias, qid, source from m where alias is not null and {KNOWN}), j as (select g.*, case when g.alias not in (select alias from c) then 'no_alias' when c.qid is null then 'no_candidate' else 'found' end as outcome, c.score from g left join c on c.alias = g.alias and c.qid = g.qid)"


def _golds(t) -> DataFrame:
    return mentions(t).where(f"alias is not null and {KNOWN}").select("sent_idx_unq", "pos", fold_alias("alias").alias("alias"), "qid", "source")


@query(f"with {_JUDGED} select sent_idx_unq, pos::integer as pos, outcome from j")
def bm01_standard(t):
    """Each mention: alias unknown, entity not among its candidates, or found (bm03)."""
    return B.judged(_golds(t), cands(t)).select("sent_idx_unq", "pos", "outcome")


@query(f"with {_JUDGED} select source, count(*) as total, count(*) filter (outcome <> 'no_alias') as alias_known, count(*) filter (outcome = 'found') as found, count(*) filter (outcome = 'found') / count(*) as recall from j group by source")
def ag17_recall(t):
    """Recall of the candidate lists by source (ag19, bm04)."""
    return B.recall(B.judged(_golds(t), cands(t)), ["source"])


@query(f"with {_JUDGED}, r as (select *, row_number() over (partition by alias order by score desc, qid desc) as rank from c), gr as (select j.qid, r.rank from j left join r on r.alias = j.alias and r.qid = j.qid) select k::integer as k, count(*) filter (rank <= k)::bigint as hits, count(*) as total, count(*) filter (rank <= k) / count(*) as recall from gr cross join (select unnest([1, 2, 3, 5, 10, 30]) as k) group by k")
def ag18_recall_at_k(t):
    return B.recall_at(_golds(t).join(C.ranked(cands(t)).select("alias", "qid", "rank"), ["alias", "qid"], "left"), [1, 2, 3, 5, 10, 30])


@query("""with n as (select qid, count(distinct property_id) as k from entity_rels where qid is not null group by qid), h as (select k, count(*) as n from n group by k)
    select k, sum(n) over (order by k) / sum(n) over () as coverage from h""")
def ag20_coverage(t):
    """Share of the entities with at most so many different relations."""
    from pyspark.sql import Window

    h = t.entity_rels.where("qid is not null").groupBy("qid").agg(F.countDistinct("property_id").alias("k")).groupBy("k").agg(F.count("*").alias("n"))  # a row per number
    return h.select("k", (F.sum("n").over(Window.orderBy("k")) / F.sum("n").over(Window.partitionBy())).alias("coverage"))


@query(f"""select alias, qid, sum(w)::bigint as weight from (select {FOLD.format('alias')} as alias, qid, 1 as w from candidate where alias is not null and qid is not null
    union all select {FOLD.format('wikidata_title')}, qid, 5 from (select distinct wikidata_title, qid from title_map where wikidata_title is not null and qid is not null)) group by all""")
def ag21_weighted(t):
    """Alias weights: 1 as an alias, 5 as the canonical name (ag22)."""
    a = t.candidate.where("alias is not null and qid is not null").select(fold_alias("alias").alias("alias"), "qid", F.lit(1).alias("w"))
    b = t.title_map.where("wikidata_title is not null and qid is not null").select("wikidata_title", "qid").distinct().select(fold_alias("wikidata_title").alias("alias"), "qid", F.lit(5).alias("w"))
    return a.unionByName(b).groupBy("alias", "qid").agg(F.sum("w").alias("weight"))


@query()
def fn11_proper_nouns(t):
    """Capitalised phrases of all sentences; tested against a loop."""
    return t.sentences.where("sentence is not null").select("sent_idx_unq", F.explode(N.proper_phrases(F.split("sentence", " "), ENGLISH.stop)).alias("phrase"))


@query(f"""with {CANDS}, {ONE}, a as (select distinct {FOLD.format('alias')} as alias from m where alias is not null), w as (select alias, string_split(alias, ' ') as ws from a),
    ph as (select alias, array_to_string(ws[i : i + k - 1], ' ') as phrase, k as n_words from (select alias, ws, k, unnest(range(1, len(ws) - k + 2)) as i from (select alias, ws, unnest(range(1, len(ws) + 1)) as k from w))
      union select alias, replace(alias, ' ', ''), len(ws) from w),
    lv as (select alias, phrase, case when phrase = alias then 0 when phrase = replace(alias, ' ', '') then 1 else 2 + len(string_split(alias, ' ')) - n_words end as level from ph),
    hit as (select distinct lv.alias, level, phrase, c.qid, c.score from lv join c on c.alias = lv.phrase)
    select alias, qid, sum(score)::bigint as score from hit h where level = (select min(level) from hit x where x.alias = h.alias) group by all""")
def fn12_subalias_backoff(t):
    """Candidates of an alias or of its longest known parts."""
    a = mentions(t).where("alias is not null").select(fold_alias("alias").alias("alias"))
    return B.backed_off(a, cands(t))


@query("""select distinct qid, title, wikidata_title, case when len(list_distinct(list_concat(a, b))) > 0 then len(list_intersect(list_distinct(a), list_distinct(b))) / len(list_distinct(list_concat(a, b))) else 0 end as score
    from (select qid, title, wikidata_title, string_split(lower(title), ' ') as a, string_split(lower(wikidata_title), ' ') as b from title_map where title is not null and wikidata_title is not null and qid is not null)""")
def fn13_jaccard_score(t):
    """Word overlap of title and label."""
    s = t.title_map.where("title is not null and wikidata_title is not null and qid is not null").select("qid", "title", "wikidata_title").distinct()
    return s.withColumn("score", B.jaccard(F.lower("title"), F.lower("wikidata_title")))


@query(f"""with {RANKED}, {ONE}, seen as (select {FOLD.format('alias')} as alias, qid, count(*) as context from m where alias is not null and {KNOWN} group by all),
    ctx as (select *, row_number() over (partition by alias order by context desc, qid desc) as cr from (select c.alias, c.qid, coalesce(context, 0) as context from c left join seen on seen.alias = c.alias and seen.qid = c.qid)),
    mr as (select r.alias, r.qid, row_number() over (partition by r.alias order by case when rank <= 5 then rank end nulls last, cr, r.qid) as k from r join ctx on ctx.alias = r.alias and ctx.qid = r.qid)
    select alias, qid, k::integer as rank from mr where k <= 10""")
def wn10_merge_rank(t):
    """First five by prior, the rest by how often mentions name them (bm02)."""
    c = cands(t)
    context = c.join(pair_counts(t), ["alias", "qid"], "left").select("alias", "qid", F.coalesce("cnt", F.lit(0)).alias("context"))
    return B.merged_ranking(c.select("alias", "qid", F.col("score").alias("prior")), context, "alias", 10)


@query()
def j23_context_hits(t):
    """Proper names of the sentence that a candidate's page also has, for benchmark items; candidates of their names or
    of the longest known parts of these."""
    c = cands(t).where("score >= 0")
    items = t.benchmark_items.where("sentence is not null").select("item_id", F.explode(N.proper_phrases(F.split("sentence", " "), ENGLISH.stop)).alias("term"))
    asked = items.select(F.col("item_id").alias("mention"), fold_alias("term").alias("alias"))
    named = asked.join(B.backed_off(asked, c).select("alias", "qid"), "alias").select("mention", "qid").distinct()
    pages = t.sentences.where("parent_qid is not null and sentence is not null").select(F.col("parent_qid").alias("qid"), "sentence")
    return B.context_scores(named, pages, items.select(F.col("item_id").alias("mention"), "term"))


@query()
def bm09_tfidf_topk(t):
    """The 30 nearest concepts of benchmark names by character n-grams; tested against all pairs."""
    names = t.benchmark_items.where("sentence is not null").select(F.explode(N.proper_phrases(F.split("sentence", " "), ENGLISH.stop)).alias("x")).select(F.lower("x").alias("alias"))
    return B.tfidf_candidates(names, cands(t).select("alias", "qid"), 30)
