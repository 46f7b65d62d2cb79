"""Queries of the language-model operators over the test tables, and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions import readings
from loomspan.functions.text import fold_alias, fold_title, key, known_qid, strip
from loomspan.llm.contamination import leaks, remove_spans
from loomspan.llm.frequent import frequent, summarise
from loomspan.llm.groups import assign, leaking, split_report
from loomspan.llm.mixture import Mixture, token_counts
from loomspan.llm.overlap import Overlap
from loomspan.llm.spans import shared_classes, shared_pairs, shared_share, shared_spans
from loomspan.operators.skew import lookup
from loomspan.plans.tables import table
from loomspan.scratch import Scratch

SHARES = {"train": 0.8, "dev": 0.1, "test": 0.1}


# 3 - most frequent values


def _elements(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sentences")
    aliases = s.select(F.lit("alias").alias("field"), F.explode("aliases").alias("value")).where("value is not null").select("field", fold_alias("value").alias("value"))
    titles = s.select(F.lit("title").alias("field"), F.explode("titles").alias("value")).where("value is not null").select("field", fold_title("value").alias("value"))
    return aliases.unionByName(titles)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Folded aliases and titles of at least 1 % of all elements."""
    return frequent(_elements(spark, d), 0.01).select("field", F.col("value").alias("folded"))


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    """Those of at least 0.2 %, with their exact counts."""
    return frequent(_elements(spark, d), 0.002).select("field", F.col("value").alias("folded"), "n", "total")


def p3_approximate(spark: SparkSession, d: str) -> DataFrame:
    """The summary itself: bounds of the count of each value that has a counter."""
    return summarise(_elements(spark, d))


# 6 - overlaps across splits


def _sides(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sentences")
    side = F.when(F.col("split") == "train", 0).when(F.col("split").isin("dev", "test"), 1)
    return s.select(F.col("sent_idx_unq").alias("id"), side.alias("side"), F.col("sentence").alias("text"))


def _overlap(spark: SparkSession, d: str) -> Overlap:
    return Overlap(_sides(spark, d), Scratch(spark, "p6"), threshold=0.8, least=8, edits=0.2)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a train and a dev or test sentence at most 0.2 word edits a word apart."""
    pairs = _overlap(spark, d).member_pairs()
    return pairs.select(F.col("a").alias("sent_a"), F.col("b").alias("sent_b"))


def _by_source(spark: SparkSession, d: str, links: DataFrame) -> DataFrame:
    s = table(spark, d, "sentences").where("split in ('dev', 'test')").select(F.col("sent_idx_unq").alias("id"), "split", "source")
    return s.join(links, "id", "left").groupBy("split", "source").agg(F.count("*").alias("n_held_out"), F.count_if(F.col("n_links") > 0).alias("n_overlapping"), F.sum(F.coalesce("n_links", F.lit(0))).alias("n_links"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Per split and source: sentences held out, those that overlap with train, and how many links they have."""
    return _by_source(spark, d, _overlap(spark, d).links())


def p6_weighted(spark: SparkSession, d: str) -> DataFrame:
    """The same of sentences whose vectors of inverse document frequencies have a cosine of 0.8 or more."""
    return _by_source(spark, d, Overlap(_sides(spark, d), Scratch(spark, "p6"), threshold=0.8, least=8, weigh="idf").links())


def p6_classes(spark: SparkSession, d: str) -> DataFrame:
    """The class of equal word lists that each sentence of 8 words or more is in, named by its smallest member."""
    return _overlap(spark, d).members.select(F.col("id").alias("sent_idx_unq"), F.col("rep").alias("class"))


def p6_links(spark: SparkSession, d: str) -> DataFrame:
    """Each sentence with its class and the number of sentences it overlaps with on the other side."""
    found = _overlap(spark, d)
    return found.links(0).unionByName(found.links(1)).select(F.col("id").alias("sent_idx_unq"), F.col("rep").alias("class"), "n_links")


# 7 - splits by group


def _related(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sentences")
    return s.select(F.col("sent_idx_unq").alias("id"), known_qid("parent_qid").alias("a"), fold_title("parent_title").alias("b"), "split", F.col("source").alias("stratum"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows of groups that lie in more than one split as delivered."""
    return leaking(_related(spark, d), Scratch(spark, "p7")).select(F.col("id").alias("sent_idx_unq"))


def p7_splits(spark: SparkSession, d: str) -> DataFrame:
    """A split for every row, one per group of related rows."""
    return assign(_related(spark, d), SHARES, Scratch(spark, "p7")).select(F.col("id").alias("sent_idx_unq"), "component", "assigned")


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Per split the share wanted and reached, the deviation of its label distribution, and groups torn."""
    scratch = Scratch(spark, "p7")
    return split_report(scratch.save(assign(_related(spark, d), SHARES, scratch)), SHARES)


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """What the splits must hold: no group torn, shares within half a point, no label off by more than two points of all
    rows."""
    return p7_shares(spark, d).select("split", "share_wanted", "torn", (F.abs(F.col("share") - F.col("share_wanted")) <= 0.005).alias("share_near"), (F.col("label_deviation") <= 0.02).alias("labels_near"))


# 8 - evaluation texts in training text


def _texts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return documents, table(spark, d, "benchmark_items").select(F.col("item_id").alias("id"), F.col("sentence").alias("text"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with 12 consecutive words of an item."""
    return leaks(*_texts(spark, d), n=12).select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Per corpus and split of the items: items that leaked, and documents they leaked into."""
    items = table(spark, d, "benchmark_items").select(F.col("item_id").alias("item"), "corpus", "split")
    return leaks(*_texts(spark, d), n=12).join(items, "item").groupBy("corpus", "split").agg(F.countDistinct("item").alias("n_items"), F.countDistinct("id").alias("n_documents"))


def p8_removed(spark: SparkSession, d: str) -> DataFrame:
    """Every document with leaked spans cut out."""
    return remove_spans(*_texts(spark, d), n=12).select(F.col("id").alias("doc_id"), "text", "words_cut")


def p8_cut(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the number of words cut out of it."""
    return p8_removed(spark, d).select("doc_id", F.col("words_cut").cast("long").alias("words_cut"))


# 9 - mixing sources


def _mixture(spark: SparkSession, d: str) -> Mixture:
    kinds = table(spark, d, "entity_rels").where(key("property_id") == "P31").select(key("qid").alias("qid"), readings.item(strip("value")).alias("kind")).where("qid is not null and kind is not null")
    kinds = kinds.groupBy("qid").agg(F.min("kind").alias("topic"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", "lang", known_qid("parent_qid").alias("qid"), "text")
    # texts are measured where they are read; only their sizes move to meet the topics, those of large pages apart
    scratch = Scratch(spark, "p9")
    sized = lookup(scratch.save(token_counts(docs)), kinds, "qid").select("id", "source", "lang", "topic", "tokens")
    return Mixture(sized, table(spark, d, "mixture_targets"), scratch)


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """What the mixture must hold for each target: no record repeated too often, and, as far as the source has documents,
    a share within one point and the size of the largest record of the wanted one."""
    m = _mixture(spark, d)
    size = m.sample.agg(F.max("tokens"), F.sum(F.col("tokens") * F.col("copies"))).first()
    near = F.abs(F.col("share_reached") - F.col("share_wanted")) <= 0.01 + (size[0] or 0) / max(size[1] or 0, 1)
    kept = F.col("most_copies") <= F.floor(F.coalesce("max_repeats", F.lit(1.0)))
    return m.report.where("target_share is not null").select("source", "target_share", near.alias("share_near"), kept.alias("repeats_kept"), (F.col("documents") > 0).alias("has_documents"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the sources wanted and reached, in tokens."""
    return _mixture(spark, d).report


def p9_marginals(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the languages and topics wanted and reached, in tokens."""
    return _mixture(spark, d).marginals


def p9_sample(spark: SparkSession, d: str) -> DataFrame:
    """The documents drawn, with their copies."""
    return _mixture(spark, d).sample


# 10 - long spans shared


def _spans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return documents, shared_spans(documents, Scratch(spark, "p10"), length=300)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents that share 300 characters in a row."""
    return shared_pairs(_spans(spark, d)[1]).select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b"))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    """How much of each document stands letter for letter in another one, in runs of 300 characters or more."""
    out = shared_share(*_spans(spark, d))
    return out.select(F.col("id").alias("doc_id"), "n_chars", "n_shared", "share")


def p10_groups(spark: SparkSession, d: str) -> DataFrame:
    """Each document that shares a span, with the class of documents linked by shared spans, named by its smallest, and
    its size: the form that grows with the documents and not with the square of a class."""
    return shared_classes(_spans(spark, d)[1], Scratch(spark, "p10")).select(F.col("id").alias("doc_id"), "class", F.col("n_records").alias("n_documents"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (p3_found, p3_counts, p3_approximate, p6_found, p6_report, p6_weighted, p6_classes, p6_links, p7_found, p7_splits, p7_shares, p7_report, p8_found, p8_report, p8_removed, p8_cut, p9_shares, p9_report, p9_marginals, p9_sample, p10_found, p10_groups, p10_shares)
    }


_FOLD = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"
_TITLE = _FOLD.format("replace(split_part({}, '#', 1), '_', ' ')")
_ELEMENTS = f"""
e as (select 'alias' as field, {_FOLD.format("v")} as folded from (select unnest(aliases) as v from sentences) where v is not null
  union all select 'title', {_TITLE.format("v")} from (select unnest(titles) as v from sentences) where v is not null),
n as (select field, folded, count(*) as n, sum(count(*)) over (partition by field)::bigint as total from e group by field, folded)"""

_WORDS = "list_filter(string_split_regex(regexp_replace(lower(strip_accents({})), '[^\\p{{L}}\\p{{Nd}}\\s]', '', 'g'), '\\s+'), lambda w: w <> '')"

_LEAKS = f"""
i as (select item_id, {_WORDS.format("sentence")} as w from benchmark_items),
ig as (select distinct item_id, array_to_string(w[k : k + 11], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 10)) as k from i)),
t as (select doc_id, {_WORDS.format("regexp_replace(text, '<[^>]*>', '', 'g')")} as w from documents),
dg as (select doc_id, array_to_string(w[k : k + 11], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from t)),
hits as (select distinct doc_id, item_id from dg join ig using (g))"""

#: Distinct word lists of 8 words or more, and the weights of their terms: a word's second occurrence is a term of its own.
_VECTORS = f"""
s as (select sent_idx_unq, split, source, case when split = 'train' then 0 when split in ('dev', 'test') then 1 end as side, {_WORDS.format("sentence")} as w from sentences),
kept as (select *, array_to_string(w, ' ') as key from s where len(w) >= 8 and side is not null),
c as (select key, any_value(w) as w, bool_or(side = 0) as train, bool_or(side = 1) as held, count(*) filter (side = 0) as n_train, min(sent_idx_unq) as rep from kept group by key),
terms as (select key, w || '#' || row_number() over (partition by key, w) as term from (select key, unnest(w) as w from c)),
df as (select term, count(*) as n from terms group by term), size as (select count(*) as total, greatest(20, count(*) * 0.0005) as floor from c),
raw as (select key, term, case when n > floor then ln(1 + total / n) else ln(1 + total / floor) end as w from terms join df using (term), size),
v as (select key, term, w / sqrt(sum(w * w) over (partition by key)) as w from raw)"""

_SPANS = """
w as (select doc_id, k, md5(substring(text, k, 300)) as g from (select doc_id, text, unnest(range(1, length(text) - 298)) as k from documents)),
twice as (select g from w group by g having count(distinct doc_id) > 1),
s as (select w.* from w join twice using (g))"""


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"with {_ELEMENTS} select field, folded from n where n >= 0.01 * total",
        "p3_counts": f"with {_ELEMENTS} select field, folded, n, total from n where n >= 0.002 * total",
        "p6_classes": f"with {_VECTORS} select sent_idx_unq, rep as class from kept join c using (key)",
        "p6_weighted": f"""with {_VECTORS},
            pairs as (select a.key as x, b.key as y from (select v.* from v join c using (key) where train) a join (select v.* from v join c using (key) where held) b on a.term = b.term group by all having sum(a.w * b.w) >= 0.8 * (1 - 1e-9)),
            links as (select y as key, sum(n_train) as n from pairs join c on c.key = x group by y)
            select s.split, s.source, count(*) as n_held_out, count(*) filter (n > 0) as n_overlapping, coalesce(sum(n), 0)::bigint as n_links
            from s left join kept using (sent_idx_unq) left join links on links.key = kept.key where s.split in ('dev', 'test') group by s.split, s.source""",
        "p7_report": "select split, share_wanted, 0::bigint as torn, true as share_near, true as labels_near from (values ('train', 0.8::double), ('dev', 0.1::double), ('test', 0.1::double)) t(split, share_wanted)",
        "p9_report": "select m.source, target_share, true as share_near, true as repeats_kept, d.source is not null as has_documents from mixture_targets m left join (select distinct lower(trim(source)) as source from documents) d on d.source = m.source",
        "p8_cut": f"""with {_LEAKS},
            places as (select doc_id, k, array_to_string(w[k : k + 11], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from t)),
            gone as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(k, k + 12)) as p from places where g in (select g from ig)) group by doc_id)
            select d.doc_id, coalesce(n, 0) as words_cut from documents d left join gone using (doc_id)""",
        "p10_groups": f"""with recursive {_SPANS.strip()},
            e as (select distinct x.doc_id as a, y.doc_id as b from (select distinct doc_id, g from s) x join (select distinct doc_id, g from s) y on x.g = y.g and x.doc_id <> y.doc_id),
            reach as (select distinct a, a as o from e union select reach.a, e.b from reach join e on e.a = reach.o), comp as (select a, min(o) as c from reach group by a)
            select a as doc_id, c as class, count(*) over (partition by c) as n_documents from comp""",
        "p7_found": f"""with recursive r as (
              select sent_idx_unq, split, nullif(nullif(upper(trim(parent_qid)), '-1'), '') as a, {_TITLE.format("parent_title")} as b from sentences),
            e as (select distinct a, b from r where a is not null and b is not null),
            near as (select distinct x.a, y.a as o from e x join e y using (b) where x.a <> y.a),
            reach as (select distinct a, a as o from near union select reach.a, near.o from reach join near on near.a = reach.o),
            comp as (select a, min(o) as c from reach group by a),
            keyed as (select r.*, coalesce('a' || coalesce(c1.c, r.a), 'a' || c2.c, 'b' || r.b) as c from r left join comp c1 on c1.a = r.a
              left join (select e.b, min(coalesce(comp.c, e.a)) as c from e left join comp using (a) group by e.b) c2 on r.a is null and c2.b = r.b)
            select distinct sent_idx_unq from keyed where c in (select c from keyed group by c having count(distinct split) > 1)""",
        "p8_found": f"with {_LEAKS} select doc_id, item_id from hits",
        "p8_report": f"with {_LEAKS} select corpus, split, count(distinct item_id) as n_items, count(distinct doc_id) as n_documents from hits join benchmark_items using (item_id, split) group by corpus, split".replace("using (item_id, split)", "using (item_id)"),
        "p10_found": f"with {_SPANS} select distinct x.doc_id as doc_a, y.doc_id as doc_b from (select distinct doc_id, g from s) x join (select distinct doc_id, g from s) y on x.g = y.g and x.doc_id < y.doc_id",
        "p10_shares": f"""with {_SPANS},
            covered as (select doc_id, count(distinct c) as n from (select doc_id, unnest(range(k, k + 300)) as c from s) group by doc_id)
            select d.doc_id, length(text)::bigint as n_chars, coalesce(n, 0) as n_shared, case when length(text) > 0 then coalesce(n, 0) / length(text) else 0 end as share from documents d left join covered using (doc_id)""",
    }
