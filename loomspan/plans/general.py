"""Queries of the general data operators: wide tables, nested records, hierarchies, skewed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomspan.functions import readings
from loomspan.functions.text import fold_alias, key, known_qid, strip
from loomspan.operators.hierarchy import descent, hierarchy, paths
from loomspan.operators.nested import json_fields, shred
from loomspan.operators.skew import balanced_join, measure, plan_balance, value_counts
from loomspan.operators.wide import cell_states, long_values, widen
from loomspan.plans.tables import parallelism, table
from loomspan.scratch import Scratch

LINKS = ("P279", "P7361")
ALIAS_SHARE = 0.025


# 1 - attribute-value rows into wide tables


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells of single properties that hold contradictions or nothing readable."""
    wide = widen(table(spark, d, "entity_rels"), table(spark, d, "property_defs"))
    return cell_states(wide).where("state in ('conflict', 'unread')").select("qid", "property_id")


def _cell_text(values: Column, datatype: str) -> Column:
    """Values of a cell as one text, each once, in order."""
    text = F.transform(values, lambda x: (x.cast("decimal(30,3)") if datatype == "quantity" else x).cast("string"))
    return F.array_join(F.array_sort(F.array_distinct(text)), "|")


def p1_wide(spark: SparkSession, d: str) -> DataFrame:
    """The wide table; arrays as text, so that any engine compares them. Cells too long for a row of widen are filled in
    from their values as rows, so that none is left out."""
    rels, defs = table(spark, d, "entity_rels"), table(spark, d, "property_defs")
    wide = widen(rels, defs)
    many = [(p, name, datatype) for p, name, datatype, single in wide._properties if not single]
    out = {name: F.col(name) for _, name, _, _ in wide._properties}
    if many:
        cell = long_values(rels, defs).groupBy("qid", "property_id").agg(F.collect_list("reading").alias("readings"))
        read = {"quantity": "double", "time": "date"}
        texts = [F.max(F.when(F.col("property_id") == p, _cell_text(F.col("readings").cast(f"array<{read.get(datatype, 'string')}>"), datatype))).alias(f"{name}__long") for p, name, datatype in many]
        wide = wide.join(cell.groupBy("qid").agg(*texts), "qid", "left")
        out |= {name: F.coalesce(F.col(f"{name}__long"), _cell_text(F.col(name), datatype)).alias(name) for _, name, datatype in many}
    return wide.select("qid", *out.values())


# 2 - nested records into flat tables


def _dump(spark: SparkSession, d: str, carry: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    return shred(table(spark, d, "preprocess_dump"), "line_no", "line", carry)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Claims, qualifiers and sitelinks of the records of type item, each with its parent."""
    t = _dump(spark, d, {"line": ["id", "type"], "line_claims": ["id", "mainsnak_snaktype", "mainsnak_datavalue"]})
    item = "line__type = 'item' and line__id is not null"
    counts = "{0} is not null and {1}snaktype = 'value' and {1}datavalue is not null"
    kinds = {
        "claim": t["line_claims"].where(counts.format("id", "mainsnak_")).withColumn("parent_id", F.col("line__id")).withColumn("child_id", F.col("id")),
        "qualifier": t["line_claims_qualifiers"].where(counts.format("line_claims__id", "line_claims__mainsnak_")).where(counts.format("hash", "")).withColumn("parent_id", F.col("line_claims__id")).withColumn("child_id", F.col("hash")),
        "sitelink": t["line_sitelinks"].where(strip("title") != "").withColumn("parent_id", F.col("line__id")).withColumn("child_id", F.col("map_key")),
    }
    return _union([rows.where(item).select(F.col("line__id").alias("qid"), F.lit(kind).alias("child_kind"), "parent_id", "child_id") for kind, rows in kinds.items()]).distinct()


def _opened(rows: DataFrame, json: str) -> DataFrame:
    """rows with the leaves of their raw values, coordinates as numbers and all else as text, whatever fields the data's values
    have."""
    wanted = {"type": "value_type", "value": "plain", "value_id": "item", "value_amount": "amount", "value_time": "time", "value_text": "text", "value_language": "language", "value_latitude": "latitude"}
    leaves = {name: c for name, c in json_fields(rows, F.col(json))}
    return rows.select("row_id", "parent_id", F.col("ordinal").cast("long").alias("ordinal"), "map_key", *[leaves.get(k, F.lit(None)).cast("double" if v == "latitude" else "string").alias(v) for k, v in wanted.items()])


def p2_claim_values(spark: SparkSession, d: str) -> DataFrame:
    """All claim rows with their path keys, the raw JSON of the value opened: a column per leaf of the schema merged over
    all rows."""
    return _opened(_dump(spark, d)["line_claims"], "mainsnak_datavalue")


def p2_qualifier_values(spark: SparkSession, d: str) -> DataFrame:
    """The same of all qualifiers."""
    return _opened(_dump(spark, d)["line_claims_qualifiers"], "datavalue")


def p2_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every flat table."""
    return _union([t.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("flat_table"), "n") for name, t in sorted(_dump(spark, d).items())])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# 4 - parent-child links to hierarchies


def _links(spark: SparkSession, d: str) -> DataFrame:
    rels = table(spark, d, "entity_rels").where(key("property_id").isin(*LINKS))
    return rels.select(key("property_id").alias("property_id"), key("qid").alias("qid"), readings.item(strip("value")).alias("parent"))


def _nested(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy(_links(spark, d), scope="property_id", child="qid", parent="parent", scratch=Scratch(spark, "p4"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Each entity with a readable parent and its topmost ancestor, -1 if the way up never ends."""
    has_parent = _nested(spark, d).where("cyclic or depth > 0")
    return has_parent.select(F.col("scope").alias("property_id"), F.col("node").alias("qid"), F.coalesce("root", F.lit("-1")).alias("root_qid"))


def p4_tree(spark: SparkSession, d: str) -> DataFrame:
    """Path, depth, root and number of descendants of every entity; cyclic ones told."""
    out = paths(_nested(spark, d))
    return out.select(F.col("scope").alias("property_id"), F.col("node").alias("qid"), "root", F.col("depth").cast("long").alias("depth"), (F.col("size") - 1).alias("n_descendants"), "path", "cyclic")


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Every entity with each of its descendants."""
    return descent(_nested(spark, d)).select(F.col("scope").alias("property_id"), "ancestor", "descendant", F.col("distance").cast("long").alias("distance"))


# 5 - a few keys that hold most records


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    """(sent_idx_unq, pos, alias folded, qid): a row per non-null alias element, with the qid at its position."""
    at = table(spark, d, "sentences").select("sent_idx_unq", "qids", F.posexplode("aliases").alias("pos", "alias")).where("alias is not null")
    return at.select("sent_idx_unq", "pos", fold_alias("alias").alias("alias"), known_qid(F.get("qids", F.col("pos"))).alias("qid"))


def _by_key(mentions: DataFrame, key_: str, value: str, spark: SparkSession) -> DataFrame:
    loads = measure(mentions, key_, Scratch(spark, "p5"))
    return value_counts(mentions, key_, value, loads, plan_balance(loads, key_, parallelism(spark)), ["sent_idx_unq", "pos"])


def p5_alias_qids(spark: SparkSession, d: str) -> DataFrame:
    """How often each alias names each qid, beside the alias's mentions, made in evenly loaded shards."""
    return _by_key(_mentions(spark, d), "alias", "qid", spark)


def p5_qid_aliases(spark: SparkSession, d: str) -> DataFrame:
    """How often each qid goes by each alias, beside the qid's mentions."""
    return _by_key(_mentions(spark, d), "qid", "alias", spark)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Aliases of at least 2.5 % of all mentions, with the qid most of theirs name; of equally many, the first."""
    mentions = _mentions(spark, d)
    loads = measure(mentions, "alias", Scratch(spark, "p5"))
    total = loads.agg(F.sum("load")).first()[0] or 0
    large = loads.where(F.col("load") >= ALIAS_SHARE * total)  # at most 40
    wanted = mentions.join(F.broadcast(large.select("alias")), "alias", "left_semi")
    counts = value_counts(wanted, "alias", "qid", large, plan_balance(large, "alias", parallelism(spark)), ["sent_idx_unq", "pos"])
    best = counts.groupBy("alias").agg(F.min_by("qid", F.struct((-F.col("n")).alias("n"), "qid")).alias("qid"))
    return best.select("alias", "qid")


def p5_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Mentions per alias whose qid is among the alias's candidates: a join on a skewed key, summed per alias."""
    mentions, scratch = _mentions(spark, d), Scratch(spark, "p5")
    loads = measure(mentions, "alias", scratch)
    plan = plan_balance(loads, "alias", parallelism(spark))
    sets = table(spark, d, "candidate").where("qid is not null and alias is not null").groupBy(fold_alias("alias").alias("alias")).agg(F.collect_set(key("qid")).alias("candidates"))
    joined = balanced_join(mentions, sets, "alias", plan, "left", ["sent_idx_unq", "pos"])
    hit = F.coalesce(F.array_contains("candidates", F.col("qid")), F.lit(False))
    return joined.groupBy("alias").agg(F.count("*").alias("n_mentions"), F.count_if(F.coalesce(hit, F.lit(False))).alias("n_in_candidates"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_wide, p2_found, p2_claim_values, p2_qualifier_values, p2_row_counts, p4_found, p4_tree, p4_descendants, p5_found, p5_alias_qids, p5_qid_aliases, p5_candidates)}


_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_FOLD = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"

_READ = f"""
claims as (
  select nullif(upper(trim(r.qid)), '') as qid, d.property_id, d.datatype, d.cardinality, trim(r.value) as raw
  from entity_rels r join property_defs d on upper(trim(r.property_id)) = d.property_id
  where trim(r.value) <> '' and trim(r.qid) <> ''),
parts as (
  select *, regexp_extract_all(raw, '[Qq][0-9]+') as items,
    regexp_extract_all(raw, '[+-]?(?:[0-9]{{1,3}}(?:,[0-9]{{3}})+|[0-9]+)(?:\\.[0-9]+)?(?:[eE][+-]?[0-9]+)?') as numbers,
    list_filter(list_transform(regexp_extract_all(raw, '[0-9]+[-/.][0-9]{{1,2}}[-/.][0-9]+'), lambda x: try_cast(
      case when length(regexp_split_to_array(x, '[-/.]')[3]) >= 4
        then regexp_split_to_array(x, '[-/.]')[3] || '-' || regexp_split_to_array(x, '[-/.]')[2] || '-' || regexp_split_to_array(x, '[-/.]')[1]
        else replace(replace(x, '/', '-'), '.', '-') end as date)), lambda x: x is not null) as days
  from claims),
readings as (
  select qid, property_id, datatype, cardinality,
    case datatype when 'wikibase-item' then case when len(items) = 1 then upper(items[1]) end
      when 'quantity' then case when len(numbers) = 1 then cast(cast(replace(numbers[1], ',', '') as double) as varchar) end
      when 'time' then case when len(days) = 1 then cast(days[1] as varchar) end
      else raw end as reading
  from parts)"""


def _wide_sql() -> str:
    columns = []
    for pid, kind, single in _WIDE_COLUMNS:
        value = {"quantity": "try_cast(reading as double)", "time": "try_cast(reading as date)"}.get(kind, "reading")
        if single:
            columns.append(f"case when count(distinct reading) filter (property_id = '{pid}') = 1 then min({value}) filter (property_id = '{pid}') end as {pid}")
        else:
            text = "cast(cast(try_cast(reading as double) as decimal(30,3)) as varchar)" if kind == "quantity" else "reading"
            columns.append(f"string_agg(distinct {text}, '|' order by {text}) filter (property_id = '{pid}') as {pid}")
    return f"with {_READ} select qid, {', '.join(columns)} from readings group by qid"


#: The fixed table property_defs: property, datatype, single.
_WIDE_COLUMNS = [
    ("P31", "wikibase-item", False), ("P279", "wikibase-item", False), ("P7361", "wikibase-item", False), ("P106", "wikibase-item", False),
    ("P7101", "wikibase-item", True), ("P7102", "wikibase-item", True), ("P7103", "wikibase-item", True), ("P7104", "wikibase-item", False),
    ("P7201", "quantity", True), ("P7202", "quantity", True), ("P7203", "quantity", False), ("P7301", "time", True),
    ("P7302", "time", True), ("P7303", "time", False), ("P7401", "string", True), ("P7402", "string", False),
]

_LINKS_SQL = """
links as (
  select property_id, qid, min(parent) as parent from (
    select upper(trim(property_id)) as property_id, upper(trim(qid)) as qid, upper(regexp_extract_all(value, '[Qq][0-9]+')[1]) as parent
    from entity_rels where upper(trim(property_id)) in ('P279', 'P7361') and len(regexp_extract_all(value, '[Qq][0-9]+')) = 1 and trim(qid) <> '')
  group by property_id, qid),
tops as (
  select distinct l.property_id, l.parent as qid from links l
  where not exists (select 1 from links m where m.property_id = l.property_id and m.qid = l.parent)),
down as (
  select property_id, qid, qid as root, 0 as depth, qid as path from tops
  union all
  select l.property_id, l.qid, d.root, d.depth + 1, d.path || ' > ' || l.qid from down d join links l on l.property_id = d.property_id and l.parent = d.qid)"""

#: The leaves of a raw value.
_LEAVES = ", ".join(
    f"json_extract_string(try_cast({{0}} as json), '{path}') as {name}"
    for path, name in (("$.type", "value_type"), ("$.value.id", "item"), ("$.value.amount", "amount"), ("$.value.time", "time"), ("$.value.text", "text"), ("$.value.language", "language"))
) + ", cast(json_extract_string(try_cast({0} as json), '$.value.latitude') as double) as latitude, case when json_type(try_cast({0} as json), '$.value') <> 'OBJECT' then json_extract_string(try_cast({0} as json), '$.value') end as plain"

_MENTIONS_SQL = f"""
m as (
  select {_FOLD.format("aliases[i]")} as alias, nullif(nullif(upper(trim(qids[i])), '-1'), '') as qid
  from (select aliases, qids, unnest(range(1, len(aliases) + 1)) as i from sentences) where aliases[i] is not null)"""


def oracle_sql() -> dict[str, str]:
    line_items = "select line_no, id as qid, claims, sitelinks from preprocess_dump where type = 'item' and id is not null"
    counting = "{0}.snaktype = 'value' and {0}.datavalue is not null"
    claims = f"select qid, unnest(flatten(map_values(claims))) as c from ({line_items})"
    return {
        "p1_found": f"""with {_READ}
            select qid, property_id from readings where cardinality = 'single'
            group by qid, property_id having count(distinct reading) <> 1""",
        "p1_wide": _wide_sql(),
        "p2_claim_values": f"""select line_no || '/claims:' || p || ':' || i as row_id, cast(line_no as varchar) as parent_id, i as ordinal, p as map_key, {_LEAVES.format("claims[p][i + 1].mainsnak.datavalue")}
            from (select line_no, claims, p, unnest(range(0, len(claims[p]))) as i from (select line_no, claims, unnest(map_keys(claims)) as p from preprocess_dump))""",
        "p2_qualifier_values": f"""with c as (select line_no || '/claims:' || p || ':' || i as parent_id, claims[p][i + 1].qualifiers as q from (select line_no, claims, p, unnest(range(0, len(claims[p]))) as i from (select line_no, claims, unnest(map_keys(claims)) as p from preprocess_dump)))
            select parent_id || '/qualifiers:' || p || ':' || i as row_id, parent_id, i as ordinal, p as map_key, {_LEAVES.format("q[p][i + 1].datavalue")}
            from (select parent_id, q, p, unnest(range(0, len(q[p]))) as i from (select parent_id, q, unnest(map_keys(q)) as p from c))""",
        "p2_row_counts": """select 'line' as flat_table, count(*) as n from preprocess_dump
            union all select 'line_aliases', coalesce(sum(len(a)), 0)::bigint from (select unnest(map_values(aliases)) as a from preprocess_dump)
            union all select 'line_claims', coalesce(sum(len(a)), 0)::bigint from (select unnest(map_values(claims)) as a from preprocess_dump)
            union all select 'line_claims_qualifiers', coalesce(sum(len(q)), 0)::bigint from (select unnest(map_values(c.qualifiers)) as q from (select unnest(flatten(map_values(claims))) as c from preprocess_dump))
            union all select 'line_descriptions', coalesce(sum(cardinality(descriptions)), 0)::bigint from preprocess_dump
            union all select 'line_labels', coalesce(sum(cardinality(labels)), 0)::bigint from preprocess_dump
            union all select 'line_sitelinks', coalesce(sum(cardinality(sitelinks)), 0)::bigint from preprocess_dump""",
        "p2_found": f"""with claim as (select qid, c from ({claims}) where c.id is not null and {counting.format("c.mainsnak")})
            select distinct qid, 'claim' as child_kind, qid as parent_id, c.id as child_id from claim
            union select distinct qid, 'qualifier', parent, q.hash from (select qid, c.id as parent, unnest(flatten(map_values(c.qualifiers))) as q from claim)
              where q.hash is not null and {counting.format("q")}
            union select distinct qid, 'sitelink', qid, k from (select qid, sitelinks, unnest(map_keys(sitelinks)) as k from ({line_items}))
              where trim(sitelinks[k].title) <> ''""",
        "p4_found": f"""with recursive {_LINKS_SQL}
            select l.property_id, l.qid, coalesce(d.root, '-1') as root_qid from links l left join down d on d.property_id = l.property_id and d.qid = l.qid""",
        "p4_tree": f"""with recursive {_LINKS_SQL},
            nodes as (select property_id, qid from links union select property_id, parent from links),
            below as (select property_id, a as qid, count(*) as n from (select property_id, qid, unnest(list_slice(string_split(path, ' > '), 1, -2)) as a from down) group by all)
            select n.property_id, n.qid, d.root, cast(d.depth as bigint) as depth, case when d.root is not null then coalesce(b.n, 0) end as n_descendants, d.path, d.root is null as cyclic
            from nodes n left join down d on d.property_id = n.property_id and d.qid = n.qid left join below b on b.property_id = n.property_id and b.qid = n.qid""",
        "p4_descendants": f"""with recursive {_LINKS_SQL},
            up as (select property_id, qid, depth, string_split(path, ' > ') as p, unnest(range(1, depth + 1)) as i from down)
            select property_id, p[i] as ancestor, qid as descendant, cast(depth + 1 - i as bigint) as distance from up""",
        "p5_found": f"""with {_MENTIONS_SQL},
            large as (select alias from m group by alias having count(*) >= 0.025 * (select count(*) from m)),
            n as (select alias, qid, count(*) as n from m where qid is not null and alias in (select alias from large) group by all)
            select alias, qid from n qualify row_number() over (partition by alias order by n desc, qid) = 1""",
        "p5_alias_qids": f"""with {_MENTIONS_SQL}
            select alias, n_key, qid, n from (select alias, qid, count(*) as n from m where qid is not null group by all)
            join (select alias, count(*) as n_key from m group by alias) using (alias)""",
        "p5_qid_aliases": f"""with {_MENTIONS_SQL}
            select qid, n_key, alias, n from (select qid, alias, count(*) as n from m where qid is not null group by all)
            join (select qid, count(*) as n_key from m where qid is not null group by qid) using (qid)""",
        "p5_candidates": f"""with {_MENTIONS_SQL},
            c as (select distinct {_FOLD.format("alias")} as alias, upper(trim(qid)) as qid, 1 as hit from candidate where qid is not null and alias is not null)
            select m.alias, count(*) as n_mentions, count(c.hit) as n_in_candidates from m left join c on c.alias = m.alias and c.qid = m.qid group by m.alias""",
    }
