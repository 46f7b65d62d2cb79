"""Wide tables, nested records, hierarchies and balanced joins against plain Python, with dirty and empty input."""

from __future__ import annotations

import datetime as dt
import random
import shutil
from collections import Counter

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from loomspan.functions import readings
from loomspan.functions.text import fold_alias, fold_title, key, known_qid, strip, words
from loomspan.operators.hierarchy import descent, hierarchy, other_links, paths
from loomspan.operators.nested import json_fields, shred
from loomspan.operators.skew import balanced_join, fragment, lookup, measure, placed, plan_balance, value_counts
from loomspan.operators.wide import CELL_LIMIT, cell_states, long_values, widen
from loomspan.plans import general

DEFS = [("P1", "item", "wikibase-item", "single"), ("P2", "n", "quantity", "single"), ("P3", "t", "time", "single"), ("P4", "s", "string", "single"), ("P5", "ns", "quantity", "many"), ("p6 ", "ss", "string", "many")]


def defs(spark):
    return spark.createDataFrame(DEFS, "property_id string, label string, datatype string, cardinality string")


def claims(spark, rows):
    return spark.createDataFrame(rows, "qid string, property_id string, value string")


def test_text_keys(spark):
    rows = [(None,), ("",), ("  \t",), (" Q7 ",), ("-1",), ("A#b_c",), ("  Foo_ \n BAR#x#y",)]
    got = spark.createDataFrame(rows, "v string").select(strip("v").alias("s"), key("v").alias("k"), known_qid("v").alias("q"), fold_alias("v").alias("a"), fold_title("v").alias("t")).collect()
    assert [r.s for r in got][:4] == [None, "", "", "Q7"]
    assert [r.k for r in got][:4] == [None, None, None, "Q7"]
    assert [r.q for r in got][3:5] == ["Q7", None]
    assert got[6].a == "foo_ bar#x#y" and got[6].t == "foo bar"


def test_words():
    assert words("Ünï-code’s  4.5_x ½ ȩ́ Ⅳ ٣") == ["unicodes", "45x", "e", "٣"]
    assert words(None) == words("") == words(" !! ") == []


@pytest.mark.parametrize(
    ("datatype", "raw", "want"),
    [
        ("wikibase-item", "<q12>", "Q12"), ("wikibase-item", "Q1 Q2", None), ("wikibase-item", "Q-1", None), ("wikibase-item", "Q", None),
        ("quantity", "+3,878,532", 3878532.0), ("quantity", '{"amount": "-4.50"}', -4.5), ("quantity", "3.767E+02", 376.7), ("quantity", "1 2", None), ("quantity", "--", None), ("quantity", "1e400", float("inf")),
        ("time", "+1735-06-23T00:00:00Z", dt.date(1735, 6, 23)), ("time", "21.06.1941", dt.date(1941, 6, 21)), ("time", "1709/11/07", dt.date(1709, 11, 7)), ("time", "1999-02-30", None), ("time", "0", None), ("time", "1999-01-01 2000-01-01", None),
        ("string", " a b ", "a b"),
    ],
)
def test_readings(spark, datatype, raw, want):
    got = spark.createDataFrame([(raw, datatype)], "v string, d string").select(readings.canonical(F.col("v"), F.col("d")).alias("r")).first().r
    if want is None or isinstance(want, str):
        assert got == want
    elif isinstance(want, dt.date):
        assert got == want.isoformat()
    else:
        assert float(got) == want


def test_widen(spark):
    rows = [
        ("Q1", "P1", "Q5"), (" q1", "p1", "<q5>"), ("Q1", "P2", "1,000"), ("Q1", "P2", "1e3"), ("Q1", "P3", "1.2.2000"), ("Q1", "P3", "2000-02-02"), ("Q1", "P4", "?"), ("Q1", "P5", "2"), ("Q1", "P5", "2.0"), ("Q1", "P5", "x"), ("Q1", "P6", "b"), ("Q1", "P6", " a"),
        ("Q2", "P2", "none"), ("Q2", "P5", "none"), ("Q2", "P9", "1"), (None, "P1", "Q1"), ("Q3", None, "Q1"), ("Q3", "P1", None), ("Q3", "P1", " "), ("", "P1", "Q1"),
    ]
    df = claims(spark, rows + rows).withColumn("chunk", F.lit("clash")).withColumn("col", F.lit(1)).withColumn("reading", F.lit("x"))
    wide = widen(df, defs(spark))
    got = {r.qid: r for r in wide.collect()}
    assert set(got) == {"Q1", "Q2"}
    a, b = got["Q1"], got["Q2"]
    assert (a.P1, a.P2, a.P3, a.P4, a.P5, a.P6) == ("Q5", 1000.0, None, "?", [2.0], ["a", "b"])
    assert (a.P1__state, a.P3__state, a.P5__state, b.P2__state, b.P5__state, b.P1__state) == ("ok", "conflict", "ok", "unread", "unread", None)
    states = {tuple(r) for r in cell_states(wide).collect()}
    assert ("Q1", "P3", "conflict") in states and ("Q2", "P2", "unread") in states and len(states) == 5


@pytest.mark.parametrize("limit", [1, 40, 998])
def test_widen_large_cell(spark, limit):
    """Every entity has one row; a cell beyond the limit is told, and its values are rows: nothing is lost."""
    rows = [("Q1", "P5", str(i)) for i in range(500)] + [("Q1", "P5", "?"), ("Q1", "P4", "x"), ("Q2", "P5", "1"), ("Q2", "P6", "a")]
    df = claims(spark, rows + rows)
    got = {r.qid: r for r in widen(df, defs(spark), cell_limit=limit).collect()}
    assert set(got) == {"Q1", "Q2"} and got["Q1"].P4 == "x" and got["Q2"].P5 == [1.0] and got["Q2"].P6 == ["a"]
    apart = [float(r.reading) for r in long_values(df, defs(spark), cell_limit=limit).collect()]
    assert got["Q1"].P5__state == ("long" if limit < 500 else "ok")
    assert sorted([*apart, *(got["Q1"].P5 or [])]) == [float(i) for i in range(500)]


def test_number_keys(spark):
    """Equal numbers share a key, different ones never do."""
    groups = [["1000", "1,000", "1e3", "+1000.0", "10E+2"], ["1e-16", "0.0000000000000001"], ["2e-16"], ["0.12345678901234561"], ["0.12345678901234562"], ["0", "-0.00", "0e7"], ["-1", "-1.0"], ["1", "001"], ["1e400"], ["1e401", "10e400"]]
    rows = [(i, x) for i, g in enumerate(groups) for x in g]
    got = spark.createDataFrame(rows, "g int, v string").select("g", readings.number_key(F.col("v")).alias("k")).collect()
    assert len({(r.g, r.k) for r in got}) == len({r.k for r in got}) == len(groups)


def test_widen_empty_and_clashing(spark):
    empty = widen(claims(spark, []), defs(spark))
    assert empty.count() == 0 and "P1__state" in empty.columns
    none = widen(claims(spark, [("Q1", "P1", "Q2")]), defs(spark).limit(0))
    assert none.collect()[0].qid == "Q1" and cell_states(_marked(none)).count() == 0
    names = spark.createDataFrame([("QID", "x", "string", "single"), ("CODE", "y", "string", "many"), (None, "z", "string", "single")], defs(spark).schema)
    got = widen(claims(spark, [("Q1", "qid", "v"), ("Q1", "code", "w")]), names).first()
    assert got["QID_"] == "v" and got["CODE"] == ["w"]


def _marked(df):
    df._properties = []
    return df


def test_shred(spark):
    schema = "k long, s struct<a:int,b:struct<c:string>>, items array<struct<id:string,subs:array<int>,m:map<string,array<struct<h:string>>>>>, m map<string,struct<t:string>>, row_id string, deep array<array<int>>"
    rows = [
        (1, (1, ("x",)), [("i0", [7, 8], {"p": [("h1",), ("h2",)], "q": None}), None, ("i2", None, None)], {"en": ("T",), "de": None}, "clash", [[1], [], None, [2, 3]]),
        (2, None, [], None, None, None), (3, (None, None), None, {}, None, []), (None, None, [("lost", None, None)], None, None, None),
    ]
    t = shred(spark.createDataFrame(rows, schema), "k", "r")
    assert set(t) == {"r", "r_items", "r_items_subs", "r_items_m", "r_m", "r_deep", "r_deep_items"}
    root = {r.row_id: r for r in t["r"].collect()}
    assert set(root) == {"1", "2", "3"} and root["1"]["row_id_"] == "clash" and root["1"]["s_b_c"] == "x"
    items = {r.row_id: r for r in t["r_items"].collect()}
    assert {(r.parent_id, r.ordinal, r.id) for r in items.values()} == {("1", 0, "i0"), ("1", 1, None), ("1", 2, "i2")}
    assert {(r.parent_id, r.ordinal, r.value) for r in t["r_items_subs"].collect()} == {("1/items:0", 0, 7), ("1/items:0", 1, 8)}
    assert {(r.parent_id, r.map_key, r.ordinal, r.h) for r in t["r_items_m"].collect()} == {("1/items:0", "p", 0, "h1"), ("1/items:0", "p", 1, "h2")}
    assert {(r.map_key, r.t) for r in t["r_m"].collect()} == {("en", "T"), ("de", None)}
    assert sorted(r.value for r in t["r_deep_items"].collect()) == [1, 2, 3]
    for name, child in t.items():
        ids = [r.row_id for r in child.collect()]
        assert len(ids) == len(set(ids)), name
    assert all(x.count() == 0 for x in shred(spark.createDataFrame([], schema), "k", "r").values())


def test_shred_keys_and_carried(spark):
    """A key can't pass for a path; columns of ancestors travel down, clashing names or not."""
    schema = "k string, kind string, m map<string,array<struct<id:string,r__kind:string,subs:map<string,string>>>>"
    t = shred(spark.createDataFrame([("a", "x", {"p": [("i", "own", {"q": "v"})], "p:0/subs:q": [("j", None, None)]}), ("a/m:p:0", "y", None)], schema), "k", "r", {"r": ["kind"], "r_m": ["id"]})
    ids = [r.row_id for x in t.values() for r in x.collect()]
    assert len(ids) == len(set(ids)) == 5
    assert {(r.id, r["r__kind"], r["r__kind_"]) for r in t["r_m"].collect()} == {("i", "x", "own"), ("j", "x", None)}
    assert [(r.map_key, r.value, r["r__kind"], r["r_m__id"]) for r in t["r_m_subs"].collect()] == [("q", "v", "x", "i")]


def test_json_fields(spark):
    rows = [('{"t": "a", "v": "plain"}',), ('{"t": "b", "v": {"c d": "x", "n": {"k": 1}}}',), ('{"v": [1, 2], "it\'s": true}',), ("broken{",), (None,), ("[1]",)]
    df = spark.createDataFrame(rows, "j string")
    got = [r.asDict() for r in df.select(*[c.cast("string").alias(n) for n, c in json_fields(df, F.col("j"))]).collect()]
    assert set(got[0]) == {"t", "v", "v_c d", "v_n_k", "it's"}
    assert (got[0]["t"], got[0]["v"]) == ("a", "plain") and (got[1]["v"], got[1]["v_c d"], got[1]["v_n_k"]) == (None, "x", "1") and got[2]["v"] == "[1,2]"
    assert all(x is None for r in got[3:] for x in r.values())
    assert json_fields(df.limit(0), F.col("j")) == []


def test_hierarchy(spark, scratch):
    rng = random.Random(3)
    rows = [("a", f"n{i}", f"n{rng.randrange(max(0, i - 3) if i % 2 else 0, i)}") for i in range(1, 120)] + [("b", f"m{i}", f"m{i - 1}") for i in range(1, 40)]
    rows += [("b", "x", "y"), ("b", "y", "z"), ("b", "z", "y"), ("b", "w", "x"), ("b", "q", "q"), ("b", None, "q"), ("b", "q", None), (None, "q", "r"), ("a", "two", "n3"), ("a", "two", "n1")]
    df = spark.createDataFrame(rows + rows[:20], "s string, c string, p string").withColumn("root", F.lit(1)).withColumn("id", F.lit("clash"))
    out = {(r.scope, r.node): r for r in hierarchy(df, scope="s", child="c", parent="p", scratch=scratch).collect()}
    parent: dict = {}
    for s, c, p in rows:
        if s and c and p:
            parent[s, c] = min(p, parent.get((s, c), p))
    up = {}
    for k in out:
        seen = [k[1]]
        while (k[0], seen[-1]) in parent and parent[k[0], seen[-1]] not in seen:
            seen.append(parent[k[0], seen[-1]])
        if (k[0], seen[-1]) not in parent:
            up[k] = seen
    assert {k for k, r in out.items() if r.cyclic} == set(out) - set(up)
    size = Counter((k[0], x) for k, u in up.items() for x in u)
    for k, u in up.items():
        r = out[k]
        assert (r.root, r.depth, r.size, r.hi) == (u[-1], len(u) - 1, size[k], r.lo + r.size - 1)
    nested = spark.createDataFrame(list(out.values()), "scope string, node string, parent string, root string, depth int, size long, lo long, hi long, cyclic boolean")
    pairs = [tuple(r) for r in descent(nested).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(k[0], a, k[1], i + 1) for k, u in up.items() for i, a in enumerate(u[1:])}
    got = {(r.scope, r.node): r.path for r in paths(nested).collect()}
    assert all(got[k] == " > ".join(reversed(u)) for k, u in up.items()) and got["b", "y"] is None
    assert [tuple(r) for r in other_links(df, scope="s", child="c", parent="p").collect()] == [("a", "two", "n3")]


@pytest.mark.parametrize("blocks", [(1,), (1, 2, 8), (1, 16, 256, 4096)])
def test_descent_blocks(spark, scratch, monkeypatch, blocks):
    """Each pair once, whatever the sizes of the blocks, none with more points than the largest."""
    monkeypatch.setattr("loomspan.operators.hierarchy.BLOCKS", blocks)
    rows = [("a", f"n{i}", f"n{i // 3}") for i in range(1, 300)]
    nested = scratch.save(hierarchy(spark.createDataFrame(rows, "s string, c string, p string"), scope="s", child="c", parent="p", scratch=scratch))
    want = set()
    for i in range(1, 300):
        j, k = i, 0
        while j:
            j, k = j // 3, k + 1
            want.add((f"n{j}", f"n{i}", k))
    got = [(r.ancestor, r.descendant, r.distance) for r in descent(nested).collect()]
    assert len(got) == len(want) and set(got) == want


def test_hierarchy_empty(spark, scratch):
    df = spark.createDataFrame([("a", None, "x")], "s string, c string, p string")
    assert hierarchy(df, scope="s", child="c", parent="p", scratch=scratch).count() == 0
    loop = spark.createDataFrame([("a", "x", "x")], "s string, c string, p string")
    assert [r.cyclic for r in hierarchy(loop, scope="s", child="c", parent="p", scratch=scratch).collect()] == [True]


def test_wide_family(spark, scratch, monkeypatch):
    """A parent with many children is numbered in slices, without gaps."""
    monkeypatch.setattr("loomspan.operators.hierarchy.SLICE", 10)
    df = spark.createDataFrame([("a", f"c{i}", "top") for i in range(95)] + [("a", "g", "c7")], "s string, c string, p string")
    out = hierarchy(df, scope="s", child="c", parent="p", scratch=scratch).collect()
    assert sorted(r.lo for r in out) == list(range(97))
    by = {r.node: r for r in out}
    assert by["c7"].lo < by["g"].lo <= by["c7"].hi


def test_balance(spark, scratch):
    rng = random.Random(5)
    keys = ["hot"] * 500 + [f"k{rng.randrange(60)}" for _ in range(500)] + [None] * 7
    left = spark.createDataFrame([(i, k, f"v{i % 3}") for i, k in enumerate(keys)], "id long, k string, v string").withColumn("_task0", F.lit(1))
    right = spark.createDataFrame([("hot", "a", 1), ("hot", "b", 2), ("k1", "c", 3), ("zz", "d", 4), (None, "e", 5)], "k string, v string, n long")
    loads = measure(left, "k", scratch)
    plan = plan_balance(loads, "k", 4)
    assert max(plan.loads) <= 1.5 * 1000 / 4 and plan.split.count() >= 1
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = balanced_join(left, right, "k", plan, how, ["id"])
        want = left.join(right.withColumnRenamed("v", "v_right"), "k", how)
        assert Counter(map(tuple, got.select(sorted(got.columns)).collect())) == Counter(map(tuple, want.select(sorted(want.columns)).collect())), how
    counts = {(r.k, r.v): (r.n_key, r.n) for r in value_counts(left, "k", "v", loads, plan, ["id"]).collect()}
    want = Counter((k, f"v{i % 3}") for i, k in enumerate(keys) if k)
    total = Counter(k for k in keys if k)
    assert counts == {k: (total[k[0]], n) for k, n in want.items()}


def test_balance_is_obeyed(spark, scratch):
    """Partitions are the planned tasks: none has over 1.2 times the mean, though one key has half of all rows, and the
    join shuffles though its other side is tiny."""
    left = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 900)).alias("k"))
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    plan = plan_balance(measure(left, "k", scratch), "k", 8)
    keyed = left.where("k is not null")
    parts = [r["count"] for r in placed(fragment(keyed, "k", plan, ["id"]), plan).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(parts) == 8 and max(parts) <= 1.2 * sum(parts) / 8
    out = balanced_join(left, right, "k", plan, "left", ["id"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) <= 1.2 * sum(sizes) / 8
    seen = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in seen and out.where("n is null").count() == left.where("k is null").count()


def test_balance_empty(spark, scratch):
    left = spark.createDataFrame([], "id long, k string, v string")
    plan = plan_balance(measure(left, "k", scratch), "k", 3)
    assert balanced_join(left, left.select("k", F.lit(1).alias("x")), "k", plan).count() == 0


def test_lookup(spark, monkeypatch):
    rows = [("h",)] * 300 + [(f"k{i}",) for i in range(20)] + [(None,)]
    left, right = spark.createDataFrame(rows, "k string"), spark.createDataFrame([("h", 1), ("k3", 2), ("no", 3)], "k string, x int")
    monkeypatch.setattr("loomspan.operators.skew.SMALL", 100)
    for n in (None, 1000, 50):
        got = Counter((r.k, r.x) for r in lookup(left, right, "k", n).collect())
        assert got == Counter((k, {"h": 1, "k3": 2}.get(k)) for (k,) in rows)



def test_scratch_is_freed(spark):
    """Tables since a mark are deleted, those before it stay."""
    from pathlib import Path
    from urllib.parse import urlparse

    from loomspan.scratch import Scratch, free, mark

    first = Scratch(spark, "first")
    kept = first.save(spark.range(3))
    at, second = mark(), Scratch(spark, "second")
    second.save(spark.range(3))
    free(at)
    assert kept.count() == 3 and not Path(urlparse(second.root).path).exists() and Path(urlparse(first.root).path).exists()


def test_wide_has_long_cells(spark, sf_dir, tmp_path):
    """The wide table agrees with its SQL where cells have more values than widen holds in a row, or values equal as text."""
    shutil.copy(f"{sf_dir}/property_defs.parquet", tmp_path)
    n = CELL_LIMIT + 2
    rows = [(q, p, v) for i in range(n) for q, p, v in (("Q1", "P31", f"Q{i}"), ("Q1", "P7203", f"{i}.25"), ("Q1", "P7303", f"{1000 + i}-01-02"), ("Q2", "P7402", f"a{i}"))]
    rows += [("Q2", "P7203", "1.0001"), ("Q2", "P7203", "1.0004"), ("Q2", "P31", "Q7"), ("Q1", "P7401", "one"), ("Q3", "P31", "Q1")]
    spark.createDataFrame(rows, "qid string, property_id string, value string").coalesce(1).write.parquet(str(tmp_path / "entity_rels.parquet"))
    got = general.p1_wide(spark, str(tmp_path))
    assert compare(got, connect(str(tmp_path)), general.oracle_sql()["p1_wide"]) == ""
    assert len(got.where("qid = 'Q1'").first().P31.split("|")) == n
