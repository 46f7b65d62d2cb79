"""Corpus records, weak labels, recall runs, slice symbols and small files, with dirty and empty input."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomspan.functions import normal as N
from loomspan.functions import registry
from loomspan.functions.languages import CHINESE, ENGLISH, HEBREW
from loomspan.operators import benchmarks as B
from loomspan.operators import labelling as L
from loomspan.operators.symbols import SliceSymbols
from loomspan.sources import corpora, files


def test_first_last(spark):
    """The built-in form says what Language.name_parts says, brackets aside."""
    names = ["Homer Simpson", "Dr. Ann B. Lee", "", "  ", "Mr.", "Cher", "ann lee jr.", "א ב-ג ד", "王 明"]
    df = spark.createDataFrame([(x,) for x in [*names, None]], "n string")
    for language in (ENGLISH, HEBREW, CHINESE):
        got = {r.n: tuple(r.p) for r in df.select("n", N.first_last(F.col("n"), language).alias("p")).collect() if r.n is not None}
        assert got == {x: language.name_parts(x) for x in names}
    assert tuple(spark.createDataFrame([("Ann Lee (choir)",)], "n string").select(N.first_last(F.col("n")).alias("p")).first().p) == ("Ann", "Lee")


def test_referenced_lines(spark):
    lines = [("f", 0, "Ann met Bob."), ("f", 1, ""), ("f", 2, "Bob, Ann -- and Bob!"), ("g", 0, None), ("g", 1, "x")]
    refs = [("f", "Bob", 8, "Q2"), ("f", "Ann", 0, "Q1"), ("f", "Bob", 12, "Q2"), ("f", "Bob", 28, "Q3"), ("f", "Zoe", 13, "Q4"), ("f", "Ann", 17, None), ("f", None, 1, "Q1"), ("h", "Ann", 0, "Q1"), ("g", "x", 99, "Q1")]
    sents, marks = corpora.referenced_lines(spark.createDataFrame(lines, "file string, n int, line string"), spark.createDataFrame(refs, "file string, alias string, offset int, qid string"))
    assert {(r.file, r.n, r.sentence) for r in sents.collect()} == {("f", 0, "Ann met Bob"), ("f", 2, "Bob Ann and Bob"), ("g", 1, "x")}
    assert {tuple(r) for r in marks.collect()} == {("f", 0, "ann", 0, 1, "Q1"), ("f", 0, "bob", 2, 3, "Q2"), ("f", 2, "bob", 0, 1, "Q2"), ("f", 2, "bob", 3, 4, "Q3")}
    out = corpora.records(sents, marks, ["file", "n"]).orderBy("sent_idx").collect()
    assert [(r.sent_idx, r.aliases, r.spans, r.gold) for r in out] == [("0", ["ann", "bob"], ["0:1", "2:3"], [True, True]), ("1", ["bob", "bob"], ["0:1", "3:4"], [True, True])]
    assert corpora.records(sents, marks.limit(0), ["file", "n"]).count() == 0


def test_document_scope(spark):
    sents = spark.createDataFrame([("d", 1, ["a", "b"]), ("d", 4, ["c"]), ("e", 1, [])], "doc_id string, sent long, tokens array<string>")
    marks = spark.createDataFrame([("d", 4, 0, 1, "c"), ("d", 1, 1, 2, "b")], "doc_id string, sent long, start int, end int, alias string")
    whole, moved = corpora.document_scope(sents, marks)
    assert {(r.doc_id, tuple(r.tokens)) for r in whole.collect()} == {("d", ("a", "b", "c")), ("e", ())}
    assert {(r.alias, r.sent, r.start, r.end) for r in moved.collect()} == {("c", 0, 2, 3), ("b", 0, 1, 2)}


def test_concept_alias_counts(spark):
    m = spark.createDataFrame([("1", "Ann", "C1"), ("1", "Ann", " C1 "), ("2", "Anny", "C1"), ("1", "?", "C2"), ("1", None, "C1"), ("1", "x", None)], "pmid string, alias string, cid string")
    c = spark.createDataFrame([("C1", ["ann", "a"]), ("C3", ["z"]), ("C2", None)], "concept_id string, aliases array<string>")
    got = {(r.alias, r.qid): r.n for r in corpora.concept_alias_counts(m, c, spark.createDataFrame([("1",), ("1",)], "pmid string")).collect()}
    assert got == {("ann", "QC1"): 4 + 2, ("a", "QC1"): 4}
    assert corpora.concept_alias_counts(m.limit(0), c, m.select("pmid").limit(0)).count() == 0


def test_type_dump(spark):
    e = spark.createDataFrame([(1, 0, "Q1", ["b", "a"]), (1, 1, "Q2", []), (2, 0, "Q1", ["c", None, "b"]), (3, 0, "Q3", None)], "doc int, pos int, qid string, types array<string>")
    types, of = corpora.type_dump(e)
    assert {r.type: r.type_id for r in types.collect()} == {"b": 0, "a": 1, "c": 2}
    assert {r.qid: list(r.type_ids) for r in of.collect()} == {"Q1": [2, 0], "Q2": [], "Q3": []}
    assert all(x.count() == 0 for x in corpora.type_dump(e.limit(0)))


def test_refreshed_titles(spark):
    asked = spark.createDataFrame([("A", 1), ("B", None), ("C", 9), ("D", 8), (None, 1)], "title string, id long")
    current = spark.createDataFrame([(1, "A2"), (2, "B"), (3, "E"), (None, "F"), (4, None)], "id long, title string")
    red = spark.createDataFrame([("C", "E"), ("C", "Zed"), ("D", "gone")], "source string, target string")
    got = {r.title: (r.now, r.how) for r in corpora.refreshed_titles(asked, current, red).collect()}
    assert got == {"A": ("A2", "id"), "B": ("B", "same"), "C": ("E", "redirect"), "D": (None, "deleted"), None: ("A2", "id")}


def test_small_files(spark, tmp_path):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(100)], "i int, t string").coalesce(1)
    n = files.write_by_size(df, str(tmp_path / "s"), "2K")
    assert 10 < n < 25 and len(list((tmp_path / "s").glob("*.json"))) == -(-100 // n)
    files.write_one(df.repartition(5), str(tmp_path / "o"))
    assert len(list((tmp_path / "o").glob("*.json"))) == 1
    files.write_json_map(spark.createDataFrame([("a", "1"), ("b", None), (None, "c")], "k string, v string"), str(tmp_path / "m"), "k", "v")
    assert {tuple(r) for r in files.load_json_map(spark, str(tmp_path / "m")).collect()} == {("a", "1"), ("b", None)}
    (tmp_path / "t").write_text('Q1 P1 a "b\\ c\nQ1 P2\n\n')
    assert [tuple(r) for r in files.space_triples(spark, str(tmp_path / "t")).collect()] == [("Q1", "P1", 'a "b\\ c'), ("Q1", "P2", None), ("", None, None)]
    (tmp_path / "u").write_text("u\tT\t5\nv\tS\t-1\nw\n")
    assert [tuple(r) for r in files.title_map_file(spark, str(tmp_path / "u")).collect()] == [("u", "T", 5), ("v", "S", None), ("w", None, None)]


def test_recall_run(spark):
    g = spark.createDataFrame([(1, 0, "a", "Q1", True), (1, 1, "a", "Q9", True), (1, 2, "a", "Q2", False), (2, 0, "a", "Q1", False), (3, 0, "zz", "Q1", True)], "sent_idx_unq int, pos int, alias string, qid string, gold boolean")
    c = spark.createDataFrame([("a", "Q1", 3), ("a", "Q2", 2), ("b", "Q1", 1)], "alias string, qid string, score long")
    run = B.recall_run(g, c)
    assert {(r.sent_idx_unq, r.pos) for r in run.kept.collect()} == {(1, 0), (1, 2)}
    assert {(r.sent_idx_unq, r.pos, r.outcome) for r in run.errors.collect()} == {(1, 1, "no_candidate"), (3, 0, "no_alias")}
    assert {tuple(r) for r in run.aliases.collect()} == {("a", "Q1", 3), ("a", "Q2", 2)}
    assert tuple(run.figures.first()) == (5, 4, 3, 0.6)
    assert B.recall_run(g.limit(0), c).kept.count() == 0
    asked = spark.createDataFrame([("m", "a x"), ("n", "b")], "mention string, alias string")
    assert {tuple(r) for r in B.GENERATORS["backoff"](asked, c, 1).collect()} == {("m", "Q1", 1), ("n", "Q1", 1)}
    assert [tuple(r) for r in B.GENERATORS["standard"](asked, c, 5).collect()] == [("n", "Q1", 1)]


@pytest.mark.parametrize("permute", [False, True])
def test_weak_labels(spark, permute):
    rng = random.Random(12)
    vocabulary = ["ann", "lee", "lake", "big", "ran", "of"]
    own = [("d0", "ann lee", "Q1"), ("d0", "ann", "Q1"), ("d0", "lee", "Q1"), ("d1", "big lake", "Q2"), ("d1", "lake", "Q2")]
    sents = [(i, f"d{i % 3}", " ".join(rng.choice(vocabulary) for _ in range(12))) for i in range(40)] + [(90, "d0", None), (91, None, "ann lee"), (92, "d0", "")]
    given = [(i, 0, len(t.split()[0]), t.split()[0], "Q7") for i, _, t in sents[:20]] + [(1, None, None, "x", None), (90, 0, 3, "ann", "Q1")]
    ranked = [("ann", "Q1", 1), ("ann", "Q5", 2), ("lee", "Q1", 1), ("big lake", "Q2", 1)]
    frame = lambda rows, s: spark.createDataFrame(rows, s)
    out = L.weak_labels(
        frame(sents, "sent int, doc string, sentence string"), frame(given, "sent int, start int, end int, alias string, qid string"), frame(own, "doc string, alias string, qid string"),
        frame(ranked, "alias string, qid string, rank int"), most_words=3, permute=permute,
    ).collect()
    assert len(out) == len(sents)
    for r in out:
        _, doc, text = next(s for s in sents if s[0] == r.sent)
        marks = [(s, e, "gold", q, a) for i, s, e, a, q in given if i == r.sent]
        aliases = {a: q for d, a, q in own if d == doc}
        words, at = (text or "").split(" "), 0
        starts = []
        for w in words:
            starts.append(at)
            at += len(w) + 1
        for n in (3, 2, 1):
            for i in range(len(words) - n + 1):
                name = " ".join(words[i : i + n])
                s, e = starts[i], starts[i] + len(name)
                if name in aliases and all(m[0] is None or m[1] <= s or e <= m[0] for m in marks):
                    marks.append((s, e, "aka", aliases[name], name))
        marks.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1] or 0, m[2]))
        assert [(x[0], x[1], s, q, a) for x, s, q, a in zip(r.char_spans, r.sources, r.qids, r.unswap_aliases, strict=True)] == marks
        assert list(r.gold) == [m[2] == "gold" for m in marks]
        want = ["ann" if permute and m[3] == "Q1" else "big lake" if permute and m[3] == "Q2" else m[4] for m in marks]
        assert list(r.aliases) == want


def test_labeller_names():
    with pytest.raises(ValueError, match="gold"):

        @L.labelling_function
        def gold(given):
            return given


def test_slice_symbols(spark, tmp_path):
    frame = spark.createDataFrame
    m, c = frame([("Q1",), ("Q1",), (None,)], "qid string"), frame([("a", "Q1", 2), ("a", "Q2", 5)], "alias string, qid string, score long")
    typed = frame([("Q1", "t2", 2), ("Q1", "t1", 1)], "qid string, type string, rank int")
    rel = frame([("Q1", "Q2", "r2"), ("Q1", "Q2", "r1"), ("Q2", "Q1", "r0")], "head string, tail string, rel string")
    words = frame([("Q1", "x"), ("Q1", "x"), ("Q1", "y"), ("Q2", "z"), ("Q1", None)], "qid string, word string")
    s = SliceSymbols.build(m, c, {"none": typed.limit(0), "some": typed}, rel.select(F.col("head").alias("qid"), F.col("tail").alias("neighbour")), rel, words, 1)
    s.save(str(tmp_path / "s"))
    s = SliceSymbols.load(spark, str(tmp_path / "s"), ["none", "some"])
    asked = frame([("Q1",), ("Q2",), ("Q2",)], "qid string")
    assert {r.qid: r.n for r in s.qid_counts(asked).collect()} == {"Q1": 2, "Q2": 0}
    assert {r.qid: list(r.types) for r in s.types(asked, "some").collect()} == {"Q1": ["t1"], "Q2": []}
    assert all(list(r.types) == [] for r in s.types(asked, "unknown").collect())
    assert {tuple(r) for r in s.is_typed(asked).collect()} == {("Q1", False, True), ("Q2", False, False)}
    assert {tuple(r) for r in s.relation(frame([("Q1", "Q2"), ("Q2", "Q1"), ("Q1", "Q1")], "a string, b string")).collect()} == {("Q1", "Q2", "r1", 3), ("Q2", "Q1", "r0", 3)}
    assert {tuple(r) for r in s.bags.collect()} == {("t1", "x", 2), ("t2", "x", 2)}
    assert {r.alias: (r.qid, r.rank) for r in s.candidates.where("rank = 1").collect()} == {"a": ("Q2", 1)}


def test_preps(spark):
    t = spark.createDataFrame([("Q1", "P1", "Q2"), ("Q1", "P2", "Q3"), (None, "P1", "Q4")], "head string, rel string, tail string")
    assert {r.qid for r in registry.PREPS["qids_of_pairs"](t, "P1").collect()} == {"Q1", "Q2", "Q4"}
    s = spark.createDataFrame([(1, "a b", ["Q1"], "Q9"), (2, None, None, None)], "sent_idx_unq long, sentence string, qids array<string>, parent_qid string")
    assert [r.sent_idx_unq for r in registry.filtered(s, "with_qids", "qids_of_relation", t, "P1").collect()] == [1]
    assert registry.filtered(s, "short").count() == 1
