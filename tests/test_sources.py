"""Readers over small files of each format."""

from __future__ import annotations

import gzip
import json
import random
import re

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from loomspan.sources import corpora, files


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_dump_lines(spark, tmp_path):
    record = {"id": "Q1", "type": "item", "labels": {"en": {"language": "en", "value": "one"}}, "claims": {"P1": [{"id": "c", "mainsnak": {"snaktype": "value", "datatype": "quantity", "datavalue": {"value": {"amount": "+3"}}}}]}}
    path = put(tmp_path / "dump.json", "[\n" + json.dumps(record) + ",\n{broken\n\n" + json.dumps({"id": "Q2"}) + "\n]\n")
    good, bad = files.dump(spark, path)
    assert sorted(r.id for r in good.collect()) == ["Q1", "Q2"]
    assert [r.line for r in bad.collect()] == ["{broken"]
    raw = good.where("id = 'Q1'").select(F.explode("claims").alias("p", "c")).select(F.col("c")[0]["mainsnak"]["datavalue"].alias("v")).first().v
    assert json.loads(raw) == {"value": {"amount": "+3"}}


def test_dump_empty(spark, tmp_path):
    good, bad = files.dump(spark, put(tmp_path / "e.json", ""))
    assert good.count() == bad.count() == 0


def test_pages_and_redirects(spark, tmp_path):
    (tmp_path / "AA").mkdir()
    put(tmp_path / "AA" / "wiki_00", json.dumps({"id": "1", "title": "A", "text": "x &amp; &lt;a href=&quot;B&quot;&gt;y&lt;/a&gt;"}) + "\n")
    assert files.pages(spark, str(tmp_path)).first().text == 'x & <a href="B">y</a>'
    xml = put(tmp_path / "r.xml", '<m><page><title>Old</title><redirect title="New" /><revision><timestamp>2020-01-02T03:04:05Z</timestamp></revision></page><page><title>New</title></page></m>')
    assert [(r.source, r.target) for r in files.redirects(spark, xml).collect()] == [("Old", "New")]


def test_small_readers(spark, tmp_path):
    assert files.space_triples(spark, put(tmp_path / "t", "Q1 P1 Q2\nQ2 P1 Q3\n")).count() == 2
    assert files.qid_filter(spark, None) is None
    assert {r.qid for r in files.qid_filter(spark, put(tmp_path / "l.json", '["Q1", "Q2"]')).collect()} == {"Q1", "Q2"}
    assert {r.qid for r in files.qid_filter(spark, put(tmp_path / "o.json", '{"Q1": 1, "Q3": {}}')).collect()} == {"Q1", "Q3"}
    assert files.qid_filter(spark, put(tmp_path / "n.json", "[]")).count() == 0
    rows = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), (None, 1)], "title string, id long")
    assert {tuple(r) for r in files.page_ids(rows).collect()} == {("a", 3), ("b", 2)}
    assert {tuple(r) for r in files.latest(rows.where("title is not null"), "title", "id").collect()} == {("a", 3), ("b", 2)}
    assert sorted(r.sent_idx_unq for r in files.numbered_sentences(rows, "id", "title").collect()) == [0, 1, 2, 3]
    assert files.run_config(spark, {"k": 1}).count() == 1


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(i, ["a", str(i)]) for i in range(10)], "i int, x array<string>").coalesce(1)
    files.write_rolled(df, str(tmp_path / "r"), 4)
    assert len(list((tmp_path / "r").glob("*.json"))) == 3
    files.write_delimited(df, str(tmp_path / "d"))
    assert "3|a~*~3" in [r.value for r in spark.read.text(str(tmp_path / "d")).collect()]


IOB = "-DOCSTART- (947testa CRICKET)\nLEICESTERSHIRE\tB\tLEICESTERSHIRE COUNTY\tx\thttp://en.wikipedia.org/wiki/A\nCOUNTY\tI\tLEICESTERSHIRE COUNTY\tx\thttp://en.wikipedia.org/wiki/A\ntakes\n\nover\nat\tB\tat\tx\thttp://en.wikipedia.org/wiki/B\n"


def test_iob(spark, tmp_path):
    sents, found = corpora.iob(spark, put(tmp_path / "aida", IOB))
    assert [r.tokens for r in sents.orderBy("sent").collect()] == [["leicestershire", "county", "takes"], ["over", "at"]]
    assert [tuple(r) for r in found.select("doc_id", "alias", "start", "end", "al").orderBy("al").collect()] == [("947", "leicestershire county", 0, 2, 0), ("947", "at", 1, 2, 1)]
    scope = corpora.with_title_scope(sents).orderBy("sent").collect()
    assert scope[1].text == "leicestershire county takes [SEP] over at"


NT = """<http://x.org/N3/RSS-500/7#char=0,9> <http://n/nif#isString> "Ann met B" .
<http://x.org/N3/RSS-500/7#char=0,3> <http://n/nif#anchorOf> "Ann" .
<http://x.org/N3/RSS-500/7#char=0,3> <http://n/nif#beginIndex> "0"^^<http://www.w3.org/2001/XMLSchema#int> .
<http://x.org/N3/RSS-500/7#char=0,3> <http://n/nif#endIndex> "3"^^<http://www.w3.org/2001/XMLSchema#int> .
<http://x.org/N3/RSS-500/7#char=0,3> <http://n/itsrdf#taIdentRef> <http://dbpedia.org/resource/Ann> .
<http://other/1#char=0,1> <http://n/nif#isString> "no" .
"""


def test_ntriples(spark, tmp_path):
    rows = corpora.ntriples(spark, put(tmp_path / "rss.nt", NT), "http://x.org/N3/RSS-500/")
    assert rows.count() == 2 and {r.key for r in rows.collect()} == {7}
    out = corpora.annotated_sentences(rows.withColumn("qid", F.lit(None).cast("string"))).first()
    assert (out.sentence, out.aliases, out.qids, out.spans) == ("Ann met B", ["Ann"], ["-2"], ["0:1"])
    assert corpora.annotated_sentences(rows.withColumn("qid", F.lit(None).cast("string")), keep_unlinked=False).count() == 0


def test_pubtator(spark, tmp_path):
    text = "12|t|Big title\n12|a|Some text here\n12\t4\t9\ttitle\tT1,T2\tC1\n12\t5\t9\title\tT1\tC2\n\n"
    path = tmp_path / "c.gz"
    path.write_bytes(gzip.compress(text.encode()))
    docs, marks = corpora.pubtator(spark, str(path))
    assert tuple(docs.first()) == ("12", "Big title", "Some text here")
    assert marks.count() == 2
    assert [tuple(r) for r in corpora.word_aligned(docs, marks).collect()] == [("12", "title", 1, 2)]
    lists = spark.createDataFrame([("12", "dev")], "pmid string, split string")
    assert corpora.split_by_list(docs, lists).first().split == "dev"


PERSHINA = "ENTITY\ttext:A\tnormalName:a\tp:x\tq:true\tqid:Q9\tdocId:9\torigText:Ann\turl:http://w/A\nCANDIDATE\tid:5\tinCount:54\toutCount:7\tlinks:1;2\turl:http://w/A\tname:Ann A\tnormalName:a\nCANDIDATE\tid:5\tinCount:60\toutCount:7\tlinks:1\turl:http://w/A\tname:Ann A\tnormalName:a\nENTITY\ttext:B\tnormalName:b\tp:x\tq:true\tqid:Q9\tdocId:9\torigText:B\turl:NIL\nCANDIDATE\tid:6\tinCount:1\toutCount:7\tlinks:1\turl:x\tname:B\tn:b\n"


def test_candidate_lists(spark, tmp_path):
    assert [tuple(r) for r in corpora.pershina(spark, put(tmp_path / "p", PERSHINA)).collect()] == [("alias_9_0", "ann", "ann a", "5", 60)]
    line = "d\tx\tParis\tl\tr\tCANDIDATES\t1,0.9,Paris\t2,0.1,Paris, Texas\tGT:\t1\n"
    got = [tuple(r) for r in corpora.ganea(spark, put(tmp_path / "g", line)).orderBy("rank").collect()]
    assert got == [("paris", "1", 0.9, "Paris", 1), ("paris", "2", 0.1, "Paris, Texas", 2)]


def test_other_corpora(spark, tmp_path):
    xml = put(tmp_path / "m.xml", "<R><ReferenceInstance><SurfaceForm> Ann </SurfaceForm><Offset>3</Offset><Length>3</Length><ChosenAnnotation>http://w/A</ChosenAnnotation></ReferenceInstance></R>")
    r = corpora.msnbc_references(spark, xml).first()
    assert (r.alias, r.offset, r.url) == ("Ann", 3, "http://w/A")
    c = corpora.concepts(spark, put(tmp_path / "u.json", json.dumps({"concept_id": "C1", "aliases": ["a"], "types": ["T"], "canonical_name": "A"})))
    assert c.first().concept_id == "C1"
    rel = spark.createDataFrame([("a", "is", "b"), ("a", "", "b"), ("a", None, "b"), ("a", "is", "a")], "head string, rela string, tail string")
    assert corpora.concept_relations(rel).count() == 1


def loop(lines, name):
    """Sentences and mentions of one IOB file, line by line."""
    doc, docs, sent, sents, found, al, m = name, 0, 0, {}, [], {}, None
    for x in lines:
        if x.startswith("-DOCSTART-") or not x.strip(" "):
            sent, m = sent + 1, None
            if x.startswith("-"):
                docs += 1
                doc = "".join(c for c in x if c.isdigit()) or str(docs)
            continue
        c, tokens = x.split("\t"), sents.setdefault((doc, sent), [])
        tokens.append(c[0].lower() if c[0][1:2].isupper() else c[0])
        if len(c) > 4:
            if c[1] == "B":
                m = [doc, sent, c[2].lower(), len(tokens) - 1, 0, c[4], al.get(doc, 0)]
                al[doc] = m[6] + 1
                found.append(m)
            if m:
                m[4] = len(tokens)
    return sorted((*k, *v) for k, v in sents.items()), sorted(map(tuple, found))


def test_iob_in_blocks(spark, tmp_path):
    """Files of several blocks, with sentences and documents over their edges, equal a loop over the whole files."""
    rng, names, want = random.Random(3), [], ([], [])
    for f in range(2):
        lines, end = ["early", "words"] * f, "\r\n" if f else "\n"
        for d in range(12):
            lines.append(f"-DOCSTART- ({f}{d:03} X)" if d % 5 else "-DOCSTART-")
            for _ in range(rng.choice([1, 3, 30])):
                word = f"{rng.choice(['a', 'LO', 'Bé'])}{rng.randrange(99)}"
                lines.append(rng.choice([word, word, "", "  ", f"{word}\tB\tThe {word}\tx\thttp://{word}", f"{word}\tI\tz\tx\ty", f"{word}\tB\tshort"]))
        path = tmp_path / f"f{f}"
        path.write_bytes(end.join(lines).encode())
        names.append(path.as_uri())
        for all_, one in zip(want, loop(lines, names[-1]), strict=True):
            all_.append(one)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert spark.read.text(names[0]).rdd.getNumPartitions() > 2
        for f, name in enumerate(names):
            sents, found = corpora.iob(spark, name)
            assert sorted((r.doc_id, r.sent, *r.tokens) for r in sents.collect()) == want[0][f]
            assert sorted((r.doc_id, r.sent, r.alias, r.start, r.end, r.url, r.al) for r in found.collect()) == want[1][f]
        sents, found = corpora.iob(spark, str(tmp_path))
        assert sents.count() == sum(map(len, want[0])) and found.count() == sum(map(len, want[1]))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("skip_nil", [False, True])
def test_iob_reads_no_file_as_a_row(spark, tmp_path, monkeypatch, skip_nil):
    """A file may be larger than a task's memory."""
    asked, text = [], DataFrameReader.text
    monkeypatch.setattr(DataFrameReader, "text", lambda self, *a, **k: (asked.append(k.get("wholetext")), text(self, *a, **k))[1])
    _, found = corpora.iob(spark, put(tmp_path / "aida", IOB), skip_nil=skip_nil)
    assert asked and not any(asked)
    assert [r.qid for r in found.orderBy("al").collect()] == ([f"http://en.wikipedia.org/wiki/{x}" for x in "AB"] if skip_nil else [None, None])


def test_iob_mentions_stay_in_their_sentence(spark, tmp_path):
    """Only sentences cut by a block's end are shuffled, tagged words never."""
    lines = ["-DOCSTART- (7)", "z\tI\tlost\tu", "a\tB\tA b\tu1\tQ1", "b\tI\tA b\tu1\tQ1", "c", "d\tI\tA b\tu1\tQ1", "e\tB\tE\t--NME--\tQ2", "f\tB\tF\tu3\t", "g\tB", "h\tB\tH\tu4", "", "i\tB\tI\tu5\tQ5\tx", "", "j\tI\tno\tu6"]
    _, found = corpora.iob(spark, put(tmp_path / "aida", "\n".join(lines)), skip_nil=True)
    assert [tuple(r) for r in found.orderBy("al").collect()] == [("7", 1, "a b", 1, 5, "u1", 0, "Q1"), ("7", 1, "f", 6, 7, "u3", 1, None), ("7", 1, "h", 8, 9, "u4", 2, None), ("7", 2, "i", 0, 1, "u5", 3, "Q5")]
    plan = found.select("doc_id", "alias", "qid")._jdf.queryExecution().executedPlan().toString()
    keys = {tuple(re.findall(r"(\w+)#", x)) for x in re.findall(r"hashpartitioning\((.*?), \d+\)", plan)}
    assert keys and keys <= {("file", "block"), ("file",), ("file", "doc_id", "sent")}
