"""Training-data operators against brute force, with dirty, empty and repeated input."""

from __future__ import annotations

import functools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("loomspan.llm")

from loomspan.functions.text import words  # noqa: E402
from loomspan.llm import contamination, frequent, groups, mixture, overlap, spans  # noqa: E402


# frequent values


def test_frequent(spark):
    rng = random.Random(1)
    rows = [("a", f"v{int(rng.paretovariate(0.6)) % 5000}") for _ in range(8000)] + [("b", "x")] * 50 + [("b", None), (None, "y"), ("c", "")]
    df = spark.createDataFrame(rows, "field string, value string").withColumn("low", F.lit("clash")).repartition(7)
    true = Counter((f, v) for f, v in rows if f and v is not None)
    total = Counter(f for f, v in rows if f and v is not None)
    for r in frequent.summarise(df, 300).collect():
        assert r.low <= true[r.field, r.value] <= r.high and r.total == total[r.field]
        assert r.high - r.low <= r.total / 301
    got = {(r.field, r.value): r.n for r in frequent.frequent(df, 0.01, 300).collect()}
    assert got == {k: n for k, n in true.items() if n >= 0.01 * total[k[0]]}
    assert frequent.frequent(df.limit(0), 0.01, 300).count() == 0
    with pytest.raises(ValueError, match="capacity"):
        frequent.frequent(df, 0.001, 300)


def test_prune_keeps_bounds():
    counts, cut = frequent.prune({str(i): i for i in range(1, 11)}, 2, 4)
    assert counts == {"7": 1, "8": 2, "9": 3, "10": 4} and cut == 8


# overlaps


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[-1] + 1))
    return row[-1]


def test_word_edits():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2))
        for most in (0, 1, 3, 9):
            assert min(overlap.word_edits(a, b, most), most + 1) == min(edits(a, b), most + 1)


def sentences(rng, n):
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of"] * 20
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(6, 30))] for _ in range(n // 3)]
    out = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(0, 7)):
            i = rng.randrange(len(w))
            k = rng.randrange(3)
            w[i : i + (k > 0)] = [rng.choice(vocabulary)] * (k < 2)
            w = w or ["x"]
        out.append(" ".join(w) + rng.choice(["", ".", "  !"]))
    return out


@pytest.mark.parametrize("crowd", [20_000_000, 1])
def test_overlap(spark, scratch, crowd):
    rng = random.Random(3)
    texts = sentences(rng, 240)
    rows = [(i, i % 3 == 0, t.upper() if i % 5 == 0 else t) for i, t in enumerate(texts)] + [(900, True, texts[1]), (901, False, texts[1]), (902, True, None), (903, None, texts[1]), (904, True, ""), (None, True, texts[1])]
    df = spark.createDataFrame([(i, None if h is None else int(h), t) for i, h, t in rows], "id long, side int, text string").withColumn("rep", F.lit(0)).withColumn("term", F.lit(0))
    found = overlap.Overlap(df, scratch, threshold=0.8, least=8, edits=0.2, crowd=crowd)
    got = [tuple(r) for r in found.member_pairs().collect()]
    w = {i: words(t) for i, _, t in rows if i is not None}
    sides = {i: h for i, h, _ in rows if i is not None and h is not None and len(w[i]) >= 8}
    want = {(min(i, j), max(i, j)) for i, h in sides.items() if h for j, g in sides.items() if not g and edits(w[i], w[j]) <= 0.2 * max(len(w[i]), len(w[j])) + 1e-9}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    links = {r.id: r.n_links for r in found.links().collect()}
    assert links == {i: sum(i in p for p in want) for i, h in sides.items() if h}


@pytest.mark.parametrize("crowd", [20_000_000, 0])
def test_overlap_weighted(spark, scratch, crowd):
    """Unit vectors with other weights: all pairs of cosine 0.6 and more."""
    rng = random.Random(4)
    texts = sentences(rng, 117) + ["alone", "Alone!", "alone two"]
    weigh = lambda count, term: 0.5 + (sum(map(ord, term)) % 7) / 4
    df = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(texts)], "id long, side int, text string")
    found = overlap.Overlap(df, scratch, threshold=0.6, weigh=weigh, frequent_share=0.5, crowd=crowd)
    rep = {r.id: r.rep for r in found.members.collect()}
    vec = {i: {k: weigh(0, k) for k in overlap.numbered(words(t))} for i, t in enumerate(texts)}
    norm = {i: sum(x * x for x in v.values()) for i, v in vec.items()}
    want = set()
    for i in range(0, 120, 2):
        for j in range(1, 120, 2):
            dot = sum(x * vec[j].get(k, 0) for k, x in vec[i].items())
            if rep[i] == rep[j] or dot >= 0.6 * max(norm[i], norm[j]):
                want.add((rep[i], rep[j]))
    assert {(r.x, r.y) for r in found.pairs.collect()} == want


@pytest.mark.parametrize("crowd", [20_000_000, 4])
def test_overlap_idf(spark, scratch, crowd):
    """Cosine of inverse document frequencies, known for frequent terms only."""
    rng = random.Random(14)
    texts = sentences(rng, 150)
    df = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(texts)], "id long, side int, text string")
    found = overlap.Overlap(df, scratch, threshold=0.7, weigh="idf", frequent_share=0.1, crowd=crowd)
    keys = {tuple(words(t)) for t in texts}
    n = Counter(x for k in keys for x in overlap.numbered(list(k)))
    weigh = overlap.idf_weight(len(keys), max(20, 0.1 * len(keys)))
    vec = []
    for t in texts:
        v = {x: weigh(n[x], x) for x in overlap.numbered(words(t))}
        norm = sum(w * w for w in v.values()) ** 0.5
        vec.append({x: w / norm for x, w in v.items()})
    want = {(i, j) for i in range(0, 150, 2) for j in range(1, 150, 2) if sum(w * vec[j].get(x, 0) for x, w in vec[i].items()) >= 0.7 - 1e-9}
    assert {tuple(r) for r in found.member_pairs().collect()} == {(min(p), max(p)) for p in want} and len(want) > 30
    assert {r.id: r.n_links for r in found.links(0).collect()} == {i: sum(i == p[0] for p in want) for i in range(0, 150, 2)}


def test_overlap_empty(spark, scratch):
    df = spark.createDataFrame([], "id long, side int, text string")
    found = overlap.Overlap(df, scratch, least=8, edits=0.2)
    assert found.member_pairs().count() == found.links().count() == 0


# grouped splits


def related(rng, n):
    rows = [(i, rng.choice([None, f"q{rng.randrange(n)}"]), rng.choice([None, f"t{rng.randrange(n)}"]), rng.choice(["train", "dev", None]), rng.choice(["s", "t", None])) for i in range(n)]
    rows += [(n + i, f"c{i // 2}", f"d{(i + 1) // 2}", "train" if i else "test", "s") for i in range(60)]  # a chain
    rows += [(2 * n + i, "hub", f"h{i}", "dev", "u") for i in range(40)] + [rows[0]]
    return rows


def roots(rows):
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, a, b, *_ in rows:
        for k in (("a", a), ("b", b)):
            if k[1] is not None:
                parent[find(("r", i))] = find(k)
    return {i: find(("r", i)) for i, *_ in rows}


def test_leaking(spark, scratch):
    rows = related(random.Random(5), 200)
    df = spark.createDataFrame(rows, "id long, a string, b string, split string, stratum string").withColumn("k", F.lit("clash")).withColumn("component", F.lit(1))
    splits: dict = {}
    root = roots(rows)
    for i, _, _, s, _ in rows:
        splits.setdefault(root[i], set()).update({s} - {None})
    # a record of neither entity is related to nothing, its repetition included
    alone = {i for i, a, b, *_ in rows if a is None and b is None and all(not (x[1] or x[2]) for x in rows if x[0] == i)}
    want = {i for i in root if len(splits[root[i]]) > 1 and i not in alone}
    got = [r.id for r in groups.leaking(df, scratch).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_assign(spark, scratch):
    rows = related(random.Random(6), 600)
    df = spark.createDataFrame(rows, "id long, a string, b string, split string, stratum string")
    got = groups.assign(df, {"train": 0.8, "dev": 0.1, "test": 0.1}, scratch).collect()
    assert Counter(r.id for r in got) == Counter(r[0] for r in rows)
    root, of = roots(rows), {}
    for r in got:
        of.setdefault(root[r.id], set()).add(r.assigned)
    assert all(len(s) == 1 for s in of.values())
    share = Counter(r.assigned for r in got)
    assert all(abs(share[k] / len(rows) - v) <= 0.005 for k, v in (("train", 0.8), ("dev", 0.1), ("test", 0.1)))
    assert Counter((r.id, r.stratum) for r in got) == Counter((r[0], r[4]) for r in rows)
    report = {r.split: r for r in groups.split_report(spark.createDataFrame(got), {"train": 0.8, "dev": 0.1, "test": 0.1}).collect()}
    assert {k: r.rows for k, r in report.items()} == share and all(r.torn == 0 and r.label_deviation < 0.02 and abs(r.share - share[k] / len(rows)) < 1e-12 for k, r in report.items())
    assert groups.assign(df.limit(0), {"train": 1.0}, scratch).count() == 0 and groups.leaking(df.limit(0), scratch).count() == 0


def test_allot():
    sizes = np.array([[1.0, 1.0]] * 100)
    got = Counter(groups.allot(sizes, np.array([0.8, 0.1, 0.1])).tolist())
    assert got == {0: 80, 1: 10, 2: 10}
    # a group larger than the small splits' needs goes where it fits, and all shares are met
    rng = np.random.default_rng(1)
    sizes = np.vstack([rng.multinomial(1, [0.5, 0.3, 0.2], 3000), [[40, 300, 60]]]).astype(float)
    got = groups.allot(sizes, np.array([0.8, 0.1, 0.1]))
    assert got[-1] == 0
    for s, want in enumerate((0.8, 0.1, 0.1)):
        assert np.allclose(sizes[got == s].sum(0) / sizes.sum(0), want, atol=0.005)
    assert groups.allot(np.zeros((0, 0)), np.array([1.0])).tolist() == []


def test_rare_labels(spark, scratch, monkeypatch):
    """Labels beyond the most frequent ones still count."""
    monkeypatch.setattr(groups, "STRATA", 2)
    rows = [(i, f"q{i // 2}", None, f"l{i % 7}") for i in range(700)]
    got = groups.assign(spark.createDataFrame(rows, "id long, a string, b string, stratum string"), {"x": 0.5, "y": 0.5}, scratch).collect()
    assert len(got) == 700 and abs(sum(r.assigned == "x" for r in got) - 350) <= 4


# leaks


def leak_rows(rng):
    vocabulary = [f"wörd{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 25)))) for i in range(30)] + [(77, None), (78, ""), (None, "x " * 20)]
    documents = []
    for d in range(80):
        w = [rng.choice(vocabulary) for _ in range(30)]
        if d % 2:
            src = rng.choice(items[:30])[1].split()
            k = rng.randrange(8, 20)
            w[10:12] = [x.upper() + rng.choice(["", ",", "<b>", "</a> "]) for x in src[:k]]
        documents.append((d, " ".join(w)))
    return documents + [(500, None), (501, ""), (502, "<" + items[0][1]), (None, items[1][1]), documents[1]], items


def test_leaks(spark):
    documents, items = leak_rows(random.Random(7))
    d = spark.createDataFrame(documents, "id long, text string").withColumn("gram", F.lit("clash")).withColumn("item", F.lit(1))
    i = spark.createDataFrame(items, "id long, text string")
    n = 6
    want = {(x, y) for x, t in documents if x is not None for y, s in items if y is not None and set(contamination.grams(contamination.plain(t or ""), n)) & set(contamination.grams(s, n))}
    got = [tuple(r) for r in contamination.leaks(d, i, n).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    assert {tuple(r) for r in contamination.leaks(d, i, n, max_grams=100).collect()} == want  # several blocks
    assert contamination.leaks(d.limit(0), i, n).count() == contamination.leaks(d, i.limit(0), n).count() == 0
    clean = {r.id: r for r in contamination.remove_spans(d, i, n).collect()}
    assert {r.id: r for r in contamination.remove_spans(d, i, n, max_grams=100).collect()} == clean  # blocks, and a join
    hit = {x for x, _ in want}
    grams = {g for y, s in items if y is not None for g in contamination.grams(s, n)}
    for x, t in documents:
        if x is not None:
            assert (clean[x].words_cut > 0) == (x in hit) and (x in hit or clean[x].text == t)
    scanner = contamination.Scanner.of(grams, n)
    text, cut = contamination.clean_text("keep this <i>" + items[0][1] + "</i> and that", contamination.Scanner.of(contamination.grams(items[0][1], 3), 3))
    assert text == "keep this <i></i> and that" and cut == len(items[0][1].split())
    assert scanner.windows([]) == contamination.Scanner.of([], n).windows(["x"] * 20) == []


def test_hits_are_verified(spark, monkeypatch):
    """Equal hashes of different n-grams are no leak."""
    monkeypatch.setattr(contamination, "gram_hash", lambda g: len(g))
    of_items = contamination._item_grams(spark.createDataFrame([(1, "aa bb cc")], "id long, text string"), 3, contamination.Scratch(spark, "test"))
    hits = spark.createDataFrame([(7, "aa bb cc"), (8, "bb aa cc")], "id long, gram string")
    assert [(r.id, r["items"]) for r in contamination._verified(hits, of_items).collect()] == [(7, [1])]


def test_scanner():
    rng = random.Random(8)
    grams = {" ".join(rng.choice("abc") for _ in range(3)) for _ in range(12)}
    s = contamination.Scanner.of(grams, 3)
    for _ in range(400):
        w = [rng.choice("abcd") for _ in range(rng.randrange(14))]
        assert [i for i, _ in s.windows(w)] == [i for i in range(len(w) - 2) if " ".join(w[i : i + 3]) in grams]


# mixtures


def test_rake():
    tokens = np.array([[[100.0, 50]], [[10.0, 40]]])
    fit = mixture.rake(tokens, [np.array([0.5, 0.5]), np.array([1.0]), np.array([0.5, 0.5])], np.array([1.0, 3.0]), 100.0)
    got = fit.copies * tokens
    assert np.allclose(got.sum((1, 2)), 50, atol=0.1) and (fit.copies <= np.array([1.0, 3.0])[:, None, None] + 1e-9).all()
    assert mixture.largest_total(np.array([100.0, 10]), np.array([0.5, 0.5]), np.array([1.0, 3.0])) == 60


def test_mixture(spark, scratch):
    rng = random.Random(9)
    docs = [(i, rng.choice(["a ", "A", "b", "c", None, "zz"]), rng.choice(["en", "EN ", "de", None]), rng.choice(["t1", "t2", None]), "word " * rng.randrange(0, 40)) for i in range(3000)] + [(9000, "b", "en", "t1", None), (9001, "b", None, None, ""), (None, "a", "en", "t1", "x")]
    d = spark.createDataFrame(docs, "id long, source string, lang string, topic string, text string").withColumn("want", F.lit(1)).withColumn("tokens", F.lit("clash"))
    t = spark.createDataFrame([("a", 0.5, 1.0), ("B", 0.3, 4.0), ("c", 0.1, 2.5), ("none", 0.1, 9.0), ("c", 0.05, 1.0), (None, 0.5, 1.0)], "source string, target_share double, max_repeats double")
    m = mixture.Mixture(d, t, scratch)
    report = {r.source: r for r in m.report.collect()}
    assert set(report) == {"a", "b", "c", "none", "zz", None}
    for s, share in (("a", 5 / 9), ("b", 3 / 9), ("c", 1 / 9)):
        assert abs(report[s].share_reached - share) < 0.01
        assert report[s].most_copies <= report[s].max_repeats
    assert report["zz"].tokens_drawn == report["none"].tokens_drawn == report[None].tokens_drawn == 0
    sample = [tuple(r) for r in m.sample.collect()]
    assert len({r[0] for r in sample}) == len(sample)
    again = mixture.Mixture(d.repartition(5), t, scratch)
    assert sorted(map(tuple, again.sample.collect())) == sorted(sample)
    small = mixture.Mixture(d, t, scratch, total=2000.0)
    assert abs(sum(r.tokens_drawn for r in small.report.collect()) - 2000) < 200
    for docs0, goals in ((d.limit(0), t), (d, t.limit(0))):
        assert mixture.Mixture(docs0, goals, scratch).sample.count() == 0


def test_mixture_many_topics(spark, scratch):
    """Each of many topics keeps its share, although the sources that have most of it are drawn unalike."""
    docs = [(i, "a" if (i // 60) % 10 < (8 if i % 2 else 2) else "b", "en", f"t{i % 60:02}", 10) for i in range(12000)]
    d = spark.createDataFrame(docs, "id long, source string, lang string, topic string, tokens long")
    t = spark.createDataFrame([("a", 0.1, 1.0), ("b", 0.9, 3.0)], "source string, target_share double, max_repeats double")
    m = mixture.Mixture(d, t, scratch, total=36000.0)
    assert len(m.fit.copies) == 120 and max(m.fit.worst.values()) < 1e-3
    topic = {r[0]: r[3] for r in docs}
    drawn = Counter()
    for r in m.sample.collect():
        drawn[topic[r.id]] += r.tokens * r.copies
    # of the topics by name, the even ones are mostly of source b, which is drawn nine times as much
    assert abs(sum(drawn[f"t{k:02}"] for k in range(0, 60, 2)) / drawn.total() - 0.5) < 0.04
    got = {(r.axis, r.value): r for r in m.marginals.collect()}
    assert set(got) == {("language", "en")} | {("topic", x) for x in topic.values()}
    for (axis, x), r in got.items():
        assert r.tokens_drawn == (drawn[x] if axis == "topic" else drawn.total()) and abs(r.share_wanted - (1 / 60 if axis == "topic" else 1)) < 1e-9
        assert abs(r.share_reached - r.tokens_drawn / drawn.total()) < 1e-9


def test_mixture_in_a_table(spark, scratch, monkeypatch):
    """Cells beyond what the driver holds are fitted alike, step by step: same copies, same sample."""
    for name in ("rake_cells", "rake_table"):
        monkeypatch.setattr(mixture, name, functools.partial(getattr(mixture, name), rounds=3))
    rng = random.Random(15)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c"]), rng.choice(["en", "de", None]), f"t{int(rng.paretovariate(1)) % 9}", rng.randrange(50)) for i in range(1500)]
    d = spark.createDataFrame(docs, "id long, source string, lang string, topic string, tokens long")
    t = spark.createDataFrame([("a", 0.3, 1.0), ("b", 0.5, 3.0), ("c", 0.2, 2.0), ("gone", 0.1, 2.0)], "source string, target_share double, max_repeats double")
    one, two = (mixture.Mixture(d, t, scratch, max_cells=n) for n in (mixture.MAX_CELLS, 3))
    assert all(abs(one.fit.worst[axis] - two.fit.worst[axis]) < 1e-9 for axis in ("source", "language", "topic"))
    assert sorted(map(tuple, one.sample.collect())) == sorted(map(tuple, two.sample.collect()))
    assert sorted(map(str, one.report.collect())) == sorted(map(str, two.report.collect()))
    assert mixture.Mixture(d.limit(0), t, scratch, max_cells=0).sample.count() == 0


# shared spans


def span_documents(rng):
    alphabet = "abcdef ghij"
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [make(n) for n in (30, 45, 60, 100, 29)] + ["ab" * 40, "x" * 70]
    docs = [(i, make(rng.randrange(0, 80)) + (rng.choice(shared)[: rng.randrange(20, 101)] if i % 2 else "") + make(rng.randrange(0, 80))) for i in range(60)]
    docs += [(100 + i, shared[3] + make(20)) for i in range(12)] + [(200, None), (201, ""), (202, docs[1][1]), (203, docs[1][1]), (None, shared[3]), (204, "é" * 50 + "\U0001f600" + shared[2]), docs[1]]
    return docs


@pytest.mark.parametrize("crowd", [64, 2])
def test_shared_spans(spark, scratch, crowd, monkeypatch):
    if crowd == 2:  # and classes cut into shards
        monkeypatch.setattr(spans, "HEAVY", 1)
    docs = span_documents(random.Random(10))
    length = 30
    df = spark.createDataFrame(docs, "id long, text string").withColumn("mini", F.lit("clash")).withColumn("start", F.lit(0))
    found = spans.shared_spans(df, scratch, length=length, piece=10, crowd=crowd)
    texts = {i: t for i, t in docs if i is not None and t is not None}
    windows: dict = {}
    for i, t in texts.items():
        for k in range(len(t) - length + 1):
            windows.setdefault(t[k : k + length], set()).add(i)
    want = {(a, b) for s in windows.values() for a in s for b in s if a < b}
    got = [tuple(r) for r in spans.shared_pairs(found).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    near: dict = {}
    for a, b in want:
        near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    classes = {}
    for i in sorted(near):
        todo = [] if i in classes else [i]
        while todo:
            x = todo.pop()
            if x not in classes:
                classes[x] = i
                todo += near[x]
    size = Counter(classes.values())
    assert {r.id: (r["class"], r.n_records) for r in spans.shared_classes(found, scratch).collect()} == {i: (c, size[c]) for i, c in classes.items()}
    share = {r.id: r.n_shared for r in spans.shared_share(df, found).collect()}
    for i, t in texts.items():
        covered = set()
        for k in range(len(t) - length + 1):
            if len(windows[t[k : k + length]]) > 1:
                covered |= set(range(k, k + length))
        assert share[i] == len(covered)
    assert share[200] == 0


def test_long_text_in_steps(monkeypatch):
    monkeypatch.setattr(spans, "_STEP", 64)
    rng = random.Random(11)
    t = "".join(rng.choice("abc") for _ in range(500))
    got = spans.runs(t, 30, 10)
    assert sorted(w for _, a, b, _ in got for w in range(a, b + 1)) == list(range(471))
    assert all(a <= p and p + 10 <= b + 30 for _, a, b, p in got)


def test_shared_spans_empty(spark, scratch):
    df = spark.createDataFrame([], "id long, text string")
    found = spans.shared_spans(df, scratch)
    assert found.count() == spans.shared_pairs(found).count() == spans.shared_share(df, found).count() == 0
