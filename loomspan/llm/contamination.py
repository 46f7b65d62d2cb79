"""Evaluation texts that leaked into training text.

The word n-grams of the evaluation items form a hash set that every task holds: 64 bits each, and the words they are
made of. A text is scanned for runs of words that all occur in some item; only windows inside such runs are looked up.
A hit is then verified: its n-gram must be equal to an item's, as text. Items of more than `max_grams` n-grams are taken
in blocks of so many, by hash, and the texts are scanned once a block, so that no text ever travels.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions.text import normal_text, words
from loomspan.operators.skew import lookup
from loomspan.scratch import Scratch

TAG = re.compile(r"<[^>]*>")


def grams(text: str | None, n: int) -> list[str]:
    w = words(text)
    return [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]


def plain(text: str) -> str:
    """The text after dropping everything from a < to the next >."""
    return TAG.sub("", text) if "<" in text else text


def _gram_rows(n: int, tags: bool):
    schema = pa.schema([("id", pa.int64()), ("gram", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(dict.fromkeys(grams(plain(t) if tags and t else t, n)))
                for k in range(0, len(found), 5000):
                    part = found[k : k + 5000]
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(part), pa.int64()), pa.array(part, pa.string())], schema=schema)

    return run


class Scanner:
    """A set of n-grams, by their hashes, and the words they are made of."""

    def __init__(self, hashes: np.ndarray, vocabulary: frozenset[str], n: int) -> None:
        self.hashes, self.known, self.n = np.sort(hashes), vocabulary, n

    @classmethod
    def of(cls, grams_: Iterable[str], n: int) -> Scanner:
        held = list(grams_)
        return cls(np.fromiter(map(gram_hash, held), np.int64, len(held)), frozenset(w for g in held for w in g.split(" ")), n)

    def windows(self, w: list[str]) -> list[tuple[int, str]]:
        """(position, n-gram) of each window of w whose hash is in the set."""
        n, known, at, start = self.n, self.known, [], 0
        if not len(self.hashes):
            return []
        # a window can only match if its last word, and so on backwards, is known: jump over windows that can't
        end = n - 1
        while end < len(w):
            if w[end] not in known:
                start = end + 1
                end += n
                continue
            back = end - 1
            while back >= start and w[back] in known:
                back -= 1
            if back >= start:  # w[back] is unknown: no window that holds it
                start, end = back + 1, back + n
                continue
            stop = end + 1
            while stop < len(w) and w[stop] in known:
                stop += 1
            at += range(end - n + 1, stop - n + 1)
            start, end = stop + 1, stop + n
        if not at:
            return []
        found = [" ".join(w[i : i + n]) for i in at]
        asked = np.fromiter(map(gram_hash, found), np.int64, len(found))
        place = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        return [(at[k], found[k]) for k in np.flatnonzero(self.hashes[place] == asked)]


def gram_hash(gram: str) -> int:
    return xxhash.xxh64_intdigest(gram) - (1 << 63)


def _scan(holder, n: int):
    schema = pa.schema([("id", pa.int64()), ("gram", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*holder.value, n)
        for batch in batches:
            ids, found = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t:
                    hit = {g for _, g in scanner.windows(words(plain(t)))}
                    ids += [i] * len(hit)
                    found += hit
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], schema=schema)

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(map(gram_hash, batch.column(1).to_pylist()), pa.int64())], ["id", "gram", "hash"])


def _item_grams(items: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """(id, gram, hash) of the items, written once."""
    rows = items.where("id is not null and text is not null").select("id", "text").mapInArrow(_gram_rows(n, False), "id long, gram string")
    return scratch.save(rows.mapInArrow(_hashed, "id long, gram string, hash long"))


def _hits(documents: DataFrame, of_items: DataFrame, n: int, max_grams: int, scratch: Scratch) -> DataFrame:
    """(id, gram): the documents' windows whose hash is that of an item's n-gram, a row per document and n-gram."""
    sc = documents.sparkSession.sparkContext
    blocks = -(-of_items.count() // max_grams) or 1
    texts, found = documents.where("id is not null and text is not null").select("id", "text"), None
    for block in range(blocks):
        part = of_items.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == block)
        # what every task holds: hashes of about max_grams n-grams, and their distinct words
        hashes = part.select("hash").distinct().toArrow()["hash"].to_numpy()
        vocabulary = frozenset(part.select(F.explode(F.split("gram", " ")).alias("w")).distinct().toArrow()["w"].to_pylist())
        rows = texts.mapInArrow(_scan(sc.broadcast((hashes, vocabulary)), n), "id long, gram string")
        found = rows if found is None else found.unionByName(rows)
    return scratch.save(found)


def _verified(hits: DataFrame, of_items: DataFrame) -> DataFrame:
    """(id, gram, items): the hits that are an item's n-gram, with these items."""
    holders = of_items.groupBy("gram").agg(F.collect_set("id").alias("items"))
    return lookup(hits, holders, "gram").where("items is not null")


def leaks(documents: DataFrame, items: DataFrame, n: int = 12, max_grams: int = 2_000_000, scratch: Scratch | None = None) -> DataFrame:
    """(id, item): the documents with at least n consecutive words in common with an item, tags dropped.

    documents and items: (id long, text string), other columns unread. Null and empty texts, items of fewer than n words
    and rows with a null id match nothing. Repeated rows give one result row.
    """
    scratch = scratch or Scratch(documents.sparkSession, "leaks")
    of_items = _item_grams(items, n, scratch)
    found = _verified(_hits(documents, of_items, n, max_grams, scratch), of_items)
    return found.select("id", F.explode("items").alias("item")).distinct()


def clean_text(text: str, scanner: Scanner) -> tuple[str, int]:
    """The text without its leaked windows, and the number of words cut. A cut goes from the first character of a
    window's first word to the last of its last; tags between them go with it."""
    kept, i = [], 0  # characters outside tags
    for m in TAG.finditer(text):
        kept += range(i, m.start())
        i = m.end()
    kept += range(i, len(text))
    out, tokens = "".join(text[k] for k in kept), []
    for m in re.finditer(r"\S+", out):
        for w in normal_text(m.group()).split():
            tokens.append((w, kept[m.start()], kept[m.end() - 1] + 1))
    gone = [False] * len(tokens)
    for at, _ in scanner.windows([t[0] for t in tokens]):
        gone[at : at + scanner.n] = [True] * scanner.n
    pieces, last, k = [], 0, 0
    while k < len(tokens):
        if gone[k]:
            end = k
            while end + 1 < len(tokens) and gone[end + 1]:
                end += 1
            pieces.append(text[last : tokens[k][1]])
            last, k = tokens[end][2], end
        k += 1
    return "".join([*pieces, text[last:]]), sum(gone)


def _clean(schema: pa.Schema, n: int, holder=None):
    """Over (id, text) with a broadcast set of n-grams, or (id, text, grams) with each document's own."""
    whole = holder and Scanner.of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = whole and whole(holder.value, n)
        for batch in batches:
            texts, cut = [], []
            own = batch.column(2).to_pylist() if scanner is None else [None] * batch.num_rows
            for t, grams_ in zip(batch.column(1).to_pylist(), own, strict=True):
                by = scanner or (Scanner.of(grams_, n) if grams_ else None)
                text, k = clean_text(t, by) if t and by and by.windows(words(plain(t))) else (t, 0)
                texts.append(text)
                cut.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(cut, pa.int32())], schema=schema)

    return run


def remove_spans(documents: DataFrame, items: DataFrame, n: int = 12, max_grams: int = 2_000_000, scratch: Scratch | None = None) -> DataFrame:
    """(id, text, words_cut) of every document, leaked windows cut out; null texts stay null.

    First the leaked n-grams are found as `leaks` finds them. Up to max_grams / 10 of them are broadcast and cut out
    where the texts lie; if there are more, each document meets its own ones in a join by the hash of its text."""
    scratch = scratch or Scratch(documents.sparkSession, "leaks")
    schema, ddl = pa.schema([("id", pa.int64()), ("text", pa.string()), ("words_cut", pa.int32())]), "id long, text string, words_cut int"
    of_items, keyed = _item_grams(items, n, scratch), documents.select("id", "text", F.xxhash64("text").alias("key"))
    hits = _hits(keyed.select(F.col("key").alias("id"), "text"), of_items, n, max_grams, scratch)
    found = scratch.save(_verified(hits, of_items).select(F.col("id").alias("key"), "gram").distinct())
    leaked = found.select("gram").distinct().limit(max_grams // 10 + 1).toArrow()["gram"].to_pylist()
    if len(leaked) <= max_grams // 10:
        return documents.select("id", "text").mapInArrow(_clean(schema, n, documents.sparkSession.sparkContext.broadcast(leaked)), ddl)
    own = found.groupBy("key").agg(F.collect_set("gram").alias("grams"))
    return lookup(keyed, own, "key").select("id", "text", "grams").mapInArrow(_clean(schema, n), ddl)
