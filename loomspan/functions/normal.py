"""Functions of the text pipeline. Arrow functions where Spark has no built-in: Unicode forms, HTML entities, URLs."""

from __future__ import annotations

import html
import re
import unicodedata
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspan.functions.languages import ENGLISH, TITLES, Language


def normal_alias(s: str | None, strip: bool = True, lower: bool = True, form: str = "NFD") -> str | None:
    """A mention's normal form: lower case; letters and digits of the decomposed text, and blanks, kept; blanks made
    one. With neither flag the text itself."""
    if s is None or not (strip or lower):
        return s
    if lower:
        s = s.lower()
    if strip:
        s = "".join(c for c in unicodedata.normalize(form, s) if c == " " or (c.isalnum() and not unicodedata.combining(c))).strip()
    return " ".join(s.split()) if strip or lower else s


def _arrow(f):
    """An Arrow function over the distinct values of a batch; null stays null."""

    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        coded = values.dictionary_encode()
        done = pa.array([f(x) for x in coded.dictionary.to_pylist()], pa.string())
        return done.take(coded.indices)

    return run


def lnrm(c: Column | str, strip: bool = True, lower: bool = True, language: Language = ENGLISH) -> Column:
    """The exact normal form of an alias, with an Arrow function."""
    form = language.form
    return _arrow(lambda s: normal_alias(s, strip, lower, form))(c)


def unescape(c: Column | str) -> Column:
    return _arrow(html.unescape)(c)


def link_title(c: Column | str) -> Column:
    """The page title in a link's href: URL-decoded (a plus sign stays), unescaped, cut at #, trimmed."""
    return _arrow(lambda s: html.unescape(unquote(s)).split("#")[0].strip())(c)


def convert_title(c: Column | str) -> Column:
    return _arrow(lambda s: html.unescape(unquote(s)))(c)


def escape(c: Column) -> Column:
    """HTML-escaped, quotes included. JVM only."""
    for plain, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(plain), F.lit(name))
    return c


def url_title(url: Column, language: str = "en") -> Column:
    """The page title in an encyclopedia URL."""
    for scheme in ("http", "https"):
        url = F.replace(url, F.lit(f"{scheme}://{language}.wikipedia.org/wiki/"), F.lit(""))
    return F.replace(url, F.lit("_"), F.lit(" "))


def quoted(c: Column) -> Column:
    """A string as Python's repr writes it, for texts without control characters or backslashes."""
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(single)


def tuple_key(*parts: Column) -> Column:
    """The text of a tuple of strings, of two or more parts."""
    return F.concat(F.lit("("), F.concat_ws(", ", *parts), F.lit(")"))


def sha1_bucket(c: Column) -> Column:
    """SHA-1 modulo 100, in built-in arithmetic: 16^5 = 76 and 76 * 76 = 76 modulo 100."""
    digest = F.sha1(c)
    part = lambda i: F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("long")
    total = part(0)
    for i in range(1, 7):
        total = total + part(i)
    return F.pmod(total * 76 + part(7), F.lit(100)).cast("int")


def span_overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Characters two spans share."""
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))


SPANS = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def match_spans(c: Column | str, pattern: str) -> Column:
    """array<struct<word, start, end>> of the matches of a pattern in a text, in characters; null for null.

    An Arrow function: built-in ones give matches without their places, and finding these again is quadratic."""

    @F.arrow_udf(SPANS)
    def run(values: pa.Array) -> pa.Array:
        rx, words, starts, ends, offsets, gone = re.compile(pattern), [], [], [], [0], []
        for t in values.to_pylist():
            gone.append(t is None)
            for m in rx.finditer(t or ""):
                words.append(m.group())
                starts.append(m.start())
                ends.append(m.end())
            offsets.append(len(words))
        parts = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["word", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts, mask=pa.array(gone))

    return run(c)


def word_spans(c: Column | str) -> Column:
    """array<struct<word, start, end>> of the whitespace-separated words of a text."""
    return match_spans(c, r"\S+")


def ngrams(words: Column, n: int) -> Column:
    """array<string>: the n-grams of an array of words, joined by blanks; null for null. The array is bound once: in a
    lambda, an expression that makes it would run anew for every n-gram."""

    def of(w: Column) -> Column:
        last = F.size(w) - n
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(w, i + 1, n), " "))).otherwise(F.expr("cast(array() as array<string>)"))

    return F.get(F.transform(F.array(words), of), F.lit(0))


def pad(values: Column, k: int, filler: Column) -> Column:
    """The array cut or filled to k elements."""
    return F.slice(F.concat(values, F.array_repeat(filler, F.greatest(F.lit(0), F.lit(k) - F.size(values)))), 1, k)


def byte_size(text: str) -> int:
    """10M -> 10485760, with K, M, G or none."""
    units = {"K": 1 << 10, "M": 1 << 20, "G": 1 << 30}
    return int(text[:-1]) * units[text[-1].upper()] if text[-1:].upper() in units else int(text)


def partial_ratio(a: str, b: str) -> float:
    """Best match, 0 to 100, of the shorter text with a stretch of the longer one."""
    from difflib import SequenceMatcher

    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0
    best = 0.0
    for i, j, _ in SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks():
        at = max(0, j - i)
        best = max(best, SequenceMatcher(None, short, long[at : at + len(short)], autojunk=False).ratio())
    return 100 * best


def first_last(name: Column, language: Language = ENGLISH) -> Column:
    """struct<first, last>, "" where there is none: what stands in brackets and titles before or behind a name don't
    count; one word is a first name. JVM only, as Language.name_parts."""
    words = F.filter(F.split(F.regexp_replace(name, r"\([^)]*\)", " "), r"\s+"), lambda w: w != "")
    if not language.last_name:
        return F.struct(F.coalesce(F.get(words, F.lit(0)), F.lit("")).alias("first"), F.lit("").alias("last"))
    if language.code == "he":
        rest = F.replace(F.array_join(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), " "), F.lit("-"), F.lit(" "))
        return F.struct(F.coalesce(F.get(words, F.lit(0)), F.lit("")).alias("first"), rest.alias("last"))
    plain = F.filter(words, lambda w: ~F.rtrim(F.lower(w), F.lit(".")).isin(*sorted(TITLES)))
    kept = F.when(F.size(plain) > 0, plain).otherwise(words)
    last = F.when(F.size(kept) > 1, F.element_at(kept, -1)).otherwise("")
    return F.struct(F.coalesce(F.get(kept, F.lit(0)), F.lit("")).alias("first"), last.alias("last"))


def proper_phrases(words: Column, stop: frozenset[str]) -> Column:
    """Maximal runs of capitalised words, the first of them no stop word, and each word of these runs; distinct."""
    capital = lambda w: w.rlike(r"^\p{Lu}")
    opens = lambda w: capital(w) & ~F.lower(w).isin(*sorted(stop))
    found = F.aggregate(
        F.concat(words, F.array(F.lit(""))),
        F.struct(F.expr("cast(array() as array<string>)").alias("done"), F.lit("").alias("run")),
        lambda a, w: F.when((a["run"] != "") & capital(w), F.struct(a["done"].alias("done"), F.concat(a["run"], F.lit(" "), w).alias("run")))
        .when(a["run"] != "", F.struct(F.concat(a["done"], F.array(a["run"])).alias("done"), F.lit("").alias("run")))
        .when(opens(w), F.struct(a["done"].alias("done"), w.alias("run")))
        .otherwise(F.struct(a["done"].alias("done"), F.lit("").alias("run"))),
    )
    runs = found["done"]
    return F.array_distinct(F.concat(runs, F.flatten(F.transform(runs, lambda r: F.split(r, " ")))))
