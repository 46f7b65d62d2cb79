"""Text keys shared by many operators: trimmed keys, folded aliases and titles, and words.

Everything but `words` is a JVM expression. `words` needs Unicode decomposition, which Spark SQL lacks, and so comes as
a plain Python function for use inside Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, as str.split() knows it.
WHITE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0                　"
_WHITE_RUN = f"[{WHITE}]+"


def strip(c: Column | str) -> Column:
    """Cut white space of any kind at both ends."""
    return F.btrim(c if isinstance(c, Column) else F.col(c), F.lit(WHITE))


def key(c: Column | str) -> Column:
    """An identifier as it is compared: trimmed, in upper case; null if nothing is left."""
    return F.nullif(F.upper(strip(c)), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def known_qid(c: Column | str) -> Column:
    """An entity id, null where it is unknown: null, blank or "-1"."""
    k = key(c)
    return F.when(k != "-1", k)


def fold_alias(c: Column | str) -> Column:
    """Lower-cased, runs of blanks made one, trimmed. Null stays null."""
    c = c if isinstance(c, Column) else F.col(c)
    return F.btrim(F.regexp_replace(F.lower(c), _WHITE_RUN, " "))


def fold_title(c: Column | str) -> Column:
    """As an alias, after cutting at the first # and taking _ for a blank."""
    c = c if isinstance(c, Column) else F.col(c)
    return fold_alias(F.translate(F.substring_index(c, "#", 1), "_", " "))


_DROPPED = re.compile(r"[^\w\s]|_")
_PLAIN = re.compile(r"[0-9a-z\s]*\Z")


def normal_text(text: str) -> str:
    """NFD, lower case, and only letters, digits and white space left."""
    if not text.isascii():
        text = unicodedata.normalize("NFD", text)
    text = _DROPPED.sub("", text.lower())
    if text.isascii():
        return text
    # \w also holds numeric signs and connectors, and some marks; only letters and decimal digits stay
    return "".join(filter(_stays, text)) if _ODD.search(text) else text


def _stays(ch: str) -> bool:
    return ch.isspace() or unicodedata.category(ch)[0] == "L" or unicodedata.category(ch) == "Nd"


def _odd_class() -> re.Pattern[str]:
    """Word characters of the Basic Multilingual Plane that are neither letters nor decimal digits."""
    runs, start, last = [], None, None
    for code in range(0x80, 0x10000):
        ch = chr(code)
        if not 0xD800 <= code < 0xE000 and re.match(r"\w", ch) and not _stays(ch):
            if last != code - 1:
                if start is not None:
                    runs.append((start, last))
                start = code
            last = code
    runs.append((start, last))
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in runs) + "\U00010000-\U0010ffff]")


_ODD = _odd_class()


def words(text: str | None) -> list[str]:
    """The words of a text; none for null."""
    return normal_text(text).split() if text else []
