"""Typed readings of raw claim values, whatever wraps the value. All JVM expressions, ANSI-safe.

A reading is null if the value can't be read. `canonical` is one string per value, equal for equal values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomspan.functions.text import strip

# Fixed patterns of the value formats.
ITEM = r"[Qq][0-9]+"
NUMBER = r"[+-]?(?:[0-9]{1,3}(?:,[0-9]{3})+(?![0-9])|[0-9]+)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
DAY = r"(?<![0-9])(?:[0-9]{4,}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4,})(?![0-9])"


def _only(raw: Column, pattern: str) -> Column:
    """The one match of pattern in raw; null for none or several."""
    found = F.regexp_extract_all(raw, F.lit(pattern), F.lit(0))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def item(raw: Column) -> Column:
    return F.upper(_only(raw, ITEM))


def _number(raw: Column) -> Column:
    return F.replace(_only(raw, NUMBER), F.lit(","), F.lit(""))


def number_key(raw: Column) -> Column:
    """The number as `sign digits e power`, its digits without zeros at either end: equal numbers, equal keys, whatever
    their length; different ones never share a key."""
    text = _number(raw)
    part = lambda pattern: F.regexp_extract(text, pattern, 1)
    fraction, exponent = part(r"\.([0-9]+)"), part(r"[eE]([+-]?[0-9]+)$")
    digits = F.ltrim(F.concat(part(r"^[+-]?([0-9]+)"), fraction), F.lit("0"))
    kept = F.rtrim(digits, F.lit("0"))
    power = F.coalesce(F.nullif(exponent, F.lit("")), F.lit("0")).try_cast("decimal(30,0)") - F.length(fraction) + F.length(digits) - F.length(kept)
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    # a power beyond 30 digits stays as it is written
    return F.when(text.isNotNull(), F.when(kept == "", "0").otherwise(F.concat(sign, kept, F.lit("e"), F.coalesce(power.cast("string"), exponent))))


def day(raw: Column) -> Column:
    """The one valid calendar day in raw, as a date. Invalid days don't count."""
    found = F.regexp_extract_all(raw, F.lit(DAY), F.lit(0))

    def as_date(t: Column) -> Column:
        part = F.split(t, r"[-/.]")
        last = F.length(F.get(part, F.lit(2))) >= 4
        year, end = F.get(part, F.when(last, 2).otherwise(0)), F.get(part, F.when(last, 0).otherwise(2))
        text = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(F.get(part, F.lit(1)), 2, "0"), F.lpad(end, 2, "0"))
        return F.when(F.length(year) == 4, text.try_cast("date"))

    valid = F.filter(F.transform(found, as_date), lambda d: d.isNotNull())
    return F.when(F.size(valid) == 1, F.get(valid, F.lit(0)))


def canonical(raw: Column, datatype: Column) -> Column:
    """The value's canonical string by datatype (wikibase-item, quantity, time, else string); null if it can't be read."""
    raw = strip(raw)
    return (
        F.when(datatype == "wikibase-item", item(raw))
        .when(datatype == "quantity", number_key(raw))
        .when(datatype == "time", day(raw).cast("string"))
        .otherwise(F.nullif(raw, F.lit("")))
    )
