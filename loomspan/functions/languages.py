"""Language settings: normal form, stop words, pronouns, words to avoid, name parsing, sentence ends."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values, as the corpora were built with: pronoun classes, genders by entity, property lists, word lists.
MALE, FEMALE, IMPERSONAL, PLURAL, UNKNOWN = 1, 2, 3, 4, 5
ENGLISH_PRONOUNS = {
    "him": 1, "he": 1, "his": 1, "himself": 1, "her": 2, "she": 2, "herself": 2,
    "it": 3, "its": 3, "itself": 3, "they": 4, "them": 4, "themselves": 4,
}
ENGLISH_POSSESSIVE = ("his", "her")
HEBREW_PRONOUNS = {
    "הוא": 1, "עצמו": 1, "שלו": 1, "בעצמו": 1, "היא": 2, "עצמה": 2, "שלה": 2, "בעצמה": 2,
    "זה": 3, "בזה": 3, "הם": 4, "הן": 4, "שלהם": 4, "שלהן": 4, "בשלהם": 4, "בשלהן": 4,
}
HEBREW_POSSESSIVE = ("שלו", "שלה", "שלהם", "שלהן")
GENDERS = {
    "Q15145778": 1, "Q179294": 1, "Q44148": 1, "Q499327": 1, "Q6581097": 1, "Q15145779": 2, "Q43445": 2, "Q6581072": 2,
}
HUMANS = ("Q5", "Q159979")
DISAMBIGUATION = ("Q4167410", "Q22808320")
ALIAS_PROPERTIES = (
    "P138", "P734", "P735", "P742", "P1448", "P1449", "P1477", "P1533", "P1549", "P1559", "P1560", "P1635", "P1705", "P1782", "P1785",
    "P1786", "P1787", "P1810", "P1813", "P1814", "P1888", "P1950", "P2358", "P2359", "PP2365", "P2366", "P2521", "P2562", "P2976",
    "PP3321", "P4239", "P4284", "P4970", "P5056", "P5278", "PP6978", "P7383",
)
IGNORED_DATATYPES = (
    "wikibase-lexeme", "musical-notation", "globe-coordinate", "commonsMedia", "geo-shape", "wikibase-sense", "wikibase-property", "math", "tabular-data",
)
ENGLISH_AVOID = ("the", "a", "in", "of", "for", "at", "to", "with", "on", "from")
HEBREW_AVOID = ("של",)
TYPE_PROPERTIES = ("P106", "P31", "P279")
# End of the fixed values.

ENGLISH_STOP = frozenset(
    "i me my we our you your he him his she her it its they them their what which who this that these those am is are was were be been being have has had do does did "
    "a an the and but if or because as until while of at by for with about against between into through during before after above below to from up down in out on off "
    "over under again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very can "
    "will just should now".split()
)


@dataclass(frozen=True)
class Language:
    """What the text operators need to know of a language."""

    code: str = "en"
    form: str = "NFD"
    stop: frozenset[str] = ENGLISH_STOP
    avoid: tuple[str, ...] = ENGLISH_AVOID
    pronouns: dict[str, int] = field(default_factory=lambda: dict(ENGLISH_PRONOUNS))
    possessive: tuple[str, ...] = ENGLISH_POSSESSIVE
    sentence_end: str = r"[.!?]+(?=\s|$)"
    last_name: bool = True

    def name_parts(self, name: str) -> tuple[str, str]:
        """First and last name, "" where there is none."""
        parts = name.split()
        if not parts:
            return "", ""
        if not self.last_name:
            return parts[0], ""
        if self.code == "he":
            return parts[0], " ".join(parts[1:]).replace("-", " ")
        parts = [p for p in parts if p.lower().rstrip(".") not in TITLES] or parts
        return parts[0], parts[-1] if len(parts) > 1 else ""


TITLES = frozenset(("mr", "mrs", "ms", "dr", "prof", "sir", "jr", "sr", "ii", "iii", "iv", "phd"))
ENGLISH = Language()
HEBREW = Language("he", "NFKD", frozenset(), HEBREW_AVOID, HEBREW_PRONOUNS, HEBREW_POSSESSIVE, r"[.,:!;]+(?=\s|$)")
CHINESE = Language("zh", "NFD", frozenset(), (), {}, (), r"[。！？.!?]+", last_name=False)
LANGUAGES = {x.code: x for x in (ENGLISH, HEBREW, CHINESE)}
