"""Whitespace, text and identifier normalisation."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that count as whitespace.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular-expression class (Java and RE2 both accept it).
WS_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same set for the JVM alone: most letters are told apart by the first two ranges.
_WS_FAST = (
    r"[\t-\r\x1c-\x20[\x{85}-\x{3000}&&"
    r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
)

# Entity replacements, applied one after the other in this order.
ENTITIES = (
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&nbsp;", " "),
    ("&mdash;", "—"),
    ("&raquo;", "»"),
    ("&laquo;", "«"),
)

_BLANK_START = 16  # characters looked at before a whole text is
_SPACES = 64


def ws_trim(text: Column) -> Column:
    """Strip whitespace of any kind from both ends."""
    return F.btrim(text, F.lit(WS_CHARS))


def is_blank(text: Column) -> Column:
    """Whether there is nothing but whitespace.

    A text that begins otherwise is read no further. Else long runs of spaces, the common kind,
    are taken out by a search for bytes, which changes no answer; only the rest is looked at
    character by character.
    """
    start = F.btrim(F.substring(text, 1, _BLANK_START), F.lit(WS_CHARS)) == ""
    rest = F.replace(text, F.lit(" " * _SPACES), F.lit(""))
    return start & rest.rlike(rf"\A{_WS_FAST}*\z")


def collapse_ws(text: Column) -> Column:
    """Runs of whitespace become one space; none is left at the ends."""
    return F.btrim(F.regexp_replace(text, _WS_FAST + "+", " "))


@lru_cache(maxsize=1)
def _rare_letters() -> str:
    """Pattern for letters whose case folding is not lower-casing plus sharp s to ss.

    Python's character database is the rule. Neighbours closer than 16 places share a
    range: a text caught without need only takes the slower way to the same result. The
    capital sigma is added because its lower case depends on its place in the word.
    """
    odd = [
        c for c in range(0x110000)
        if chr(c).casefold() != chr(c).lower().replace("ß", "ss") or chr(c) == "Σ"
    ]
    ranges = []
    for c in odd:
        if ranges and c - ranges[-1][1] < 16:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    listed = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)
    # one comparison settles every letter before the first of them
    return f"[\\x{{{ranges[0][0]:x}}}-\\x{{10ffff}}&&[{listed}]]"


@lru_cache(maxsize=1)
def _foldings() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Letters that fold to one other letter, what they fold to, and those that fold to several.

    Python's character database is the rule.
    """
    folded = [(chr(c), chr(c).casefold()) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    single = [(c, f) for c, f in folded if f != c and len(f) == 1]
    return "".join(c for c, _ in single), "".join(f for _, f in single), tuple((c, f) for c, f in folded if len(f) > 1)


def casefold(text: Column) -> Column:
    """Full Unicode case folding.

    Texts in which lower-casing is not enough (some Greek, Armenian or Cherokee letters,
    ligatures) are folded letter by letter; for all others lower-casing and the sharp s do,
    and for texts of one byte per letter lower-casing alone.
    """
    native = F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))
    letters, single, several = _foldings()
    # one look-up a letter: a replacement for each of the foldings makes code too long to be compiled
    table = F.create_map(*[F.lit(x) for pair in several for x in pair])
    folded = F.transform(F.split(F.translate(text, letters, single), ""), lambda c: F.coalesce(F.try_element_at(table, c), c))
    full = F.array_join(folded, "")
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).when(text.rlike(_rare_letters()), full).otherwise(native)


def normalize_text(text: Column, exact: bool = True) -> Column:
    """Comparison form of a text field; NULL becomes the empty string.

    ``exact=False`` folds case with ``lower`` alone; it gives
    the same for Cyrillic and, but for a few letters such as the sharp s, for Latin.
    """
    # folding neither makes nor changes whitespace, so collapsing can come last
    return F.coalesce(collapse_ws(casefold(text) if exact else F.lower(text)), F.lit(""))


def normalize_isbn(text: Column) -> Column:
    """Upper-cased, without blanks and hyphens; NULL when nothing is left."""
    return F.nullif(F.translate(F.upper(ws_trim(text)), " -", ""), F.lit(""))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]+>", "")


def decode_entities(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text
