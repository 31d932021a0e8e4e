"""Regular-expression extraction that keeps "no match" (NULL) apart from "empty match"."""

from __future__ import annotations

import re
from re import _constants as sre
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.text import WS_CLASS


def java_pattern(pattern: str, dotall: bool = False) -> str:
    """Pattern for the JVM engine.

    ``\\s`` covers all Unicode whitespace, and without ``dotall`` the dot stops at
    line feeds only.
    """
    return ("(?s)" if dotall else "(?d)") + pattern.replace(r"\s", WS_CLASS)


def may_be_empty(pattern: str) -> bool:
    """Whether a pattern can match without taking any character."""
    return re.fullmatch(pattern, "", re.DOTALL) is not None


def has_optional_group(pattern: str) -> bool:
    """Whether a group may take no part in a match: there are alternatives, or a group may be left out."""
    bare = re.sub(r"\\.|\[(?:\\.|[^\]])*\]", "x", pattern)
    return "|" in bare or re.search(r"\)(?:[?*]|\{0?,)", bare) is not None


def needs_context(pattern: str) -> bool:
    """Whether the text around a match may decide what is matched: the pattern looks around,
    has an anchor or word boundary, or never gives back what it has taken. Its groups can't
    be taken from the matched text alone."""
    bare = re.sub(r"\[\^?\]?(?:\\.|[^\]\\])*\]", "x", re.sub(r"\\[^bBAZzG]", "x", pattern))
    return re.search(r"\(\?(?:=|!|<=|<!|>)|[\^$]|\\[bBAZzG]|[*+?}]\+", bare) is not None


def needed_literal(pattern: str) -> str:
    """The longest text that stands in every match of a pattern; empty if none is sure to.

    Python's own reading of the pattern is walked: literals that follow each other are one
    text, a group goes on with it, what may be absent or differ ends it.
    """
    runs = [""]

    def walk(parts) -> None:
        for kind, value in parts:
            if kind is sre.LITERAL:
                runs[-1] += chr(value)
            elif kind is sre.SUBPATTERN and not value[1] and not value[2]:
                walk(value[3])
            else:
                runs.append("")
                if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and value[0] > 0:
                    walk(value[2])
                    runs.append("")

    walk(_parser.parse(pattern))
    return max(runs, key=len)


def _guarded(text: Column, pattern: str, found: Column) -> Column:
    """``found``, looked for only in texts that have what every match has: a search for plain
    text costs a fraction of the pattern's."""
    literal = needed_literal(pattern)
    return F.when(F.contains(text, F.lit(literal)), found) if len(literal) > 1 else found


def first_match(text: Column, pattern: str, dotall: bool = False) -> Column:
    """Text of the first match, NULL without one: a single scan of ``text``.

    A pattern that can match nothing at all is looked for a second time, as the function
    gives NULL for an empty match, too.
    """
    java = java_pattern(pattern, dotall)
    found = F.regexp_substr(text, F.lit(java))
    if may_be_empty(pattern):
        return F.when(text.rlike(java), F.coalesce(found, F.lit("")))
    return _guarded(text, pattern, found)


def group_of(match: Column, pattern: str, group: int = 1, dotall: bool = False) -> Column:
    """One capture group, taken from the short matched text rather than the page; NULL where
    the group took no part in the match."""
    java = java_pattern(pattern, dotall)
    found = F.regexp_extract(match, java, group)
    if not group or not has_optional_group(pattern):
        return found
    return F.when((found != "") | _took_part(match, java, group), found)


def _took_part(text: Column, java: str, group: int) -> Column:
    """Whether a group that is empty took part in the first match of ``text``.

    A reference to a group that took no part fails, one to an empty group matches anywhere.
    The match is made once, looking ahead, and not given back for another.
    """
    return text.rlike(f"^(?>(?s:.*?)(?={java}))\\{group}")


def group_in(text: Column, pattern: str, group: int = 1, dotall: bool = False) -> Column:
    """One capture group of the first match, taken from the whole text: for patterns that
    :func:`needs_context` names. NULL without a match, or where the group took no part."""
    java = java_pattern(pattern, dotall)
    found = F.regexp_extract(text, java, group)
    if not group or not has_optional_group(pattern):
        return _guarded(text, pattern, F.when(text.rlike(java), found))
    return _guarded(text, pattern, F.when((found != "") | (text.rlike(java) & _took_part(text, java, group)), found))


def first_group(text: Column, pattern: str, group: int = 1, dotall: bool = False) -> Column:
    if needs_context(pattern):
        return group_in(text, pattern, group, dotall)
    return group_of(first_match(text, pattern, dotall), pattern, group, dotall)


def all_groups(text: Column, pattern: str, group: int = 1, dotall: bool = False) -> Column:
    """Array with one capture group of every match."""
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern, dotall)), F.lit(group))
