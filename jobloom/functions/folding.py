"""Unicode folding as native expressions: decomposition, case folding and removal of marks for every code point.

A fold maps each character on its own.  One scan lists the characters beyond ASCII, each *distinct* one is looked up and, if the fold
changes it, replaced in the whole text.  Ordinary text has a few dozen of them at most, so a fold costs one scan and a few
replacements, whatever the size of the table, and it works inside lambdas.  Tables come from ``unicodedata``; results never hold a
character that is replaced later, as distinct characters are taken in ascending order (checked when a table is built).

A pattern of the table's own ranges would list fewer characters, but a class of many ranges takes six times as long to scan.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, functions as F

BEYOND_ASCII = r"[^\x00-\x7F]"
#: Code points of a page; a lookup searches one page only.
PAGE = 256
_BETWEEN_PAGES, _BETWEEN_VALUES = "\x1e", "\x1f"
# the Korean syllables, two thirds of all that decompose, do so by arithmetic
_SYLLABLES = (0xAC00, 0xD7A3)
_LEADS = "".join(chr(c) for c in range(0x1100, 0x1113))
_VOWELS = "".join(chr(c) for c in range(0x1161, 0x1176))
_TAILS = "".join(chr(c) for c in range(0x11A8, 0x11C3))


def _bare(text: str) -> str:
    return "".join(ch for ch in text if not unicodedata.combining(ch))


def to_ascii(text: str) -> str:
    """Compatibility decomposition, of which only ASCII stays."""
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def to_caseless(text: str) -> str:
    """Case folding and compatibility decomposition without marks; white space is blanks, long dashes are hyphens."""
    plain = _bare(unicodedata.normalize("NFKD", text.casefold())).replace("–", "-").replace("—", "-")
    return "".join(" " if ch.isspace() else ch for ch in plain)


def to_unaccented(text: str) -> str:
    """Canonical decomposition without the common accents."""
    return "".join(ch for ch in unicodedata.normalize("NFD", text) if not "̀" <= ch <= "ͯ")


def to_comparable(text: str) -> str:
    """``to_unaccented`` with white space as blanks and long dashes as hyphens."""
    plain = to_unaccented(text).replace("–", "-").replace("—", "-")
    return "".join(" " if ch.isspace() or ch == "\ufeff" else ch for ch in plain)


@lru_cache(maxsize=None)
def _pages(fold: Callable[[str], str], drops_rest: bool) -> tuple[str, str]:
    """Per page of code points, the characters that change and what they become."""
    pages: list[list[tuple[str, str]]] = []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or _SYLLABLES[0] <= code <= _SYLLABLES[1]:
            continue
        folded = fold(chr(code))
        if folded != ("" if drops_rest else chr(code)):
            while len(pages) <= code // PAGE:
                pages.append([])
            pages[code // PAGE].append((chr(code), folded))
    keys = {key for page in pages for key, _ in page}
    if any(ch in keys and ch >= key for page in pages for key, folded in page for ch in folded):
        raise ValueError("a fold gives characters that are replaced after it")
    return (
        _BETWEEN_PAGES.join("".join(key for key, _ in page) for page in pages),
        _BETWEEN_PAGES.join(_BETWEEN_VALUES.join(folded for _, folded in page) for page in pages),
    )


def _syllable(code: Column) -> Column:
    place, tails = code - _SYLLABLES[0], len(_TAILS) + 1
    lead, vowel, tail = F.floor(place / (len(_VOWELS) * tails)), F.floor(place / tails) % len(_VOWELS), place % tails
    part = lambda letters, at: F.substring(F.lit(letters), at.cast("int"), F.lit(1))
    return F.concat(part(_LEADS, lead + 1), part(_VOWELS, vowel + 1), F.when(tail > 0, part(_TAILS, tail)).otherwise(""))


def replaced(text: Column, fold: Callable[[str], str], drops_rest: bool = False) -> Column:
    """The text with every character that ``fold`` changes replaced; ASCII is left to the caller.

    With ``drops_rest``, characters that fold to nothing are not looked up: the caller removes what is left beyond ASCII.
    """
    # splitting a literal is done once, when the plan is optimised
    keys, values = (F.split(F.lit(pages), _BETWEEN_PAGES) for pages in _pages(fold, drops_rest))

    def change(ch: Column) -> Column:
        page = F.floor(F.ascii(ch) / PAGE).cast("int")
        at = F.instr(F.coalesce(F.get(keys, page), F.lit("")), ch)
        value = F.when(at > 0, F.get(F.split(F.get(values, page), _BETWEEN_VALUES), at - 1))
        if not drops_rest:
            value = F.when(F.ascii(ch).between(*_SYLLABLES), _syllable(F.ascii(ch))).otherwise(value)
        return F.struct(ch.alias("ch"), value.alias("to"))

    found = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(BEYOND_ASCII), F.lit(0))))
    changes = F.filter(F.transform(found, change), lambda c: c["to"].isNotNull())
    return F.aggregate(changes, text, lambda done, c: F.replace(done, c["ch"], c["to"]))
