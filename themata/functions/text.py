"""Text cleaning and tokenising as Column expressions (no Python at run time)."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column, functions as F

from themata.cluster import sql_list

# Fixed values.
NUMBER_CONST = "NUMBERVALUE"
COUNTRY_CONST = "COUNTRYVALUE"
MIN_TOKEN_CHARS = 3

#: letter, digit or underscore in any script. Java's ``(?U)\w`` also takes marks and joiners,
#: and misses some numerals, so the class is spelt out.
WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]+"
SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"

DECIMAL = rf"([0-9]){SPACE}*[.,]{SPACE}*([0-9])"
# The look-behind only lets a match start at the first letter of a run, which is where the
# leftmost match starts anyway; without it a long run is rescanned from each of its letters.
ACRONYM = rf"(?<!{WORD})({WORD}++)\.({WORD}++)\.(?:({WORD}++)\.)?(?:({WORD}++)\.)?(?:({WORD}++)\.)?"

_HANGUL_FIRST, _HANGUL_LAST = "가", "힣"


@lru_cache(maxsize=1)
def _accent_maps() -> tuple[str, str, str, dict[str, str]]:
    """(from, to, deleted, several): what each character becomes under NFD without marks."""
    one_from, one_to, deleted, several = [], [], [], {}
    # the planes in use; the wide gap between them holds no characters
    for code in chain(range(0x34000), range(0xE0000, 0xE1000)):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3:
            continue
        char = chr(code)
        kept = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")
        if kept == char:
            continue
        if not kept:
            deleted.append(char)
        elif len(kept) == 1:
            one_from.append(char)
            one_to.append(kept)
        else:
            several[char] = kept
    return "".join(one_from), "".join(one_to), "".join(deleted), several


def _jamo(char: Column) -> Column:
    """A Hangul syllable as its two or three letters, by the arithmetic of the Unicode standard."""
    index = F.ascii(char) - F.lit(0xAC00)
    lead = F.array(*[F.lit(chr(0x1100 + i)) for i in range(19)])
    vowel = F.array(*[F.lit(chr(0x1161 + i)) for i in range(21)])
    tail = F.array(F.lit(""), *[F.lit(chr(0x11A8 + i)) for i in range(27)])
    at = lambda values, i: F.get(values, i.cast("int"))
    return F.concat(
        at(lead, F.floor(index / 588)), at(vowel, F.floor((index % 588) / 28)), at(tail, index % 28)
    )


def strip_accents(text: Column) -> Column:
    """Canonical decomposition, then drop non-spacing marks.

    Nearly every character maps to one character or to none, which is a ``translate``. The few
    that fall into several letters (Hangul, some Indic signs) take a branch per character, and
    only in texts that hold one.
    """
    one_from, one_to, deleted, several = _accent_maps()
    plain = F.translate(text, one_from + deleted, one_to)
    pairs = [F.lit(x) for item in several.items() for x in item]
    table = F.create_map(*pairs)

    def split_char(c: Column) -> Column:
        return F.when(c.between(_HANGUL_FIRST, _HANGUL_LAST), _jamo(c)).otherwise(
            F.coalesce(F.try_element_at(table, c), c)
        )

    # a coarse test in three ranges; texts that pass it without need come out the same
    low = [c for c in several if c < _HANGUL_FIRST]
    high = [c for c in several if c > _HANGUL_LAST]
    rare = f"[{min(low)}-{max(low)}{_HANGUL_FIRST}-{_HANGUL_LAST}{min(high)}-{max(high)}]"
    decomposed = F.array_join(F.transform(F.split(plain, ""), split_char), "")
    return F.when(text.rlike(rare), decomposed).otherwise(plain)


def upper_text(text: Column) -> Column:
    return F.upper(text)


def merge_decimals(text: Column, compat: bool = False) -> Column:
    """``3.14`` becomes ``314``. ``compat=True`` deletes the digits instead (two control characters)."""
    return F.regexp_replace(text, DECIMAL, "\x01\x03" if compat else "$1$2")


def collapse_acronyms(text: Column, compat: bool = False) -> Column:
    """Two to five dotted parts become one token. ``compat=True`` keeps only the fourth part."""
    return F.regexp_replace(text, ACRONYM, "\x02\x04\x06$4\x08" if compat else "$1$2$3$4$5")


def clean_nonword(text: Column) -> Column:
    return F.regexp_replace(text, NON_WORD, " ")


def tokenize(text: Column, compat: bool = False) -> Column:
    """Merge decimals, collapse acronyms, blank out non-words, split on one space.

    Empty strings may appear at both ends; the minimum length filter removes them.
    """
    merged = collapse_acronyms(merge_decimals(text, compat), compat)
    return F.split(clean_nonword(merged), " ")


def drop_terms(column: str, terms) -> Column:
    """Drop the tokens found in ``terms`` (a bounded collection), keeping order and duplicates."""
    terms = list(terms)
    return F.expr(f"filter({column}, t -> t NOT IN ({sql_list(terms)}))") if terms else F.col(column)


def keep_terms(column: str, terms) -> Column:
    """Keep only the tokens found in ``terms`` (a bounded collection)."""
    return F.expr(f"filter({column}, t -> t IN ({sql_list(terms) or 'null'}))")


def mark_numbers(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(NUMBER_CONST)).otherwise(t))


def mark_terms(column: str, terms, constant: str = COUNTRY_CONST) -> Column:
    """Replace the tokens found in ``terms`` (a bounded collection) by ``constant``."""
    terms = list(terms)
    if not terms:
        return F.col(column)
    return F.expr(f"transform({column}, t -> if(t IN ({sql_list(terms)}), {sql_list([constant])}, t))")


def min_length(tokens: Column, chars: int = MIN_TOKEN_CHARS) -> Column:
    return F.filter(tokens, lambda t: F.length(t) >= chars)
