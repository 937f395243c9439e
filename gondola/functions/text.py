"""Text cleaning: names, brands, categories, free text."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola import dims

_MARK = "\u0001 "
# white space of any script, spelled out: much faster to match than a Unicode class
_SPACE = r"\s\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def _compatibility_forms() -> dict[str, str]:
    """Characters of the basic plane and their compatibility form without marks.

    Hangul syllables are left whole: their parts are letters, not accents.
    """
    forms = {}
    for code in [*range(0x00A0, 0xAC00), *range(0xF900, 0xFFFE)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code))
                        if not unicodedata.combining(c))
        if plain != chr(code) and not unicodedata.combining(chr(code)):
            forms[chr(code)] = plain
    return forms


_FORMS = _compatibility_forms()
_SINGLE = {c: plain for c, plain in _FORMS.items() if len(plain) == 1}
_LONGER = {c: plain for c, plain in _FORMS.items() if len(plain) > 1}
_ACCENTED, _PLAIN = "".join(_SINGLE), "".join(_SINGLE.values())


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"[{_SPACE}]+", " "))


def strip_accents(c: Column) -> Column:
    """Compatibility form without accents; combining marks in the input go as well.

    Plain ASCII is passed through. Ligatures and other forms of several letters are
    rare, so texts without one skip their table.
    """
    table = F.str_to_map(F.lit("\u0001".join(f"{k}\u0002{v}" for k, v in _LONGER.items())),
                         F.lit("\u0001"), F.lit("\u0002"))
    bare = F.regexp_replace(c, r"\p{M}+", "")
    spelled = F.array_join(F.transform(
        F.split(bare, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    some = bare.rlike("[" + re.escape("".join(_LONGER)) + "]")
    plain = F.translate(F.when(some, spelled).otherwise(bare), _ACCENTED, _PLAIN)
    return F.when(is_ascii(c), c).otherwise(plain)


def is_ascii(c: Column) -> Column:
    """As many bytes as characters."""
    return F.octet_length(c) == F.length(c)


def title_case(c: Column) -> Column:
    """Upper-case the first letter after any non-letter, lower-case the rest.

    ``initcap`` only starts a word after white space, so a marker space is put
    at every other letter boundary and taken out again.
    """
    marked = F.regexp_replace(F.lower(c), r"(?<=\P{L})(?=\p{L})", _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def norm_name(c: Column) -> Column:
    """Lower case, no accents, title case, allowed characters, single blanks; NULL if empty."""
    low = F.lower(c)
    plain = F.when(is_ascii(c), F.regexp_replace(low, r"\s+", " ")).otherwise(
        collapse_spaces(strip_accents(low)))
    # printable ASCII first, then the allowed part of it: two plain tests per character
    kept = F.regexp_replace(title_case(plain), r"[^ -~]|[^\p{Alnum} ()/-]", "")
    return blank_to_null(F.trim(F.regexp_replace(kept, " {2,}", " ")))


def brand_base(c: Column) -> Column:
    """Title case without legal suffixes at the end."""
    suffixes = "|".join(dims.LEGAL_SUFFIXES)
    return F.regexp_replace(collapse_spaces(title_case(F.trim(c))),
                            rf"(?i)(\s+({suffixes})\.?)+$", "")


def brand_of(base: Column) -> Column:
    """Alias of a cleaned brand, each word once."""
    aliases = F.create_map(*[F.lit(x) for pair in dims.BRAND_ALIASES.items() for x in pair])
    named = F.coalesce(F.try_element_at(aliases, base), base)
    return blank_to_null(F.array_join(F.array_distinct(F.split(named, " ")), " "))


def norm_brand(c: Column) -> Column:
    """Title case, legal suffixes off the end, aliases, repeated words once."""
    return brand_of(brand_base(c))


def category_key(c: Column) -> Column:
    return blank_to_null(F.trim(F.lower(c)))


def category_of(key: Column) -> Column:
    """Standard category of a lower-cased key: exact, else first containment match.

    Patterns of one standard category are consecutive, so "first match in order"
    is the first block with any match: two tests per block.
    """
    exact = F.create_map(*[F.lit(x) for _, pattern, std in dims.category_rows()
                           for x in (pattern, std)])
    fuzzy = F.lit(None).cast("string")
    for standard, patterns in reversed(dims.CATEGORY_PATTERNS):
        inside = key.rlike("|".join(patterns))
        around = F.contains(F.lit("\u0000".join(patterns)), key)
        fuzzy = F.when(inside | around, standard).otherwise(fuzzy)
    return F.coalesce(F.try_element_at(exact, key), fuzzy, F.lit(dims.UNCATEGORIZED))


def norm_category(c: Column) -> Column:
    return category_of(category_key(c))


def category_hierarchy(c: Column) -> Column:
    return F.array(c)


def category_multi(c: Column) -> Column:
    """All standards of a raw category (an array), the single mapping otherwise."""
    key = category_key(c)
    out = F.array(norm_category(c))
    for raw, standards in dims.CATEGORY_MULTI.items():
        out = F.when(key == raw, F.array(*[F.lit(s) for s in standards])).otherwise(out)
    return out


def dedup_consecutive_words(c: Column) -> Column:
    """Drop a word equal (ignoring case) to the one just before it: one linear scan."""
    return F.regexp_replace(collapse_spaces(c), r"(?iu)(?<!\S)(\S+)(?: \1(?!\S))+", "$1")


def sanitize_string(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[^a-zA-Z0-9\s\-]", ""))


def market_name(c: Column, title_fallback: bool = True) -> Column:
    names = F.create_map(*[F.lit(x) for pair in dims.MARKET_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, c), title_case(c) if title_fallback else c)
