"""Regular-expression extraction from product-card HTML."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.functions.numbers import parse_brl
from gondola.functions.text import blank_to_null

# fixed values: patterns of the result page
CARD = r'(?s)<a\b[^>]*data-testid="search-product-card"[^>]*>.*?</a>'
PRICE_SPAN = r'(?s)<span\b[^>]*class="[^"]*text-price-default[^"]*"[^>]*>(.*?)</span>'
ID_IN_HREF = r"-(\d+)(?:\?|$)"


# entities nearly all texts are made of; "&amp;" comes last, so that what it gives stays as it is
COMMON = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"),
          ("&amp;", "&")]
# an ampersand that is neither one of these nor a plain one before a blank or the end
UNCOMMON = "&(?!(?:" + "|".join(e[1:-1] for e, _ in COMMON) + r");|[\t\n\f <&;]|$)"
NUMBER = r"^(#(?:[0-9]+|[xX][0-9a-fA-F]+));?"
NAME = r"^([a-zA-Z][a-zA-Z0-9]{0,31});"
# names that count without a semicolon as well; the longest that fits is read
OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.str_to_map(F.lit("\u0001".join(f"{n}\u0002{c}" for n, c in pairs.items())),
                        F.lit("\u0001"), F.lit("\u0002"))


def _named(name: Column) -> Column:
    """Characters of an entity name: a short map per first letter, as a map is searched in order."""
    by_letter: dict[str, dict[str, str]] = {}
    for n, c in html5.items():
        if n.endswith(";"):
            by_letter.setdefault(n[0], {})[n[:-1]] = c
    maps = F.array(*[_literal_map(by_letter.get(chr(c), {"": ""})) for c in range(65, 123)])
    return F.try_element_at(F.get(maps, F.ascii(name) - 65), name)


def _code_point(digits: Column, base: int) -> Column:
    """Character of a number in decimal or hexadecimal digits, of any length.

    As browsers read it: 128 to 159 are Windows-1252, what is no character becomes
    U+FFFD, and control characters vanish.
    """
    plain = F.regexp_replace(digits, "^0+", "")
    code = F.when(F.length(plain) <= 7, F.conv(plain, base, 10).cast("bigint"))
    old = F.create_map(*[F.lit(x) for b in range(0x80, 0xA0) for x in (
        b, bytes([b]).decode("cp1252", "ignore") or chr(b))])
    control = code.between(1, 8) | code.between(14, 31) | code.isin(11, 127) | \
        code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    safe = F.when(valid, code).otherwise(0xFFFD)
    char = F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")
    return (F.when(code.between(0x80, 0x9F), F.try_element_at(old, code.cast("int")))
            .when(valid & control, "").otherwise(char))


def _decoded(p: Column) -> Column:
    """What follows an ampersand, up to the next one, with its entity decoded."""
    number = blank_to_null(F.regexp_extract(p, NUMBER, 1))
    whole_number = F.length(F.regexp_extract(p, NUMBER, 0))
    name = blank_to_null(F.regexp_extract(p, NAME, 1))
    char = (F.when(number.rlike("^#[xX]"), _code_point(F.substr(number, F.lit(3)), 16))
            .when(number.isNotNull(), _code_point(F.substr(number, F.lit(2)), 10))
            .otherwise(_named(name)))
    size = F.when(number.isNotNull(), whole_number).otherwise(F.length(name) + 1)
    opened = blank_to_null(F.regexp_extract(p, f"^({'|'.join(OPEN_NAMES)})", 1))
    half = F.try_element_at(_literal_map({n: html5[n] for n in OPEN_NAMES}), opened)
    return F.coalesce(F.concat(char, F.substr(p, size + 1)),
                      F.concat(half, F.substr(p, F.length(opened) + 1)),
                      F.concat(F.lit("&"), p))


def unescape(c: Column) -> Column:
    """Decode named and numeric entities in one pass; unknown ones stay as they are.

    Half-written entities count as browsers read them: numbers without a semicolon, and the
    longest of the names that need none (``&notit;`` is the sign of "not" and ``it;``).
    Text without ``&`` is left alone, and text with common entities only is decoded by
    replacement; the rest is cut at each ``&``, so that a decoded ``&amp;`` can never start
    another entity.
    """
    plain = c
    for entity, char in COMMON:
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    decoded = F.transform(F.split(c, "&"), lambda p, i: F.when(i == 0, p).otherwise(_decoded(p)))
    return (F.when(~F.contains(c, F.lit("&")), c).when(~c.rlike(UNCOMMON), plain)
            .otherwise(F.array_join(decoded, "")))


def clean_text(c: Column) -> Column:
    text = unescape(F.regexp_replace(c, r"<[^>]+>", ""))
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def cards(page: Column) -> Column:
    return F.regexp_extract_all(page, F.lit(CARD), F.lit(0))


def raw_attr(c: Column, name: str) -> Column:
    return blank_to_null(F.regexp_extract(c, rf'{name}="([^"]+)"', 1))


def attr(c: Column, name: str) -> Column:
    return unescape(raw_attr(c, name))


def raw_card(card: Column) -> Column:
    """The undecoded parts of a product card, one regular expression each."""
    return F.struct(
        raw_attr(card, "href").alias("href"), raw_attr(card, "src").alias("src"),
        raw_attr(card, "alt").alias("alt"),
        F.regexp_extract(card, r"(?s)<h2\b[^>]*>(.*?)</h2>", 1).alias("h2"),
        F.regexp_extract(card, PRICE_SPAN, 1).alias("span"))


def tag_text(c: Column, tag: str = "h2") -> Column:
    """Text of the first element: NULL without one, maybe empty with one."""
    pattern = rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"
    return F.when(c.rlike(pattern), clean_text(F.regexp_extract(c, pattern, 1)))


def price(c: Column) -> Column:
    return price_text(F.regexp_extract(c, PRICE_SPAN, 1))


def price_text(span: Column) -> Column:
    return parse_brl(blank_to_null(clean_text(span)))


def product_id(href: Column) -> Column:
    return blank_to_null(F.regexp_extract(href, ID_IN_HREF, 1))


def url_join(base: str, href: Column) -> Column:
    """Absolute links stay, others are resolved against the site root."""
    path = F.regexp_replace(F.coalesce(href, F.lit("")), r"^/+", "")
    return F.when(href.rlike(r"^https?://"), href).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), path))
