"""Literal-row tests of every cleaning function."""

import json

import pytest
from pyspark.sql import functions as F

from gondola import dims
from gondola.functions import ean, html, numbers, scoring, text, units


def values(spark, fn, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def check(spark, fn, cases, kind="string"):
    assert values(spark, fn, list(cases), kind) == list(cases.values())


def test_names(spark):
    check(spark, text.norm_name, {
        "  LEITE  INTEGRAL PARMALAT 1L  ": "Leite Integral Parmalat 1L",
        "Café Pão d'Água Roll-On 1,010kg": "Cafe Pao DAgua Roll-On 1010Kg",
        "!!!": None, "": None, None: None, "a & b": "A B", "açúcar\tmascavo (1/2)":
        "Acucar Mascavo (1/2)", "a  b": "A B"})


def test_title_case_matches_python(spark):
    words = ["roll-on d'agua 1l", "ÁGUA de côco", "x2y z", "", "a.b_c", "MIX 4U"]
    assert values(spark, text.title_case, words) == [w.title() for w in words]


def test_strip_accents(spark):
    check(spark, text.strip_accents, {"áàâãäçéêíóôõúü": "aaaaaceeiooouu", "ñ": "n",
                                      "plain": "plain", None: None})


def test_volume_units(spark):
    check(spark, units.volume_unit, {
        "12 garrafas": "g", "10 latas": "l", "500 mg": "mg", "12 pça": "pç", "Leite 1L": "l",
        "sem volume": None, None: None})
    assert values(spark, units.volume_quantity, ["Oleo 1,5 l", "Cafe 500g", "x"]) == \
        [1.5, 500.0, None]
    assert values(spark, lambda c: units.volume_unit(c, strict=True),
                  ["12 garrafas", "500 mg"]) == [None, "mg"]
    check(spark, units.norm_unit, {"l": "L", "L": "L", "kg": "kg", "ML": "ml", "mg": "un",
                                   "liter": "un", "xyz": None, None: None})


def test_every_unit_is_known(spark):
    for unit, factor in dims.UNIT_FACTORS.items():
        got = values(spark, lambda c: units.to_base_unit(F.lit(2.0), c), [unit])[0]
        assert got == pytest.approx(2 * dims.UNIT_FACTORS[unit.lower()]), unit
        assert factor == dims.UNIT_FACTORS[unit.lower()]


def test_prices(spark):
    check(spark, numbers.norm_price, {0.009: None, 0.01: 0.01, 100000.0: 100000.0,
                                      100000.01: None, None: None, 2.345: 2.35}, "double")
    check(spark, numbers.parse_brl, {"R$ 1.234,56": 1234.56, "R$ 4,50": 4.5, "grátis": None,
                                     "": None, None: None, "R$ 7,00": 7.0})
    check(spark, numbers.safe_to_float, {"1.5": 1.5, "NaN": None, "x": None, None: None})
    check(spark, numbers.comma_to_float, {
        "1,5": 1.5, "2.5": 2.5, "n/d": None, "R$ 4,50": 4.5, "r$ 1.234,56": 1234.56, "": None})
    check(spark, numbers.price_tier, {9.99: "Budget", 10.0: "Standard", 49.99: "Standard",
                                      50.0: "Premium"}, "double")


def test_price_consistency(spark):
    df = spark.createDataFrame([(10.0, 11.0), (10.0, 11.01), (None, 5.0), (0.0, 5.0)],
                               "p DOUBLE, u DOUBLE")
    got = df.select(numbers.price_consistency(F.col("p"), F.col("u"))).collect()
    assert [r[0] for r in got] == [True, False, True, True]


def test_categories(spark):
    check(spark, text.norm_category, {
        "Leite e Derivados": "Laticínios", "Carnes e Aves": "Carnes", "salsicha": "Pantry",
        "Brinquedos": "Uncategorized", None: "Uncategorized", "   ": "Uncategorized",
        "BEBIDAS LÁCTEAS": "Bebidas"})


def test_category_matches_a_linear_scan(spark):
    flat = dims.category_rows()

    def slow(raw):
        key = (raw or "").lower().strip()
        if not key:
            return dims.UNCATEGORIZED
        exact = {p: s for _, p, s in flat}
        if key in exact:
            return exact[key]
        return next((s for _, p, s in flat if p in key or key in p), dims.UNCATEGORIZED)

    inputs = [p for _, p, _ in flat] + [p[:3] for _, p, _ in flat] + \
        [f"x {p} y" for _, p, _ in flat] + ["frango e peixe", "bolo de leite", "zzz", "a"]
    assert values(spark, text.norm_category, inputs) == [slow(v) for v in inputs]


def test_brands(spark):
    check(spark, text.norm_brand, {
        "PARMALAT S/A": "Parmalat", "P&G": "Procter & Gamble", "Nestle": "Nestlé",
        "acme llc": "Acme", "Foo Ltda.": "Foo", "Foo Incrivel": "Foo Incrivel",
        "leite parmalat LEITE": "Leite Parmalat", "": None, None: None, "coca cola": "Coca-Cola"})


def test_eans(spark):
    df = spark.createDataFrame([(v,) for v in [
        "7894001234567", "7891000100103", "123", "12345678", "123456789012", None, "",
        "789-1000-100103"]], "ean STRING")
    got = {r["ean"]: (r["ean_valid"], r["ean_normalized"], r["error"])
           for r in ean.with_validity(df, error="error").collect()}
    assert got == {
        "7894001234567": (False, "7894001234567", "Invalid check digit: expected 3, got 7"),
        "7891000100103": (True, "7891000100103", None),
        "123": (False, None, "Invalid format: 123"),
        "12345678": (True, "12345678", None), "123456789012": (True, "123456789012", None),
        None: (False, None, "Empty EAN"), "": (False, None, "Empty EAN"),
        "789-1000-100103": (True, "7891000100103", None)}


def test_searched_and_resolved_ean(spark):
    check(spark, ean.searched_ean, {" 12345678 ": "12345678", "leite": None, "123456789": None,
                                    "12345678901234": "12345678901234"})
    rows = [("carrefour", "1", "2"), ("atacadao", "1", "2"), ("atacadao", None, "2"),
            ("atacadao", None, None)]
    df = spark.createDataFrame(rows, "m STRING, r STRING, s STRING")
    got = df.select(ean.resolve_ean(F.col("m"), F.col("r"), F.col("s")).alias("e")).collect()
    assert [tuple(r["e"]) for r in got] == [("2", "search_term"), ("1", "market_response"),
                                            ("2", "search_term"), (None, None)]


def test_scores_and_flags(spark):
    rows = [("m", "n", 5.0, "c", "b", "7891000100103", "Carnes"),
            ("m", "n", 200000.0, None, None, "123", "Uncategorized"),
            ("m", "n", None, None, None, None, "Uncategorized"),
            ("m", "n", 0.0, "c", "", "", "Carnes")]
    df = spark.createDataFrame(rows, "market STRING, product_name STRING, price DOUBLE, "
                               "category STRING, brand STRING, ean STRING, "
                               "category_normalized STRING")
    df = ean.with_validity(df).withColumn("dc", scoring.data_completeness())
    got = df.select("dc", scoring.quality_score(F.col("dc"), F.col("ean_valid")),
                    scoring.quality_flags(F.col("ean_valid"), F.col("dc"),
                                          F.col("category_normalized"))).collect()
    assert [(r[0], r[1]) for r in got] == [(100.0, 100.0), (66.7, 26.7), (33.3, 13.3),
                                           (50.0, 20.0)]
    assert [json.loads(r[2]) for r in got] == [
        [], ["invalid_ean", "price_outlier", "missing_brand", "uncategorized"],
        ["missing_brand", "low_completeness", "uncategorized"], ["price_outlier"]]


def test_free_text(spark):
    check(spark, text.dedup_consecutive_words, {
        "leite Leite  integral leite": "leite integral leite", "a a a b": "a b", "": "",
        "água ÁGUA": "água", "aa a a aa": "aa a aa"})
    check(spark, text.sanitize_string, {" a#b-c! ": "ab-c", None: None})


def test_html(spark):
    import html as std
    samples = ["a &amp; b", "&amp;lt;", "p&atilde;o &#231; &#x1F34E;", "x & y", "&unknown; z",
               "none", "&eacute;&quot;&#39;", "AT&T; &copy;"]
    assert values(spark, html.unescape, samples) == [std.unescape(s) for s in samples]
    card = ('<a data-testid="search-product-card" href="/p-12?x"><img src="/i.png" '
            'alt="Alt &amp; b"><h2 class="t"> <b>Nome</b> </h2>'
            '<span class="a text-price-default">R$ 1.234,56</span></a>')
    page = f"<a href='/x'>n</a>{card}\n{card}"
    assert values(spark, lambda c: F.size(html.cards(c)), [page, "no"]) == [2, 0]
    assert values(spark, html.tag_text, [card, "<p>"]) == ["Nome", None]
    assert values(spark, html.price, [card, "<p>"]) == [1234.56, None]
    assert values(spark, lambda c: html.attr(c, "alt"), [card]) == ["Alt & b"]
    check(spark, html.product_id, {"/p-12?x": "12", "/p-7": "7", "/p-x": None, None: None})
    check(spark, lambda c: html.url_join("https://s.example/", c), {
        "/a": "https://s.example/a", "http://b/c": "http://b/c", None: "https://s.example/"})


def test_market_name(spark):
    assert values(spark, text.market_name, ["atacadao", "mix_mateus", "middle_east"]) == \
        ["Atacadão", "Mix Mateus", "Middle_East"]


def test_entities_are_read_as_browsers_do(spark):
    import html as library
    texts = ["&#9999999;", "&#1114112;", "&#xD800;x", "&#128;", "&#x80;", "&lpar;a&rpar;",
             "&NotEqualTilde;", "&#0;", "&#1;z", "&#0000000000065;", "&#99999999999999999999;",
             "&amp;lt;", "&nosuch;", "a & b", "&#13;", "&#x1F600;"]
    check(spark, html.unescape, {t: library.unescape(t) for t in texts})


def test_accents_over_the_whole_plane(spark):
    check(spark, text.strip_accents, {
        "\u1ea1b": "ab", "\ufb01n": "fin", "\uff21\uff22": "AB", "e\u0301": "e", "\u00bd": "1\u20442",
        "\uac00": "\uac00", "plain": "plain", "\u01c6": "dz"})
    check(spark, text.norm_name, {"\u1ea1b": "Ab"})


def test_every_entity_name_with_and_without_semicolon(spark):
    import html as library
    import random
    from html.entities import html5
    names = sorted({n.rstrip(";") for n in html5})
    rng = random.Random(1)
    texts = [f"&{n};" for n in names] + [f"&{n}" for n in names] + [f"x&{n}y;&" for n in names]
    texts += [f"&{n};&amp;{n};&amp{n}" for n in rng.sample(names, 300)]
    signs = ["&", "#", "x", ";", "amp", "lt", "not", "it", "1", "65", "128", " ", "&amp;", "&lt;",
             "\n", "é", "<", "notin", " ", "&#39;", "AMP", "Copy", "copy", "0", "f"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 12))) for _ in range(4000)]
    check(spark, html.unescape, {t: library.unescape(t) for t in texts})
