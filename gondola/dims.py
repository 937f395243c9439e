"""Lookup tables, thresholds and labels the results depend on."""

from __future__ import annotations

# --- fixed values: unit -> factor to the base unit (ml, g or un) -------------
UNIT_FACTORS = {
    "L": 1000.0, "l": 1000.0, "liter": 1000.0, "litre": 1000.0, "ml": 1.0, "milliliter": 1.0,
    "kg": 1000.0, "kilogram": 1000.0, "g": 1.0, "gram": 1.0, "mg": 0.001,
    "un": 1.0, "unit": 1.0, "pc": 1.0, "piece": 1.0, "pcs": 1.0, "pç": 1.0, "pça": 1.0,
}
# unit symbols that keep a name of their own; every other known unit counts as "un"
UNIT_SYMBOLS = {"l": "L", "ml": "ml", "kg": "kg", "g": "g"}
OTHER_UNIT = "un"
VOLUME_PATTERN = r"(\d+(?:[.,]\d+)?)\s*(l|ml|kg|g|mg|un|pc|pç|pça)"
VOLUME_PATTERN_STRICT = r"\b(\d+(?:[.,]\d+)?)\s*(ml|l|kg|mg|g|un|pça|pç|pc)\b"

# --- fixed values: standard category -> patterns; order decides fuzzy matches --
CATEGORY_PATTERNS = [
    ("Laticínios", ["laticínios", "leite", "leites", "leite e derivados", "queijo", "queijos",
                    "iogurte", "iogurtes", "derivados do leite", "mantega", "manteiga",
                    "requeijão"]),
    ("Bebidas", ["bebidas", "bebida", "bebidas não alcoólicas", "sucos", "suco", "refrigerante",
                 "refrigerantes", "água", "bebida láctea", "bebidas lácteas", "café", "chá"]),
    ("Carnes", ["carnes", "carne", "frango", "peixes", "peixe", "embutidos", "embutido"]),
    ("Frutas & Vegetais", ["frutas", "fruta", "verduras", "verdura", "legumes", "legume"]),
    ("Padaria", ["padaria", "pão", "pães", "bolos", "bolo", "biscoitos", "biscoito"]),
    ("Pantry", ["alimentos", "alimento", "arroz", "feijão", "macarrão", "massa", "óleo", "sal",
                "açúcar"]),
]
UNCATEGORIZED = "Uncategorized"

# --- fixed values: documented one-to-many categories --------------------------
CATEGORY_MULTI = {
    "laticínios": ["Laticínios"],
    "leites": ["Laticínios"],
    "leite e derivados": ["Laticínios"],
    "bebidas": ["Bebidas", "Bebidas Não Alcoólicas"],
    "bebidas lácteas": ["Bebidas", "Laticínios"],
}
# --- fixed values: documented two-level hierarchy, parent and children -------------
CATEGORY_CHILDREN = {"Laticínios": ["Leites", "Queijos", "Iogurtes", "Derivados"]}

# --- fixed values: brand aliases, looked up without a legal suffix; suffixes ----
BRAND_ALIASES = {
    "Nestle": "Nestlé", "P&G": "Procter & Gamble", "Kimberly Clark": "Kimberly-Clark",
    "Unilever Brasil": "Unilever", "Coca Cola": "Coca-Cola", "Ambev": "Ambev",
    "Pepsico": "PepsiCo",
}
LEGAL_SUFFIXES = ["S/A", "Ltda", "Inc", "Ltd", "LLC"]
SUSPICIOUS_BRANDS = ["unknown", "not specified", "n/a", "none"]

# --- fixed values: markets -----------------------------------------------------
MARKET_NAMES = {"atacadao": "Atacadão", "carrefour": "Carrefour", "mix_mateus": "Mix Mateus"}
# this market's product codes always come from the search term when it is a code
TRUSTED_SEARCH_MARKET = "carrefour"
MARKET_CEPS = [("atacadao", "04543010"), ("carrefour", None), ("mix_mateus", None)]
# market order for choosing the best product code
EAN_MARKET_PRIORITY = ["atacadao", "carrefour", "mix_mateus"]
DEFAULT_SEARCHES = [("atacadao", "leite", "04543010"), ("carrefour", "leite", None),
                    ("mix_mateus", "leite", None)]

# --- fixed values: limits ------------------------------------------------------
PRICE_MIN, PRICE_MAX = 0.01, 100000.0
EAN_LENGTHS = (8, 12, 13, 14)
COMPLETENESS_FIELDS = ["market", "product_name", "price", "category", "brand", "ean"]
NULL_RATE_LIMITS = {"market": 0.0, "product_name": 0.0, "price": 0.05, "ean": 0.20,
                    "brand": 0.30, "category": 0.10}
MIN_EAN_VALID_RATE = 0.80
MIN_COMPLETENESS = 50.0
MAX_MISSING_BRAND_RATE = 0.20
MAX_UNCATEGORIZED_RATE = 0.10
TOTAL_CHECKS = 7
PRICE_TIERS = [(10.0, "Budget"), (50.0, "Standard")]
TOP_TIER = "Premium"


def category_rows() -> list[tuple[int, str, str]]:
    """(ordinal, pattern, standard) rows of the category dimension, in match order."""
    flat = [(p, std) for std, patterns in CATEGORY_PATTERNS for p in patterns]
    return [(i, p, std) for i, (p, std) in enumerate(flat)]
