"""Quantities and units found in product names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola import dims
from gondola.functions.numbers import comma_to_float
from gondola.functions.text import blank_to_null


def _volume_part(name: Column, group: int, strict: bool) -> Column:
    pattern = dims.VOLUME_PATTERN_STRICT if strict else dims.VOLUME_PATTERN
    return blank_to_null(F.regexp_extract(F.lower(name), pattern, group))


def volume_quantity(name: Column, strict: bool = False) -> Column:
    return comma_to_float(_volume_part(name, 1, strict))


def volume_unit(name: Column, strict: bool = False) -> Column:
    return _volume_part(name, 2, strict)


def extract_volume(name: Column, strict: bool = False) -> Column:
    """First number with a unit as ``struct(quantity, unit)``."""
    return F.struct(volume_quantity(name, strict).alias("quantity"),
                    volume_unit(name, strict).alias("unit"))


def norm_unit(unit: Column) -> Column:
    """``L``, ``ml``, ``kg``, ``g`` or ``un``; NULL for an unknown unit."""
    names = {u: dims.UNIT_SYMBOLS.get(u, dims.OTHER_UNIT) for u in dims.UNIT_FACTORS
             if u == u.lower()}
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.try_element_at(table, F.trim(F.lower(unit)))


def unit_factor(unit: Column) -> Column:
    table = F.create_map(*[F.lit(x) for u, f in dims.UNIT_FACTORS.items()
                           if u == u.lower() and f != 1.0 for x in (u, f)])
    return F.coalesce(F.try_element_at(table, F.lower(unit)), F.lit(1.0))


def to_base_unit(quantity: Column, unit: Column) -> Column:
    """Quantity in ml, g or un; unknown or missing units leave it unchanged."""
    return quantity * unit_factor(unit)
