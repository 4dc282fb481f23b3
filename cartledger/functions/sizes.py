"""Package sizes and canonical unit prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V

_BASES = {"fl_oz": V.VOLUME_UNITS, "oz": V.WEIGHT_UNITS, "ct": V.COUNT_UNITS}
_UNIT_BASE = {unit: base for base, units in _BASES.items() for unit in units}
_UNIT_FACTOR = {unit: f for units in _BASES.values() for unit, f in units.items()}


def unit_pattern() -> str:
    """Alternation over every unit word, longer words tried first."""
    words = sorted(_UNIT_BASE, key=lambda w: -len(w))
    return "|".join(w.replace(".", r"\.") for w in words)


def size_patterns() -> tuple[str, str]:
    units = unit_pattern()
    amount = r"(\d+\s+\d+/\d+|\d+/\d+|\d+(?:\.\d+)?)"
    return rf"{amount}\s*({units})\b", rf"per\s+({units})\b"


def _lookup(values: dict, key: Column) -> Column:
    flat = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*flat)[key]


def parse_magnitude(token: Column) -> Column:
    """``3``, ``1.5``, ``1/2`` or ``1 1/2``; NULL when the divisor is zero."""
    whole = F.nullif(F.regexp_extract(token, r"^(\d+(?:\.\d+)?)(?:\s|$)", 1), F.lit(""))
    top = F.regexp_extract(token, r"(\d+)/(\d+)$", 1).try_cast("double")
    bottom = F.regexp_extract(token, r"(\d+)/(\d+)$", 2).try_cast("double")
    part = F.when(token.contains("/"), F.try_divide(top, bottom)).otherwise(F.lit(0.0))
    return F.coalesce(whole.cast("double"), F.lit(0.0)) + part


def parse_size(text: Column) -> Column:
    """Struct (magnitude, unit, base_unit, base_qty), NULL when no size is found.

    The first amount with a unit wins; otherwise ``per <unit>`` counts as one.
    The text is searched once: the match is bound to a lambda variable and the
    rest reads that short token.
    """
    sized, per = size_patterns()
    low = F.lower(text)
    found = F.coalesce(
        F.nullif(F.regexp_extract(low, sized, 0), F.lit("")),
        F.nullif(F.regexp_extract(low, per, 0), F.lit("")),
    )

    def read(token: Column) -> Column:
        is_per = token.startswith("per")
        unit = F.regexp_replace(token, r"^(?:per\s+|[\d\s./]+)", "")
        amount = F.rtrim(F.regexp_extract(token, r"^(?:\d+\s+\d+/\d+|[\d./]+)", 0))
        magnitude = F.when(is_per, F.lit(1.0)).otherwise(parse_magnitude(amount))
        return F.when(
            token.isNotNull(),
            F.struct(
                magnitude.alias("magnitude"),
                unit.alias("unit"),
                _lookup(_UNIT_BASE, unit).alias("base_unit"),
                (magnitude * _lookup(_UNIT_FACTOR, unit)).alias("base_qty"),
            ),
        )

    return F.get(F.transform(F.array(found), read), F.lit(0))


def price_per_base(price: Column, size: Column) -> Column:
    """Struct (unit_price, unit) from a price and a size struct: price per base
    unit to four places and its ``$/<base>`` label; both NULL without a price or
    a positive size."""

    def read(parsed: Column) -> Column:
        usable = price.isNotNull() & (parsed["base_qty"] > 0)
        per_unit = F.round(F.try_divide(price.cast("double"), parsed["base_qty"]), 4)
        return F.struct(
            F.when(usable, per_unit).alias("unit_price"),
            F.when(usable, F.concat(F.lit("$/"), parsed["base_unit"])).alias("unit"),
        )

    return F.get(F.transform(F.array(size), read), F.lit(0))


def unit_price(price: Column, size_text: Column) -> Column:
    """:func:`price_per_base` straight from the size text."""
    return price_per_base(price, parse_size(size_text))
