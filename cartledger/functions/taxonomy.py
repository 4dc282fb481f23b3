"""Coarse product categories as one Catalyst expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def _first_rule(text: Column, rules: list[tuple[str, str]]) -> Column:
    low = F.lower(text)
    whens = [(low.rlike(rf"\b(?:{words})\b"), F.lit(name)) for words, name in rules]
    return reduce(lambda c, w: c.when(*w), whens[1:], F.when(*whens[0]))


def coarse_category(
    hint: Column, name: Column, hint_rules=V.HINT_RULES, name_rules=V.NAME_RULES
) -> Column:
    """The retailer's own hint decides first, then the name; NULL when neither
    says anything."""
    return F.coalesce(_first_rule(hint, hint_rules), _first_rule(name, name_rules))


def list_to_coarse(list_category: Column, mapping: dict[str, str] = V.LIST_TO_COARSE) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[list_category]


def compatible(left: Column, right: Column) -> Column:
    """Category guard: blocks only when both sides are known and differ."""
    return left.isNull() | right.isNull() | (left == right)
