"""Price expressions: promotions, discounts, ad weeks, confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V


def ad_week(when: Column) -> Column:
    """The Wednesday on or before a date; zone is the session's (pin UTC)."""
    return F.date_sub(F.next_day(F.to_date(when), "WED"), 7)


def discount_pct(regular: Column, price: Column) -> Column:
    """Whole percent off, ties to even; NULL without a positive regular price."""
    off = F.try_divide((regular - price).cast("double"), regular.cast("double"))
    return F.when(regular > 0, F.rint(off * 100))


def promo_when_positive(regular: Column, promo: Column) -> Column:
    """Promotion rule of catalogues that send ``promo = 0`` for none."""
    return F.coalesce(promo > 0, F.lit(False))


def promo_when_lower(regular: Column, sale: Column) -> Column:
    """Promotion rule of catalogues whose sale price must undercut the regular."""
    below = regular.isNull() | (regular == 0) | (sale < regular)
    return F.coalesce((sale > 0) & below, F.lit(False))


def effective_price(regular: Column, offered: Column, is_promo: Column) -> Column:
    """Struct (price, regular_price, is_promo, discount_pct): what is paid now;
    the regular price is kept only while a promotion runs."""
    return F.struct(
        F.when(is_promo, offered).otherwise(regular).alias("price"),
        F.when(is_promo, regular).alias("regular_price"),
        is_promo.alias("is_promo"),
        F.when(is_promo, discount_pct(regular, offered)).alias("discount_pct"),
    )


def source_confidence(
    source: Column,
    known: dict[str, float] = V.SOURCE_CONFIDENCE,
    default: float = V.DEFAULT_SOURCE_CONFIDENCE,
) -> Column:
    pairs = [F.lit(x) for item in known.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[source], F.lit(default))


def clamp_verdict(verdict: Column, confidence: Column, reason: Column) -> Column:
    """A decider's answer made safe to store: default ``no_match``, confidence
    inside [0, 1], reason at most 500 characters."""
    return F.struct(
        F.coalesce(verdict, F.lit("no_match")).alias("verdict"),
        F.greatest(
            F.lit(0.0), F.least(F.lit(1.0), F.coalesce(confidence, F.lit(0.0)))
        ).alias("confidence"),
        F.substring(F.coalesce(reason, F.lit("")), 1, V.MAX_REASON_CHARS).alias("reason"),
    )
