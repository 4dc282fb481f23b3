"""Text expressions. All stay in the JVM except :func:`unescape_all`."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V


def normalize_name(raw: Column) -> Column:
    """Matching key of a product name: no marks, sizes or punctuation; '' for NULL."""
    text = F.lower(F.regexp_replace(raw, V.TRADEMARKS, ""))
    for pattern in (V.PARENTHESES, V.NAME_SIZE_TOKENS, "[^a-z0-9 ]+", r"\s+"):
        text = F.regexp_replace(text, pattern, " ")
    return F.coalesce(F.trim(text), F.lit(""))


def display_name(raw: Column) -> Column:
    """Name shown for a canonical product: trademark signs dropped, trimmed."""
    bare = F.regexp_replace(F.coalesce(raw, F.lit("")), V.TRADEMARKS, "")
    return F.regexp_replace(bare, r"^\s+|\s+$", "")


def unescape_basic(text: Column) -> Column:
    """The five markup entities, in the JVM. ``&amp;`` goes last so that an
    escaped entity is opened once only."""
    for pattern, char in (
        ("&quot;|&#34;|&#x22;", '"'),
        ("&lt;|&#60;", "<"),
        ("&gt;|&#62;", ">"),
        ("&apos;|&#39;|&#x27;", "'"),
        ("&amp;|&#38;", "&"),
    ):
        text = F.regexp_replace(text, pattern, char)
    return text


@F.pandas_udf(T.StringType())
def _unescape_batch(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def unescape_all(text: Column) -> Column:
    """Every named and numeric HTML entity. Spark has no such built-in, so this
    is one Arrow batch call; use :func:`unescape_basic` where five suffice."""
    return _unescape_batch(text)


def to_double(text: Column) -> Column:
    """Number in text, NULL when it is not one."""
    return text.try_cast("double")


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that gives NULL, not '', when nothing matches."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))
