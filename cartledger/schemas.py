"""Table schemas. Additive change goes through :func:`conform`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T._parse_datatype_string(" ".join(text.split()))


DDL = {
    "record": """source string, source_sku string, raw_name string, raw_brand string,
        raw_size_text string, category_hint string, price double, regular_price double,
        unit_price double, unit string, is_promo boolean, discount_pct double,
        promo_text string""",
    "bronze_manifest": """manifest_id bigint, source string, source_kind string,
        fetched_at timestamp, ad_week date, region string, store_id string,
        request_url string, request_params string, http_status int, content_type string,
        raw_path string, content_sha256 string, byte_size bigint, parse_status string,
        parser_version string, notes string""",
    "sources": """source string, banner string, chain_parent string, access_method string,
        confidence_tier string""",
    "stores": """source string, store_id string, banner string, name string, address string,
        zip string, region string, lat double, lon double""",
    "canonical_products": """canonical_id bigint, name string, category string,
        coarse_category string, brand string, canonical_unit string, size_value double,
        notes string, created_at timestamp""",
    "source_products": """source_product_id bigint, source string, source_sku string,
        raw_name string, raw_brand string, raw_size_text string, category_hint string,
        coarse_category string, canonical_id bigint, match_confidence double,
        match_method string, resolved_at timestamp, first_seen_at timestamp,
        last_seen_at timestamp, bronze_manifest_id bigint""",
    "prices": """price_id bigint, source_product_id bigint, source string, store_id string,
        region string, observed_at timestamp, ad_week date, price decimal(10,2),
        regular_price decimal(10,2), unit_price decimal(12,4), unit string,
        is_promo boolean, discount_pct double, promo_text string, valid_from date,
        valid_to date, bronze_manifest_id bigint, confidence double""",
    "match_verdicts": """verdict_id bigint, term string, canonical_id bigint, verdict string,
        confidence double, reason string, model string, decided_by string,
        created_at timestamp, updated_at timestamp""",
    "match_review_queue": """verdict_id bigint, status string, created_at timestamp,
        resolved_at timestamp, resolved_by string""",
    "resolution_queue": """queue_id bigint, source_product_id bigint,
        candidate_canonical_id bigint, proposed_confidence double, reason string,
        status string, created_at timestamp, resolved_at timestamp, resolved_by string""",
    "baskets": """basket_id bigint, name string, household_size int, is_synthetic boolean,
        created_at timestamp, notes string""",
    "basket_items": """basket_id bigint, canonical_id bigint, category string, label string,
        quantity bigint""",
    "narrations": """basket_id bigint, ad_week date, narration string, citations string,
        facts string, model string, audit_ok boolean, created_at timestamp""",
}


def schema(name: str) -> T.StructType:
    return _schema(DDL[name])


def empty(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], schema(name))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Bring ``df`` to the current schema: absent columns arrive as NULL,
    present ones are cast, extra ones are kept at the end."""
    wanted = schema(name)
    have = set(df.columns)
    cols = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in wanted
    ]
    return df.select(*cols, *[c for c in df.columns if c not in wanted.names])


def register(tables: dict[str, DataFrame]) -> list[str]:
    """Expose every table as a temp view; running it again replaces them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
