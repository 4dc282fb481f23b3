"""Registered queries: sources, scalar functions, ingest."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from cartledger import fixed_values as V
from cartledger.functions import pricing as P
from cartledger.functions import sizes as Z
from cartledger.functions import taxonomy as T
from cartledger.functions import text as X
from cartledger.operators import keyed_table as K
from cartledger.operators import state
from cartledger.plans.narration import with_banner
from cartledger.session import cut_lineage, work_dir
from cartledger.sources import artifacts as A
from cartledger.sources import catalogs as C
from cartledger.sources import pages as H
from cartledger.streaming import ingest

from .oracle import quoted
from .registry import day, dbl, query
from .roles import Roles, size_text, to_money

LINE = ["l_orderkey", "l_linenumber", "l_suppkey"]


# ---- artifacts -------------------------------------------------------------------

def page_artifacts(r: Roles):
    url = F.col("url")
    kind = (
        F.when(url.contains(".html"), "text/html; charset=utf-8")
        .when(url.contains("utm_"), "application/JSON")
        .when(url.contains("#top"), "application/xml")
    )
    return r.table("pages").select(
        F.col("page_id").alias("manifest_id"),
        F.parse_url(url, F.lit("HOST")).alias("source"),
        F.timestamp_micros(F.lit(1704067200123456) + F.col("page_id") * 1000001).alias("fetched_at"),
        F.col("html").alias("content"),
        kind.alias("content_type"),
    )


@query(
    "bronze_manifest",
    """SELECT manifest_id, content_sha256, byte_size, 'pending' AS parse_status,
       source || '/' || strftime(fetched, '%Y-%m-%d') || '/' || strftime(fetched, '%Y%m%dT%H%M%S%f') || '_'
         || left(content_sha256, 8) || '.' || ext AS raw_path
       FROM (SELECT page_id AS manifest_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS source,
         make_timestamp(1704067200123456 + page_id * 1000001) AS fetched,
         sha256(html) AS content_sha256, octet_length(encode(html)) AS byte_size,
         CASE WHEN url LIKE '%.html%' THEN 'html' WHEN contains(url, 'utm_') THEN 'json'
              WHEN contains(url, '#top') THEN 'xml' ELSE 'bin' END AS ext FROM pages)""",
)
def _(r):
    return A.land(page_artifacts(r)).select(
        "manifest_id", "content_sha256", "byte_size", "parse_status", "raw_path"
    )


def event_manifest(r: Roles):
    return r.table("events").select(
        F.col("event_id").alias("manifest_id"),
        F.col("event_type").alias("source"),
        F.col("props").alias("request_params"),
        F.when(F.col("user_id") % 2 == 0, "pending").otherwise("parsed").alias("parse_status"),
    )


@query(
    "pending_manifests",
    """SELECT event_id AS manifest_id, event_type AS source FROM events
       WHERE user_id % 2 = 0 AND (event_type IN ('purchase', 'view')
         OR (event_type = 'click' AND json_extract_string(props, '$.k') = '7'))""",
)
def _(r):
    rules = {"click": ("$.k", "7"), "purchase": None, "view": None}
    return A.pending(event_manifest(r), rules).select("manifest_id", "source")


@query(
    "json_endpoint_filter",
    """SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, sum(value::DECIMAL(12,2))::DOUBLE AS total
       FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1""",
)
def _(r):
    rows = r.table("events").withColumn("k", F.get_json_object("props", "$.k"))
    return rows.filter("k IS NOT NULL").groupBy("k").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total")
    )


@query(
    "incremental_ingest",
    """SELECT doc_id AS manifest_id,
       CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'parsed' ELSE 'pending' END AS parse_status,
       CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'v1' END AS parser_version,
       doc_id NOT IN (SELECT doc_id FROM labels) AS waiting FROM documents""",
)
def _(r):
    """Labelled documents count as parsed; the rest is what a run would take."""
    manifest = r.table("documents").select(
        F.col("doc_id").alias("manifest_id"),
        F.lit("pending").alias("parse_status"),
        F.lit(None).cast("string").alias("parser_version"),
    )
    parsed = r.table("labels").select(F.col("doc_id").alias("manifest_id"))
    marked = A.mark_parsed(manifest, parsed)
    waiting = A.unparsed(manifest, parsed).select("manifest_id", F.lit(True).alias("waiting"))
    return marked.join(waiting, "manifest_id", "left").withColumn(
        "waiting", F.coalesce("waiting", F.lit(False))
    )


def streamed(r: Roles) -> str:
    """Orders as artifacts, each line a product of its part (every fifth line without sku), in two deliveries
    through the stream; the second brings a third of the first again. Some payloads can't be read."""
    spark, root = r.spark, os.path.join(work_dir(r.spark), f"stream-{uuid.uuid4().hex}")
    price = F.struct(F.col("p_retailprice").alias("regular"))
    product = F.struct(
        "l_linenumber", F.when(F.col("l_linenumber") % 5 > 0, F.col("l_partkey").cast("string")).alias("productId"),
        F.col("p_name").alias("description"), F.array(F.struct(price.alias("price"), F.lit("1 ct").alias("size"))).alias("items"),
    )
    lines = r.table("lineitem").join(r.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    payload = F.to_json(F.struct(F.array_sort(F.collect_list(product)).alias("data")))
    orders = lines.groupBy("l_orderkey").agg(payload.alias("payload")).join(
        r.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    key = F.col("o_orderkey")
    artifacts = orders.select(
        key.alias("manifest_id"), F.lit("kroger").alias("source"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"),
        F.when(key % 50 == 7, "oops").otherwise(F.col("payload")).alias("payload"),
    )
    key = F.col("manifest_id")
    for delivered in (key % 2 == 0, (key % 2 == 1) | (key % 6 == 0)):
        artifacts.filter(delivered).write.mode("append").json(f"{root}/incoming")
        ingest.ingest_stream(spark, f"{root}/incoming", root).awaitTermination()
    return root


@query(
    "stream_manifest",
    """SELECT o_orderkey AS manifest_id, CASE WHEN o_orderkey % 50 = 7 THEN 'failed' ELSE 'parsed' END AS parse_status,
       CASE WHEN o_orderkey % 50 = 7 THEN 0 ELSE count(*) END AS n_prices,
       CASE WHEN o_orderkey % 50 = 7 THEN 0 ELSE sum(p_retailprice::DECIMAL(10,2))::DOUBLE END AS total
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY o_orderkey""",
)
def _(r):
    root = streamed(r)
    prices = ingest.ingested_prices(r.spark, root).groupBy(F.col("bronze_manifest_id").alias("manifest_id")).agg(
        F.count("*").alias("n"), F.sum("price").cast("double").alias("sum")
    )
    manifest = r.spark.read.parquet(f"{root}/artifacts").select("manifest_id", "parse_status")
    return manifest.join(prices, "manifest_id", "left").select(
        "manifest_id", "parse_status", F.coalesce("n", F.lit(0)).alias("n_prices"), F.coalesce("sum", F.lit(0.0)).alias("total")
    )


@query(
    "stream_products",
    """SELECT source_sku, raw_name, CASE WHEN source_sku IS NULL THEN count(*) ELSE 1 END AS n_products, count(*) AS n_prices,
       strftime(min(d), '%Y-%m-%d') AS first_seen, strftime(max(d), '%Y-%m-%d') AS last_seen FROM (
         SELECT CASE WHEN l_linenumber % 5 > 0 THEN l_partkey::VARCHAR END AS source_sku, p_name AS raw_name, o_orderdate::DATE AS d
         FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderkey % 50 <> 7)
       GROUP BY source_sku, raw_name""",
)
def _(r):
    root = streamed(r)
    products = ingest.ingested_products(r.spark, root)
    prices = ingest.ingested_prices(r.spark, root).groupBy("source_product_id").agg(F.count("*").alias("n"))
    return products.join(prices, "source_product_id").groupBy("source_sku", "raw_name").agg(
        F.count("*").alias("n_products"), F.sum("n").alias("n_prices"),
        F.date_format(F.min("first_seen_at"), "yyyy-MM-dd").alias("first_seen"),
        F.date_format(F.max("last_seen_at"), "yyyy-MM-dd").alias("last_seen"),
    )


@query(
    "url_policy",
    """SELECT page_id, path, reason IS NULL AS allowed, reason FROM (
         SELECT page_id, path, CASE WHEN starts_with(path, '/es') THEN 'prefix /es'
            WHEN starts_with(path, '/de') THEN 'prefix /de'
            WHEN contains(path, 'utm_source=') THEN 'parameter utm_source=' END AS reason
         FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1) AS path FROM pages))""",
)
def _(r):
    rows = r.table("pages").select("page_id", A.url_path(F.col("url")).alias("path"))
    return rows.withColumn(
        "reason", A.url_policy(F.col("path"), ["/es", "/de"], "utm_source=")
    ).withColumn("allowed", F.col("reason").isNull())


# ---- payloads ---------------------------------------------------------------------

def line_parts(r: Roles):
    part = r.table("part").withColumnRenamed("p_partkey", "l_partkey").withColumn("p_partkey", F.col("l_partkey"))
    return r.priced_lines.join(part, "l_partkey")


LINE_PARTS = """(SELECT c.*, p.p_brand, p.p_name, p.p_type, p.size_text AS size_text,
    s.base_unit, s.base_qty
    FROM cents c JOIN parts p ON p.p_partkey = c.l_partkey JOIN sized s ON s.p_partkey = c.l_partkey)"""
PER_UNIT = "round(((({price})::DOUBLE / base_qty)::VARCHAR)::DECIMAL(38,18), 4)::DOUBLE"


@query(
    "parse_catalog_json",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, source_sku, raw_name, raw_brand, raw_size_text,
       category_hint, price, regular_price, {PER_UNIT.format(price="price")} AS unit_price,
       '$/' || base_unit AS unit, is_promo, discount_pct FROM (
       SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey::VARCHAR AS source_sku,
         p_name AS raw_name, p_brand AS raw_brand, size_text AS raw_size_text, p_type AS category_hint,
         CASE WHEN percent > 0 THEN paid_cents ELSE regular_cents END::DOUBLE / 100 AS price,
         CASE WHEN percent > 0 THEN regular_cents::DOUBLE / 100 END AS regular_price,
         percent > 0 AS is_promo, base_unit, base_qty,
         CASE WHEN percent > 0 THEN round_even((regular_cents::DOUBLE / 100 - paid_cents::DOUBLE / 100)
              / (regular_cents::DOUBLE / 100) * 100, 0) END AS discount_pct
       FROM {LINE_PARTS})""",
)
def _(r):
    """Each line item becomes a one-product payload, then goes through the parser."""
    offer = F.struct(
        (F.col("regular_cents").cast("double") / 100).alias("regular"),
        F.when(F.col("percent") > 0, F.col("paid_cents").cast("double") / 100)
        .otherwise(F.lit(0.0)).alias("promo"),
    )
    product = F.struct(
        F.col("l_partkey").cast("string").alias("productId"),
        F.col("p_brand").alias("brand"),
        F.array("p_type").alias("categories"),
        F.col("p_name").alias("description"),
        F.array(F.struct(offer.alias("price"), size_text().alias("size"))).alias("items"),
    )
    payloads = line_parts(r).select(
        *LINE, F.to_json(F.struct(F.array(product).alias("data"))).alias("payload")
    )
    return C.parse_first_item(payloads, LINE).drop("source", "promo_text")


@query(
    "parse_breadcrumb_json",
    f"""SELECT p_partkey, 'PART-' || p_partkey AS source_sku, p_name AS raw_name, p_brand AS raw_brand,
       uom AS raw_size_text, p_type AS category_hint, price, regular_price,
       {PER_UNIT.format(price="price")} AS unit_price, '$/' || base_unit AS unit, is_promo, discount_pct
       FROM (SELECT *, CASE WHEN is_promo THEN sale ELSE regular END AS price,
         CASE WHEN is_promo THEN regular END AS regular_price,
         CASE WHEN is_promo THEN round_even((regular - sale) / regular * 100, 0) END AS discount_pct,
         CASE uom WHEN 'lb' THEN 16.0::DOUBLE ELSE 1.0::DOUBLE END AS base_qty,
         CASE uom WHEN 'lb' THEN 'oz' ELSE 'ct' END AS base_unit
         FROM (SELECT *, sale > 0 AND sale < regular AS is_promo FROM (
           SELECT *, p_retailprice AS regular, p_size * 25.0::DOUBLE AS sale,
             CASE WHEN p_size % 2 = 0 THEN 'lb' ELSE 'ea' END AS uom FROM part)))""",
)
def _(r):
    product = F.struct(
        F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
        F.concat(F.lit("PART-"), "p_partkey").alias("slug"),
        F.col("p_retailprice").alias("regularPrice"),
        (F.col("p_size") * 25.0).alias("salePrice"),
        F.when(F.col("p_size") % 2 == 0, "lb").otherwise("ea").alias("uom"),
    )
    crumbs = F.array(
        F.struct(F.lit("Products").alias("label")), F.struct(F.col("p_type").alias("label"))
    )
    payloads = r.table("part").select(
        "p_partkey",
        F.to_json(F.struct(crumbs.alias("breadcrumb"), F.array(product).alias("results"))).alias("payload"),
    )
    return C.parse_breadcrumb(payloads, ["p_partkey"]).drop("source", "promo_text")


@query(
    "parse_text_price_json",
    f"""SELECT p_partkey, p_partkey::VARCHAR AS source_sku, p_name AS raw_name, raw_size_text, category_hint,
       price, {PER_UNIT.format(price="price")} AS unit_price, '$/oz' AS unit, is_promo FROM (
       SELECT *, CASE WHEN p_size % 5 = 0 THEN p_size * 1.5::DOUBLE ELSE p_retailprice END AS price,
         p_size || ' Lb' AS raw_size_text, p_type AS category_hint, p_size * 16.0::DOUBLE AS base_qty,
         false AS is_promo FROM part)""",
)
def _(r):
    text = F.when(F.col("p_size") % 5 == 0, "ask in store").otherwise(F.col("p_retailprice").cast("string"))
    nested = F.struct(F.struct(F.struct((F.col("p_size") * 1.5).alias("value")).alias("final_price")).alias("minimum_price"))
    product = F.struct(
        F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("item_title"),
        F.array(F.struct(F.lit("Products").alias("name")), F.struct(F.col("p_type").alias("name"))).alias("category_hierarchy"),
        F.col("p_size").alias("sales_size"), F.lit("Lb").alias("sales_uom_description"),
        text.alias("retail_price"), nested.alias("price_range"),
    )
    items = F.struct(F.struct(F.array(product).alias("items")).alias("products"))
    payloads = r.table("part").select("p_partkey", F.to_json(F.struct(items.alias("data"))).alias("payload"))
    return C.parse_string_price(payloads, ["p_partkey"]).drop(
        "source", "promo_text", "raw_brand", "regular_price", "discount_pct"
    )


@query(
    "artifact_profile",
    """SELECT l_orderkey, sum(2)::BIGINT AS n_products, count(*) FILTER (WHERE percent > 0) AS n_priced
       FROM cents GROUP BY l_orderkey""",
)
def _(r):
    """Two products per line payload; one is priced only under a discount."""
    price = F.when(F.col("percent") > 0, F.struct(F.col("paid_cents").cast("double").alias("regular")))
    priced = F.struct(F.array(F.struct(price.alias("price"))).alias("items"))
    bare = F.struct(F.array(F.struct(F.when(F.lit(False), F.struct(F.lit(0.0).alias("regular"))).alias("price"))).alias("items"))
    payloads = r.priced_lines.select(
        "l_orderkey", F.to_json(F.struct(F.array(priced, bare).alias("data"))).alias("payload")
    )
    return C.artifact_profile(payloads, ["l_orderkey"]).groupBy("l_orderkey").agg(
        F.sum("n_products").alias("n_products"), F.sum("n_priced").alias("n_priced")
    )


@query(
    "preferred_store",
    """SELECT source, store_id, name, preferred FROM (
       SELECT source, s_suppkey AS store_id, s_name AS name, contains(s_name, '77') AS preferred FROM places)
       QUALIFY row_number() OVER (PARTITION BY source ORDER BY NOT preferred, store_id) = 1""",
)
def _(r):
    stores = r.stores.withColumn("position", F.col("store_id"))
    flag = C.is_preferred(F.lit(None).cast("string"), F.col("name"), banner="77")
    return C.preferred_store(stores, ["source"], flag)


UNESCAPED = """replace(replace(replace(replace(html, '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"""


@query(
    "html_blob_extract",
    f"""SELECT page_id, target, label FROM (
       SELECT page_id, i, regexp_extract(piece, '^([^"]+)"', 1) AS target,
         regexp_extract(piece, '^[^"]*">([^<]*)</a>', 1) AS label,
         regexp_matches(piece, '^([^"]+)"') AND regexp_matches(piece, '^[^"]*">([^<]*)</a>') AS ok
       FROM (SELECT page_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i
         FROM (SELECT page_id, string_split({UNESCAPED}, '<a href="') AS pieces FROM pages)))
       WHERE i > 1 AND ok
       QUALIFY row_number() OVER (PARTITION BY page_id, target, label ORDER BY i) = 1""",
)
def _(r):
    return H.blob_extract(
        r.table("pages"), X.unescape_all(F.col("html")), ["page_id"], '<a href="',
        {"label": r'^[^"]*">([^<]*)</a>'}, ["target", "label"], ["target", "label"], lead="target",
    ).drop("position")


@query(
    "deal_pages",
    f"""SELECT p_partkey, p_partkey::VARCHAR AS source_sku, raw_name, price, regular_price,
       {PER_UNIT.format(price="price")} AS unit_price, '$/' || base_unit AS unit, is_promo,
       CASE WHEN regular_price > 0 THEN round_even((regular_price - price) / regular_price * 100, 0) END AS discount_pct,
       'SALE' AS promo_text FROM (
       SELECT p.p_partkey, p_name || ', ' || p.size_text AS raw_name, p_size + 0.5::DOUBLE AS price,
         CASE WHEN p_size % 7 <> 0 THEN p_size + 2.25::DOUBLE END AS regular_price,
         base_unit, base_qty, true AS is_promo
       FROM parts p JOIN sized s ON s.p_partkey = p.p_partkey)""",
)
def _(r):
    """One entity-escaped deal page per part, through the deal parser."""
    q = "&quot;"

    def field(name, value, is_text=True):
        mark = q if is_text else ""
        return F.concat(F.lit(f",{q}{name}{q}:[0,{mark}"), value, F.lit(f"{mark}]"))

    size = F.col("p_size").cast("double")
    html = F.concat(
        F.lit(f"<script>x={q}{q},{q}_id{q}:[0,{q}store1{q}],{q}name{q}:[0,{q}Store{q}],{q}_id{q}:[0,{q}P"),
        "p_partkey", F.lit(f"{q}]"),
        field("name", F.concat("p_name", F.lit(", "), size_text())),
        F.when(F.col("p_size") % 7 != 0, field("regularPrice", (size + 2.25).cast("string"), False)).otherwise(""),
        field("discountPrice", (size + 0.5).cast("string"), False),
        field("discountType", F.lit("SALE")),
        field("url", F.concat(F.lit("https://shop.example/products/"), "p_partkey", F.lit("-x"))),
        F.lit("</script>"),
    )
    pages = r.table("part").select("p_partkey", html.alias("html"))
    deals = H.parse_deals(pages, ["p_partkey"])
    return H.deal_records(deals, ["p_partkey"]).drop("source", "raw_brand", "raw_size_text", "category_hint")


@query(
    "html_links",
    f"""SELECT page_id, url AS detail_url, title FROM (
       SELECT page_id, i, CASE WHEN starts_with(href, 'http') THEN href ELSE host || href END AS url,
         coalesce(nullif(regexp_replace(regexp_replace(anchor, '(?is)^<a\\s[^>]*>|</a>$', '', 'g'), '<[^>]*>', '', 'g'), ''),
           CASE WHEN starts_with(href, 'http') THEN href ELSE host || href END) AS title
       FROM (SELECT page_id, i, anchor, host,
           replace(regexp_extract(anchor, '(?is)href\\s*=\\s*"([^"]*)"', 1), '&amp;', '&') AS href
         FROM (SELECT page_id, host, unnest(a) AS anchor, generate_subscripts(a, 1) AS i
           FROM (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS host,
                   regexp_extract_all(html, '(?is)<a\\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS a FROM pages)))
       WHERE contains(href, '/t'))
       QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY i) = 1""",
)
def _(r):
    pages = r.table("pages")
    host = F.regexp_extract("url", r"^([a-z]+://[^/?#]+)", 1)
    return H.page_links(pages, ["page_id"], "/t", host).select("page_id", "detail_url", "title")


@query(
    "link_dates",
    """SELECT doc_id, 'https://shop.example/leaflets/' || doc_id AS detail_url, title,
       strftime(try_strptime(pair[1], '%m/%d/%Y'), '%Y-%m-%d') AS valid_from,
       strftime(try_strptime(pair[2], '%m/%d/%Y'), '%Y-%m-%d') AS valid_to
       FROM (SELECT doc_id, CASE doc_id % 3
           WHEN 0 THEN 'Leaflet ' || m || '/' || d || '/2026 - ' || (m + 1) || '/' || d || '/2026'
           WHEN 1 THEN source || ' until ' || m || '/' || d || '/2026' ELSE 'Ad' || m || '/1/2026-' || m || '/' || d || '/2026' END AS title,
         CASE doc_id % 3 WHEN 0 THEN [m || '/' || d || '/2026', (m + 1) || '/' || d || '/2026']
           WHEN 2 THEN [m || '/1/2026', m || '/' || d || '/2026'] END AS pair
         FROM (SELECT doc_id, source, 1 + doc_id % 11 AS m, 1 + doc_id % 28 AS d FROM documents WHERE doc_id IS NOT NULL))""",
)
def _(r):
    """Documents as leaflet pages: the title of each page's link carries a date range, or none. Open tags, a closing
    tag inside a value and a second link to the same leaflet stand around it."""
    m, d = (F.col("doc_id") % 11 + 1).cast("string"), (F.col("doc_id") % 28 + 1).cast("string")
    title = (
        F.when(F.col("doc_id") % 3 == 0,
               F.concat(F.lit("Leaflet "), m, F.lit("/"), d, F.lit("/2026 - "), (F.col("doc_id") % 11 + 2).cast("string"),
                        F.lit("/"), d, F.lit("/2026")))
        .when(F.col("doc_id") % 3 == 1, F.concat("source", F.lit(" until "), m, F.lit("/"), d, F.lit("/2026")))
        .otherwise(F.concat(F.lit("Ad"), m, F.lit("/1/2026-"), m, F.lit("/"), d, F.lit("/2026")))
    )
    link = F.concat(F.lit("<a title='</a>' href=\"/leaflets/"), F.col("doc_id").cast("string"), F.lit("\"> <b>"))
    html = F.concat(F.lit("<p>a < b</a>"), link, title, F.lit("</b></a>"), link, F.lit("again</b></a><a href='/leaflets/x"))
    pages = r.table("documents").filter("doc_id IS NOT NULL").select("doc_id", html.alias("html"))
    links = H.page_links(pages, ["doc_id"], "/leaflets/", "https://shop.example")
    return links.select("doc_id", "detail_url", "title", day("valid_from"), day("valid_to"))


@query(
    "dim_insert_new",
    """SELECT source, origin FROM (
       SELECT source, 'labelled' AS origin, 0 AS o FROM documents JOIN labels USING (doc_id)
       UNION ALL SELECT source, 'document', 1 FROM documents
       UNION ALL SELECT n_name, 'nation', 1 FROM nation)
       QUALIFY row_number() OVER (PARTITION BY source ORDER BY o) = 1""",
)
def _(r):
    docs = r.table("documents")
    old = docs.join(r.table("labels"), "doc_id").select("source").distinct().withColumn("origin", F.lit("labelled"))
    new = docs.select("source", F.lit("document").alias("origin")).unionByName(
        r.table("nation").select(F.col("n_name").alias("source"), F.lit("nation").alias("origin"))
    )
    return state.insert_new(old, new, ["source"])


# ---- scalar functions ----------------------------------------------------------------

@query(
    "parse_size",
    "SELECT p_partkey, magnitude, unit_word AS unit, base_unit, base_qty FROM sized",
)
def _(r):
    return r.table("part").select("p_partkey", Z.parse_size(size_text()).alias("s")).select("p_partkey", "s.*")


@query(
    "unit_price",
    f"""SELECT sized.p_partkey, {PER_UNIT.format(price="p_retailprice")} AS unit_price, '$/' || base_unit AS unit
       FROM sized JOIN part ON part.p_partkey = sized.p_partkey""",
)
def _(r):
    return r.table("part").select(
        "p_partkey", Z.unit_price(F.col("p_retailprice"), size_text()).alias("u")
    ).select("p_partkey", "u.*")


def _sql_normalized(text):
    out = f"lower(regexp_replace({text}, {quoted(V.TRADEMARKS)}, '', 'g'))"
    for pattern in (V.PARENTHESES, V.NAME_SIZE_TOKENS, "[^a-z0-9 ]+", r"\s+"):
        out = f"regexp_replace({out}, {quoted(pattern)}, ' ', 'g')"
    return f"trim({out})"


@query(
    "normalize_name",
    f"""SELECT doc_id, md5(n) AS digest, length(n) AS length
       FROM (SELECT doc_id, {_sql_normalized("text")} AS n FROM documents)""",
)
def _(r):
    n = X.normalize_name(F.col("text"))
    return r.table("documents").select("doc_id", F.md5(n).alias("digest"), F.length(n).alias("length"))


@query(
    "display_name",
    f"""SELECT doc_id, md5(n) AS digest, length(n) AS length FROM (SELECT doc_id,
       regexp_replace(regexp_replace(text, {quoted(V.TRADEMARKS)}, '', 'g'), '^\\s+|\\s+$', '', 'g') AS n FROM documents)""",
)
def _(r):
    n = X.display_name(F.col("text"))
    return r.table("documents").select("doc_id", F.md5(n).alias("digest"), F.length(n).alias("length"))


@query(
    "ad_week",
    """SELECT strftime(o_orderdate::DATE - ((isodow(o_orderdate) + 4) % 7)::INT, '%Y-%m-%d') AS ad_week,
       count(*) AS n FROM orders GROUP BY 1""",
)
def _(r):
    weeks = r.table("orders").select(P.ad_week(F.col("o_orderdate")).alias("ad_week"))
    return weeks.groupBy("ad_week").agg(F.count("*").alias("n")).select(day("ad_week"), "n")


@query(
    "effective_price",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       CASE WHEN percent > 0 THEN paid_cents ELSE regular_cents END::DOUBLE / 100 AS price,
       CASE WHEN percent > 0 THEN regular_cents::DOUBLE / 100 END AS regular_price, percent > 0 AS is_promo
       FROM cents""",
)
def _(r):
    regular = to_money(F.col("regular_cents"))
    promo = F.when(F.col("percent") > 0, to_money(F.col("paid_cents"))).otherwise(F.lit(0).cast("decimal(10,2)"))
    paid = P.effective_price(regular, promo, P.promo_when_positive(regular, promo))
    return r.priced_lines.select(*LINE, "l_partkey", paid.alias("e")).select(
        *LINE, "l_partkey", F.col("e.price").cast("double").alias("price"),
        F.col("e.regular_price").cast("double").alias("regular_price"), "e.is_promo",
    )


@query(
    "discount_pct",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
       round_even((regular_cents::DOUBLE - paid_cents::DOUBLE) / regular_cents::DOUBLE * 100, 0) AS discount_pct
       FROM cents""",
)
def _(r):
    return r.priced_lines.select(
        *LINE, "l_partkey", P.discount_pct(F.col("regular_cents"), F.col("paid_cents")).alias("discount_pct")
    )


FOODS = ["turkey jerky", "onion gravy", "lemon muffins", "limes", "mango sorbet", "basmati rice",
         "sour cream", "beef noodles", "gouda wedge", "frozen corn", "gelato", "glass cleaner", "phone charger",
         "half and half", "hot dog", "meatballs", "rye crackers", "diapers", "grape juice"]
HINTS = ["", "Candy", "Seasonal", "Poultry", "Cheese shop", "Plant Based", "Breakfast"]


def _pick(words, index):
    return F.element_at(F.array(*[F.lit(w) for w in words]), (index % len(words) + 1).cast("int"))


def _sql_pick(words, index):
    return f"[{', '.join(quoted(w) for w in words)}][({index}) % {len(words)} + 1]"


def _sql_rules(text, rules):
    whens = " ".join(
        f"WHEN regexp_matches(lower({text}), {quoted(chr(92) + 'b(?:' + p + ')' + chr(92) + 'b')}) THEN {quoted(c)}"
        for p, c in rules
    )
    return f"CASE {whens} END"


@query(
    "coarse_category",
    f"""SELECT p_partkey, coalesce({_sql_rules("hint", V.HINT_RULES)}, {_sql_rules("food", V.NAME_RULES)}) AS coarse_category
       FROM (SELECT p_partkey, {_sql_pick(HINTS, "p_size")} AS hint,
               p_name || ' ' || {_sql_pick(FOODS, "p_partkey")} AS food FROM part)""",
)
def _(r):
    food = F.concat_ws(" ", "p_name", _pick(FOODS, F.col("p_partkey")))
    return r.table("part").select(
        "p_partkey", T.coarse_category(_pick(HINTS, F.col("p_size")), food).alias("coarse_category")
    )


@query(
    "source_confidence",
    """SELECT source, confidence, count(*) AS n FROM (SELECT source, CASE source WHEN 'NATION_0' THEN 0.99::DOUBLE
       WHEN 'NATION_1' THEN 0.9::DOUBLE WHEN 'NATION_2' THEN 0.8::DOUBLE ELSE 0.75::DOUBLE END AS confidence
       FROM prices) GROUP BY ALL""",
)
def _(r):
    known = {"NATION_0": 0.99, "NATION_1": 0.90, "NATION_2": 0.80}
    return r.prices.groupBy("source").agg(F.count("*").alias("n")).withColumn(
        "confidence", P.source_confidence(F.col("source"), known)
    )


@query(
    "clamp_verdict",
    """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'match' ELSE 'no_match' END AS verdict,
       greatest(0.0::DOUBLE, least(1.0::DOUBLE, value / 50 - 0.5)) AS confidence,
       repeat(props, 60)[1:500] AS reason FROM events""",
)
def _(r):
    verdict = F.when(F.col("event_type").isin("view", "click"), "match")
    safe = P.clamp_verdict(verdict, F.col("value") / 50 - 0.5, F.repeat("props", 60))
    return r.table("events").select("event_id", safe.alias("s")).select("event_id", "s.*")


@query(
    "banner_lookup",
    """SELECT s_suppkey AS store_id, p.source, coalesce(banner, p.source) AS banner
       FROM places p LEFT JOIN sources s ON s.source = p.source""",
)
def _(r):
    return with_banner(r.stores, r.sources).select("store_id", "source", "banner")


@query(
    "list_to_coarse",
    f"""SELECT p_partkey, CASE {_sql_pick([*V.LIST_TO_COARSE, "other"], "p_size")}
       {" ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in V.LIST_TO_COARSE.items())} END AS coarse FROM part""",
)
def _(r):
    word = _pick([*V.LIST_TO_COARSE, "other"], F.col("p_size"))
    return r.table("part").select("p_partkey", T.list_to_coarse(word).alias("coarse"))


@query(
    "price_observations",
    """SELECT price_id, source_product_id, source, store_id, strftime(ad_week, '%Y-%m-%d') AS ad_week,
       price::DOUBLE AS price, 0.75::DOUBLE AS confidence FROM prices""",
)
def _(r):
    return state.price_observations(r.prices.drop("ad_week")).select(
        "price_id", "source_product_id", "source", "store_id", day("ad_week"), *dbl("price"), "confidence"
    )


SIGHTED = """SELECT l_suppkey::VARCHAR AS source, l_partkey::VARCHAR AS source_sku,
       arg_max(l_returnflag, o) AS raw_name, arg_min(l_linestatus, o) AS raw_brand,
       arg_min(l_quantity::BIGINT, o) FILTER (WHERE l_tax > 0)::VARCHAR AS category_hint,
       strftime(min(l_shipdate), '%Y-%m-%d') AS first_seen, strftime(max(l_shipdate), '%Y-%m-%d') AS last_seen
       FROM (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice,
           l_quantity, l_tax, l_returnflag, l_linestatus) AS o FROM lineitem)
       GROUP BY l_suppkey, l_partkey"""


def sighted(r: Roles):
    """Line items as sightings of (supplier, part), in two batches; the later ships second. Also the order of arrival."""
    seen = r.table("lineitem").select(
        F.col("l_suppkey").cast("string").alias("source"),
        F.col("l_partkey").cast("string").alias("source_sku"),
        F.col("l_returnflag").alias("raw_name"),
        F.lit(None).cast("string").alias("raw_size_text"),
        F.col("l_linestatus").alias("raw_brand"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity").cast("bigint").cast("string")).alias("category_hint"),
        F.lit(None).cast("string").alias("coarse_category"),
        F.col("l_shipdate").alias("seen_at"),
        "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax",
        "l_returnflag", "l_linestatus",
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax",
             "l_returnflag", "l_linestatus"]
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return seen.filter(early), seen.filter(~early), order


def sighted_products(folded):
    return state.source_product_table(folded).select(
        "source", "source_sku", "raw_name", "raw_brand", "category_hint",
        F.date_format("first_seen_at", "yyyy-MM-dd").alias("first_seen"),
        F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_seen"),
    )


@query("upsert_source_products", SIGHTED)
def _(r):
    early, late, order = sighted(r)
    first = state.upsert_source_products(None, early, order)
    return sighted_products(state.upsert_source_products(first, late, order))


@query("keyed_source_products", SIGHTED)
def _(r):
    """The same state in a table dealt by key, whose touched partitions alone are replaced."""
    early, late, order = sighted(r)
    first = state.upsert_source_products(None, early, order)
    table = K.KeyedTable(r.spark, f"{work_dir(r.spark)}/sighted-{uuid.uuid4().hex}", ("source", "source_sku", "lone_key"),
                         first._jdf.schema().toDDL(), parts=16)
    table.create(first)
    K.upsert_sightings(table, late, order)
    return sighted_products(table.read())
