"""SQL twins of the registered queries, for the check engine.

``ROLES_SQL`` restates the roles of ``roles.py``; :func:`sql` puts the ones a
query needs in front of it.
"""

from __future__ import annotations

import re

from cartledger import fixed_values as V
from cartledger.functions.sizes import size_patterns, unit_pattern

_SIZED, _PER = size_patterns()
_UNITS = {
    u: (base, f)
    for base, units in (("fl_oz", V.VOLUME_UNITS), ("oz", V.WEIGHT_UNITS), ("ct", V.COUNT_UNITS))
    for u, f in units.items()
}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def size_sql(text: str) -> str:
    """(magnitude, unit, base_unit, base_qty) columns for a size text."""
    unit = (
        f"CASE WHEN regexp_matches(lower({text}), {quoted(_SIZED)}) THEN regexp_extract(lower({text}), {quoted(_SIZED)}, 2)"
        f" WHEN regexp_matches(lower({text}), {quoted(_PER)}) THEN regexp_extract(lower({text}), {quoted(_PER)}, 1) END"
    )
    return unit


ROLES_SQL = {
    "nations": "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey",
    "sources": "SELECT n_name AS source, r_name AS banner FROM nations WHERE n_nationkey % 5 <> 4",
    "places": """SELECT s_suppkey, s_name, n_name AS source, r_name AS region
        FROM supplier JOIN nations ON s_nationkey = n_nationkey""",
    "stores": "SELECT source, s_suppkey AS store_id, s_name AS name, region FROM places",
    "canonical": """SELECT min(p_partkey) AS canonical_id, p_brand || ' ' || p_name AS name,
        min(p_type) AS category,
        CASE WHEN min(p_partkey) % 10 <> 0 THEN split_part(p_name, ' ', -1) END AS coarse_category,
        p_brand AS brand, p_name
        FROM part GROUP BY p_brand, p_name""",
    "parts": """SELECT part.*, canonical_id, category,
        CASE p_partkey % 8 WHEN 0 THEN p_size || ' oz' WHEN 1 THEN p_size || ' lb'
          WHEN 2 THEN p_size || ' ct' WHEN 3 THEN p_size || ' fl oz' WHEN 4 THEN p_size || ' gal'
          WHEN 5 THEN 'per lb' WHEN 6 THEN '1/2 gal' ELSE p_size || ' 1/2 oz' END AS size_text
        FROM part JOIN canonical ON brand = p_brand AND canonical.p_name = part.p_name""",
    "source_products": """SELECT l_suppkey || '-' || l_partkey AS source_product_id, source,
        l_partkey::VARCHAR AS source_sku, p_name AS raw_name, p_brand AS raw_brand,
        size_text AS raw_size_text, p_type AS category_hint,
        CASE WHEN p_size % 10 = 1 THEN split_part(p_name, ' ', 1)
             WHEN p_size % 10 <> 0 THEN split_part(p_name, ' ', -1) END AS coarse_category,
        CASE WHEN p_partkey % 21 >= 3 THEN canonical_id END AS canonical_id,
        CASE WHEN p_partkey % 21 >= 3 THEN (80 + p_partkey % 21)::DOUBLE / 100 END AS match_confidence,
        CASE WHEN p_partkey % 21 >= 3 THEN
          CASE p_size % 3 WHEN 0 THEN 'rapidfuzz' WHEN 1 THEN 'llm_adjudicator' ELSE 'manual' END
        END AS match_method,
        canonical_id AS best_guess, (80 + p_partkey % 21)::DOUBLE / 100 AS guess_confidence
        FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
        JOIN parts ON p_partkey = l_partkey JOIN places ON s_suppkey = l_suppkey""",
    "queue": """SELECT source_product_id AS queue_id, source_product_id,
        best_guess AS candidate_canonical_id, guess_confidence AS proposed_confidence,
        'open' AS status FROM source_products WHERE canonical_id IS NULL""",
    "cents": """SELECT *, (2 * regular_cents * (100 - percent) + 100) // 200 AS paid_cents FROM (
        SELECT *, (2 * floor(l_extendedprice * 100 + 0.5)::BIGINT + l_quantity::BIGINT)
                  // (2 * l_quantity::BIGINT) AS regular_cents,
               floor(l_discount * 100 + 0.5)::BIGINT AS percent FROM lineitem)""",
    "prices": """SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || l_partkey AS price_id,
        l_suppkey || '-' || l_partkey AS source_product_id, l_partkey, source,
        l_suppkey AS store_id, l_shipdate AS observed_at,
        l_shipdate::DATE - ((isodow(l_shipdate) + 4) % 7)::INT AS ad_week,
        (paid_cents::DECIMAL(12,0) * 0.01)::DECIMAL(10,2) AS price,
        CASE WHEN percent > 0 THEN (regular_cents::DECIMAL(12,0) * 0.01)::DECIMAL(10,2) END AS regular_price,
        percent > 0 AS is_promo
        FROM cents JOIN places ON s_suppkey = l_suppkey""",
    "sized": f"""SELECT p_partkey, size_text, low, unit_word,
        CASE WHEN unit_word IN ({", ".join(quoted(u) for u, (b, _) in _UNITS.items() if b == "fl_oz")}) THEN 'fl_oz'
             WHEN unit_word IN ({", ".join(quoted(u) for u, (b, _) in _UNITS.items() if b == "oz")}) THEN 'oz'
             WHEN unit_word IN ({", ".join(quoted(u) for u, (b, _) in _UNITS.items() if b == "ct")}) THEN 'ct' END AS base_unit,
        magnitude, magnitude * CASE unit_word {" ".join(f"WHEN {quoted(u)} THEN {f}::DOUBLE" for u, (_, f) in _UNITS.items())} END AS base_qty
        FROM (SELECT *, CASE WHEN amount = '' THEN 1.0::DOUBLE
            ELSE coalesce(nullif(regexp_extract(amount, '^(\\d+(?:\\.\\d+)?)(?:\\s|$)', 1), '')::DOUBLE, 0)
               + CASE WHEN contains(amount, '/') THEN regexp_extract(amount, '(\\d+)/(\\d+)$', 1)::DOUBLE
                   / regexp_extract(amount, '(\\d+)/(\\d+)$', 2)::DOUBLE ELSE 0 END END AS magnitude
          FROM (SELECT p_partkey, size_text, lower(size_text) AS low,
              regexp_extract(lower(size_text), {quoted(_SIZED)}, 1) AS amount,
              {size_sql("size_text")} AS unit_word FROM parts))""",
    "gold": """SELECT c.canonical_id, c.name AS canonical_name, c.category, c.coarse_category,
        p.source, p.store_id, st.name AS store_name, st.region AS store_region, p.ad_week,
        p.observed_at, p.price, p.regular_price,
        round(((p.price::DOUBLE / base_qty)::VARCHAR)::DECIMAL(38,18), 4)::DOUBLE AS unit_price,
        '$/' || base_unit AS unit, p.is_promo, sp.source_product_id, sp.match_confidence, p.price_id
        FROM prices p
        JOIN source_products sp ON sp.source_product_id = p.source_product_id
        JOIN canonical c ON c.canonical_id = sp.canonical_id
        LEFT JOIN stores st ON st.source = p.source AND st.store_id = p.store_id
        LEFT JOIN sized ON sized.p_partkey = p.l_partkey
        WHERE sp.canonical_id IS NOT NULL AND sp.match_confidence >= 0.85
        QUALIFY row_number() OVER (PARTITION BY p.source_product_id, p.store_id
          ORDER BY p.observed_at DESC, p.price_id DESC, p.price DESC, p.regular_price DESC NULLS LAST) = 1""",
    "baskets": """SELECT o_orderkey AS basket_id, 'order ' || o_orderkey AS name,
        o_orderdate AS created_at FROM orders""",
    "items": """SELECT l_orderkey AS basket_id, canonical_id, any_value(n) AS label,
        any_value(category) AS category, sum(l_quantity::BIGINT)::BIGINT AS quantity
        FROM lineitem JOIN (SELECT p_partkey, parts.canonical_id, name AS n, parts.category
             FROM parts JOIN canonical USING (canonical_id)) ON p_partkey = l_partkey
        GROUP BY l_orderkey, canonical_id""",
    "modes": "SELECT * FROM (VALUES ('flexible', 0.85::DOUBLE), ('exact', 0.97::DOUBLE)) m(mode, floor)",
    # offers reduced per product and source; the result equals joining all rows
    "offers": """SELECT canonical_id, source, mode, min(price) AS price
        FROM gold, modes WHERE match_confidence >= floor GROUP BY ALL""",
    "cheapest_offer": """SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY canonical_id
        ORDER BY price ASC NULLS LAST, source, store_id, price_id) = 1""",
    "item_cost": """SELECT basket_id, i.category, label, quantity, g.canonical_id, g.canonical_name,
        g.source, g.store_id, g.price, g.unit_price, g.unit, g.price * quantity AS line_cost, g.price_id
        FROM items i JOIN cheapest_offer g ON g.canonical_id = i.canonical_id""",
    "list_sizes": "SELECT basket_id, count(*) AS n_items FROM items GROUP BY basket_id",
    "ranking": """SELECT *, row_number() OVER (PARTITION BY basket_id, mode
            ORDER BY full_coverage DESC, store_total, source) AS rank
        FROM (SELECT basket_id, mode, source, count(*) AS items_covered, n_items,
                sum(price * quantity) AS store_total, n_items - count(*) AS missing_count,
                count(*) = n_items AS full_coverage
              FROM items JOIN offers USING (canonical_id) JOIN list_sizes USING (basket_id)
              GROUP BY basket_id, mode, source, n_items)""",
    "split": """SELECT basket_id, count(*) AS n_priced, sum(line_cost) AS split_total,
        list_sort(list(DISTINCT source)) AS stores_used FROM item_cost GROUP BY basket_id""",
    "spans": """SELECT canonical_id, count(DISTINCT source) AS n_sources, min(price) AS low,
        max(price) AS high FROM gold GROUP BY canonical_id""",
    "optimized": """SELECT l.basket_id, coalesce(n_priced, 0) AS n_items, l.n_items AS n_list,
          coalesce(split_total, 0) AS split_total, stores_used,
          best.source AS best_single_source, best.store_total AS best_single_total,
          best.store_total - split_total AS savings_vs_single,
          coalesce(multi, 0) AS multi_source_items, coalesce(value, 0) AS optimizer_value
        FROM list_sizes l LEFT JOIN split USING (basket_id)
        LEFT JOIN (SELECT r.* FROM ranking r JOIN split s ON s.basket_id = r.basket_id
              AND r.items_covered = s.n_priced WHERE mode = 'flexible'
              QUALIFY row_number() OVER (PARTITION BY r.basket_id ORDER BY store_total, source) = 1) best
          ON best.basket_id = l.basket_id
        LEFT JOIN (SELECT basket_id, count(*) FILTER (WHERE n_sources >= 2) AS multi,
              sum((high - low) * quantity) FILTER (WHERE n_sources >= 2) AS value
            FROM items JOIN spans USING (canonical_id) GROUP BY basket_id) sp ON sp.basket_id = l.basket_id""",
    "winners": "SELECT * FROM ranking WHERE rank = 1 AND full_coverage",
    "verdict_rows": """SELECT o.basket_id, o.n_items, o.n_list,
          f.source AS flexible_winner, f.store_total AS flexible_total,
          e.source AS exact_winner, e.store_total AS exact_total,
          CASE WHEN f.source IS NOT NULL THEN f.store_total - o.split_total > 0
               ELSE o.n_items > 0 END AS has_footnote,
          o.split_total AS all_split, o.stores_used AS all_stores
        FROM optimized o
        LEFT JOIN (SELECT * FROM winners WHERE mode = 'flexible') f ON f.basket_id = o.basket_id
        LEFT JOIN (SELECT * FROM winners WHERE mode = 'exact') e ON e.basket_id = o.basket_id""",
    "verdict": """SELECT basket_id, n_items, n_list, flexible_winner, flexible_total, exact_winner,
          exact_total, has_footnote,
          CASE WHEN has_footnote THEN all_split END AS split_total,
          CASE WHEN has_footnote THEN all_stores END AS stores_used,
          CASE WHEN has_footnote AND flexible_winner IS NOT NULL THEN flexible_total - all_split END AS split_savings,
          CASE WHEN has_footnote AND flexible_winner IS NOT NULL THEN
            flexible_total - all_split >= 10
            OR (flexible_total - all_split)::DOUBLE / flexible_total::DOUBLE >= 0.08 END AS worth_it
        FROM verdict_rows""",
}


def sql(body: str, **extra: str) -> str:
    """``body`` with the roles it names, directly or through others, as CTEs."""
    defs = {**ROLES_SQL, **extra}
    names = "|".join(sorted(defs, key=len, reverse=True))
    needed: list[str] = []

    def need(text, seen):
        for name in re.findall(rf"\b({names})\b", text):
            if name not in needed and name not in seen:
                need(defs[name], seen | {name})
                if name not in needed:
                    needed.append(name)

    need(body, frozenset())
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({defs[n]})" for n in needed)
    return f"WITH RECURSIVE {ctes}\n{body}" if needed else body
