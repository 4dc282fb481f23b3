"""Registered queries: matching, resolution, state changes, reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartledger import fixed_values as V
from cartledger.functions.pricing import ad_week
from cartledger.functions.taxonomy import compatible
from cartledger.functions.text import normalize_name
from cartledger.operators import basket as B
from cartledger.operators import gold as G
from cartledger.operators import resolve as R
from cartledger.operators import review, state, terms
from cartledger.operators import similarity_join as J
from cartledger.functions import similarity as S
from cartledger.plans import jobs
from cartledger.plans import narration as N
from cartledger.plans import reports
from cartledger.plans.baskets import basket_tables
from cartledger.session import cut_lineage

from .oracle import quoted
from .registry import day, dbl, joined, query
from .roles import Roles

# ---- roles only these queries need ------------------------------------------------

NOUN_RULE = [("widget|gadget", "tools"), ("ring", "jewellery"), ("bolt|rod", "parts")]
RULE = "CASE " + " ".join(
    rf"WHEN regexp_matches(lower({{0}}), '\b(?:{words})\b') THEN '{kind}'" for words, kind in NOUN_RULE
) + " END"

EXTRA = {
    "filled": f"""SELECT canonical_id AS cid, coalesce(coarse_category, {RULE.format("raw_name")}) AS cat
        FROM source_products""",
    "common_category": """SELECT cid, cat FROM (SELECT cid, cat, count(*) AS n FROM filled
        WHERE cid IS NOT NULL AND cat IS NOT NULL GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY cid ORDER BY n DESC, cat) = 1""",
    "verdicts": """SELECT canonical_id * 2 + pos AS verdict_id, term, canonical_id,
        CASE WHEN canonical_id % 4 = 0 THEN 'no_match' ELSE 'match' END AS verdict,
        (70 + canonical_id % 31)::DOUBLE / 100 AS confidence, 'rule for ' || term AS reason,
        'stub' AS model, 'llm' AS decided_by, make_timestamp((1704067200 + canonical_id) * 1000000) AS created_at
        FROM (SELECT canonical_id, split_part(p_name, ' ', 1) AS term, 0 AS pos FROM canonical
              UNION ALL SELECT canonical_id, split_part(p_name, ' ', 2), 1 FROM canonical)""",
    "reviews": """SELECT verdict_id, CASE WHEN canonical_id % 3 = 1 THEN 'open' ELSE 'approved' END AS status
        FROM verdicts WHERE confidence < 0.85 AND canonical_id % 3 <> 0""",
    "terms": """SELECT DISTINCT * FROM (
        SELECT p_name AS keyword, split_part(p_name, ' ', -1) AS coarse FROM part
        UNION ALL SELECT split_part(p_name, ' ', 1), NULL FROM part
        UNION ALL SELECT split_part(p_name, ' ', -1), split_part(p_name, ' ', -1) FROM part)""",
    "products": f"""SELECT canonical_id, canonical_name, min(coarse_category) AS coarse_category,
        count(DISTINCT source) AS n_sources, min(price) AS min_price FROM gold
        WHERE NOT regexp_matches(lower(canonical_name), {quoted(V.FALSE_FRIENDS)})
        GROUP BY canonical_id, canonical_name""",
    "hits": r"""SELECT keyword, coarse, canonical_id, canonical_name,
        CASE WHEN starts_with(lower(canonical_name), lower(keyword)) THEN 1 ELSE 0 END AS starts,
        n_sources, length(canonical_name) AS name_length, min_price
        FROM terms, products
        WHERE regexp_matches(lower(canonical_name), '\b' || replace(lower(keyword), ' ', '\s+') || '(?:s|es)?\b')
          AND (coarse IS NULL OR coarse_category IS NULL OR coarse = coarse_category)""",
    "pairs": """SELECT *, keyword AS term, row_number() OVER (PARTITION BY keyword, coarse ORDER BY starts DESC,
          n_sources DESC, name_length, min_price, canonical_id) AS rank FROM hits
        QUALIFY row_number() OVER (PARTITION BY keyword, coarse ORDER BY starts DESC,
          n_sources DESC, name_length, min_price, canonical_id) <= 5""",
    "confident": """SELECT keyword, coarse, v.canonical_id, c.name AS canonical_name, confidence, min_price
        FROM terms JOIN verdicts v ON v.term = keyword
        JOIN canonical c ON c.canonical_id = v.canonical_id
        JOIN (SELECT canonical_id, min(price) AS min_price FROM gold GROUP BY canonical_id) g
          ON g.canonical_id = v.canonical_id
        WHERE verdict = 'match' AND confidence >= 0.85
          AND (coarse IS NULL OR coarse_category IS NULL OR coarse = coarse_category)""",
    "queue_rows": """SELECT q.queue_id, q.source_product_id, q.candidate_canonical_id, q.proposed_confidence,
        sp.source, sp.raw_name, sp.raw_brand, c.name AS candidate_name,
        CASE WHEN present.source IS NULL THEN 1 ELSE 0 END AS adds_source
        FROM queue q JOIN source_products sp ON sp.source_product_id = q.source_product_id
        JOIN canonical c ON c.canonical_id = q.candidate_canonical_id
        LEFT JOIN (SELECT DISTINCT canonical_id, source FROM source_products WHERE canonical_id IS NOT NULL) present
          ON present.canonical_id = q.candidate_canonical_id AND present.source = sp.source
        WHERE sp.coarse_category IS NULL OR c.coarse_category IS NULL OR sp.coarse_category = c.coarse_category""",
    # bit-parallel longest common subsequence over sorted names
    "sorted_names": """SELECT canonical_id AS id, name AS shown, coarse_category AS cat,
        array_to_string(list_sort(string_split(trim(regexp_replace(lower(name), '[^a-z0-9 ]+', ' ', 'g')), ' ')), ' ') AS name
        FROM canonical""",
    "lcs_pairs": """SELECT left_id, right_id, n + m AS total, n - bit_count(list_reduce(
            list_prepend((1::BIGINT << n) - 1, list_transform(string_split(b, ''), lambda ch:
              list_sum(list_transform(range(1, n + 1), lambda i: CASE WHEN a[i] = ch THEN 1::BIGINT << (i - 1) ELSE 0::BIGINT END))::BIGINT)),
            lambda v, mask: ((v + (v & mask)) | (v - (v & mask))) & ((1::BIGINT << n) - 1)))::BIGINT AS common
        FROM (SELECT l.id AS left_id, r.id AS right_id, l.name AS a, r.name AS b,
                length(l.name)::INT AS n, length(r.name)::INT AS m
              FROM sorted_names l JOIN sorted_names r ON l.id > r.id
                AND (l.cat IS NULL OR r.cat IS NULL OR l.cat = r.cat))""",
    "alike": "SELECT * FROM lcs_pairs WHERE 200 * common >= 78 * total",
    "neighbours": """SELECT row_number() OVER (ORDER BY s.id) AS i, s.id, coalesce(n, []) AS n
        FROM sorted_names s LEFT JOIN (SELECT left_id, list(right_id) AS n FROM alike GROUP BY left_id) e
        ON e.left_id = s.id""",
    "greedy": """SELECT 0::BIGINT AS i, []::BIGINT[] AS founders
        UNION ALL SELECT g.i + 1, CASE WHEN list_has_any(n, founders) THEN founders
            ELSE list_append(founders, x.id) END
        FROM greedy g JOIN neighbours x ON x.i = g.i + 1""",
    "founders": "SELECT unnest(founders) AS id FROM greedy WHERE i = (SELECT max(i) FROM greedy)",
    "lists": """SELECT r_regionkey AS list_id, keyword, coarse, row_number() OVER (PARTITION BY r_regionkey
          ORDER BY CASE WHEN r_regionkey % 2 = 0 THEN keyword END,
                   CASE WHEN r_regionkey % 2 = 1 THEN keyword END DESC) AS position FROM terms, region""",
    "choices": """SELECT list_id, position, list(canonical_id ORDER BY tier, n) AS ids FROM (
          SELECT list_id, position, l.keyword, canonical_id, 0 AS tier, row_number() OVER (
              PARTITION BY list_id, position ORDER BY confidence DESC, min_price, canonical_id) AS n
            FROM lists l JOIN confident c ON c.keyword = l.keyword AND c.coarse IS NOT DISTINCT FROM l.coarse
          UNION ALL
          SELECT list_id, position, l.keyword, canonical_id, 1, row_number() OVER (PARTITION BY list_id, position
              ORDER BY starts DESC, n_sources DESC, name_length, min_price, canonical_id)
            FROM lists l JOIN hits h ON h.keyword = l.keyword AND h.coarse IS NOT DISTINCT FROM l.coarse
            WHERE NOT EXISTS (SELECT 1 FROM verdicts v WHERE v.term = l.keyword AND v.canonical_id = h.canonical_id
              AND v.verdict = 'no_match' AND v.confidence >= 0.85))
        GROUP BY list_id, position""",
    "serial": """SELECT r_regionkey AS list_id, 0::BIGINT AS position, []::BIGINT[] AS taken, NULL::BIGINT AS pick FROM region
        UNION ALL SELECT list_id, position, CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END, pick
        FROM (SELECT s.list_id, s.position + 1 AS position, taken,
            list_filter(coalesce(ids, []), lambda x: NOT list_contains(taken, x))[1] AS pick
          FROM serial s JOIN lists l ON l.list_id = s.list_id AND l.position = s.position + 1
          LEFT JOIN choices c ON c.list_id = s.list_id AND c.position = s.position + 1)""",
    "cited": """SELECT basket_id, max(ad_week) AS ad_week, count(price_id) AS n_price_ids,
        coalesce(list_sort(list(price_id) FILTER (WHERE price_id IS NOT NULL)), []) AS price_ids
        FROM items LEFT JOIN (SELECT canonical_id, price_id, ad_week FROM gold) USING (canonical_id)
        GROUP BY basket_id""",
    "texts": """SELECT basket_id, CASE WHEN flexible_winner IS NULL
          THEN 'No store covers all ' || n_list || ' items.'
          ELSE 'Week of 2026-07-29: shop at ' || flexible_winner || ' for $' || flexible_total::VARCHAR
            || ', all ' || n_list || ' items.' END
          || CASE WHEN basket_id % 7 = 0 THEN ' You save $9,999,999.99!' ELSE '' END AS narration
        FROM verdict""",
    "fact_numbers": """SELECT basket_id, list(DISTINCT round(x, 2)) AS numbers FROM (
          SELECT basket_id, unnest([store_total::DOUBLE, items_covered::DOUBLE, n_items::DOUBLE, missing_count::DOUBLE]) AS x
            FROM ranking WHERE mode = 'flexible'
          UNION ALL SELECT basket_id, n_items::DOUBLE FROM verdict
          UNION ALL SELECT basket_id, (n.store_total - w.store_total)::DOUBLE FROM
            (SELECT * FROM winners WHERE mode = 'flexible') w
            JOIN (SELECT * FROM ranking WHERE mode = 'flexible' AND rank = 2 AND full_coverage) n USING (basket_id)
          UNION ALL SELECT basket_id, unnest([split_total::DOUBLE, len(stores_used)::DOUBLE, split_savings::DOUBLE])
            FROM verdict WHERE has_footnote)
        WHERE x IS NOT NULL GROUP BY basket_id""",
    "audited": r"""SELECT t.basket_id, narration,
        list_concat(
          list_transform(list_filter(regexp_extract_all(regexp_replace(narration, '\b\d{4}-\d{2}-\d{2}\b', ' ', 'g'),
              '\$\s?([\d,]+(?:\.\d{1,2})?)', 1),
            lambda x: NOT list_contains(numbers, round(replace(x, ',', '')::DOUBLE, 2))),
            lambda x: '$' || x || ' not in fact pack'),
          list_transform(list_filter(regexp_extract_all(regexp_replace(regexp_replace(narration,
              '\b\d{4}-\d{2}-\d{2}\b', ' ', 'g'), '\$\s?([\d,]+(?:\.\d{1,2})?)', ' ', 'g'), '\b\d+(?:\.\d+)?\b'),
            lambda x: NOT list_contains(numbers, round(x::DOUBLE, 2))),
            lambda x: x || ' not in fact pack')) AS violations
        FROM texts t JOIN fact_numbers f ON f.basket_id = t.basket_id""",
}


def matched(name, twin=None):
    return query(name, twin, **EXTRA) if twin else query(name)


# ---- trust, guard, queue -----------------------------------------------------------

@matched(
    "cross_store_items",
    """SELECT canonical_id, count(DISTINCT source) AS n_sources FROM source_products
       WHERE canonical_id IS NOT NULL GROUP BY canonical_id HAVING count(DISTINCT source) >= 2""",
)
def _(r):
    return G.cross_store_items(r.source_products)


@matched(
    "gold_report_top25",
    """SELECT category, canonical_name, source, store_id, price::DOUBLE AS price, unit_price, unit, source_product_id
       FROM gold ORDER BY category NULLS LAST, canonical_name, source, store_id, source_product_id LIMIT 25""",
)
def _(r):
    return G.gold_report(r.gold).withColumn("price", F.col("price").cast("double"))


@matched(
    "category_guard_pairs",
    """SELECT q.queue_id, sp.coarse_category IS NULL OR c.coarse_category IS NULL
         OR sp.coarse_category = c.coarse_category AS allowed
       FROM queue q JOIN source_products sp ON sp.source_product_id = q.source_product_id
       JOIN canonical c ON c.canonical_id = q.candidate_canonical_id""",
)
def _(r):
    sp = r.source_products.select("source_product_id", F.col("coarse_category").alias("a"))
    c = r.canonical.select(F.col("canonical_id").alias("candidate_canonical_id"), F.col("coarse_category").alias("b"))
    return r.queue.join(sp, "source_product_id").join(c, "candidate_canonical_id").select(
        "queue_id", compatible(F.col("a"), F.col("b")).alias("allowed")
    )


@matched(
    "open_queue",
    """SELECT queue_id, candidate_canonical_id, proposed_confidence, source, raw_name, raw_brand,
       candidate_name, adds_source FROM queue_rows""",
)
def _(r):
    """The whole queue, in the order in which it is to be adjudicated."""
    return review.prioritized(review.open_queue(r.queue, r.source_products, r.canonical)).select(
        "queue_id", "candidate_canonical_id", "proposed_confidence", "source", "raw_name",
        "raw_brand", "candidate_name", "adds_source",
    )


@matched(
    "adds_source_flag",
    """SELECT queue_id, CASE WHEN NOT EXISTS (SELECT 1 FROM source_products p
         WHERE p.canonical_id = q.candidate_canonical_id AND p.source = sp.source) THEN 1 ELSE 0 END AS adds_source
       FROM queue q JOIN source_products sp ON sp.source_product_id = q.source_product_id""",
)
def _(r):
    rows = r.queue.join(r.source_products.select("source_product_id", "source"), "source_product_id")
    return review.adds_source(rows, r.source_products).select("queue_id", "adds_source")


@matched(
    "guard_sever",
    """SELECT source_product_id, sp.canonical_id AS before, coalesce(match_method = 'rapidfuzz'
         AND sp.coarse_category <> c.coarse_category, false) AS severed,
       CASE WHEN NOT coalesce(match_method = 'rapidfuzz' AND sp.coarse_category <> c.coarse_category, false)
         THEN sp.canonical_id END AS canonical_id
       FROM source_products sp LEFT JOIN canonical c ON c.canonical_id = sp.canonical_id""",
)
def _(r):
    sp = r.source_products.withColumn("before", F.col("canonical_id"))
    return state.sever_cross_category(sp, r.canonical).select(
        "source_product_id", "before", "severed", "canonical_id"
    )


@matched(
    "semi_delete",
    """SELECT price_id, price::DOUBLE AS price FROM prices
       WHERE source_product_id NOT IN (SELECT source_product_id FROM queue)""",
)
def _(r):
    """Prices left after the queued listings' prices are deleted."""
    return state.delete_where(r.prices, r.queue, ["source_product_id"]).select("price_id", *dbl("price"))


@matched(
    "inherit_category",
    """SELECT canonical_id, coarse_category FROM (SELECT canonical_id, coarse_category, count(*) AS n
         FROM source_products WHERE canonical_id IS NOT NULL AND coarse_category IS NOT NULL GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY n DESC, coarse_category) = 1""",
)
def _(r):
    return state.most_common(r.source_products, "canonical_id", "coarse_category")



@matched(
    "backfill_categories",
    """SELECT canonical_id, coalesce(coarse_category, RULE(name), cat) AS coarse_category
       FROM canonical LEFT JOIN common_category ON cid = canonical_id""".replace("RULE(name)", RULE.format("name")),
)
def _(r):
    from cartledger.functions.taxonomy import coarse_category

    classify = lambda hint, name: coarse_category(hint, name, NOUN_RULE, NOUN_RULE)
    _, canonical = state.backfill_categories(r.source_products, r.canonical, classify)
    return canonical.select("canonical_id", "coarse_category")


# ---- similarity and resolution ----------------------------------------------------------

def sorted_names(r: Roles):
    return r.canonical.select(
        F.col("canonical_id").alias("id"),
        S.token_sorted(normalize_name(F.col("name"))).alias("name"),
        F.col("coarse_category").alias("category"),
    )


@matched("fuzzy_pairs", "SELECT left_id, right_id, common, total::BIGINT AS total FROM alike")
def _(r):
    names = sorted_names(r)
    index = J.index_for(names, V.REVIEW_LOW_SCORE)
    rows = cut_lineage(J.signed(names, index))
    pairs = J.similar_pairs(rows, rows, index, F.col("l.id") > F.col("r.id"))
    return pairs.select("left_id", "right_id", F.col("common").cast("bigint").alias("common"),
                        F.col("total").cast("bigint").alias("total"))


def resolved(r: Roles):
    products = r.canonical.select(
        F.col("canonical_id").alias("product_id"), F.col("name").alias("raw_name"), "coarse_category"
    )
    return R.resolve_products(products, r.canonical.limit(0))


RESOLVED = """(SELECT s.id AS product_id, best.right_id AS match_id, best.common, best.total
    FROM sorted_names s LEFT JOIN (
      SELECT left_id, right_id, common, total FROM alike JOIN founders ON founders.id = right_id
      QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY common::DOUBLE / total DESC, right_id) = 1) best
    ON best.left_id = s.id)"""


@matched(
    "resolve",
    f"""SELECT product_id, CASE WHEN match_id IS NULL THEN 'created' WHEN 200 * common >= 90 * total THEN 'linked'
         ELSE 'queued' END AS outcome, coalesce(match_id, product_id) AS founder_product_id,
       CASE WHEN match_id IS NULL THEN 1.0::DOUBLE ELSE round((200.0::DOUBLE * common / total / 100), 3) END AS confidence
       FROM {RESOLVED}""",
)
def _(r):
    return resolved(r).select("product_id", "outcome", "founder_product_id", "confidence")


@matched(
    "resolution_stats",
    f"""SELECT CASE WHEN match_id IS NULL THEN 'created' WHEN 200 * common >= 90 * total THEN 'linked'
         ELSE 'queued' END AS outcome, count(*) AS n FROM {RESOLVED} GROUP BY 1""",
)
def _(r):
    return R.resolution_stats(resolved(r))


# ---- terms and the verdict cache ----------------------------------------------------------

CANDIDATE_COLUMNS = ["keyword", "coarse", "canonical_id", "canonical_name", "starts", "n_sources", "name_length"]


@matched(
    "term_candidates",
    """SELECT keyword, coarse, canonical_id, canonical_name, starts, n_sources, name_length,
       min_price::DOUBLE AS min_price FROM hits""",
)
def _(r):
    return terms.term_candidates(r.terms, terms.gold_products(r.gold)).select(
        *CANDIDATE_COLUMNS, *dbl("min_price")
    )


@matched(
    "exclude_no_match",
    """SELECT keyword, coarse, canonical_id FROM hits h WHERE canonical_id NOT IN (SELECT canonical_id FROM verdicts v
       WHERE v.term = h.keyword AND v.verdict = 'no_match' AND v.confidence >= 0.85)""",
)
def _(r):
    return terms.term_candidates(r.terms, terms.gold_products(r.gold), r.verdicts).select(
        "keyword", "coarse", "canonical_id"
    )


def pairs_of(r: Roles):
    return terms.adjudication_pairs(r.terms, terms.gold_products(r.gold))


@matched("adjudication_pairs", "SELECT keyword, coarse, term, canonical_id, rank FROM pairs")
def _(r):
    return pairs_of(r).select("keyword", "coarse", "term", "canonical_id", "rank")


@matched(
    "fresh_pairs",
    """SELECT DISTINCT term, canonical_id FROM pairs p WHERE NOT EXISTS (
       SELECT 1 FROM verdicts v WHERE v.term = p.term AND v.canonical_id = p.canonical_id)""",
)
def _(r):
    return state.fresh_pairs(pairs_of(r), r.verdicts).select("term", "canonical_id")


@matched(
    "verdict_lookup",
    """SELECT p.keyword, p.canonical_id, v.verdict, v.confidence, v.reason, v.decided_by
       FROM pairs p JOIN verdicts v ON v.term = p.term AND v.canonical_id = p.canonical_id""",
)
def _(r):
    return state.verdict_lookup(r.verdicts, pairs_of(r).select("keyword", "term", "canonical_id")).select(
        "keyword", "canonical_id", "verdict", "confidence", "reason", "decided_by"
    )


@matched(
    "confident_matches",
    """SELECT keyword, coarse, canonical_id, canonical_name, confidence, min_price::DOUBLE AS min_price,
       row_number() OVER (PARTITION BY keyword, coarse ORDER BY confidence DESC, confident.min_price, canonical_id) = 1 AS best
       FROM confident""",
)
def _(r):
    hits = terms.confident_matches(r.terms, r.verdicts, r.canonical, r.gold)
    best = terms.best_cached(hits, terms.TERM_FIELDS).select(
        "keyword", "canonical_id", F.lit(True).alias("best")
    )
    return hits.join(best, ["keyword", "canonical_id"], "left").select(
        "keyword", "coarse", "canonical_id", "canonical_name", "confidence", *dbl("min_price"),
        F.coalesce("best", F.lit(False)).alias("best"),
    )


@matched(
    "assign_basket",
    """SELECT l.list_id, l.position, l.keyword, pick AS canonical_id
       FROM lists l JOIN serial s ON s.list_id = l.list_id AND s.position = l.position""",
)
def _(r):
    """Five lists over all terms; odd ones go through them backwards."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(4)).cast("array<bigint>"))
    up = F.when(F.col("list_id") % 2 == 0, F.col("keyword"))
    down = F.when(F.col("list_id") % 2 == 1, F.col("keyword"))
    w = Window.partitionBy("list_id").orderBy(F.asc(up), F.desc(down))
    lists = r.terms.withColumn("list_id", copies).withColumn("position", F.row_number().over(w))
    cached = terms.confident_matches(lists, r.verdicts, r.canonical, r.gold)
    found = terms.term_candidates(lists, terms.gold_products(r.gold), r.verdicts)
    return terms.assign_basket(lists, cached, found).select("list_id", "position", "keyword", "canonical_id")


@matched(
    "enqueue_review",
    """SELECT verdict_id, 'open' AS status FROM verdicts WHERE confidence < 0.85
       AND verdict_id NOT IN (SELECT verdict_id FROM reviews WHERE status = 'open')""",
)
def _(r):
    return state.enqueue_review(r.verdicts, r.reviews)


@matched(
    "upsert_verdicts",
    """SELECT term, canonical_id, arg_max(verdict, at2) AS verdict, arg_max(confidence, at2) AS confidence,
       arg_max(reason, at2) AS reason, arg_max(decided_by, at2) AS decided_by,
       strftime(min(created_at), '%Y-%m-%d %H:%M:%S') AS created,
       CASE WHEN count(*) > 1 THEN strftime(max(at2), '%Y-%m-%d %H:%M:%S') END AS updated
       FROM (SELECT term, canonical_id, verdict, confidence, reason, decided_by, created_at, created_at AS at2 FROM verdicts
         UNION ALL SELECT term, canonical_id, 'match', 1.0, 'checked', 'human', created_at + INTERVAL 1 DAY,
           created_at + INTERVAL 1 DAY FROM verdicts WHERE verdict = 'no_match'
         UNION ALL SELECT brand, canonical_id, 'no_match', 0.9, 'brand only', 'llm', TIMESTAMP '2024-06-01 00:00:00',
           TIMESTAMP '2024-06-01 00:00:00' FROM canonical)
       GROUP BY term, canonical_id""",
)
def _(r):
    again = r.verdicts.filter("verdict = 'no_match'").select(
        "term", "canonical_id", F.lit("match").alias("verdict"), F.lit(1.0).alias("confidence"),
        F.lit("checked").alias("reason"), F.lit(None).cast("string").alias("model"),
        F.lit("human").alias("decided_by"), F.expr("created_at + INTERVAL 1 DAY").alias("created_at"),
    )
    new = r.canonical.select(
        F.col("brand").alias("term"), "canonical_id", F.lit("no_match").alias("verdict"),
        F.lit(0.9).alias("confidence"), F.lit("brand only").alias("reason"), F.lit("stub").alias("model"),
        F.lit("llm").alias("decided_by"), F.lit("2024-06-01").cast("timestamp").alias("created_at"),
    )
    out = state.upsert_verdicts(r.verdicts, again.unionByName(new))
    stamp = "yyyy-MM-dd HH:mm:ss"
    return out.select(
        "term", "canonical_id", "verdict", "confidence", "reason", "decided_by",
        F.date_format("created_at", stamp).alias("created"), F.date_format("updated_at", stamp).alias("updated"),
    )


@matched(
    "apply_reviews",
    """SELECT v.verdict_id, CASE WHEN d.verdict_id IS NOT NULL AND NOT approve
         THEN CASE WHEN verdict = 'match' THEN 'no_match' ELSE 'match' END ELSE verdict END AS verdict,
       CASE WHEN d.verdict_id IS NOT NULL THEN 1.0 ELSE confidence END AS confidence,
       CASE WHEN d.verdict_id IS NOT NULL THEN 'human' ELSE decided_by END AS decided_by,
       CASE WHEN d.verdict_id IS NULL THEN model END AS model,
       CASE WHEN q.status = 'open' AND d.verdict_id IS NOT NULL
         THEN CASE WHEN approve THEN 'approved' ELSE 'rejected' END ELSE q.status END AS status
       FROM verdicts v LEFT JOIN (SELECT verdict_id, verdict_id % 5 <> 0 AS approve FROM reviews
           WHERE status = 'open') d ON d.verdict_id = v.verdict_id
       LEFT JOIN reviews q ON q.verdict_id = v.verdict_id""",
)
def _(r):
    decisions = r.reviews.filter("status = 'open'").select(
        "verdict_id", (F.col("verdict_id") % 5 != 0).alias("approve"),
        F.lit("2024-07-01").cast("timestamp").alias("decided_at"), F.lit("human").alias("resolved_by"),
    )
    cache, closed = state.apply_reviews(r.verdicts, r.reviews, decisions)
    return cache.join(closed.select("verdict_id", "status"), "verdict_id", "left").select(
        "verdict_id", "verdict", "confidence", "decided_by", "model", "status"
    )


@matched(
    "apply_adjudication",
    """SELECT sp.source_product_id, CASE WHEN same THEN best_guess ELSE canonical_id END AS canonical_id,
       CASE WHEN same THEN 0.9 ELSE match_confidence END AS match_confidence,
       CASE WHEN same THEN 'llm_adjudicator' ELSE match_method END AS match_method,
       CASE WHEN canonical_id IS NULL THEN CASE WHEN same THEN 'approved' WHEN NOT asked THEN 'open' ELSE 'rejected' END END AS status,
       CASE WHEN canonical_id IS NULL THEN CASE WHEN asked THEN 'stub' ELSE 'alike' END END AS reason,
       CASE WHEN canonical_id IS NULL AND asked THEN 'llm_adjudicator' END AS resolved_by,
       CASE WHEN canonical_id IS NULL AND asked THEN '2026-07-08' END AS resolved_at
       FROM (SELECT *, asked AND canonical_id IS NULL AND n % 2 = 0 AS same FROM (
             SELECT *, n % 5 <> 0 AS asked FROM (SELECT *, split_part(source_product_id, '-', 1)::BIGINT AS n
             FROM source_products))) sp""",
)
def _(r):
    n = F.substring_index("queue_id", "-", 1).cast("bigint")
    even = n % 2 == 0
    queue = r.queue.withColumns({
        "status": F.lit("open"), "reason": F.lit("alike"), "resolved_by": F.lit(None).cast("string"),
        "resolved_at": F.lit(None).cast("timestamp"),
    })
    decisions = queue.where(n % 5 != 0).select(
        "queue_id", "source_product_id", "candidate_canonical_id", F.lit(True).alias("same_product"),
        F.when(even, 0.9).otherwise(0.6).alias("confidence"), F.lit("stub").alias("reason"),
        F.lit(None).cast("string").alias("error"),
    )
    products, queue = review.apply_adjudication(r.source_products, queue, decisions, now="2026-07-08")
    closed = queue.select("source_product_id", "status", "reason", "resolved_by", day("resolved_at"))
    return products.join(closed, "source_product_id", "left").select(
        "source_product_id", "canonical_id", "match_confidence", "match_method", "status", "reason", "resolved_by", "resolved_at"
    )


@matched(
    "adjudicate_queue",
    """SELECT queue_id, ends_with(candidate_name, raw_name) AND source <> 'NATION_3' AS same_product,
       CASE WHEN source <> 'NATION_3' THEN least(1.0::DOUBLE, length(candidate_name)::DOUBLE / 20) ELSE 0.0 END AS confidence,
       CASE WHEN source <> 'NATION_3' THEN candidate_name ELSE '' END AS reason, source = 'NATION_3' AS failed FROM queue_rows""",
)
def _(r):
    """A stub decider over the whole open queue; it fails for one source."""

    def decide(source, candidate):
        if source["source"] == "NATION_3":
            raise RuntimeError("no answer")
        return {"same_product": candidate["name"].endswith(source["raw_name"]),
                "confidence": len(candidate["name"]) / 20, "reason": candidate["name"]}

    rows = review.open_queue(r.queue, r.source_products, r.canonical)
    return review.decide_queue(rows, decide).select(
        "queue_id", F.coalesce("same_product", F.lit(False)).alias("same_product"), "confidence", "reason",
        F.col("error").isNotNull().alias("failed"),
    )


@matched(
    "adjudicate_pairs",
    f"""SELECT DISTINCT term, canonical_id, verdict, confidence, reason, decided_by FROM verdicts
       UNION ALL
       SELECT DISTINCT term, canonical_id, CASE WHEN length(canonical_name) % 2 = 0 THEN 'match' ELSE 'no_match' END,
         least(1.0::DOUBLE, length(canonical_name)::DOUBLE / 40), canonical_name, {quoted(V.DECIDED_BY_MODEL)}
       FROM pairs p WHERE canonical_id % 7 <> 3
         AND NOT EXISTS (SELECT 1 FROM verdicts v WHERE v.term = p.term AND v.canonical_id = p.canonical_id)""",
)
def _(r):
    """The cache after a stub has decided what it does not hold; failures stay open."""

    def decide(term, candidate):
        if candidate["canonical_id"] % 7 == 3:
            raise RuntimeError("no answer")
        size = len(candidate["name"])
        return {"verdict": "no_match" if size % 2 else "match", "confidence": size / 40, "reason": candidate["name"]}

    cache, _ = review.adjudicate_pairs(pairs_of(r), r.verdicts, decide, "2024-06-01 00:00:00")
    return cache.select("term", "canonical_id", "verdict", "confidence", "reason", "decided_by")


@matched(
    "rebuild_resolution",
    """SELECT source_product_id, raw_name, CASE WHEN keep THEN canonical_id END AS canonical_id,
       CASE WHEN keep THEN match_confidence END AS match_confidence, CASE WHEN keep THEN match_method END AS match_method,
       keep AND canonical_id IS NOT NULL AS dated
       FROM (SELECT *, coalesce(match_method IN ('llm_adjudicator', 'manual'), FALSE) AS keep FROM source_products)""",
)
def _(r):
    stamped = r.source_products.withColumn(
        "resolved_at", F.when(F.col("canonical_id").isNotNull(), F.lit("2024-06-01").cast("timestamp"))
    )
    return jobs.rebuild_resolution(stamped).select(
        "source_product_id", "raw_name", "canonical_id", "match_confidence", "match_method",
        F.col("resolved_at").isNotNull().alias("dated"),
    )


# ---- baskets ---------------------------------------------------------------------------------

@matched(
    "replace_basket",
    """SELECT basket_id, canonical_id, label, category, quantity::BIGINT AS quantity FROM items WHERE basket_id <> 1
       UNION ALL SELECT 1, canonical_id, name, category, 2 FROM canonical""",
)
def _(r):
    """The first basket anew, with two of every product."""
    lines = r.canonical.select(
        "canonical_id", F.col("name").alias("label"), "category", F.lit(2).cast("bigint").alias("quantity")
    )
    return B.replace_basket(r.items, 1, lines).select("basket_id", "canonical_id", "label", "category", "quantity")


@matched(
    "price_spread",
    """SELECT basket_id, canonical_id, n_sources, low::DOUBLE AS min_price, high::DOUBLE AS max_price,
       CASE WHEN n_sources >= 2 THEN ((high - low) * quantity)::DOUBLE END AS spread
       FROM items JOIN spans USING (canonical_id)""",
)
def _(r):
    return B.price_spread(r.items, r.offers).select(
        "basket_id", "canonical_id", "n_sources", *dbl("min_price", "max_price", "spread")
    )


@matched(
    "split_total",
    """SELECT basket_id, split_total::DOUBLE AS split_total,
       array_to_string(coalesce(stores_used, []), ',') AS stores_used FROM optimized""",
)
def _(r):
    return B.optimize_basket(r.sheet).select("basket_id", *dbl("split_total"), joined("stores_used"))


@matched(
    "best_single_store",
    """SELECT basket_id, best_single_source, best_single_total::DOUBLE AS best_single_total,
       savings_vs_single::DOUBLE AS savings_vs_single FROM optimized WHERE best_single_source IS NOT NULL""",
)
def _(r):
    return B.optimize_basket(r.sheet).filter("best_single_source IS NOT NULL").select(
        "basket_id", "best_single_source", *dbl("best_single_total", "savings_vs_single")
    )


@matched(
    "split_footnote",
    """SELECT basket_id, split_total::DOUBLE AS split_total, array_to_string(stores_used, ',') AS stores_used,
       split_savings::DOUBLE AS split_savings, worth_it FROM verdict WHERE has_footnote""",
)
def _(r):
    return B.verdict(r.sheet).filter("has_footnote").select(
        "basket_id", *dbl("split_total", "split_savings"), joined("stores_used"), "worth_it"
    )


#: Gold columns that a citation reads.
CITED = ("canonical_id", "price_id", "ad_week")


@matched(
    "provenance",
    """SELECT basket_id, strftime(ad_week, '%Y-%m-%d') AS ad_week, n_price_ids,
       coalesce(array_to_string(price_ids, ','), '') AS price_ids FROM cited""",
)
def _(r):
    rows = basket_tables(r.items, r.gold.select(*CITED), write_gold=True, dealt=r.item_tasks).provenance
    return rows.select("basket_id", day("ad_week"), "n_price_ids",
        F.array_join(F.coalesce("price_ids", F.array().cast("array<string>")), ",").alias("price_ids"))


@matched(
    "provenance_rows",
    """SELECT i.basket_id, i.canonical_id, g.price_id, strftime(g.ad_week, '%Y-%m-%d') AS ad_week
       FROM items i JOIN gold g ON g.canonical_id = i.canonical_id""",
)
def _(r):
    gold = r.gold.withColumn("ad_week", day("ad_week"))  # once a price row, not once a pair
    return B.provenance_rows(r.items, gold).select("basket_id", "canonical_id", "price_id", "ad_week")


@matched(
    "citations",
    """SELECT basket_id, 'basket ' || basket_id || ' · ad week ' || coalesce(strftime(ad_week, '%Y-%m-%d'), 'None')
       || ' · ' || n_price_ids || ' gold price rows (price_id ' || coalesce(array_to_string(price_ids[1:20], ','), '')
       || CASE WHEN n_price_ids > 20 THEN '…' ELSE '' END || ')' AS citations FROM cited""",
)
def _(r):
    rows = basket_tables(r.items, r.gold.select(*CITED), write_gold=True, dealt=r.item_tasks).cited
    week = F.date_format("ad_week", "yyyy-MM-dd")
    ids = F.coalesce("price_ids", F.array().cast("array<string>"))
    return rows.select(
        "basket_id", N.citation(F.col("basket_id"), week, F.col("n_price_ids"), ids).alias("citations")
    )


@matched("latest_basket", "SELECT basket_id, name FROM baskets ORDER BY basket_id DESC LIMIT 1")
def _(r):
    return reports.latest_basket(r.baskets).select("basket_id", "name")


@matched(
    "basket_lines",
    """SELECT basket_id, row_number() OVER (PARTITION BY basket_id ORDER BY category NULLS LAST, label NULLS LAST,
       canonical_id NULLS LAST, quantity NULLS LAST, price_id NULLS LAST) AS place,
       category, label, quantity, i.source, coalesce(banner, i.source) AS banner,
       price::DOUBLE AS price, line_cost::DOUBLE AS line_cost, price_id
       FROM item_cost i LEFT JOIN sources s ON s.source = i.source""",
)
def _(r):
    return reports.basket_lines(B.basket_item_cost(r.items, r.offers), r.sources).select(
        "basket_id", "place", "category", "label", "quantity", "source", "banner", *dbl("price", "line_cost"), "price_id"
    )


@matched(
    "verdict_report",
    """SELECT v.basket_id, b.name, strftime(ad_week, '%Y-%m-%d') AS ad_week, v.n_items, flexible_winner,
       coalesce(f.banner, flexible_winner) AS flexible_banner, flexible_total::DOUBLE AS flexible_total,
       exact_winner, coalesce(e.banner, exact_winner) AS exact_banner, split_savings::DOUBLE AS split_savings
       FROM verdict v JOIN baskets b ON b.basket_id = v.basket_id
       LEFT JOIN cited c ON c.basket_id = v.basket_id
       LEFT JOIN sources f ON f.source = flexible_winner LEFT JOIN sources e ON e.source = exact_winner""",
)
def _(r):
    t = basket_tables(r.items, r.gold, write_gold=True, dealt=r.item_tasks)
    return reports.verdict_report(t.verdict, r.baskets, r.sources, t.ad_weeks).select(
        "basket_id", "name", day("ad_week"), "n_items", "flexible_winner", "flexible_banner",
        "exact_winner", "exact_banner", *dbl("flexible_total", "split_savings"),
    )


@matched(
    "verdict_lines",
    """SELECT r.basket_id, r.mode, r.source, rank::INT AS rank, NULL::VARCHAR AS label,
       CASE WHEN rank = 1 AND full_coverage THEN 'WINNER: ' || r.source || ' wins this week at $' || store_total
              || ' (covers all ' || n_items || ' items)'
            WHEN full_coverage THEN r.source || ': would''ve been $' || store_total
            ELSE r.source || ': $' || store_total || ' but missing ' || missing_count || ' of ' || n_items
              || ' items' END AS line
       FROM ranking r UNION ALL
       SELECT s.basket_id, s.mode, s.source, NULL, i.label, NULL
       FROM ranking s JOIN items i ON i.basket_id = s.basket_id
       LEFT JOIN offers o ON o.canonical_id = i.canonical_id AND o.source = s.source AND o.mode = s.mode
       WHERE o.canonical_id IS NULL""",
)
def _(r):
    t = r.basket_tables
    return reports.verdict_lines(t.ranking, t.missing)


# ---- fact packs and narration ---------------------------------------------------------------

def packs(r: Roles):
    t = basket_tables(r.items, r.gold, write_gold=True, dealt=r.item_tasks)
    return N.fact_pack(t.ranking, t.missing_flexible, t.verdict, r.sources, t.provenance), t.verdict


@matched(
    "fact_pack",
    """SELECT * FROM (WITH absent AS (SELECT s.basket_id, s.source, list(i.label ORDER BY i.label, i.canonical_id)[1:5] AS labels
         FROM (SELECT basket_id, source FROM ranking WHERE mode = 'flexible') s JOIN items i ON i.basket_id = s.basket_id
         LEFT JOIN offers o ON o.canonical_id = i.canonical_id AND o.source = s.source AND o.mode = 'flexible'
         WHERE o.canonical_id IS NULL GROUP BY ALL),
       stores AS (SELECT k.basket_id, rank, full_coverage, store_total, coalesce(banner, k.source) AS store,
           coalesce(banner, k.source) || ':' || missing_count || ':' || coalesce(array_to_string(labels, '/'), '') AS told
         FROM ranking k LEFT JOIN absent USING (basket_id, source) LEFT JOIN sources s ON s.source = k.source
         WHERE mode = 'flexible'),
       told AS (SELECT basket_id, string_agg(told, ';' ORDER BY rank) AS others FROM stores JOIN verdict USING (basket_id)
         WHERE rank > 1 OR flexible_winner IS NULL GROUP BY basket_id)
       SELECT v.basket_id, v.n_items, coalesce(b.banner, flexible_winner) AS winner, flexible_total::DOUBLE AS total,
       n.store AS runner_up, round(100 * (n.store_total - flexible_total))::BIGINT AS saved_cents,
       len(numbers) AS n_numbers, len(stores_used) AS n_split_stores, n_price_ids AS cited, coalesce(others, '') AS others,
       coalesce(array_to_string(price_ids, ','), '') AS price_ids, strftime(ad_week, '%Y-%m-%d') AS ad_week,
       'basket ' || v.basket_id || ' · ad week ' || coalesce(strftime(ad_week, '%Y-%m-%d'), 'None')
         || ' · ' || n_price_ids || ' gold price rows (price_id ' || coalesce(array_to_string(price_ids[1:20], ','), '')
         || CASE WHEN n_price_ids > 20 THEN '…' ELSE '' END || ')' AS citations
       FROM verdict v LEFT JOIN sources b ON b.source = flexible_winner LEFT JOIN told ON told.basket_id = v.basket_id
       LEFT JOIN stores n ON n.basket_id = v.basket_id AND n.rank = 2 AND n.full_coverage AND flexible_winner IS NOT NULL
       LEFT JOIN fact_numbers f ON f.basket_id = v.basket_id LEFT JOIN cited c ON c.basket_id = v.basket_id)""",
)
def _(r):
    rows, _ = packs(r)
    named = ["n_items", "winner", "runner_up", "saving_vs_runner_up", "split", "other_stores", "ad_week", "_provenance"]
    # a pack is as long as its ids are many: it is read once, and its parts after that
    parts = rows.select("basket_id", "numbers", "citations", F.json_tuple("facts", *named).alias(*named))
    parts = parts.select("*", F.json_tuple("_provenance", "price_id_count", "price_ids").alias("cited", "ids"))
    at = lambda part, path, kind: F.get_json_object(part, path).cast(kind)
    stores = F.from_json("other_stores", "array<struct<store string, missing_count int, missing_labels array<string>>>")
    told = F.transform(stores, lambda x: F.concat_ws(":", x["store"], x["missing_count"].cast("string"), F.array_join(x["missing_labels"], "/")))
    return parts.select(
        "basket_id",
        F.col("n_items").cast("bigint").alias("n_items"),
        at("winner", "$.store", "string").alias("winner"),
        at("winner", "$.total", "double").alias("total"),
        at("runner_up", "$.store", "string").alias("runner_up"),
        F.round(100 * F.col("saving_vs_runner_up").cast("double")).cast("bigint").alias("saved_cents"),
        F.size("numbers").alias("n_numbers"),
        at("split", "$.n_stores", "int").alias("n_split_stores"),
        F.col("cited").cast("bigint").alias("cited"),
        F.coalesce(F.array_join(told, ";"), F.lit("")).alias("others"),
        F.array_join(F.from_json("ids", "array<string>"), ",").alias("price_ids"),
        "ad_week",
        "citations",
    )


def written(r: Roles):
    """A text per basket; every seventh holds an amount nobody can vouch for."""
    rows, verdicts = packs(r)
    good = F.concat(
        F.lit("Week of 2026-07-29: shop at "), "flexible_winner", F.lit(" for $"),
        F.col("flexible_total").cast("string"), F.lit(", all "), F.col("n_list").cast("string"), F.lit(" items."),
    )
    none = F.concat(F.lit("No store covers all "), F.col("n_list").cast("string"), F.lit(" items."))
    slip = F.when(F.col("basket_id") % 7 == 0, " You save $9,999,999.99!").otherwise("")
    texts = verdicts.select(
        "basket_id",
        F.concat(F.when(F.col("flexible_winner").isNull(), none).otherwise(good), slip).alias("narration"),
    )
    return rows.join(texts, "basket_id")


@matched(
    "narration_audit",
    "SELECT basket_id, narration, array_to_string(violations, '; ') AS violations FROM audited",
)
def _(r):
    rows = written(r)
    return rows.select(
        "basket_id", "narration",
        F.array_join(N.audit(F.col("narration"), F.col("numbers")), "; ").alias("violations"),
    )


@matched("narration_gate", "SELECT basket_id, narration, 'stub' AS model, true AS audit_ok FROM audited WHERE len(violations) = 0")
def _(r):
    accepted, _ = N.gate(written(r), model="stub")
    return accepted.select("basket_id", "narration", "model", "audit_ok")


@matched(
    "latest_narration",
    """SELECT o_custkey AS basket_id, arg_max(o_orderpriority, o_orderkey) AS narration,
       arg_max(o_orderstatus, o_orderkey) AS citations,
       strftime(arg_max(o_orderdate::DATE - ((isodow(o_orderdate) + 4) % 7)::INT, o_orderkey), '%Y-%m-%d') AS ad_week
       FROM orders WHERE o_totalprice > 100000 GROUP BY o_custkey""",
)
def _(r):
    """Orders as stored narrations of their customer's basket."""
    stored = r.table("orders").select(
        F.col("o_custkey").alias("basket_id"), F.col("o_orderkey").alias("narration_id"),
        F.col("o_orderpriority").alias("narration"), F.col("o_orderstatus").alias("citations"),
        ad_week(F.col("o_orderdate")).alias("ad_week"), F.lit("stub").alias("model"),
        (F.col("o_totalprice") > 100000).alias("audit_ok"),
    )
    return N.latest_narration(stored, "narration_id").select("basket_id", "narration", "citations", day("ad_week"))
