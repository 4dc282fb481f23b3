"""Multi-step jobs over named tables: each returns the tables it changes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.taxonomy import coarse_category
from ..operators import basket as B
from ..operators import resolve as R
from ..operators import review, state, terms
from ..operators.gold import cross_store_items, gold_current_prices
from ..schemas import conform
from ..session import cut_lineage
from ..sources.artifacts import mark_parsed
from ..sources.catalogs import unreadable
from ..streaming.ingest import parse_artifacts, prices_of, sightings, waiting
from . import narration as N
from .baskets import basket_tables

Tables = dict[str, DataFrame]


def normalize(artifacts: DataFrame, tables: Tables, now: Column | None = None) -> Tables:
    """Payloads to resolved products and prices: parse, fold sightings, fill
    categories, undo cross-category links, resolve what is unlinked in the order it arrived.

    Only pending artifacts are taken; the manifest of all comes back with what was parsed or could not be read.
    Stored products stay: what is seen again takes
    its new name and size, and keeps its first sighting, brand, known categories and
    links. A price row that is stored already is not added again. New links and queue rows are stamped ``now``."""
    now = F.current_timestamp() if now is None else now
    taken = waiting(artifacts)
    records = parse_artifacts(taken)
    seen = state.source_product_table(sightings(records), "manifest_id", "line")
    lines = seen.select("source_product_id", "line")
    seen = conform(seen.withColumnRenamed("manifest_id", "bronze_manifest_id").drop("line"), "source_products")
    products = with_stored(seen, tables["source_products"])
    products, canonical = state.backfill_categories(
        products, tables["canonical_products"], coarse_category
    )
    products = cut_lineage(state.sever_cross_category(products, canonical).drop("severed"))
    todo = products.filter("canonical_id IS NULL").join(lines, "source_product_id", "left")
    todo = R.numbered(todo, ["first_seen_at", "bronze_manifest_id", "line", "source_product_id"]).select(
        "product_id", "source_product_id", "raw_name", "category_hint", "coarse_category"
    )
    outcome = R.resolve_products(todo, canonical.select("canonical_id", "name", "coarse_category"))
    outcome = cut_lineage(R.named(outcome, todo, "source_product_id"))
    own = todo.drop("product_id").withColumnRenamed("source_product_id", "product_id")
    new = conform(R.new_canonicals(outcome, own).withColumn("created_at", now), "canonical_products")
    resolved = R.apply_resolution(
        products.withColumnRenamed("source_product_id", "product_id"), outcome, now
    ).withColumnRenamed("product_id", "source_product_id")
    queued = R.queued_pairs(outcome, tables["resolution_queue"], now).withColumn(
        "queue_id", F.xxhash64("source_product_id", "candidate_canonical_id")
    )
    return {
        "source_products": conform(resolved, "source_products"),
        "canonical_products": conform(canonical, "canonical_products").unionByName(new),
        "resolution_queue": tables["resolution_queue"].unionByName(conform(queued, "resolution_queue")),
        "prices": tables["prices"].unionByName(
            conform(prices_of(records), "prices").join(tables["prices"].select("price_id"), "price_id", "left_anti")
            .select(*tables["prices"].columns)
        ),
        "bronze_manifest": manifest_after(artifacts, taken),
    }


def manifest_after(artifacts: DataFrame, taken: DataFrame) -> DataFrame:
    """The manifest of some artifacts after ``taken`` were parsed."""
    manifest = conform(artifacts, "bronze_manifest").withColumn("parse_status", F.coalesce("parse_status", F.lit("pending")))
    failed = unreadable(taken.filter("source <> 'aldi_kcl'"))
    parsed = taken.join(failed.select("manifest_id"), "manifest_id", "left_anti")
    return conform(mark_parsed(manifest, parsed, failed).drop("payload"), "bronze_manifest")


def with_stored(seen: DataFrame, stored: DataFrame) -> DataFrame:
    """Products of a run folded into the stored ones."""
    new = F.col("n.source_product_id").isNotNull()
    later = new & F.coalesce(F.col("n.last_seen_at") >= F.col("o.last_seen_at"), F.lit(True))
    kept = {"first_seen_at": F.least("n.first_seen_at", "o.first_seen_at"),
            "last_seen_at": F.greatest("n.last_seen_at", "o.last_seen_at")}
    followed = {"raw_name", "raw_size_text"}
    both = seen.alias("n").join(stored.alias("o"), F.col("n.source_product_id") == F.col("o.source_product_id"), "full")
    return both.select(*[
        kept.get(c, F.when(later, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in followed
                 else F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}"))).alias(c)
        for c in stored.columns
    ])


def rebuild_resolution(source_products: DataFrame) -> DataFrame:
    """Drop the links a resolution run made, keep adjudicated and manual ones."""
    derived = F.col("match_method").isin(V.METHOD_SEED, V.METHOD_NEW, V.METHOD_FUZZY)
    out = source_products
    for field in state.LINK_FIELDS:
        out = out.withColumn(f"_{field}", F.when(~F.coalesce(derived, F.lit(True)), F.col(field)))
    return out.select(
        *[F.col(f"_{c}").alias(c) if c in state.LINK_FIELDS else F.col(c) for c in source_products.columns]
    )


def current_gold(tables: Tables) -> DataFrame:
    return gold_current_prices(
        tables["prices"], tables["source_products"], tables["canonical_products"], tables["stores"]
    )


def adjudicate_queue(
    tables: Tables, decide: Callable, limit: int | None = None, journal: str | None = None
) -> tuple[Tables, dict]:
    """Decide open pairs; reports how many products two or more sources share
    before and after."""
    rows = review.prioritized(
        review.open_queue(
            tables["resolution_queue"], tables["source_products"], tables["canonical_products"]
        ),
        limit,
    )
    decisions = state_written(review.decide_queue(rows, decide, journal))
    before = cross_store_items(tables["source_products"]).count()
    products, queue = review.apply_adjudication(
        tables["source_products"], tables["resolution_queue"], decisions
    )
    stats = {r["outcome"]: r["n"] for r in review.adjudication_stats(decisions).collect()}
    stats.update(before=before, after=cross_store_items(products).count())
    return {"source_products": products, "resolution_queue": queue}, stats


def state_written(df: DataFrame) -> DataFrame:
    """Answers of a paid decider are written before they are used; a ``journal`` of the job keeps them even from tasks
    and runs that fail on the way here."""
    return cut_lineage(df)


def adjudicate_list(
    lists: DataFrame, tables: Tables, decide: Callable, now, model: str | None = None, journal: str | None = None
) -> tuple[Tables, DataFrame]:
    """Ask about the list's undecided (term, product) pairs; weak answers wait
    for review. Returns the new cache and queue, and this run's answers."""
    products = terms.gold_products(current_gold(tables))
    pairs = terms.adjudication_pairs(lists.select(*terms.TERM_FIELDS).distinct(), products)
    asked = state.fresh_pairs(pairs, tables["match_verdicts"])
    known = tables["match_verdicts"]
    _, answers = review.adjudicate_pairs(asked, known.limit(0), decide, now, model, journal)
    answers = state_written(answers)
    changes = answers.filter("error IS NULL").select(
        *state.VERDICT_KEY, "verdict", "confidence", "reason",
        F.lit(model).cast("string").alias("model"),
        F.lit(V.DECIDED_BY_MODEL).alias("decided_by"),
        F.lit(now).cast("timestamp").alias("created_at"),
    )
    cache = state.upsert_verdicts(known, changes).withColumn(
        "verdict_id", F.xxhash64(*state.VERDICT_KEY)
    )
    queue = tables["match_review_queue"]
    opened = conform(state.enqueue_review(cache.join(changes.select(*state.VERDICT_KEY),
                                                    state.VERDICT_KEY, "left_semi"), queue),
                     "match_review_queue")
    return {
        "match_verdicts": conform(cache, "match_verdicts"),
        "match_review_queue": queue.unionByName(opened),
    }, answers


def optimize(lists: DataFrame, tables: Tables, basket_id: int = 1) -> Tables:
    """Build one basket from a shopping list, then its ranking and verdict."""
    gold = current_gold(tables)
    wanted = lists.withColumn("list_id", F.lit(basket_id).cast("bigint"))
    cached = terms.confident_matches(wanted, tables["match_verdicts"], tables["canonical_products"], gold)
    found = terms.term_candidates(wanted, terms.gold_products(gold), tables["match_verdicts"])
    placed = terms.assign_basket(wanted, cached, found)
    items = placed.filter("canonical_id IS NOT NULL").select(
        F.col("list_id").alias("basket_id"), "canonical_id", "category", "label", "quantity"
    )
    t = basket_tables(items, gold)
    return {
        "basket_items": B.replace_basket(tables["basket_items"], basket_id, items.drop("basket_id")),
        "missing_terms": placed.filter("canonical_id IS NULL").select("position", "label"),
        "ranking": t.ranking,
        "verdict": t.verdict,
        "optimized": B.optimize_basket(t.sheet),
    }


def fact_packs(tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Packs that hold every price id, and the same price rows as a table keyed by basket_id."""
    gold = current_gold(tables).withColumn("price_id", F.col("price_id").cast("string"))
    t = basket_tables(tables["basket_items"], gold, write_gold=True)
    return N.fact_pack(t.ranking, t.missing_flexible, t.verdict, tables["sources"], t.provenance), t.provenance_rows


@dataclass(frozen=True)
class Narrated:
    """Summaries of every basket, and every price row behind them by basket_id; unpacks to the summaries."""

    accepted: DataFrame
    rejected: DataFrame
    provenance_rows: DataFrame

    def __iter__(self) -> Iterator[DataFrame]:
        return iter((self.accepted, self.rejected))


def narrate(
    tables: Tables, write: Callable[[str], str], model: str | None = None, journal: str | None = None
) -> Narrated:
    """(accepted, rejected) summaries of every basket, with their price rows beside them."""
    packs, rows = fact_packs(tables)
    return Narrated(*N.gate(state_written(N.write_summaries(packs, write, journal)), model), rows)
