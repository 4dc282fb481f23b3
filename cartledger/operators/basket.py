"""Basket totals, store rankings, verdicts: every basket in one plan.

Offers do not depend on baskets, so they are reduced to one row per product
(at most one offer per source) before any basket line meets them. Money is
summed as whole cents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..session import cut_lineage

MODES = {"flexible": V.FLEXIBLE_CONFIDENCE, "exact": V.EXACT_CONFIDENCE}

#: Rows per (line, source) that one task makes at most on average, so that their sorts fit its memory.
ROWS_A_TASK = 500_000
#: Price ids that are sent to all tasks at most (some 150 MB); beyond that Spark joins them by product.
SENT_IDS = 5_000_000
#: Offers (a source of a product each) that are sent to all tasks at most; beyond that Spark decides by their written size.
SENT_OFFERS = 1_000_000


def cents(price: Column) -> Column:
    return (price * 100).cast("bigint")


def money(amount: Column) -> Column:
    return (amount.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(
        "decimal(18,2)"
    )


def product_offers(gold: DataFrame) -> DataFrame:
    """One row per product: its best offer per source and mode, the number of
    priced sources, lowest and highest price, and the cheapest row overall.

    Aggregates per (product, source) first, so a hot product is reduced by many
    tasks and its ``offers`` list holds at most one entry per source.
    """
    price = cents(F.col("price"))
    confidence = F.col("match_confidence")
    best_row = F.struct(
        "price", "source", "store_id", "price_id", "unit_price", "unit", "canonical_name"
    )
    per_source = (
        gold.filter("price IS NOT NULL")
        .groupBy("canonical_id", "source")
        .agg(
            *[
                F.min(F.when(confidence >= floor, price)).alias(mode)
                for mode, floor in MODES.items()
            ],
            F.min(price).alias("low"),
            F.max(price).alias("high"),
            F.min(best_row).alias("best"),
        )
    )
    return per_source.groupBy("canonical_id").agg(
        F.collect_list(F.struct("source", *MODES)).alias("offers"),
        F.count("*").alias("n_sources"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("best").alias("best"),
    )


def basket_item_cost(items: DataFrame, offers: DataFrame) -> DataFrame:
    """The optimal split: each basket line at its cheapest offer."""
    best = offers.select("canonical_id", "best.*")
    return items.join(best, "canonical_id").select(
        "basket_id", "category", "label", "quantity", "canonical_id", "canonical_name",
        "source", "store_id", "price", "unit_price", "unit",
        (F.col("price") * F.col("quantity")).cast("decimal(18,2)").alias("line_cost"),
        "price_id",
    )


LIST_FIGURES = ["n_items", "n_priced", "split_cents", "n_multi", "spread_cents"]


def basket_list(items: DataFrame) -> DataFrame:
    """(basket_id, canonical_id, n_lines, quantity): a basket's lines, one row per product.

    What a store covers and costs depends on the product alone, so equal products count together. A basket
    has at most as many rows as there are products, however many lines it holds. Rows of a basket stand together in a
    task, which makes them small on disk, here and when they are dealt.
    """
    return items.groupBy("basket_id", "canonical_id").agg(
        F.count("*").alias("n_lines"), F.sum("quantity").alias("quantity")
    ).sortWithinPartitions("basket_id")


def basket_tasks(basket_list: DataFrame, offers: DataFrame) -> int:
    """How many tasks the rows of a written :func:`basket_list` are dealt into: see :func:`tasks_of`."""
    sources = offers.agg(F.max("n_sources")).first()[0] or 1
    return tasks_of(basket_list.sparkSession, basket_list.count(), sources)


def tasks_of(spark: SparkSession, rows: int, sources: int) -> int:
    """Tasks grow with the ``rows`` of baskets, as each becomes one per source of its product there."""
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(4 * least, -(-rows * sources // ROWS_A_TASK))


def by_basket(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows of a basket in one task, in more tasks than usual: each row becomes one per source there."""
    spark = rows.sparkSession
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks or 4 * least, "basket_id")


def sent(offers: DataFrame) -> DataFrame:
    """Written offers, up to ``SENT_OFFERS`` of them sent to all tasks whatever size the plan guesses: lines dealt by basket
    stay where they are."""
    few = (offers.agg(F.sum("n_sources")).first()[0] or 0) <= SENT_OFFERS
    return F.broadcast(offers) if few else offers


def basket_sheet(items: DataFrame, offers: DataFrame) -> DataFrame:
    """One row per (basket, source); lines nobody offers stand under a NULL source. See :func:`sheet_of_list`.

    The basket list is written first: its size decides how many tasks there are."""
    lines, offers = cut_lineage(basket_list(items)), cut_lineage(offers)
    return sheet_of_list(lines, offers, basket_tasks(lines, offers))


def sheet_of_list(basket_list: DataFrame, offers: DataFrame, tasks: int | None = None) -> DataFrame:
    """The sheet of the rows of :func:`basket_list`, made in ``tasks`` (see :func:`basket_tasks`).

    Rows are dealt by basket while they are narrow. Each is then exploded into its offers and aggregated in the
    same task, and so is all that is grouped by basket later: rows per source are never shuffled. That
    holds up to ``SENT_OFFERS``, or where Spark finds ``offers`` (a row per product) small enough to be broadcast; else partial aggregates
    are shuffled. The first offer of a row also carries its whole-list figures, so summed over a basket's rows
    every line counts once, and one aggregation yields store totals and list totals alike.
    """
    lines = by_basket(basket_list, tasks).join(sent(offers), "canonical_id", "left").select(
        "basket_id",
        "n_lines",
        "quantity",
        "n_sources",
        "low",
        "high",
        F.col("best.source").alias("best_source"),
        F.posexplode_outer("offers").alias("position", "offer"),
    )
    source, qty = F.col("offer.source"), F.col("quantity")
    whole = F.coalesce(F.col("position"), F.lit(0)) == 0
    multi = whole & (F.col("n_sources") >= 2)

    def counted(when):
        return F.sum(F.when(when, F.col("n_lines")).otherwise(0))

    return lines.groupBy("basket_id", source.alias("source")).agg(
        *[counted(F.col(f"offer.{m}").isNotNull()).alias(f"covered_{m}") for m in MODES],
        *[F.sum(F.col(f"offer.{m}") * qty).alias(f"cents_{m}") for m in MODES],
        counted(source == F.col("best_source")).alias("best_lines"),
        counted(whole).alias("n_items"),
        counted(whole & F.col("low").isNotNull()).alias("n_priced"),
        F.sum(F.when(whole, F.col("low") * qty)).alias("split_cents"),
        counted(multi).alias("n_multi"),
        F.sum(F.when(multi, (F.col("high") - F.col("low")) * qty)).alias("spread_cents"),
    )


def _with_list_figures(sheet: DataFrame) -> DataFrame:
    """Give every row its basket's whole-list figures; a group is one basket's
    sources, never its lines."""
    w = Window.partitionBy("basket_id")
    return sheet.select(
        "basket_id", "source", "best_lines",
        *[f"covered_{m}" for m in MODES],
        *[f"cents_{m}" for m in MODES],
        *[F.sum(n).over(w).alias(n) for n in LIST_FIGURES],
    )


def basket_store_totals(items: DataFrame, offers: DataFrame) -> DataFrame:
    """Per (basket, source): covered items and the total to buy them there."""
    rows, offers = cut_lineage(basket_list(items)), cut_lineage(offers)
    rows = by_basket(rows, basket_tasks(rows, offers))
    lines = rows.join(sent(offers).select("canonical_id", "offers"), "canonical_id").select(
        "basket_id", "n_lines", "quantity", F.inline("offers")
    )
    return (
        lines.filter("flexible IS NOT NULL").groupBy("basket_id", "source")
        .agg(
            F.sum("n_lines").alias("items_covered"),
            F.sum(F.col("flexible") * F.col("quantity")).alias("total"),
        )
        .filter("items_covered > 0")
        .select("basket_id", "source", "items_covered", money(F.col("total")).alias("store_total"))
    )


def store_ranking(sheet: DataFrame) -> DataFrame:
    """Every store of every basket in both modes, best first: full coverage
    before partial, then the lower total, then the source name."""
    rows = _with_list_figures(sheet).filter("source IS NOT NULL")
    modes = F.array(
        *[
            F.struct(
                F.lit(mode).alias("mode"),
                F.col(f"covered_{mode}").alias("items_covered"),
                F.col(f"cents_{mode}").alias("total_cents"),
            )
            for mode in MODES
        ]
    )
    rows = (
        rows.select("basket_id", "source", "n_items", F.inline(modes))
        .filter("items_covered > 0")
        .withColumn("full_coverage", F.col("items_covered") == F.col("n_items"))
    )
    w = Window.partitionBy("basket_id", "mode").orderBy(
        F.desc("full_coverage"), F.asc("total_cents"), F.asc("source")
    )
    return rows.select(
        "basket_id", "mode", "source", "items_covered", "n_items",
        money(F.col("total_cents")).alias("store_total"),
        (F.col("n_items") - F.col("items_covered")).alias("missing_count"),
        "full_coverage",
        F.row_number().over(w).alias("rank"),
    )


def verdict_winner(ranking: DataFrame) -> DataFrame:
    """The winning store per (basket, mode); none without full coverage."""
    return ranking.filter("rank = 1 AND full_coverage").select(
        "basket_id", "mode", "source", "store_total", "n_items"
    )


def store_deltas(ranking: DataFrame) -> DataFrame:
    """What each store costs above the winner; NULL when it does not."""
    w = Window.partitionBy("basket_id", "mode")
    winner = F.max(
        F.when((F.col("rank") == 1) & F.col("full_coverage"), F.col("store_total"))
    ).over(w)
    above = F.col("store_total") - F.col("winner_total")
    return ranking.withColumn("winner_total", winner).select(
        "basket_id", "mode", "source", "store_total", "winner_total",
        F.when(above > 0, above).alias("above_winner"),
    )


def runner_up(ranking: DataFrame) -> DataFrame:
    """Winner and next full-coverage store per (basket, mode), and the saving.
    Full-coverage stores come first, so the runner-up is rank 2."""
    full = ranking.filter("full_coverage AND rank <= 2")
    pick = lambda rank, name: F.max(F.when(F.col("rank") == rank, F.col(name)))
    return full.groupBy("basket_id", "mode").agg(
        pick(1, "source").alias("winner"),
        pick(1, "store_total").alias("winner_total"),
        pick(2, "source").alias("runner_up"),
        pick(2, "store_total").alias("runner_up_total"),
        (pick(2, "store_total") - pick(1, "store_total")).alias("saving"),
    )


def source_bits(sources: DataFrame) -> DataFrame:
    """(source, word, bit, flag): every source's place in masks of 64 bits.

    One row per source. Numbering them takes one task, so ``sources`` is a dimension or the sources of a sheet, which
    are few; more than 64 of them take more words, not wider ones.
    """
    number = F.row_number().over(Window.orderBy("source")) - 1
    return (
        sources.select("source").filter("source IS NOT NULL").distinct()
        .select("source", number.alias("n"))
        .selectExpr("source", "n DIV 64 AS word", "n % 64 AS bit", "shiftleft(1L, n % 64) AS flag")
    )


def _mask(mode: str, held: Column) -> Column:
    return F.coalesce(F.bit_or(F.when(held, F.col("flag"))), F.lit(0).cast("bigint")).alias(mode)


def missing_masks(
    items: DataFrame, offers: DataFrame, sheet: DataFrame, bits: DataFrame, like_sheet: bool = False
) -> DataFrame:
    """(basket_id, canonical_id, label, word, flexible, exact): the ranked stores that lack a basket line, as bits.

    A basket's stores and a product's stores are one mask each, so a line meets two whole numbers and what is absent is
    one AND NOT; ``bit_count`` counts it without making rows. Lines that no store lacks are left out. A product's masks
    are written, so that lines, dealt by basket, are not dealt anew where these are small.

    A basket's masks are narrow and are sent to the lines, which carry labels; with ``like_sheet`` lines are dealt into the
    tasks of the sheet instead, for readers that join both.
    """
    offered = offers.select("canonical_id", F.inline("offers")).join(bits, "source")
    have = offered.groupBy("canonical_id", "word").agg(*[_mask(f"have_{m}", F.col(m).isNotNull()) for m in MODES])
    have = cut_lineage(have)
    have = F.broadcast(have) if have.count() <= SENT_OFFERS else have
    ranked = sheet.join(bits, "source").groupBy("basket_id", "word").agg(
        *[_mask(f"all_{m}", F.col(f"covered_{m}") > 0) for m in MODES]
    )
    ranked = ranked if like_sheet else by_basket(ranked)
    lines = items.select("basket_id", "canonical_id", "label").join(ranked, "basket_id")
    met = lines.join(have, ["canonical_id", "word"], "left")
    absent = [
        F.col(f"all_{m}").bitwiseAND(F.bitwise_not(F.coalesce(f"have_{m}", F.lit(0).cast("bigint")))).alias(m)
        for m in MODES
    ]
    some = " OR ".join(f"{m} <> 0" for m in MODES)
    return met.select("basket_id", "canonical_id", "label", "word", *absent).filter(some)


def missing_counts(masks: DataFrame) -> DataFrame:
    """Per (basket, line): how many ranked stores lack it in each mode, straight from the masks."""
    return masks.groupBy("basket_id", "canonical_id", "label").agg(
        *[F.sum(F.bit_count(m)).alias(f"lacking_{m}") for m in MODES]
    )


def missing_items(
    items: DataFrame,
    offers: DataFrame,
    sheet: DataFrame,
    bits: DataFrame | None = None,
    modes: tuple[str, ...] = tuple(MODES),
    like_sheet: bool = False,
) -> DataFrame:
    """(basket_id, mode, source, canonical_id, label) for every line a ranked store lacks in one of ``modes``.

    Rows are made from :func:`missing_masks` last of all, one per bit that is set. ``bits`` is the table of
    :func:`source_bits`, numbered from the sheet when it is not given.
    """
    bits = source_bits(sheet) if bits is None else bits
    masks = missing_masks(items, offers, sheet, bits, like_sheet)
    by_mode = F.array(*[F.struct(F.lit(m).alias("mode"), F.col(m).alias("mask")) for m in modes])
    rows = masks.select("basket_id", "canonical_id", "label", "word", F.inline(by_mode)).filter("mask <> 0")
    places = F.expr("filter(sequence(0, 63), i -> getbit(mask, i) = 1)")
    return (
        rows.select("basket_id", "canonical_id", "label", "word", "mode", F.explode(places).alias("bit"))
        .join(bits.select("word", "bit", "source"), ["word", "bit"])
        .select("basket_id", "mode", "source", "canonical_id", "label")
    )


def optimize_basket(sheet: DataFrame) -> DataFrame:
    """One row per basket: split total and stores, best single store that covers
    every priced item, the saving, and the spread over multi-source items."""
    rows = _with_list_figures(sheet)
    full = F.col("source").isNotNull() & (F.col("covered_flexible") == F.col("n_priced"))
    best = F.min(F.when(full, F.struct("cents_flexible", "source")))
    keys = ["n_priced", "split_cents", "n_multi", "spread_cents"]
    out = rows.groupBy("basket_id").agg(
        *[F.max(k).alias(k) for k in keys],
        F.max("n_items").alias("n_list"),
        F.sort_array(
            F.collect_list(F.when(F.col("best_lines") > 0, F.col("source")))
        ).alias("stores_used"),
        best.alias("best"),
    )
    split = F.coalesce(F.col("split_cents"), F.lit(0))
    return out.select(
        "basket_id",
        F.col("n_list"),
        F.col("n_priced").alias("n_items"),
        money(split).alias("split_total"),
        "stores_used",
        F.col("best.source").alias("best_single_source"),
        money(F.col("best.cents_flexible")).alias("best_single_total"),
        money(F.col("best.cents_flexible") - split).alias("savings_vs_single"),
        F.col("n_multi").alias("multi_source_items"),
        money(F.coalesce(F.col("spread_cents"), F.lit(0))).alias("optimizer_value"),
    )


def verdict(sheet: DataFrame) -> DataFrame:
    """One row per basket: the winner in each mode and the split footnote.

    Coverage here means the whole list, priced or not. The footnote is absent
    when a winner exists and the split saves nothing; without a winner it has no
    saving to weigh. Runs on the sheet's own partitioning: no join.
    """
    rows = _with_list_figures(sheet)

    def winner(mode):
        full = F.col("source").isNotNull() & (F.col(f"covered_{mode}") == F.col("n_items"))
        return F.min(F.when(full, F.struct(F.col(f"cents_{mode}").alias("cents"), "source")))

    out = rows.groupBy("basket_id").agg(
        F.max("n_priced").alias("n_items"),
        F.max("n_items").alias("n_list"),
        F.max("split_cents").alias("split_cents"),
        F.sort_array(
            F.collect_list(F.when(F.col("best_lines") > 0, F.col("source")))
        ).alias("stores_used"),
        *[winner(m).alias(m) for m in MODES],
    )
    total = F.col("flexible.cents")
    saved = total - F.col("split_cents")
    has_winner = F.col("flexible").isNotNull()
    shown = (has_winner & (saved > 0)) | (~has_winner & (F.col("n_items") > 0))
    worth = (saved >= int(V.WORTH_IT_SAVING * 100)) | (
        F.try_divide(saved.cast("double"), total.cast("double")) >= V.WORTH_IT_SHARE
    )
    return out.select(
        "basket_id",
        "n_items",
        "n_list",
        *[
            c
            for m in MODES
            for c in (
                F.col(f"{m}.source").alias(f"{m}_winner"),
                money(F.col(f"{m}.cents")).alias(f"{m}_total"),
            )
        ],
        shown.alias("has_footnote"),
        F.when(shown, money(F.col("split_cents"))).alias("split_total"),
        F.when(shown, F.col("stores_used")).alias("stores_used"),
        F.when(shown & has_winner, money(saved)).alias("split_savings"),
        F.when(shown & has_winner, worth).alias("worth_it"),
    )


def price_spread(items: DataFrame, offers: DataFrame) -> DataFrame:
    """Per basket line: priced sources, lowest and highest price, and the money
    between them where at least two sources carry it."""
    span = (F.col("high") - F.col("low")) * F.col("quantity")
    return items.join(offers, "canonical_id").select(
        "basket_id", "canonical_id", "n_sources",
        money(F.col("low")).alias("min_price"),
        money(F.col("high")).alias("max_price"),
        F.when(F.col("n_sources") >= 2, money(span)).alias("spread"),
    )


def provenance(items: DataFrame, gold: DataFrame, ids: bool | int = True, tasks: int | None = None) -> DataFrame:
    """Per basket: latest ad week, how many gold price rows stand behind it and, with ``ids``, every one of their ids in
    order; a number asks for the first so many.

    A gold row belongs to one product, so all of it is gathered per product first and meets a basket's products, each taken
    once. A reader that leaves out ``price_ids`` pays for no ids: they are not gathered before they are read. ``gold`` is read
    twice, so it is written already. It holds current prices only: a basket's ids are at most its lines times
    the stores. :func:`provenance_rows` gives them as rows.

    With every id, a row of a line is as wide as its product has ids. So lines are dealt into ``tasks`` and ordered by
    basket while they are narrow, the ids are sent to them up to ``SENT_IDS``, and a window reads one basket at a time:
    rows with ids are neither shuffled nor sorted. Beyond that ids meet lines by product, in a join that falls away where nobody
    reads them.
    """
    listed = ids is True
    known = [F.max("ad_week").alias("ad_week"), F.count("price_id").alias("n_ids")]
    every_id = F.sort_array(F.collect_list("price_id")).alias("ids")
    lines = by_basket(items.select("basket_id", "canonical_id"), tasks).distinct()
    every = F.sort_array(F.flatten("ids"))
    shown = F.when(F.col("n_lists") > 0, every if listed else F.slice(every, 1, int(ids) or 1))
    figures = {
        "ad_week": F.max("ad_week"), "n_price_ids": F.sum("n_ids"), "n_lists": F.count("n_ids"),
        **({"ids": F.collect_list("ids")} if ids else {}),
    }
    if listed and gold.agg(F.count("price_id")).first()[0] <= SENT_IDS:
        facts = F.broadcast(gold.groupBy("canonical_id").agg(*known, every_id))
        basket = Window.partitionBy("basket_id")
        lines = lines.withColumn("n", F.row_number().over(basket.orderBy("canonical_id")))
        rows = lines.join(facts, "canonical_id", "left").select(
            "basket_id", "n", *[figure.over(basket).alias(name) for name, figure in figures.items()]
        ).filter("n = 1")
    else:
        facts = gold.groupBy("canonical_id").agg(*known)
        if ids and not listed:
            rank = F.row_number().over(Window.partitionBy("canonical_id").orderBy("price_id"))
            first = gold.select("canonical_id", "price_id").filter("price_id IS NOT NULL").withColumn("n", rank)
            first = first.filter(F.col("n") <= ids).groupBy("canonical_id").agg(F.collect_list("price_id").alias("ids"))
            facts = facts.join(first, "canonical_id", "left")
        facts = cut_lineage(facts)  # its true size decides how it is joined
        if listed:
            facts = F.broadcast(facts) if facts.count() <= SENT_OFFERS else facts
            lists = gold.groupBy("canonical_id").agg(every_id)
            # a row each, taken by max: so the optimizer knows that the join can go where ids are not read
            met = lines.join(facts, "canonical_id", "left").join(lists, "canonical_id", "left")
            met = met.groupBy("basket_id", "canonical_id").agg(*[F.max(c).alias(c) for c in ("ad_week", "n_ids", "ids")])
        else:
            met = lines.join(facts, "canonical_id", "left")
        rows = met.groupBy("basket_id").agg(*[figure.alias(name) for name, figure in figures.items()])
    return rows.select(
        "basket_id", "ad_week", F.coalesce("n_price_ids", F.lit(0)).alias("n_price_ids"),
        *[shown.alias("price_ids")] * bool(ids),
    )


def provenance_rows(items: DataFrame, gold: DataFrame) -> DataFrame:
    """Every (basket, gold price row) pair, once."""
    return items.select("basket_id", "canonical_id").distinct().join(
        gold.select("canonical_id", "price_id", "ad_week"), "canonical_id"
    )


def replace_basket(
    items: DataFrame, basket_id: int, new_items: DataFrame
) -> DataFrame:
    """State after one basket's lines are dropped and written anew."""
    return items.filter(F.col("basket_id") != basket_id).unionByName(
        new_items.withColumn("basket_id", F.lit(basket_id).cast("bigint")),
        allowMissingColumns=True,
    )
