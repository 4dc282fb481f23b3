"""Mixing sources to target weights: temperature, bisected exponent, budgeted block permutations.

A source's natural share is its part of all tokens. Mixing raises shares to an exponent in [0, 1] and
normalises: 1 keeps the natural mix, 0 makes all sources equal. The exponent is bisected: the largest
that reaches the target entropy, but never so small that a source repeats beyond the limit.

The budget is as large as every document's being taken once requires: the source that the mix holds
back most is read exactly once, all others once or more. A source is dealt into blocks by a hash of
its documents; each pass over it takes the blocks in a new order, and the last, unfinished pass takes
whole blocks while the budget lasts. So an emission depends on its document, its block's place and
a few figures by source, and no source is ever sorted or gathered in one task.

Nulls: a null text has no tokens and goes with every pass of its block; a null source is a source of
its own. Repeated rows are taken each; blocks of equal turn go by number, and emissions of equal key may
stand in either order. A text of any length counts as one document. Empty tables give empty results.
All columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartledger.session import cut_lineage

#: Part of the largest possible entropy that the mix should reach.
TARGET_EVENNESS = 0.95
#: Passes over a source at most.
MAX_REPEATS = 2.0
#: Blocks of a source: a weight is met to one part in as many.
BLOCKS = 1024
SEED = 17

#: Five halvings at once: the inner points of as many parts are tried by one aggregation.
_POINTS, _PASSES = 32, 6
#: Names of the added columns, and of those used on the way; a column of such a name is replaced.
ADDED = ("mix_tokens", "mix_pass", "mix_block", "mix_key", "mix_source", "mix_of", "mix_turns", "mix_turn")


def n_tokens(text: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _entropies(shares: DataFrame, exponents: list[float]) -> list[float]:
    """Entropy of the mix at each exponent, by one aggregation over ``shares`` (x: logarithm of a source's share)."""
    x = F.col("x")
    sums = [s for a in exponents for s in (F.sum(F.exp(x * a)), F.sum(F.exp(x * a) * x * a))]
    found = shares.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    return [math.log(whole) - part / whole for whole, part in zip(found[::2], found[1::2], strict=True)]


def exponent_of(shares: DataFrame, evenness: float, max_repeats: float, spread: float) -> float:
    """The largest exponent in [0, 1] that reaches the entropy, or the least that ``max_repeats`` allows if that is more.

    ``spread`` is the logarithm of the largest source over the smallest: the smallest is read
    exp((1 - exponent) * spread) times when the largest is read once.
    """
    allowed = max(0.0, 1.0 - math.log(max(max_repeats, 1.0)) / spread) if spread > 0 else 0.0
    target = evenness * math.log(shares.count())
    if allowed >= 1.0 or _entropies(shares, [1.0])[0] >= target:
        return 1.0
    lo, width = 0.0, 1.0
    for _ in range(_PASSES):
        width /= _POINTS
        points = [lo + k * width for k in range(1, _POINTS)]
        # entropy falls as the exponent grows: the points that reach it come first
        lo += width * sum(h >= target for h in _entropies(shares, points))
    return max(lo, allowed)


def source_plan(tokens: DataFrame, evenness: float, max_repeats: float) -> DataFrame:
    """(of, weight, repeats) from (source, tokens), for any number of sources: only sums reach the driver."""
    tokens = cut_lineage(tokens)
    some = tokens.where("tokens > 0")
    whole = some.agg(F.count("*").alias("n"), F.sum("tokens").alias("all"), F.min("tokens").alias("least"), F.max("tokens").alias("most")).first()
    if not whole["n"]:
        return tokens.select(F.col("source").alias("of"), F.lit(0.0).alias("weight"), F.lit(1.0).alias("repeats"))
    shares = some.select(F.log(F.col("tokens") / F.lit(float(whole["all"]))).alias("x"))
    exponent = 1.0
    if whole["n"] > 1:
        exponent = exponent_of(shares, evenness, max_repeats, math.log(whole["most"] / whole["least"]))
    scale = shares.agg(F.sum(F.exp(F.col("x") * exponent))).first()[0]
    raised = F.pow(F.col("tokens") / F.lit(float(whole["all"])), F.lit(exponent))
    weight = F.when(F.col("tokens") > 0, raised / scale).otherwise(0.0)
    repeats = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(whole["most"])), F.lit(exponent - 1.0))).otherwise(1.0)
    return tokens.select(F.col("source").alias("of"), weight.alias("weight"), repeats.alias("repeats"))


def mixed(docs: DataFrame, evenness: float = TARGET_EVENNESS, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """Every document, once for each time the mix takes it.

    Adds ``mix_tokens``, ``mix_pass`` (from 0), ``mix_block`` and ``mix_key``: read in its order, the
    sources stand next to each other in the weights of the mix throughout.
    """
    own = [c for c in docs.columns if c not in ADDED]
    block = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(BLOCKS)).cast("int")
    docs = docs.select(*own).withColumns({"mix_tokens": n_tokens(), "mix_block": block})
    sizes = cut_lineage(docs.groupBy("source", "mix_block").agg(F.sum("mix_tokens").alias("tokens")))
    plan = source_plan(sizes.groupBy("source").agg(F.sum("tokens").alias("tokens")), evenness, max_repeats)

    # of BLOCKS blocks at most for each source and pass: their order, and how far the budget lasts
    passes = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("repeats") - 1, F.lit(0)).cast("int"))).alias("mix_pass")
    dealt = sizes.join(plan, F.col("source").eqNullSafe(F.col("of"))).select("source", "mix_block", "tokens", "repeats", passes)
    turn = F.xxhash64(F.lit(SEED), "source", "mix_pass", "mix_block")
    line = Window.partitionBy("source", "mix_pass")
    order = line.orderBy(turn, "mix_block")
    seen = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    width = F.lit(1.0) / F.count("*").over(line)
    dealt = dealt.withColumns({
        "all_tokens": F.sum("tokens").over(line), "seen": seen, "width": width, "place": (F.row_number().over(order) - 1) * width,
    })
    room = (F.col("repeats") - F.col("mix_pass")) * F.col("all_tokens")
    taken = (
        # a whole pass, or the blocks of which at least half fits
        dealt.where((F.col("repeats") - F.col("mix_pass") >= 1) | (F.col("seen") + F.col("tokens") / 2 < room))
        .groupBy(F.col("source").alias("mix_source"), F.col("mix_block").alias("mix_of"))
        .agg(F.array_sort(F.collect_list(F.struct("mix_pass", "place", "width", "repeats"))).alias("mix_turns"))
    )
    joined = docs.join(cut_lineage(taken), F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("mix_block") == F.col("mix_of")))
    u = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id", "mix_turn.mix_pass"), F.lit(1 << 30)) / float(1 << 30)
    key = (F.col("mix_turn.mix_pass") + F.col("mix_turn.place") + u * F.col("mix_turn.width")) / F.col("mix_turn.repeats")
    return joined.select(*own, "mix_tokens", "mix_block", F.explode("mix_turns").alias("mix_turn")).select(
        *own, "mix_tokens", F.col("mix_turn.mix_pass").alias("mix_pass"), "mix_block", key.alias("mix_key")
    )


def mixture(docs: DataFrame, evenness: float = TARGET_EVENNESS, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """The mix without its texts: doc_id, source, n_tokens, pass, block and order key of each emission."""
    return mixed(docs.select("doc_id", "source", "text"), evenness, max_repeats).select(
        "doc_id", "source", F.col("mix_tokens").alias("n_tokens"), "mix_pass", "mix_block", "mix_key"
    )
