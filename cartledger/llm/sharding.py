"""Balanced label propagation: linked rows move towards their neighbours' shards under quotas.

Rows start in contiguous runs of a random order. In each round every linked row looks at its
neighbours' shards, by turns at later and earlier neighbours, and asks for the one that holds most
of them; requests are granted by fine hash classes, whole classes only, as far as the quota of a
shard allows. At last shards are levelled: those above their share pass rows on, rows without links first, to those below. Row counts then differ
by one at most (the law ``rows``).

Rows are numbered without a global sort in one task: ranges of the sort key are counted apart, and
each range starts at the sum of the counts before it.

Nulls: a null text has no bytes and its rows form no group; a null doc_id sorts first. Repeated rows
are rows of their own and group by their equal text; which of them has which slot is open. Of equally many
neighbours the lowest shard wins. A text of any length is one row. Empty tables give empty results.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartledger.session import cut_lineage

SHARDS = 24
ROUNDS = 6
#: A shard may grow to this part of its share while rows move; levelling brings it back.
QUOTA = 2.0
#: Hash classes by which requests are granted.
CLASSES = 1024
LAW = "rows"


def numbered(df: DataFrame, name: str, group: str | None, *order: Column | str) -> DataFrame:
    """Adds ``name``: 0, 1, ... in ``order``, for each ``group`` on its own if given.

    Equal rows are told apart by a salt, so that many of them fill several ranges. Only counts by range and
    group reach the driver: with one group a row for each task, else as many more as groups meet in a range.
    """
    names, df = df.columns, df.withColumn("salt_", F.rand(11))
    order = (*order, "salt_")
    keys = ([group] if group else []) + list(order)
    tasks = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(tasks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut_lineage(df.repartitionByRange(tasks, *keys).withColumn("range_", F.spark_partition_id()))
    by = ["range_"] + ([group] if group else [])
    counts = ranged.groupBy(*by).agg(F.count("*").alias("n")).collect()
    counts.sort(key=lambda r: ((r[group] if group else 0), r["range_"]))
    begin, at, last = [], 0, None
    for r in counts:
        if group and r[group] != last:
            at, last = 0, r[group]
        begin.append((r["range_"], r[group] if group else 0, at))
        at += r["n"]
    starts = df.sparkSession.createDataFrame(begin, "r_ int, g_ int, start_ long")
    own = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    on = (F.col("range_") == F.col("r_")) & (F.col("g_") == (F.col(group) if group else F.lit(0)))
    # as many rows as ranges and groups, at most tasks x shards
    return ranged.withColumn("own_", own).join(F.broadcast(starts), on).select(*names, (F.col("own_") + F.col("start_")).cast("long").alias(name))


def shares(n: int, shards: int) -> list[int]:
    """Rows of each shard when all are as even as can be."""
    return [n // shards + (i < n % shards) for i in range(shards)]


def propagate(nodes: DataFrame, edges: DataFrame, n: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(node, shard) after ``rounds`` of moves from (node, shard); edges are (src, dst), either way."""
    both = cut_lineage(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    quota = max(1, int(QUOTA * n / shards))
    labels = nodes
    for turn in range(rounds):
        # rows look at later neighbours in one round and at earlier ones in the next, so no two swap
        seen = both.where("dst < src" if turn % 2 else "dst > src")
        votes = (
            seen.join(labels.select(F.col("node").alias("dst"), "shard"), "dst")
            .groupBy("src", "shard").agg(F.count("*").alias("votes"))
        )
        best = votes.groupBy("src").agg(F.max(F.struct("votes", (-F.col("shard")).alias("minus"))).alias("best"))
        stay = votes.select("src", F.col("shard").alias("at"), F.col("votes").alias("here"))
        asks = (
            labels.join(best.select(F.col("src").alias("node"), F.col("best.votes").alias("votes"), (-F.col("best.minus")).alias("to")), "node")
            .join(stay.select(F.col("src").alias("node"), F.col("at").alias("shard"), "here"), ["node", "shard"], "left")
            .where(F.col("votes") > F.coalesce("here", F.lit(0)))
            .select("node", "to", F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(CLASSES)).cast("int").alias("class"))
        )
        asks = cut_lineage(asks)
        held = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}
        wanted: dict[int, list[tuple[int, int]]] = {}
        for r in asks.groupBy("to", "class").count().collect():  # shards x CLASSES rows at most
            wanted.setdefault(r["to"], []).append((r["class"], r["count"]))
        granted = []
        for to, classes in wanted.items():
            sums = accumulate(c for _, c in sorted(classes))
            room = quota - held.get(to, 0)
            granted += [(to, cls) for (cls, _), s in zip(sorted(classes), sums, strict=True) if s <= room]
        if not granted:
            continue
        allowed = labels.sparkSession.createDataFrame(granted, "to int, class int")
        moves = asks.join(F.broadcast(allowed), ["to", "class"], "left_semi").select(F.col("node").alias("moved"), "to")
        labels = cut_lineage(
            labels.join(moves, F.col("node") == F.col("moved"), "left").select("node", F.coalesce("to", "shard").alias("shard"))
        )
    return labels


def levelled(labels: DataFrame, n: int, shards: int = SHARDS) -> DataFrame:
    """(node, shard) with counts at most one apart; rows with ``linked`` false move first."""
    share = shares(n, shards)
    ranked = cut_lineage(numbered(labels, "place", "shard", F.col("linked").desc(), "group", "node"))
    fixed = labels.sparkSession.createDataFrame([(i, s) for i, s in enumerate(share)], "s_ int, share long")
    ranked = ranked.join(F.broadcast(fixed), F.col("shard") == F.col("s_"))
    held = {r["shard"]: r["count"] for r in labels.groupBy("shard").count().collect()}
    surplus = [max(0, held.get(i, 0) - s) for i, s in enumerate(share)]
    first = list(accumulate([0, *surplus]))
    # the k-th surplus row of all goes to the shard whose gap covers k; gaps come to as many rows as surpluses
    gaps, at = [], 0
    for i, s in enumerate(share):
        if (gap := s - held.get(i, 0)) > 0:
            gaps.append((at, i))
            at += gap
    begins = labels.sparkSession.createDataFrame([(i, x) for i, x in enumerate(first[:-1])], "f_ int, first long")
    k = F.col("place") - F.col("share") + F.col("first")
    # at most ``shards`` rows, and as many entries in the two lists
    spread = ranked.join(F.broadcast(begins), F.col("shard") == F.col("f_"))
    if not gaps:
        return spread.select("node", "shard")
    starts, targets = (F.lit(list(x)) for x in zip(*gaps, strict=True))
    into = F.element_at(targets, F.size(F.filter(starts, lambda start: start <= k)))
    return spread.select("node", F.when(F.col("place") >= F.col("share"), into).otherwise(F.col("shard")).cast("int").alias("shard"))


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row; links join equal texts."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    group = F.when(F.col("text").isNotNull(), F.xxhash64("text", F.octet_length("text")))
    rows = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), group.alias("group"))
    rows = cut_lineage(numbered(rows, "node", None, "doc_id", "size", "text_crc32", "group"))
    n = rows.count()

    hubs = rows.where("group is not null").groupBy("group").agg(F.min("node").alias("hub"), F.count("*").alias("m"))
    hubs = cut_lineage(hubs.where("m > 1").withColumnRenamed("group", "of"))
    tied = cut_lineage(rows.join(hubs, F.col("group") == F.col("of"), "left").select("node", "group", "hub"))
    edges = tied.where("hub <> node").select(F.col("node").alias("src"), F.col("hub").alias("dst"))

    start = numbered(rows.select("node"), "place", None, F.xxhash64("node", F.lit(5)), "node")
    start = cut_lineage(start.select("node", F.floor(F.col("place") * shards / max(1, n)).cast("int").alias("shard")))
    moved = propagate(start, edges, n, shards, rounds)
    marked = moved.join(tied.select("node", "group", F.col("hub").isNotNull().alias("linked")), "node")
    final = levelled(marked, n, shards)
    placed = rows.join(final, "node")
    # slots run in a hash order: copies of a row stand apart, and every stretch of a shard holds its sources in their shares
    return numbered(placed, "slot", "shard", F.xxhash64("node", F.lit(7)), "node").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
