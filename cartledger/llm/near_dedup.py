"""Near duplicates: MinHash bands, signature and full-set checks, components by alternating stars.

Words are lower-cased (A-Z) runs of non-blanks; a document's set is its distinct five-word shingles,
or its whole word sequence if shorter. Documents with equal sets are one class, so copies never meet
one another. Classes meet in buckets: 160 minima of multiply-shift hashes, in 40 bands of four. Two
sets at the least similarity of 0.75 share no bucket with probability below 3e-7.

Buckets are never expanded into all pairs. First each class meets the smallest class of its bucket;
confirmed links give components. Only buckets that still hold several components are looked at again,
only across components and in bounded blocks, from which no more links come than join components.
A candidate must pass the size bound and an estimate from its signature (more than five deviations
below the threshold) before full sets are compared.

Nulls and empty texts have an empty set and are linked with nothing. Repeated rows count as copies
and return each; a null doc_id never names a component unless all of its ids are null. Empty tables
give empty results. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartledger.session import cut_lineage

from .texts import Words, gram_hashes, lowered, mix, ranges, slices, text_buffer, text_key

SHINGLE = 5
#: Link from this percentage of the union on.
PERCENT = 75
BANDS, ROWS = 40, 4
MINIMA = BANDS * ROWS
#: Equal bytes of a signature that a pair at the threshold falls short of with probability 1e-8.
SIGNATURE_LEAST = int(0.55 * MINIMA)
#: Shingles of a block; buckets with more are cut into blocks that meet two by two.
BLOCK = 500_000

_RANDOM = np.random.default_rng(75)
_FACTORS = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
_SHORT = np.uint64(0x5851F42D4C957F2D)

SIGNED = "doc_id long, body long, body2 int, n_shingles long, node long, bands array<long>, signature binary"


def _sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(lowered(data), offsets)
    hashes = words.hashes
    grams = gram_hashes(hashes, SHINGLE)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(grams[a : b - SHINGLE + 1])
        elif b > a:
            yield gram_hashes(hashes[a:b], b - a) ^ _SHORT
        else:
            yield np.zeros(0, np.uint64)


def _minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32))[None, :]
    least = np.full(MINIMA, 1 << 32, np.uint64)
    for lo in range(0, x.shape[1], 512):
        h = x[:, lo : lo + 512] * _FACTORS[:, None]
        h += _SHIFTS[:, None]
        h >>= np.uint64(32)
        np.minimum(least, h.min(axis=1), out=least)
    return least


def _class_of(shingles: np.ndarray) -> int:
    """One 63-bit number for each set."""
    if not len(shingles):
        return -1
    total = np.bitwise_xor.reduce(mix(shingles + np.uint64(7))) ^ mix(shingles.sum(keepdims=True))[0]
    return int(mix(np.array([total ^ np.uint64(len(shingles))]))[0] >> np.uint64(1))


_PLACES = np.arange(1, BANDS + 1, dtype=np.uint64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sizes, nodes, bands, signatures = [], [], [], []
            for shingles in _sets(*text_buffer(part.column("text"))):
                sizes.append(len(shingles))
                nodes.append(_class_of(shingles))
                if len(shingles):
                    m = _minima(shingles)
                    rows = m.reshape(BANDS, ROWS)
                    key = mix(rows[:, 0] << np.uint64(32) | rows[:, 1]) ^ mix(_PLACES)
                    bands.append(mix(key + (rows[:, 2] << np.uint64(32) | rows[:, 3])).view(np.int64))
                    signatures.append(mix(m).astype(np.uint8).tobytes())
                else:
                    bands.append(np.zeros(0, np.int64))
                    signatures.append(b"")
            ends = np.cumsum([0] + [len(b) for b in bands])
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in ("doc_id", "body", "body2")], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bands))),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "body", "body2", "n_shingles", "node", "bands", "signature"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = list(_sets(*text_buffer(part.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["node", "shingles"],
            )


def signed(docs: DataFrame) -> DataFrame:
    """Set size, class, bands and signature of every whole text."""
    return docs.select("doc_id", *text_key(), "text").mapInArrow(_sign, SIGNED)


@F.pandas_udf(T.IntegerType())
def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    left = np.frombuffer(b"".join(a), np.uint8).reshape(-1, MINIMA)
    right = np.frombuffer(b"".join(b), np.uint8).reshape(-1, MINIMA)
    return pd.Series((left == right).sum(axis=1).astype(np.int32))


@F.pandas_udf(T.LongType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    count = lambda x, y: len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
    return pd.Series([count(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


def _sizes_allow(a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct (a, b) whose sizes and signatures allow a link."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}"))
    return (
        pairs.distinct().join(side("a"), "a").join(side("b"), "b")
        .where(_sizes_allow("n_a", "n_b"))
        .where(_agreement("s_a", "s_b") >= SIGNATURE_LEAST)
        .select("a", "b")
    )


def _row():
    """Key of a row by id and text, null ids included; rows that share one are told apart by their class."""
    return F.xxhash64("doc_id", "body", "body2")


def _sets_of(wanted: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted classes; their texts are read again."""
    speakers = classes.join(wanted, "node", "left_semi").select("speaker").distinct()
    texts = docs.select("doc_id", *text_key(), "text").select(_row().alias("speaker"), "text").join(speakers, "speaker", "left_semi")
    sets = texts.mapInArrow(_full_sets, "node long, shingles binary").dropDuplicates(["node"])
    return cut_lineage(sets.join(wanted, "node", "left_semi"))


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that full sets confirm."""
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, classes)
    side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s_{x}"))
    size = lambda x: (F.octet_length(f"s_{x}") / 8).cast("long")
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .select("a", "b", size("a").alias("n_a"), size("b").alias("n_b"), _shared("s_a", "s_b").alias("both"))
        .where((F.col("n_a") > 0) & (F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * PERCENT))
        .select("a", "b")
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node reached.

    Alternates large-star and small-star until no edge changes. A node's neighbours are only ever
    reduced to their minimum, so a hub costs no more than its edges.
    """
    edges = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("of")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), "m")
        small = large.join(least, F.col("u") == F.col("of")).select("u", "v", "m")
        edges = cut_lineage(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == state:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())


def _pairs_in(left: pd.DataFrame, right: pd.DataFrame, groups: dict[int, int]) -> list[tuple[int, int]]:
    """Confirmed links between two blocks of a bucket, only those that join two groups of components.

    A pair is looked at in the first band only in which it meets.
    """
    def columns(block: pd.DataFrame):
        sets = [np.frombuffer(x, np.uint64) for x in block["shingles"]]
        return (block["node"].to_numpy(), np.stack(block["bands"]), np.frombuffer(b"".join(block["signature"]), np.uint8).reshape(-1, MINIMA),
                np.array([len(x) for x in sets]), sets)

    nodes_a, bands_a, signs_a, sizes_a, sets_a = columns(left)
    nodes_b, bands_b, signs_b, sizes_b, sets_b = columns(right)
    band, found = int(left["band"].iloc[0]), []
    flat = np.concatenate(sets_b)
    values, places = np.unique(flat, return_inverse=True)
    begin = np.cumsum(sizes_b) - sizes_b
    label_a = np.array([groups[c] for c in left["component"]])
    label_b = label_a if left is right else np.array([groups[c] for c in right["component"]])
    for i in range(len(nodes_a)):
        at = np.flatnonzero((label_b != label_a[i]) & (np.minimum(sizes_b, sizes_a[i]) * 100 >= np.maximum(sizes_b, sizes_a[i]) * PERCENT))
        if left is right:
            at = at[at > i]
        at = at[~(bands_b[at, :band] == bands_a[i, :band]).any(axis=1)]
        at = at[(signs_b[at] == signs_a[i]).sum(axis=1) >= SIGNATURE_LEAST]
        if not len(at):
            continue
        own = np.zeros(len(values) + 1, bool)
        slot = np.searchsorted(values, sets_a[i])
        slot[slot == len(values)] = 0
        own[slot[values[slot] == sets_a[i]]] = True
        chosen = ranges(begin[at], sizes_b[at])
        both = np.add.reduceat(own[places[chosen]], np.cumsum(sizes_b[at]) - sizes_b[at], dtype=np.int64)
        for j in at[both * 100 >= (sizes_a[i] + sizes_b[at] - both) * PERCENT].tolist():
            if label_a[i] != label_b[j]:
                found.append((int(nodes_a[i]), int(nodes_b[j])))
                keep, gone = int(label_a[i]), int(label_b[j])
                label_a[label_a == gone] = keep
                label_b[label_b == gone] = keep
                for c, g in groups.items():
                    if g == gone:
                        groups[c] = keep
    return found


def _compare(bundle: pd.DataFrame) -> pd.DataFrame:
    found = []
    for (_, i, j), block in bundle.groupby(["key", "i", "j"], sort=True):
        groups = {c: k for k, c in enumerate(sorted(set(block["component"])))}
        if i == j:
            found += _pairs_in(block, block, groups)
        elif block["right"].nunique() == 2:
            found += _pairs_in(block[~block["right"]], block[block["right"]], groups)
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _across(marked: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Confirmed (a, b) between components that share a bucket: enough of them to join what belongs together.

    ``marked`` has the members of such buckets. A bucket is cut into blocks of about BLOCK shingles;
    two blocks, or a bundle of small buckets, meet in one task with their full sets.
    """
    rows = cut_lineage(marked.join(classes.select("node", "n_shingles"), "node"))
    sets = _sets_of(rows.select("node").distinct(), docs, classes)
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    weight = rows.groupBy("key").agg(F.sum("n_shingles").alias("weight")).withColumnRenamed("key", "k")
    rows = rows.join(weight, F.col("key") == F.col("k")).withColumn("n", F.ceil(F.col("weight") / BLOCK).cast("int"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(3)), F.col("n")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    i, j = F.least("mine", "other"), F.greatest("mine", "other")
    small = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-total // BLOCK))))
    rows = rows.select(
        F.when(F.col("n") == 1, small).otherwise(F.xxhash64("key", i, j)).alias("bundle"), "key", "band", i.alias("i"), j.alias("j"),
        (F.col("mine") > F.col("other")).alias("right"), "node", "component",
    )
    full = cut_lineage(classes.select("node", "bands", "signature").join(sets, "node"))
    return rows.join(full, "node").groupBy("bundle").applyInPandas(_compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id linked, itself included) and kept."""
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return grouped(docs).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def survivors(docs: DataFrame) -> DataFrame:
    """doc_id and text key of one row of each group, that of the smallest doc_id, and of each row without words."""
    alone = F.when(F.col("n_shingles") == 0, F.struct("doc_id", "body", "body2"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "body", "body2")).alias("least")
    return grouped(docs).groupBy("component", alone.alias("alone")).agg(least).select("least.doc_id", "least.body", "least.body2")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text key and n_shingles of every row, the component of its class and its smallest doc_id; null without words."""
    sign = cut_lineage(signed(docs))
    members = cut_lineage(sign.where("n_shingles > 0").groupBy("node").agg(F.min(_row()).alias("speaker"), F.min("doc_id").alias("name")))
    # one row for each class: that of its speaker
    own = F.struct(_row().alias("speaker"), "node").alias("own")
    classes = cut_lineage(
        sign.select(own, "n_shingles", "bands", "signature")
        .join(members.select(F.struct("speaker", "node").alias("own")), "own", "left_semi")
        .select("own.node", "own.speaker", "n_shingles", "bands", "signature")
        .dropDuplicates(["node"])
    )
    keys = classes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("hub")).where("members > 1")
    buckets = cut_lineage(keys.join(shared, "key"))

    first = buckets.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = cut_lineage(_confirmed(cut_lineage(_alike(first, classes)), docs, classes))
    found = cut_lineage(components(links))

    label = found.select(F.col("node").alias("n0"), "component")
    marked = buckets.join(label, F.col("node") == F.col("n0"), "left").select(
        "key", "band", "node", F.coalesce("component", "node").alias("component")
    )
    mixed = marked.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    more = cut_lineage(_across(marked.join(mixed, "key", "left_semi"), docs, classes))
    if not more.isEmpty():
        found = cut_lineage(components(links.union(more)))

    # components in terms of documents: the smallest id of the linked classes
    of_class = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = of_class.groupBy("component").agg(F.min("name").alias("component_id"))
    ids = cut_lineage(of_class.join(names, "component").select(F.col("node").alias("of"), "component", "component_id"))
    return (
        sign.select("doc_id", "body", "body2", "n_shingles", "node").join(ids, F.col("node") == F.col("of"), "left")
        .select("doc_id", "body", "body2", "n_shingles", "component", "component_id")
    )
