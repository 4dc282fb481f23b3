"""Exact duplicates through an extendible-hash index on shared files.

1. Texts are normalised and keyed by a 64-bit hash; texts of one slice that are equal byte for byte make one entry with
   all their ids. Entries are written to the shared folder.
2. The directory maps the leading bits of a key to a bucket. It starts with one bucket and is doubled as long as an overfull
   bucket can be split by one more bit; buckets that fit keep their shorter prefix and are pointed to by several cells.
3. Each bucket, a range of keys, belongs to one owner task, which reads its entries in key order: entries of one key are
   compared byte for byte with the texts of that key's chain so far, and join a link or add one. Only one chain is in memory.
   A key that alone overfills a bucket can't be split by bits: its entries are dealt to several owners, and a second
   round of owners joins the first texts of their links into one chain.
4. Entries of one key and link are a class: its size and the id that stays are summed up and joined back.

Nulls: a null text counts as empty; a null doc_id is smaller than any other and stays only where a class has no other.
Empty texts are equal to each other. Very long texts: a text is held whole by one task, its bytes are compared like any other's.
Ties: of rows with equal doc_id and equal text one stays. Repeated rows count each and return each. Empty tables give empty
results. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartledger.session import cut_lineage, release

from .texts import lowered, slices, text_buffer

#: Bytes of entries that a bucket may hold before it is split.
BUCKET_BYTES = 8 << 20
#: Most leading bits of a key that the directory may use: it has 2^MAX_DEPTH cells at most, whatever the input.
MAX_DEPTH = 16
#: Bytes that an entry takes besides its text and 8 for each id.
ENTRY_BYTES = 64

ENTRIES = "page long, hash long, bytes long, digest string, ids array<long>, text binary"
CHAINED = "owner int, part int, page long, hash long, link int, digest string, ids array<long>, first binary"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    page = TaskContext.get().partitionId() << 33
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_buffer(part.column("text"))
            raw = lowered(data).tobytes()
            known: dict[bytes, list] = {}
            for doc_id, x, y in zip(part.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                known.setdefault(raw[x:y], []).append(doc_id)
            keys = np.array([xxhash.xxh64_intdigest(t) for t in known], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(known), page)), pa.array(keys),
                pa.array([ENTRY_BYTES + len(t) + 8 * len(ids) for t, ids in known.items()], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in known], pa.string()),
                pa.array(known.values(), pa.list_(pa.int64())), pa.array(known.keys(), pa.binary()),
            ], names=["page", "hash", "bytes", "digest", "ids", "text"])
            page += 1


def directory(filled: np.ndarray, capacity: int = BUCKET_BYTES) -> np.ndarray:
    """Local depth of the bucket that each cell points to. ``filled``: bytes of each cell, 2^n of them.

    Buckets of more than ``capacity`` bytes are split by their next bit until they fit or a bucket is one cell."""
    depth, most = np.zeros(len(filled), np.int64), len(filled).bit_length() - 1
    for d in range(most):
        width = len(filled) >> d
        overfull = filled.reshape(-1, width).sum(axis=1) > capacity
        split = np.repeat(overfull, width) & (depth == d)
        if not split.any():
            break
        depth[split] = d + 1
    return depth


@dataclass(frozen=True)
class Index:
    """Tables of one index in the shared folder.

    ``entries``: see ENTRIES. ``cells``: cell, depth, bucket, parts, base (the first owner of the bucket)."""

    entries: DataFrame
    cells: DataFrame
    owners: int
    parted: bool


def _cell(key: str = "hash") -> Column:
    return F.shiftrightunsigned(key, 64 - MAX_DEPTH)


def build(docs: DataFrame, capacity: int = BUCKET_BYTES) -> Index:
    """Entries of all rows, and the directory over their keys."""
    spark = docs.sparkSession
    entries = cut_lineage(docs.select("doc_id", "text").mapInArrow(_entries, ENTRIES))
    keys = entries.groupBy("hash").agg(F.sum("bytes").alias("bytes"))
    # what reaches the driver is bounded by the number of cells
    found = keys.groupBy(_cell().alias("cell")).agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")).toPandas()
    filled, most = (np.zeros(1 << MAX_DEPTH, np.int64) for _ in range(2))
    filled[found["cell"]], most[found["cell"]] = found["bytes"], found["most"]
    depth = directory(filled, capacity)
    cells = np.arange(1 << MAX_DEPTH)
    bucket = cells >> (MAX_DEPTH - depth) << (MAX_DEPTH - depth)
    # a key that no bit splits: its bucket has as many owners as it fills buckets
    parts = np.ones(1 << MAX_DEPTH, np.int64)
    np.maximum.at(parts, bucket, -(-most // capacity))
    parts = parts[bucket]
    opens = bucket == cells
    base = (np.cumsum(np.where(opens, parts, 0)) - parts)[bucket]
    used = np.flatnonzero(filled)
    table = spark.createDataFrame(
        list(zip(*[x[used].tolist() for x in (cells, depth, bucket, parts, base)], strict=True)),
        "cell long, depth int, bucket long, parts int, base int",
    )
    return Index(entries, cut_lineage(table), int(parts[opens].sum()), bool((parts > 1).any()))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in key order, each with its link in the chain of its key. ``parts`` tells whether other owners hold the key
    too; then the first text of a link comes along."""
    key, chain = None, []
    for batch in batches:
        cols = {c: batch.column(c) for c in batch.schema.names}
        links, firsts = [], []
        rows = zip(cols["owner"].to_pylist(), cols["hash"].to_pylist(), cols["parts"].to_pylist(), cols["text"].to_pylist(), strict=True)
        for owner, value, parts, text in rows:
            if (owner, value) != key:
                key, chain = (owner, value), []
            link = next((i for i, t in enumerate(chain) if t == text), len(chain))
            fresh = link == len(chain)
            if fresh:
                chain.append(text)
            links.append(link)
            firsts.append(text if fresh and parts > 1 else None)
        yield pa.RecordBatch.from_arrays(
            [cols["owner"], cols["part"], cols["page"], cols["hash"], pa.array(links, pa.int32()), cols["digest"], cols["ids"], pa.array(firsts, pa.binary())],
            names=["owner", "part", "page", "hash", "link", "digest", "ids", "first"],
        )


def _owned(rows: DataFrame, owners: int) -> DataFrame:
    """Each owner's rows in one task, in key order, chained."""
    columns = ["owner", "part", "parts", "page", "hash", "digest", "ids", "text"]
    dealt = rows.select(*columns).repartition(owners, "owner").sortWithinPartitions("owner", "hash", "page")
    return dealt.mapInArrow(_chained, CHAINED)


def chained(index: Index) -> DataFrame:
    """Entries with (hash, link), which is equal for equal texts and for no others."""
    cells = F.broadcast(index.cells)  # 2^MAX_DEPTH rows at most
    rows = index.entries.withColumn("cell", _cell()).join(cells, "cell")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("page"), F.col("parts")).cast("int"))
    rows = rows.withColumn("owner", (F.col("base") + F.col("part")).cast("int"))
    known = cut_lineage(_owned(rows, max(1, index.owners)))
    if not index.parted:
        return known
    # (page, link) of a first text names it in the second round
    firsts = known.where("first is not null").withColumn("cell", _cell()).join(cells, "cell")
    firsts = firsts.select(
        F.col("base").alias("owner"), "part", F.lit(1).alias("parts"), F.col("link").cast("long").alias("page"), "hash",
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("array<long>").alias("ids"), F.col("first").alias("text"),
    )
    merged = cut_lineage(_owned(firsts, max(1, index.owners)))
    merged = merged.select("hash", "part", F.col("page").cast("int").alias("link"), F.col("link").alias("whole"))
    parted = known.join(merged, ["hash", "part", "link"], "left")
    return parted.withColumn("link", F.coalesce("whole", "link")).drop("whole")


def exact_duplicates(docs: DataFrame, capacity: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 (of the normalised text) of every row."""
    index = build(docs, capacity)
    rows = cut_lineage(chained(index).select("page", "hash", "link", "digest", "ids"))
    release(index.entries)
    top = F.struct(F.array_max("ids").alias("id"), (-F.col("page")).alias("page"))
    classes = rows.groupBy("hash", "link").agg(F.sum(F.size("ids")).alias("group_size"), F.max(top).alias("top"))
    flat = rows.join(classes, ["hash", "link"]).select(
        "page", "digest", "group_size", "top", F.coalesce(F.array_position("ids", F.col("top.id")), F.lit(1)).alias("at"),
        F.posexplode("ids").alias("pos", "doc_id"),
    )
    return flat.select(
        "doc_id", F.col("top.id").alias("keep_id"), "group_size",
        ((F.col("page") == -F.col("top.page")) & (F.col("pos") + 1 == F.col("at"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
