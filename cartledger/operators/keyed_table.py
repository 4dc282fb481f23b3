"""State tables dealt into partitions by the hash of their key, so that an upsert reads and writes touched partitions only.

A change set names its keys, and with them their partitions. Only those are read (a partition filter of the
scan), merged with the changes by a function of :mod:`.state`, and replaced by a dynamic partition overwrite;
files of all others stay as they are. The merged rows are first written beside the table, so the table never reads
what it replaces, and a run that is lost on the way leaves either the old partitions or rows to write again: merging the same changes twice
gives the same state. One run at a time may change a table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from . import state
from .gold import latest_prices

PART = "key_part"
#: States repeat the arrival keys behind each value, which zstd packs more tightly than the default.
COMPRESSION = "zstd"
Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table at ``path`` with rows of ``schema``, dealt by ``keys`` into ``parts`` partitions.

    ``parts`` is fixed for the life of the table; choose it so that a partition holds some hundred MB."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: str
    parts: int = 64

    @property
    def part(self) -> Column:
        # the hash that rows are dealt by (see ``_dealt``), so that a task holds one partition
        return F.pmod(F.hash(*self.keys), F.lit(self.parts)).cast("int")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """One task for each partition; a partition is a share of a hash, so none is hot."""
        return rows.repartition(self.parts, *self.keys)

    def create(self, rows: DataFrame) -> None:
        """Write the table anew from rows of unique keys."""
        self._write(self._dealt(rows), "static")

    def read(self, touched: list[int] | None = None) -> DataFrame:
        rows = self.spark.read.schema(f"{self.schema}, {PART} int").parquet(self.path)
        if touched is not None:
            rows = rows.filter(F.col(PART).isin(touched))
        return rows.drop(PART)

    def upsert(self, changes: DataFrame, merge: Merge) -> list[int]:
        """Replace the partitions that ``changes`` touch by ``merge(their rows, changes)``; gives their numbers, of which
        there are at most ``parts``."""
        changes = cut_lineage(changes, COMPRESSION)
        touched = sorted(r[0] for r in changes.select(self.part.alias(PART)).distinct().collect())
        if touched:
            self._same_hash()
            # both are dealt before the merge, which groups by the keys: it moves nothing, nor does the write after it
            merged = cut_lineage(merge(self._dealt(self.read(touched)), self._dealt(changes)), COMPRESSION)
            self._write(merged, "dynamic")
            release(merged)
        release(changes)
        return touched

    def _same_hash(self) -> None:
        """Some rows tell whether the table was dealt by this hash; by another, changes would miss the rows they replace."""
        some = self.spark.read.schema(f"{self.schema}, {PART} int").parquet(self.path).limit(100)
        if not some.filter(F.col(PART) != self.part).isEmpty():
            raise ValueError(f"{self.path} was dealt by another hash or number of partitions: create it anew")

    def _write(self, rows: DataFrame, mode: str) -> None:
        dealt = rows.withColumn(PART, self.part)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(PART).parquet(self.path, compression=COMPRESSION)


def upsert_sightings(table: KeyedTable, seen: DataFrame, arrival: list[str]) -> list[int]:
    """Fold sightings into a table of source-product states (see :func:`.state.upsert_source_products`)."""
    fold = lambda old, new: state.fold_states(old, new)
    return table.upsert(state.upsert_source_products(None, seen, arrival), fold)


def upsert_verdicts(table: KeyedTable, changes: DataFrame) -> list[int]:
    """Latest verdicts by (term, product)."""
    return table.upsert(changes, lambda old, new: state.upsert_verdicts(old, new).select(*old.columns))


def refresh_latest(table: KeyedTable, delta: DataFrame, tie_break: tuple[str, ...] = ()) -> list[int]:
    """Fold new price rows into a table of latest rows by (product, store)."""
    columns = table.read().columns
    return table.upsert(
        delta.select(*columns), lambda old, new: latest_prices(old.unionByName(new), tie_break).select(*columns)
    )
