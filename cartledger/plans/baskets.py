"""The tables several basket reports share, each made when a report first asks for it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators import basket as B
from ..session import cut_lineage


@dataclass(frozen=True)
class BasketTables:
    """Basket lines and gold prices, and what reports derive from them.

    Nothing is written when this is built. Offers (a row per product) and the basket list (a row per basket and
    product) are written to the shared folder when they are first needed, as several reports read both. The sheet (a row
    per basket and source) is many times larger and made from them in the tasks that read it; basket lines and gold
    prices are never written here.

    ``dealt`` says that ``items`` are dealt by basket already, into so many tasks. Then all follows there: nothing of a basket is
    written or dealt a second time, and Spark makes what several readers deal alike only once.
    """

    items: DataFrame
    gold: DataFrame
    dealt: int | None = None

    @cached_property
    def offers(self) -> DataFrame:
        return cut_lineage(B.product_offers(self.gold))

    @cached_property
    def basket_list(self) -> DataFrame:
        lines = B.basket_list(self.items)
        return lines if self.dealt else cut_lineage(lines)

    @cached_property
    def tasks(self) -> int:
        """How many tasks all that is dealt by basket shares, so that reports join without dealing again."""
        if self.dealt:
            return self.dealt
        offers = self.offers
        return B.basket_tasks(self.basket_list, offers)

    @cached_property
    def sheet(self) -> DataFrame:
        offers = self.offers
        return B.sheet_of_list(self.basket_list, offers, self.tasks)

    @cached_property
    def bits(self) -> DataFrame:
        """All sources with an offer. Written, so that its true size decides how it is joined."""
        return cut_lineage(B.source_bits(self.offers.select(F.inline("offers"))))

    @property
    def ranking(self) -> DataFrame:
        return B.store_ranking(self.sheet)

    @property
    def verdict(self) -> DataFrame:
        return B.verdict(self.sheet)

    @property
    def missing(self) -> DataFrame:
        return B.missing_items(self.items, self.offers, self.sheet, self.bits, like_sheet=bool(self.dealt))

    @property
    def missing_flexible(self) -> DataFrame:
        return B.missing_items(self.items, self.offers, self.sheet, self.bits, modes=("flexible",), like_sheet=True)

    @property
    def missing_masks(self) -> DataFrame:
        return B.missing_masks(self.items, self.offers, self.sheet, self.bits, like_sheet=bool(self.dealt))

    @property
    def provenance(self) -> DataFrame:
        return B.provenance(self.basket_list, self.gold, tasks=self.tasks)

    @property
    def ad_weeks(self) -> DataFrame:
        return B.provenance(self.basket_list, self.gold, ids=False, tasks=self.tasks)

    @property
    def cited(self) -> DataFrame:
        """Provenance with the ids that a citation names."""
        return B.provenance(self.basket_list, self.gold, ids=V.CITED_PRICE_IDS, tasks=self.dealt)

    @property
    def provenance_rows(self) -> DataFrame:
        return B.provenance_rows(self.items, self.gold)


#: What the tables read of gold prices.
GOLD = ("canonical_id", "canonical_name", "source", "store_id", "price", "unit_price", "unit", "match_confidence", "price_id", "ad_week")


def basket_tables(items: DataFrame, gold: DataFrame, write_gold: bool = False, dealt: int | None = None) -> BasketTables:
    """The shared tables of ``items`` and ``gold``. ``write_gold`` writes gold prices first, for reports that read them
    again for their provenance; ``dealt`` is how many tasks ``items`` are dealt into by basket, if they are."""
    if write_gold:
        gold = cut_lineage(gold.select(*[c for c in gold.columns if c in GOLD]))
    return BasketTables(items, gold, dealt)
