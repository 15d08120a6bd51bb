"""Which columns of a panel are its series key, its date and its value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PanelSpec:
    product: str = "product"
    date: str = "month_end"
    value: str = "quantity"

    @property
    def w(self) -> WindowSpec:
        """The series in order of date. Every operator partitions by the product alone, so that one shuffle serves all."""
        return Window.partitionBy(self.product).orderBy(self.date)

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy(self.product)

    @property
    def so_far(self) -> WindowSpec:
        return self.w.rowsBetween(Window.unboundedPreceding, 0)

    @property
    def from_here(self) -> WindowSpec:
        return self.w.rowsBetween(0, Window.unboundedFollowing)

    def last_rows(self, n: int) -> WindowSpec:
        return self.w.rowsBetween(-(n - 1), 0)

    @property
    def v(self) -> Column:
        return F.col(self.value)

    @property
    def d(self) -> Column:
        return F.col(self.date)
