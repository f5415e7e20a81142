"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, Window, WindowSpec, functions as F


def by(keys: str | Iterable[str], *order) -> WindowSpec:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return Window.partitionBy(*keys).orderBy(*order)


def daily_window() -> WindowSpec:
    """A ticker's days in order."""
    return by("ticker", "date")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def price_change(new: Column, old: Column) -> Column:
    return ratio(new - old, old)


def correlation(a: Column, b: Column) -> Column:
    """Aggregate: Pearson's correlation over the rows with both values; NaN where one of them never varies, null without rows.

    corr() itself divides by zero there.
    """
    both = a.isNotNull() & b.isNotNull()
    value = ratio(F.covar_pop(a, b), F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b)))
    return F.when(F.count(F.when(both, 1)) > 0, F.coalesce(value, F.lit(float("nan"))))


def full_window(value: Column, window: WindowSpec, first: int, last: int, agg, rows: int) -> Column:
    """agg over rows (first, last), null until `rows` values are there."""
    frame = window.rowsBetween(first, last)
    return F.when(F.count(value).over(frame) == rows, agg(value).over(frame))


def run_length(condition: Column, window: WindowSpec) -> Column:
    """Length of the run of true values that ends at each row (0 where false), over rows of one partition.

    The row number less that of the last row without the condition: no second grouping is needed.
    """
    row = F.row_number().over(window)
    stop = F.max(F.when(~F.coalesce(condition, F.lit(False)), row)).over(window.rowsBetween(Window.unboundedPreceding, 0))
    return row - F.coalesce(stop, F.lit(0))


def binned(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width right-closed bins 0..bins-1 over [low, high]; a constant column is in the middle one."""
    place = F.ceil((x - low) / ((high - low) / bins)) - 1
    return F.when(high == low, F.lit(bins // 2)).otherwise(F.greatest(F.lit(0), F.least(F.lit(bins - 1), place))).cast("int")
