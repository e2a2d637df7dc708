"""Margin ratios and the key customers are grouped under."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(margin: Column, sales: Column) -> Column:
    """margin / sales as double; NULL for zero sales or when both are negative."""
    usable = (sales != 0) & ~((margin < 0) & (sales < 0))
    return F.when(usable, F.try_divide(margin.cast("double"), sales.cast("double")))


def homologated_key(chain: Column, customer: Column) -> Column:
    """The chain code, or the customer's own code when it has no chain."""
    return F.when(F.trim(chain) != "", chain).otherwise(customer)
