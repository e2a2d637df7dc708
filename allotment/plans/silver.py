"""Bronze to Silver: one narrow projection per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from .. import contracts as c
from ..operators.cleaning import conform


def sales_offers(df: DataFrame, execution_id: str, time_anchor: Column | None = None) -> DataFrame:
    """Sales offers. ``time_anchor`` dates an ``ERZET`` that is only a time of day."""
    return conform(df, c.OFFERS_CASTS, execution_id, time_anchor=time_anchor, label="sales offers")


def orders(df: DataFrame, execution_id: str) -> DataFrame:
    return conform(df, c.ORDERS_CASTS, execution_id, label="orders")


def priority_groups(df: DataFrame, execution_id: str) -> DataFrame:
    return conform(
        df, c.PRIORITY_GROUPS_CASTS, execution_id,
        renames=c.PRIORITY_GROUPS_RENAMES, label="priority groups",
    )


def previous_priorities(df: DataFrame, execution_id: str) -> DataFrame:
    return conform(
        df, c.PREVIOUS_PRIORITIES_CASTS, execution_id,
        renames=c.PREVIOUS_PRIORITIES_RENAMES, label="previous priorities",
    )
