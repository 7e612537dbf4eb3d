"""Sale details of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from retail_stream.operators import sales


def sale_details(
    orders: DataFrame,
    details: DataFrame,
    users: DataFrame,
    as_of: Column | str,
    tolerance_seconds: float = sales.TOLERANCE_SECONDS,
    arrivals: bool = False,
) -> DataFrame:
    """Orders joined to their lines and to the latest user record, one row per (order, line).

    The user fields depend on the order alone, so they are merged into the orders before the lines
    come in: the many lines are then shuffled for the order join only, never by user.
    """
    needed = users.select("id", "user_level", "birthday", "gender", "arrival_ts")
    known = sales.enrich_users(orders, sales.user_snapshot(needed), as_of)
    joined = sales.join_sales(known, details, tolerance_seconds, arrivals)
    return sales.with_document_id(sales.sale_columns(joined))
