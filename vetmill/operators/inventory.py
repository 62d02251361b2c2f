"""Inventory usage lists: typed rows and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _part(c: str, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, group), F.lit(""))


def parse_inventory(rows: DataFrame) -> DataFrame:
    """Rows with avg_use, orders_count, date_range, total_cost and amount taken apart into types.

    A single date is both first and last; a part that does not fit its form is null."""
    use, amount = r"^\s*(-?[0-9.]+)\s*/\s*(.+?)\s*$", r"^\s*for\s+(-?[0-9.,]+)\s+(.+?)\s*$"
    days = r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2})(?:\s*[—–-]\s*([0-9]{4}-[0-9]{2}-[0-9]{2}))?\s*$"
    money = F.regexp_replace(F.coalesce("total_cost", F.lit("")), r"[$,\s]", "")
    first = F.try_to_date(_part("date_range", days, 1), "yyyy-MM-dd")
    return rows.select(
        "name", "details", "frequency", "status",
        _part("avg_use", use, 1).try_cast("decimal(12,2)").alias("use_value"), _part("avg_use", use, 2).alias("use_unit"),
        _part("orders_count", r"^\s*([0-9]+)\s+orders?\s*$", 1).try_cast("int").alias("orders"),
        first.alias("first_order"), F.coalesce(F.try_to_date(_part("date_range", days, 2), "yyyy-MM-dd"), first).alias("last_order"),
        F.nullif(money, F.lit("")).try_cast("decimal(12,2)").alias("cost"),
        F.replace(_part("amount", amount, 1), F.lit(","), F.lit("")).try_cast("decimal(12,2)").alias("quantity"), _part("amount", amount, 2).alias("quantity_unit"))


def inventory_rollup(typed: DataFrame) -> DataFrame:
    """Rows, orders, net quantity and net cost for each frequency, unit and status."""
    return typed.groupBy("frequency", "quantity_unit", "status").agg(
        F.count("*").alias("n"), F.sum("orders").alias("orders"), F.sum("quantity").alias("quantity"), F.sum("cost").alias("cost"))
