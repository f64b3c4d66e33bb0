"""Data quality: row rules in one pass, referential checks, keys, columns and completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.scalars import blank, city_in_country, currency_of, line_total
from daybook.operators.skew import PROBE, hashed_side, join_unique
from daybook.schemas import COUNTRIES

# --- row rules: a Column that is true where the row breaks the rule ---


def not_positive(quantity: Column) -> Column:
    return quantity.isNull() | (quantity <= 0)


def outside(value: Column, domain: Sequence[str]) -> Column:
    """Not one of the allowed values; NULL is not allowed either."""
    return value.isNull() | ~value.isin(*domain)


def unknown_country(country: Column) -> Column:
    return outside(country, COUNTRIES)


def before(later: Column, earlier: Column) -> Column:
    """``later`` lies before ``earlier``; passes while either is NULL."""
    return later < earlier


def differs(value: Column, expected: Column, tolerance: str = "0.01") -> Column:
    """Further from the expected amount than the tolerance, or one of the two is missing."""
    gap = F.abs(value - expected) > F.lit(tolerance).cast("decimal(12,4)")
    return F.coalesce(gap, F.lit(True))


def wrong_line_total(price: Column, quantity: Column, discount: Column, total: Column) -> Column:
    return differs(total, line_total(price, quantity, discount))


def wrong_currency(currency: Column, country: Column) -> Column:
    """Currency is not the one of a known country."""
    return currency_of(country).isNotNull() & ~currency.eqNullSafe(currency_of(country))


def wrong_city(city: Column, country: Column) -> Column:
    """City is not in a known country."""
    return ~city_in_country(city, country)


def item_rules() -> dict[str, Column]:
    return {
        "quantity_positive": not_positive(F.col("quantity")),
        "line_total": wrong_line_total(
            F.col("unit_price"), F.col("quantity"), F.col("discount_amount"), F.col("line_total")
        ),
    }


def order_rules() -> dict[str, Column]:
    return {
        "country_known": unknown_country(F.col("country_code")),
        "currency_of_country": wrong_currency(F.col("currency"), F.col("country_code")),
        "customer_given": blank(F.col("customer_id")),
    }


def customer_rules() -> dict[str, Column]:
    return {
        "country_known": unknown_country(F.col("country_code")),
        "city_in_country": wrong_city(F.col("city"), F.col("country_code")),
    }


def shipment_rules() -> dict[str, Column]:
    return {
        "delivered_after_shipped": before(F.col("delivered_at"), F.col("shipped_at")),
        "city_in_country": wrong_city(F.col("delivery_city"), F.col("delivery_country")),
    }


# --- applying row rules ---


def check_rows(df: DataFrame, rules: Mapping[str, Column], name: str = "failed_rules") -> DataFrame:
    """Add the names of the rules each row breaks, all rules in one pass."""
    hits = [F.when(broken, F.lit(rule)).otherwise("") for rule, broken in rules.items()]
    return df.withColumn(name, F.array_remove(F.array(*hits), ""))


def report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: rule, checked, failed; all rules in one aggregation."""
    counts = [F.count_if(broken).alias(f"f{i}") for i, broken in enumerate(rules.values())]
    lines = [
        F.struct(F.lit(r).alias("rule"), F.col("n").alias("checked"), F.col(f"f{i}").alias("failed"))
        for i, r in enumerate(rules)
    ]
    return df.agg(F.count(F.lit(1)).alias("n"), *counts).select(F.inline(F.array(*lines)))


def as_rules(names: Sequence[str], name: str = "failed_rules") -> dict[str, Column]:
    """The rules of already checked rows, for a report on them."""
    return {rule: F.array_contains(name, rule) for rule in names}


def split_checked(checked: DataFrame, name: str = "failed_rules") -> tuple[DataFrame, DataFrame]:
    """Clean rows without the rule column, and quarantined rows with it, of stored checked rows."""
    return checked.filter(F.size(name) == 0).drop(name), checked.filter(F.size(name) > 0)


def split(
    df: DataFrame, rules: Mapping[str, Column], name: str = "failed_rules"
) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and quarantined rows with the names of the rules they break.

    A row is tested up to the first rule it breaks; only quarantined rows get the list.
    """
    broken = reduce(or_, [F.coalesce(b, F.lit(False)) for b in rules.values()])
    return df.filter(~broken), check_rows(df.filter(broken), rules, name)


# --- checks against another table ---


def _parent_keys(parent: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Keys that are only asked for, so several rows of one parent change nothing."""
    return parent.select(F.col(parent_key).alias(child_key))


def without_parent(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Child rows whose key is missing in the parent table, or NULL."""
    keys = _parent_keys(parent, parent_key, child_key)
    return join_unique(child, keys, [child_key], "left_anti", hot)


def with_parent(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Child rows whose key exists in the parent table."""
    keys = _parent_keys(parent, parent_key, child_key)
    return join_unique(child, keys, [child_key], "left_semi", hot)


def wrong_payment_amount(
    payments: DataFrame,
    orders: DataFrame,
    tolerance: str = "0.01",
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Failed, authorized and captured payments that differ from their order's net amount.

    Refunded rows may be partial and are not checked. ``orders`` has one row per order.
    """
    due = payments.filter(is_due())
    joined = join_unique(due, orders.select("order_id", "net_amount"), ["order_id"], "inner", hot)
    return joined.filter(differs(F.col("amount"), F.col("net_amount"), tolerance))


def is_due() -> Column:
    """Whether a payment row is over the whole amount of its order."""
    return F.col("payment_status").isin("failed", "authorized", "captured")


def against_order(
    children: DataFrame, orders: DataFrame, broken: Column, hot: DataFrame | str | None = PROBE
) -> DataFrame:
    """One row: the children without an order (``without``), and those whose order has them ``broken``.

    ``orders`` has one row per order; its net_amount is what the child is compared with.
    """
    known = orders.select("order_id", "net_amount", F.lit(True).alias("__known"))
    joined = join_unique(children, hashed_side(known), ["order_id"], "left", hot)
    found = F.col("__known").isNotNull()
    return joined.agg(F.count_if(~found).alias("without"), F.count_if(found & broken).alias("broken"))


def excessive_refund(
    refunds: DataFrame, orders: DataFrame, hot: DataFrame | str | None = PROBE
) -> DataFrame:
    """Refunds above their order's net amount. ``orders`` has one row per order."""
    joined = join_unique(refunds, orders.select("order_id", "net_amount"), ["order_id"], "inner", hot)
    return joined.filter(F.col("refund_amount") > F.col("net_amount"))


# --- whole-table checks ---


def column_report(df: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    """One row per required column: whether the table has it and how many rows the table has."""
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(c in df.columns).alias("is_present"),
            F.col("row_count"),
        )
        for c in required
    ]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.inline(F.array(*lines)))


def missing_days(
    found: DataFrame, expected_days: DataFrame, groups: Sequence[str], group: str, day: str
) -> DataFrame:
    """Expected (group, day) pairs that ``found`` has no row for.

    ``groups`` is the fixed list of tables or types that each of ``expected_days`` should have.
    """
    listed = F.explode(F.array(*[F.lit(g) for g in groups])).alias(group)
    expected = expected_days.select(day, listed)
    return expected.join(found.select(day, group).distinct(), [day, group], "left_anti")
