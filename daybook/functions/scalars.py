"""Keys, text, money and clamping as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.schemas import BASE_RATE_TO_PLN, CITIES_OF_COUNTRY, CURRENCY_OF_COUNTRY


def literal_map(values: dict) -> Column:
    """A constant look-up table as a map column."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs)


def money(amount: Column, scale: int = 2) -> Column:
    """Amount as a decimal, rounded half up on its decimal text."""
    return amount.cast(f"decimal(18,{scale})")


def padded_key(prefix: str, number: Column, width: int = 5) -> Column:
    """``prod_00042``-style key; a number wider than ``width`` keeps all its digits."""
    digits = number.cast("string")
    return (
        F.when(number >= 10**width, F.concat(F.lit(prefix), digits))
        .when(number >= 0, F.concat(F.lit(prefix), F.lpad(digits, width, "0")))
        .otherwise(F.format_string(f"{prefix}%0{width}d", number))
    )


def joined_text(*values: Column) -> Column:
    """Values as one text that no other values share: each with its length in front, NULL as a dash."""
    texts = [value.cast("string") for value in values]
    parts = [F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.concat(*[F.coalesce(part, F.lit("-")) for part in parts])


def surrogate_key(prefix: str, *natural_key: Column, length: int = 32) -> Column:
    """Reproducible hex key of a natural key. A shorter ``length`` is for small tables only."""
    return F.concat(F.lit(prefix), F.substring(F.md5(joined_text(*natural_key)), 1, length))


def product_name(brand: Column, category: Column, word: Column) -> Column:
    return F.concat_ws(" ", brand, F.initcap(category), F.initcap(word))


def landing_path(prefix: str | Column, relative: Column) -> Column:
    """``prefix`` without trailing slashes, then the relative path."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(F.regexp_replace(prefix, "/+$", ""), F.lit("/"), relative)


def count_of_share(total: Column, share: float, least: int = 0) -> Column:
    """How many of ``total`` rows a share is: truncated, at least ``least``, at most all."""
    wanted = (total * F.lit(str(share)).cast("decimal(12,6)")).cast("bigint")
    return F.least(total, F.greatest(F.lit(least).cast("bigint"), wanted))


def blank(value: Column) -> Column:
    """True for NULL and for empty text."""
    return value.isNull() | (value == "")


def page_url(event_type: Column, sku: Column) -> Column:
    """Page a web event happened on; ``sku`` is NULL where no product is involved."""
    return (
        F.when(
            event_type.isin("product_view", "add_to_cart") & sku.isNotNull(),
            F.concat(F.lit("/product/"), sku),
        )
        .when(event_type == "checkout_started", "/checkout")
        .when(event_type == "purchase_completed", "/checkout/success")
        .otherwise("/")
    )


def currency_of(country: Column) -> Column:
    """Currency of a country code, NULL for an unknown one."""
    return F.try_element_at(literal_map(CURRENCY_OF_COUNTRY), country)


def city_in_country(city: Column, country: Column) -> Column:
    """Whether the city is one of the country's; NULL for an unknown country."""
    towns = F.create_map(
        *[
            x
            for code, names in CITIES_OF_COUNTRY.items()
            for x in (F.lit(code), F.array(*[F.lit(n) for n in names]))
        ]
    )
    return F.array_contains(F.try_element_at(towns, country), city)


def base_rate_to_pln(currency: Column) -> Column:
    """Fixed rate of a currency to PLN, NULL for an unknown one."""
    return F.try_element_at(literal_map(BASE_RATE_TO_PLN), currency).cast("decimal(12,4)")


def from_pln(amount: Column, rate_to_pln: Column) -> Column:
    """A PLN amount in another currency, two places."""
    return F.round(money(amount) / rate_to_pln.cast("decimal(12,4)"), 2).cast("decimal(18,2)")


def line_total(unit_price: Column, quantity: Column, discount: Column) -> Column:
    return F.round(unit_price * quantity - discount, 2)
