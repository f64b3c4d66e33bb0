"""Column types of the eleven landed tables and the fixed value domains they use."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data contract, in all of this module.

_LOADED = "load_date date, loaded_at timestamp, source_event_at timestamp"

TABLES = {
    "customers": "customer_id string, email string, first_name string, last_name string, "
    "country_code string, city string, created_at timestamp, updated_at timestamp, "
    f"customer_status string, marketing_consent boolean, {_LOADED}",
    "products": "product_id string, sku string, product_name string, category string, "
    "brand string, unit_price decimal(12,2), currency string, is_active boolean, "
    f"created_at timestamp, updated_at timestamp, {_LOADED}",
    "marketing_campaigns": "campaign_id string, campaign_name string, source_channel string, "
    "start_date date, end_date date, budget_amount int, currency string, "
    f"created_at timestamp, updated_at timestamp, is_active boolean, {_LOADED}",
    "calendar": "date_day date, year int, quarter int, month int, day_of_month int, "
    "day_of_week int, day_name string, week_of_year int, is_weekend boolean, "
    "is_polish_public_holiday boolean, holiday_name string, load_date date, loaded_at timestamp",
    "exchange_rates": "rate_date date, currency string, rate_to_pln decimal(12,4), "
    "source string, load_date date, loaded_at timestamp",
    "orders": "order_id string, customer_id string, order_status string, "
    "order_created_at timestamp, order_updated_at timestamp, country_code string, "
    "currency string, gross_amount decimal(12,2), discount_amount decimal(12,2), "
    f"net_amount decimal(12,2), source_channel string, campaign_id string, {_LOADED}",
    "order_items": "order_item_id string, order_id string, product_id string, quantity int, "
    "unit_price decimal(12,2), discount_amount decimal(12,2), line_total decimal(12,2), "
    f"created_at timestamp, {_LOADED}",
    "payments": "payment_id string, order_id string, payment_attempt_number int, "
    "payment_method string, payment_status string, amount decimal(12,2), currency string, "
    f"created_at timestamp, processed_at timestamp, failure_reason string, {_LOADED}",
    "shipments": "shipment_id string, order_id string, carrier string, shipment_status string, "
    "shipped_at timestamp, estimated_delivery_at timestamp, delivered_at timestamp, "
    "delivery_country string, delivery_city string, shipping_cost decimal(12,2), "
    f"{_LOADED}",
    "refunds": "refund_id string, order_id string, payment_id string, refund_reason string, "
    "refund_amount decimal(12,2), currency string, created_at timestamp, "
    f"processed_at timestamp, refund_status string, {_LOADED}",
    "web_events": "event_id string, session_id string, customer_id string, "
    "anonymous_id string, event_type string, event_timestamp timestamp, product_id string, "
    "campaign_id string, device_type string, country_code string, page_url string, "
    f"{_LOADED}",
}

# Columns every consumer relies on.
REQUIRED = {
    "customers": ["customer_id", "email", "country_code", "customer_status", "load_date", "loaded_at"],
    "products": ["product_id", "sku", "category", "unit_price", "currency", "load_date", "loaded_at"],
    "orders": [
        "order_id", "customer_id", "order_status", "order_created_at", "country_code",
        "currency", "net_amount", "load_date", "loaded_at",
    ],
    "order_items": [
        "order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total",
        "load_date", "loaded_at",
    ],
    "payments": [
        "payment_id", "order_id", "payment_attempt_number", "payment_status", "amount",
        "currency", "load_date", "loaded_at",
    ],
}

# Natural key and version order of each table whose rows change over time.
VERSIONED = {
    "customers": (["customer_id"], ["updated_at", "loaded_at"]),
    "products": (["product_id"], ["updated_at", "loaded_at"]),
    "orders": (["order_id"], ["order_updated_at", "loaded_at"]),
    "shipments": (["shipment_id"], ["source_event_at", "loaded_at"]),
}

# Natural key of each table whose rows are written once.
KEYS = {
    "marketing_campaigns": ["campaign_id"],
    "calendar": ["date_day"],
    "exchange_rates": ["rate_date", "currency"],
    "order_items": ["order_item_id"],
    "payments": ["payment_id"],
    "refunds": ["refund_id"],
    "web_events": ["event_id"],
}

COUNTRIES = ["PL", "DE", "CZ", "SK", "LT"]
CURRENCY_OF_COUNTRY = {"PL": "PLN", "DE": "EUR", "CZ": "CZK", "SK": "EUR", "LT": "EUR"}
CITIES_OF_COUNTRY = {
    "PL": ["Warszawa", "Kraków", "Wrocław", "Gdańsk", "Poznań", "Łódź"],
    "DE": ["Berlin", "Hamburg", "Munich", "Cologne", "Frankfurt"],
    "CZ": ["Prague", "Brno", "Ostrava", "Plzeň"],
    "SK": ["Bratislava", "Košice", "Žilina", "Nitra"],
    "LT": ["Vilnius", "Kaunas", "Klaipėda", "Šiauliai"],
}
BASE_RATE_TO_PLN = {"PLN": "1.0000", "EUR": "4.3200", "CZK": "0.1700"}
CAMPAIGNS = [
    # campaign_id, campaign_name, source_channel, start_date, end_date, budget_amount
    ("cmp_winter", "Winter Sale", "paid_search", "2026-01-01", "2026-01-21", 7000),
    ("cmp_student", "Student Promo", "social", "2026-01-10", "2026-02-15", 5500),
    ("cmp_valentine", "Valentine Campaign", "email", "2026-02-01", "2026-02-16", 4000),
    ("cmp_spring", "Spring Launch", "paid_search", "2026-03-01", "2026-03-31", 9000),
    ("cmp_retention", "Retention Email Series", "email", "2026-01-01", "2026-03-31", 3000),
]
HOLIDAYS = {
    "2026-01-01": "New Year's Day",
    "2026-01-06": "Epiphany",
    "2026-04-05": "Easter Sunday",
    "2026-04-06": "Easter Monday",
    "2026-05-01": "Labour Day",
    "2026-05-03": "Constitution Day",
    "2026-12-25": "Christmas Day",
    "2026-12-26": "Second Day of Christmas",
}
# Status changes an order may go through.
ORDER_TRANSITIONS = [
    ("created", "paid"),
    ("created", "cancelled"),
    ("paid", "shipped"),
    ("shipped", "delivered"),
    ("delivered", "refunded"),
    ("delivered", "partially_refunded"),
]
ORDER_STATUSES = [
    "created", "paid", "cancelled", "shipped", "delivered", "refunded", "partially_refunded",
]


def schema_of(table: str) -> T.StructType:
    """Spark schema of a landed table (needs a running session)."""
    return T.StructType.fromDDL(TABLES[table])
