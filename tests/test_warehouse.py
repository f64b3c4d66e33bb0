"""Landing zone to daily totals on a small hand-made landing with one fault of each kind."""

from __future__ import annotations

import csv

import pytest

from daybook.plans import warehouse
from daybook.schemas import TABLES

D1, D2 = "2026-01-02", "2026-01-03"


def loaded(rows, load_date, event="source_event_at"):
    """Add the load metadata a landed row carries."""
    return [
        {**row, "load_date": load_date, "loaded_at": f"{load_date} 05:00:00", event: row.get("at", f"{load_date} 00:00:00")}
        for row in rows
    ]


def customer(n, city="Brno", updated="2026-01-01 09:00:00"):
    return {
        "customer_id": f"c{n}", "email": f"c{n}@example.org", "first_name": "A", "last_name": "B",
        "country_code": "CZ", "city": city, "created_at": "2026-01-01 08:00:00", "updated_at": updated,
        "customer_status": "active", "marketing_consent": "True", "at": updated,
    }


def product(price, updated):
    return {
        "product_id": "prod_00001", "sku": "SKU-00001", "product_name": "X", "category": "books",
        "brand": "Bookly", "unit_price": price, "currency": "PLN", "is_active": "True",
        "created_at": "2026-01-01 08:00:00", "updated_at": updated, "at": updated,
    }


def order(n, status="created", updated=f"{D1} 10:00:00", **changed):
    return {
        "order_id": f"o{n}", "customer_id": "c1", "order_status": status,
        "order_created_at": f"{D1} 10:00:00", "order_updated_at": updated, "country_code": "CZ",
        "currency": "CZK", "gross_amount": "100.00", "discount_amount": "0.00", "net_amount": "100.00",
        "source_channel": "email", "campaign_id": "", "at": updated, **changed,
    }


def item(n, quantity=1, total="17.00"):
    return {
        "order_item_id": f"o{n}_1", "order_id": f"o{n}", "product_id": "prod_00001", "quantity": quantity,
        "unit_price": "17.00", "discount_amount": "0.00", "line_total": total, "created_at": f"{D1} 10:00:00",
    }


def payment(name, n, status="captured", amount="100.00", attempt=1):
    return {
        "payment_id": name, "order_id": f"o{n}", "payment_attempt_number": attempt, "payment_method": "card",
        "payment_status": status, "amount": amount, "currency": "CZK", "created_at": f"{D1} 10:05:00",
        "processed_at": f"{D1} 10:05:30", "failure_reason": "", "at": f"{D1} 10:05:00",
    }


def shipment(status, delivered, at):
    return {
        "shipment_id": "s1", "order_id": "o1", "carrier": "DPD", "shipment_status": status,
        "shipped_at": f"{D1} 20:00:00", "estimated_delivery_at": f"{D2} 20:00:00", "delivered_at": delivered,
        "delivery_country": "CZ", "delivery_city": "Brno", "shipping_cost": "9.00", "at": at,
    }


def refund(name, payment_id, amount="40.00"):
    return {
        "refund_id": name, "order_id": "o1", "payment_id": payment_id, "refund_reason": "damaged",
        "refund_amount": amount, "currency": "CZK", "created_at": f"{D2} 10:00:00",
        "processed_at": f"{D2} 11:00:00", "refund_status": "processed", "at": f"{D2} 10:00:00",
    }


LANDED = {
    D1: {
        "customers": [customer(1)],
        "products": [product("17.00", f"{D1} 09:00:00")],
        "orders": [
            order(1), order(2), order(3), order(4, customer_id="missing_customer"),
            order(5, country_code="XX"),
        ],
        "order_items": [item(1), item(2), item(3, quantity=-1)],
        "payments": [payment("p1", 1), payment("p2", 2, "failed"), payment("p3", 3, amount="150.00"),
                     payment("p5", 5, amount="90.00")],  # of an order in quarantine
    },
    D2: {
        "customers": [customer(1, "Praha", f"{D2} 09:00:00")],  # not a town of the list
        "products": [product("20.00", f"{D2} 18:00:00")],
        "orders": [order(1, "paid", f"{D1} 10:05:00"), order(1, "paid", f"{D1} 10:05:00")],  # a copy
        "payments": [payment("p4", 2, "captured", attempt=2)],
        "shipments": [
            shipment("shipped", "", f"{D1} 20:00:00"), shipment("delivered", f"{D2} 21:00:00", f"{D2} 21:00:00"),
        ],
        "refunds": [refund("r1", "p1"), refund("r2", "missing_payment")],
    },
}


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    for load_date, tables in LANDED.items():
        for table, ddl in TABLES.items():
            folder = root / "raw" / table / f"load_date={load_date}"
            folder.mkdir(parents=True)
            with open(folder / f"{table}.csv", "w", newline="") as out:
                rows = loaded(tables.get(table, []), load_date)
                names = [column.split()[0] for column in ddl.replace("decimal(12,", "decimal(12.").split(", ")]
                if not rows:
                    out.write("\n")
                    continue
                writer = csv.DictWriter(out, names, extrasaction="ignore", lineterminator="\n")
                writer.writeheader()
                writer.writerows(rows)
    return warehouse.run(spark, str(root / "raw"), str(root / "warehouse"))


def test_report_finds_every_fault(result):
    failed = {(r.table_name, r.rule): r.failed for r in result["quality_report"].collect() if r.failed}
    assert failed == {
        ("customers", "city_in_country"): 1,
        ("order_items", "quantity_positive"): 1,
        ("order_items", "line_total"): 1,
        ("orders", "country_known"): 1,
        ("orders", "customer_id_exists"): 1,
        ("orders", "no_copies"): 1,
        ("payments", "amount_of_order"): 2,
        ("refunds", "payment_id_exists"): 1,
    }


def test_quarantine_keeps_the_rows(result):
    assert [r.order_item_id for r in result["quarantine_order_items"].collect()] == ["o3_1"]
    assert [r.order_id for r in result["quarantine_orders"].collect()] == ["o5"]
    assert result["quarantine_payments"].count() == 0


def test_order_facts(result):
    rows = {r.order_id: r for r in result["order_facts"].collect()}
    assert sorted(rows) == ["o1", "o2", "o3", "o4"]
    assert (rows["o1"].order_status, rows["o1"].payment_outcome, rows["o1"].refund_class) == (
        "paid", "first_try", "partial",
    )
    assert rows["o2"].payment_outcome == "retried" and str(rows["o2"].items_net_pln) == "17.00"
    assert rows["o4"].payment_outcome == "open" and rows["o3"].items_net_pln is None


def test_other_tables(result):
    totals = [
        (str(r.order_date), r.currency, r.order_count, str(r.daily_order_amount))
        for r in result["daily_totals"].collect()
    ]
    assert totals == [(D1, "CZK", 4, "400.00")]
    prices = {(str(r.unit_price), r.is_current) for r in result["product_history"].collect()}
    assert prices == {("17.00", False), ("20.00", True)}
    assert {r.order_item_id: str(r.list_price) for r in result["item_prices"].collect()} == {
        "o1_1": "17.00", "o2_1": "17.00",
    }
    ship = result["shipment_outcome"].collect()
    assert [(r.shipment_outcome, r.is_late, r.days_late) for r in ship] == [("delivered", True, 0)]
    assert [r.is_current for r in result["customer_history"].collect()] == [True]
    life = {r.order_id: r for r in result["order_lifecycle"].collect()}
    assert life["o1"].current_status == "paid" and life["o2"].paid_at is None


def test_columns_days_and_lateness(result):
    assert all(r.is_present and r.row_count > 0 for r in result["column_report"].collect())
    missing = {(r.table_name, str(r.load_date)) for r in result["missing_days"].collect()}
    assert ("shipments", D1) in missing and ("order_items", D2) in missing
    assert not {t for t, _ in missing} & {"orders", "payments", "customers", "marketing_campaigns"}
    late = {
        (r.table_name, str(r.load_date)): (r.row_count, r.late_count, r.max_lag_days)
        for r in result["lateness_report"].collect()
    }
    assert late["orders", D2] == (1, 0, 1)  # a status row of the day before
    assert late["payments", D1] == (4, 0, 0) and late["payments", D2] == (1, 1, 1)
    assert late["shipments", D2] == (2, 0, 1)
