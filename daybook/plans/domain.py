"""The whole warehouse over orders brought into the form they land in."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.scalars import currency_of, money, padded_key
from daybook.operators import state
from daybook.operators.tables import union_batches
from daybook.plans import warehouse
from daybook.plans.registry import day_text, query, table
from daybook.session import remove_folder, shared_folder, side_by_side
from daybook.sources import landing

_COUNTRY = ("PL", "DE", "CZ")
# Landed lines are long beside what they hold. A compressed file is read by one task, so its lines are limited.
_LANDED = {"header": True, "compression": "lz4", "maxRecordsPerFile": 1_000_000}
_FILES = "*.csv.lz4"


def _land_domain(spark: SparkSession, folder: str) -> str:
    """Customers, products, orders, items, payments, shipments and refunds of two days as landed CSV, with known faults."""
    root = shared_folder(spark, "domain")
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    day = F.when(key % 2 == 0, "2026-01-02").otherwise("2026-01-03")
    moment = F.concat(day, F.lit(" 10:00:00"))
    country = F.element_at(F.array(*map(F.lit, _COUNTRY)), (key % 3).cast("int") + 1)
    amount = money(F.col("o_totalprice"))
    order_id = F.concat(F.lit("ord_"), key.cast("string"))
    nothing = F.lit(None).cast("string")

    landed = {}

    def land(name: str, rows: DataFrame, cells: dict) -> None:
        cells = cells | {"load_date": cells["load_date"], "loaded_at": F.concat(cells["load_date"], F.lit(" 01:00:00"))}
        if "source_event_at" in landing.landed_schema(name).fieldNames():
            cells = {"source_event_at": cells["loaded_at"]} | cells
        names = [n for n in landing.landed_schema(name).fieldNames() if n != landing.CORRUPT]
        lines = rows.select(*[cells[n].cast("string").alias(n) for n in names], cells["load_date"].alias("day"))
        # The folder's name ends in the day; the file has load_date itself.
        written = lines.write.partitionBy("day").options(**_LANDED)
        landed[name] = partial(written.csv, f"{root}/{name}")

    first = F.lit("2026-01-02")
    # Each fifth customer withdraws consent on the second day.
    customers = table(spark, folder, "customer")
    changes = F.when(F.col("c_custkey") % 5 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    customers = customers.select("c_custkey", F.explode(changes).alias("changed"))
    changed = F.col("changed")
    land(
        "customers",
        customers,
        {
            "customer_id": F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")),
            "email": F.lit("a@example.org"),
            "first_name": F.lit("A"),
            "last_name": F.lit("B"),
            "country_code": F.lit("PL"),
            "city": F.when(F.col("c_custkey") % 50 == 0, "Berlin").otherwise("Gdańsk"),
            "created_at": F.lit("2026-01-01 08:00:00"),
            "updated_at": F.when(changed, "2026-01-03 08:00:00").otherwise("2026-01-01 08:00:00"),
            "customer_status": F.when(F.col("c_custkey") % 3 == 0, "inactive").otherwise("active"),
            "marketing_consent": F.when(changed, "false").otherwise("true"),
            "load_date": F.when(changed, "2026-01-03").otherwise(first),
        },
    )
    land(
        "products",
        table(spark, folder, "part"),
        {
            "product_id": padded_key("prod_", F.col("p_partkey")),
            "sku": padded_key("SKU-", F.col("p_partkey")),
            "product_name": F.lit("x"),
            "category": F.lit("books"),
            "brand": F.col("p_brand"),
            "unit_price": money(F.col("p_retailprice")),
            "currency": F.lit("PLN"),
            "is_active": F.lit("true"),
            "created_at": F.lit("2026-01-01 08:00:00"),
            "updated_at": F.lit("2026-01-01 08:00:00"),
            "load_date": first,
        },
    )
    land(
        "orders",
        orders,
        {
            "order_id": order_id,
            "customer_id": F.when(key % 41 == 0, "missing_customer").otherwise(
                F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"))
            ),
            "order_status": F.lit("created"),
            "order_created_at": moment,
            "order_updated_at": moment,
            "country_code": F.when(key % 37 == 0, "XX").otherwise(country),
            "currency": currency_of(country),
            "gross_amount": amount,
            "discount_amount": F.lit("0.00"),
            "net_amount": amount,
            "source_channel": F.lit("direct"),
            "campaign_id": nothing,
            "load_date": day,
        },
    )
    line_order = F.col("l_orderkey")
    line_order_id = F.concat(F.lit("ord_"), line_order.cast("string"))
    line_day = F.when(line_order % 2 == 0, "2026-01-02").otherwise("2026-01-03")
    line_amount = money(F.col("l_extendedprice"))
    land(
        "order_items",
        table(spark, folder, "lineitem"),
        {
            # Line numbers repeat within an order.
            "order_item_id": F.concat_ws(
                "_", line_order_id, *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_extendedprice")]
            ),
            "order_id": line_order_id,
            "product_id": padded_key("prod_", F.col("l_partkey")),
            "quantity": F.when(line_order % 31 == 0, -1).otherwise(1),
            "unit_price": line_amount,
            "discount_amount": F.lit("0.00"),
            "line_total": line_amount,
            "created_at": F.concat(line_day, F.lit(" 10:00:00")),
            "load_date": line_day,
        },
    )
    delivered = (
        F.when(key % 11 == 0, nothing)
        .when(key % 7 == 0, F.concat(day, F.lit(" 09:00:00")))
        .when(key % 5 == 0, "2026-01-08 12:00:00")
        .otherwise("2026-01-04 12:00:00")
    )
    land(
        "shipments",
        orders,
        {
            "shipment_id": F.concat(F.lit("ship_"), key.cast("string")),
            "order_id": order_id,
            "carrier": F.lit("x"),
            "shipment_status": F.when(key % 11 == 0, "shipped").otherwise("delivered"),
            "shipped_at": moment,
            "estimated_delivery_at": F.lit("2026-01-05 10:00:00"),
            "delivered_at": delivered,
            "delivery_country": F.lit("PL"),
            "delivery_city": F.lit("Gdańsk"),
            "shipping_cost": F.lit("9.99"),
            "load_date": day,
            "source_event_at": F.when(key % 13 == 0, "2025-12-31 10:00:00").otherwise(moment),
        },
    )
    land(
        "refunds",
        orders.filter(key % 23 == 0),
        {
            "refund_id": F.concat(F.lit("ref_"), key.cast("string")),
            "order_id": order_id,
            "payment_id": F.concat(F.lit("pay_"), key.cast("string")),
            "refund_reason": F.lit("x"),
            "refund_amount": F.when(key % 46 == 0, amount + 1).otherwise(amount),
            "currency": currency_of(country),
            "created_at": moment,
            "processed_at": moment,
            "refund_status": F.lit("processed"),
            "load_date": day,
        },
    )
    land(
        "payments",
        orders,
        {
            "payment_id": F.concat(F.lit("pay_"), key.cast("string")),
            "order_id": order_id,
            "payment_attempt_number": F.lit(1),
            "payment_method": F.lit("card"),
            "payment_status": F.lit("captured"),
            "amount": F.when(key % 29 == 0, amount + 1).otherwise(amount),
            "currency": currency_of(country),
            "created_at": moment,
            "processed_at": moment,
            "failure_reason": nothing,
            "load_date": day,
        },
    )
    side_by_side(spark, landed)
    return root


@query(
    "warehouse_domain",
    """
    WITH o AS (
      SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
             CASE WHEN o_orderkey % 2 = 0 THEN '2026-01-02' ELSE '2026-01-03' END AS day,
             ['PLN', 'EUR', 'CZK'][o_orderkey % 3 + 1] AS currency
      FROM orders),
    i AS (SELECT l_orderkey AS k, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem),
    s AS (SELECT k, day, k % 11 = 0 AS in_transit, k % 11 <> 0 AND k % 7 <> 0 AND k % 5 = 0 AS delayed,
                 CASE WHEN k % 13 = 0 THEN DATEDIFF('day', DATE '2025-12-31', day::DATE) ELSE 0 END AS lag
          FROM o WHERE k % 11 = 0 OR k % 7 <> 0),
    totals AS (SELECT 'total' AS kind, day AS name, currency AS detail, COUNT(*) AS n, SUM(amount) AS amount
               FROM o WHERE k % 37 <> 0 GROUP BY day, currency),
    failed(kind, name, detail, n, amount) AS (
      SELECT 'failed', 'orders', 'country_known', COUNT(*) FILTER (k % 37 = 0), 0 FROM o
      UNION ALL SELECT 'failed', 'orders', 'customer_id_exists', COUNT(*) FILTER (k % 37 <> 0 AND k % 41 = 0), 0 FROM o
      UNION ALL SELECT 'failed', 'order_items', 'quantity_positive', COUNT(*) FILTER (k % 31 = 0), 0 FROM i
      UNION ALL SELECT 'failed', 'order_items', 'line_total', COUNT(*) FILTER (k % 31 = 0), 0 FROM i
      UNION ALL SELECT 'failed', 'shipments', 'delivered_after_shipped', COUNT(*) FILTER (k % 11 <> 0 AND k % 7 = 0), 0 FROM o
      UNION ALL SELECT 'failed', 'refunds', 'within_order', COUNT(*) FILTER (k % 46 = 0), 0 FROM o
      UNION ALL SELECT 'failed', 'payments', 'amount_of_order', COUNT(*) FILTER (k % 29 = 0), 0 FROM o
      UNION ALL SELECT 'failed', 'customers', 'city_in_country', 2 * COUNT(*) FILTER (c_custkey % 50 = 0), 0 FROM customer),
    held(kind, name, detail, n, amount) AS (
      SELECT 'quarantine', 'orders', '', COUNT(*) FILTER (k % 37 = 0), 0 FROM o
      UNION ALL SELECT 'quarantine', 'order_items', '', COUNT(*) FILTER (k % 31 = 0), 0 FROM i
      UNION ALL SELECT 'quarantine', 'shipments', '', COUNT(*) FILTER (k % 11 <> 0 AND k % 7 = 0), 0 FROM o
      UNION ALL SELECT 'quarantine', 'customers', '', 2 * COUNT(*) FILTER (c_custkey % 50 = 0), 0 FROM customer),
    facts(kind, name, detail, n, amount) AS (
      SELECT 'facts', 'first_try', '', COUNT(*),
             (SELECT SUM(i.amount) FROM i JOIN o USING (k) WHERE k % 37 <> 0 AND k % 31 <> 0)
      FROM o WHERE k % 37 <> 0
      UNION ALL
      SELECT 'priced', 'order_items', '', COUNT(*), SUM(CAST(p_retailprice AS DECIMAL(18,2)))
      FROM i JOIN part ON p_partkey = l_partkey WHERE k % 31 <> 0
      UNION ALL
      SELECT 'lifecycle', 'created', '', COUNT(*), 0 FROM o WHERE k % 37 <> 0
      UNION ALL
      SELECT 'shipped', CASE WHEN in_transit THEN 'in_transit' ELSE 'delivered' END, '', COUNT(*), COUNT(*) FILTER (delayed)
      FROM s GROUP BY ALL
      UNION ALL
      SELECT 'late', 'shipments', day, COUNT(*), COUNT(*) FILTER (lag > 1) FROM s GROUP BY day
      UNION ALL
      SELECT 'late', 'orders', day, COUNT(*), 0 FROM o WHERE k % 37 <> 0 GROUP BY day
      UNION ALL
      SELECT 'late', 'refunds', day, COUNT(*), 0 FROM o WHERE k % 23 = 0 GROUP BY day
      UNION ALL
      SELECT 'versions', 'customers', 'current', COUNT(*), 0 FROM customer WHERE c_custkey % 50 <> 0
      UNION ALL
      SELECT 'versions', 'customers', 'ended', COUNT(*), 0 FROM customer WHERE c_custkey % 50 <> 0 AND c_custkey % 5 = 0
      UNION ALL
      SELECT 'versions', 'products', 'current', COUNT(*), 0 FROM part
      UNION ALL
      SELECT 'active', 'customers', '', COUNT(*), 0 FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 50 <> 0
      UNION ALL
      SELECT 'missing', table_name, '2026-01-04', 1, 0 FROM (VALUES ('orders'), ('payments')) t(table_name)),
    lines AS (SELECT * FROM totals UNION ALL SELECT * FROM failed UNION ALL SELECT * FROM held UNION ALL SELECT * FROM facts)
    SELECT kind, name, detail, n::BIGINT AS n, amount::DOUBLE AS amount FROM lines WHERE n > 0
    """,
)
def warehouse_domain(spark, folder):
    """Totals, reports, quarantine, facts, prices, outcomes, histories and missing days of one warehouse run."""
    days = ["2026-01-02", "2026-01-03"]
    landed = _land_domain(spark, folder)
    result = warehouse.run(
        spark,
        landed,
        shared_folder(spark, "warehouse"),
        expected_days=[*days, "2026-01-04"],
        files=_FILES,
        loaded=partial(remove_folder, spark, landed),
    )
    count, none = F.count(F.lit(1)).alias("n"), F.lit(0).alias("amount")

    def lines(kind: str, rows: DataFrame, name: Column, detail: Column) -> DataFrame:
        amount = F.col("amount").cast("double").alias("amount")
        return rows.select(F.lit(kind).alias("kind"), name.alias("name"), detail.alias("detail"), "n", amount)

    empty = F.lit("")
    totals = result["daily_totals"].withColumnsRenamed({"order_count": "n", "daily_order_amount": "amount"})
    report = result["quality_report"].select("table_name", "rule", F.col("failed").alias("n"), none)
    held = union_batches(
        *[
            result[f"quarantine_{t}"].agg(count, none).withColumn("table_name", F.lit(t))
            for t in ("orders", "order_items", "shipments", "customers")
        ]
    )
    lifecycle = result["order_lifecycle"].groupBy("current_status").agg(count, none)
    delayed = F.count_if("is_late").alias("amount")
    shipped = result["shipment_outcome"].groupBy("shipment_outcome").agg(count, delayed)
    late = result["lateness_report"].withColumnsRenamed({"row_count": "n", "late_count": "amount"})
    late = late.filter(F.col("table_name").isin("shipments", "orders", "refunds"))
    ended = F.when(F.col("is_current"), "current").otherwise("ended").alias("ended")
    versions = union_batches(
        *[
            result[f"{one}_history"].groupBy(ended).agg(count, none).withColumn("table_name", F.lit(f"{one}s"))
            for one in ("customer", "product")
        ]
    )
    facts = result["order_facts"].groupBy("payment_outcome").agg(count, F.sum("items_net_pln").alias("amount"))
    priced = result["item_prices"].agg(count, F.sum("list_price").alias("amount"))
    active = state.active_customers(result["clean_customers"]).agg(count, none)
    missing = result["missing_days"].filter(F.col("table_name").isin("orders", "payments"))
    missing = missing.groupBy("table_name", "load_date").agg(count, none)
    return union_batches(
        lines("total", totals, day_text(F.col("order_date")), F.col("currency")),
        lines("failed", report.filter("n > 0"), F.col("table_name"), F.col("rule")),
        lines("quarantine", held.filter("n > 0"), F.col("table_name"), empty),
        lines("facts", facts, F.col("payment_outcome"), empty),
        lines("priced", priced.filter("n > 0"), F.lit("order_items"), empty),
        lines("active", active.filter("n > 0"), F.lit("customers"), empty),
        lines("lifecycle", lifecycle, F.col("current_status"), empty),
        lines("shipped", shipped, F.col("shipment_outcome"), empty),
        lines("late", late, F.col("table_name"), day_text(F.col("load_date"))),
        lines("versions", versions, F.col("table_name"), F.col("ended")),
        lines("missing", missing, F.col("table_name"), day_text(F.col("load_date"))),
    )
