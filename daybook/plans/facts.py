"""Queries on state, history and order facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.scalars import base_rate_to_pln, currency_of, money, padded_key
from daybook.operators import bucketed, dims, maintained, orders, ranges, skew, state, tables
from daybook.operators.events import checkout_gate, interval_pairs, next_in_interval
from daybook.plans.daily import campaign_day
from daybook.plans.registry import day_text, query, table, time_text
from daybook.session import checkpointed, shared_folder

# --- current state and history: the orders of a customer as versions of that customer ---


@query(
    "current_state",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS updated_on
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
            AND o_orderstatus <> 'F'
    """,
)
def current_state(spark, folder):
    feed = table(spark, folder, "orders").drop("o_totalprice", "o_orderpriority")
    current = state.current_state(
        feed, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") != "F"
    )
    return current.select(
        "o_custkey", "o_orderkey", "o_orderstatus", day_text(F.col("o_orderdate")).alias("updated_on")
    )


def _history(spark, folder, strategy: str, hot_rows: int | None = None) -> DataFrame:
    feed = table(spark, folder, "orders")
    keys = ["o_custkey"]
    # A low bound makes ordinary customers hot and takes them through the split plan.
    hot = skew.hot_keys(feed, keys, hot_rows, sample=1.0) if hot_rows else skew.PROBE
    history = state.version_history(
        feed, keys, ["o_orderdate", "o_orderkey"], ["o_orderstatus"], strategy, hot
    )
    return history.select(
        "o_custkey",
        "o_orderstatus",
        day_text(F.col("valid_from")).alias("valid_from"),
        F.coalesce(day_text(F.col("valid_to")), F.lit("")).alias("valid_to"),
        "is_current",
    )


TIMESTAMP_SQL = """
    SELECT o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS valid_from,
           COALESCE(strftime(lead(o_orderdate) OVER w, '%Y-%m-%d'), '') AS valid_to,
           lead(o_orderdate) OVER w IS NULL AS is_current
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
"""
CHECK_SQL = """
    WITH c AS (SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey
                                                  ORDER BY o_orderdate, o_orderkey) AS b FROM orders),
         k AS (SELECT * FROM c WHERE b IS NULL OR b <> o_orderstatus)
    SELECT o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS valid_from,
           COALESCE(strftime(lead(o_orderdate) OVER w, '%Y-%m-%d'), '') AS valid_to,
           lead(o_orderdate) OVER w IS NULL AS is_current
    FROM k WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
"""


@query("scd2_timestamp", TIMESTAMP_SQL)
def scd2_timestamp(spark, folder):
    return _history(spark, folder, "timestamp")


@query("scd2_check", CHECK_SQL)
def scd2_check(spark, folder):
    return _history(spark, folder, "check")


@query("scd2_check_split", CHECK_SQL)
def scd2_check_split(spark, folder):
    return _history(spark, folder, "check", hot_rows=8)


# --- the same, load by load: orders come in three loads out of order of time, one of them twice ---

LOADS = ["1", "0", "2", "0"]


def _history_by_loads(spark, folder, strategy: str) -> DataFrame:
    feed = table(spark, folder, "orders")
    target = shared_folder(spark, "history")
    keys, version, attributes = ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"]
    for load in LOADS:
        rows = feed.filter(F.col("o_orderkey") % 3 == int(load))
        maintained.merge_history(rows, target, keys, version, attributes)
    history = maintained.history(spark, target, keys, version, attributes, strategy)
    return history.select(
        "o_custkey",
        "o_orderstatus",
        day_text(F.col("valid_from")).alias("valid_from"),
        F.coalesce(day_text(F.col("valid_to")), F.lit("")).alias("valid_to"),
        "is_current",
    )


@query("history_by_loads", TIMESTAMP_SQL)
def history_by_loads(spark, folder):
    return _history_by_loads(spark, folder, "timestamp")


@query("history_by_loads_check", CHECK_SQL)
def history_by_loads_check(spark, folder):
    return _history_by_loads(spark, folder, "check")


# Every order is landed as created; every fifth again with another amount, every seventh held back after that.
VERSIONS_SQL = """
    versions AS (
      SELECT o_orderkey, o_orderdate, k AS number, (o_orderkey + k) % 3 AS load, k = 2 AS held_back,
             CAST(o_totalprice AS DECIMAL(18,2)) + k AS amount
      FROM orders, range(3) v(k)
      WHERE k = 0 OR k = 1 AND o_orderkey % 5 = 0 OR k = 2 AND o_orderkey % 7 = 0),
    latest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY number DESC) = 1)
"""


def _order_versions(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", money(F.col("o_totalprice")).alias("amount"))
    key = F.col("o_orderkey")
    numbers = F.array_compact(F.array(F.lit(0), F.when(key % 5 == 0, 1), F.when(key % 7 == 0, 2)))
    rows = orders.withColumn("number", F.explode(numbers))
    amount = (F.col("amount") + F.col("number")).cast("decimal(18,2)")
    return rows.withColumns({"amount": amount, "held_back": F.col("number") == 2})


def _merged_orders(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Merge the versions of all orders load by load; returns the folders of the state and of the totals."""
    state_folder, totals_folder = shared_folder(spark, "current"), shared_folder(spark, "totals")
    versions = _order_versions(spark, folder)
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int")
    for load in LOADS:
        rows = versions.filter((F.col("o_orderkey") + F.col("number")) % 3 == int(load))
        images = maintained.merge_current(
            rows, state_folder, load, ["o_orderkey"], ["number"], keep=~F.col("held_back"), bucket=month
        )
        maintained.merge_totals(images, totals_folder, load, ["o_orderdate"], "amount")
    return state_folder, totals_folder


@query(
    "current_by_loads",
    f"""
    WITH {VERSIONS_SQL}
    SELECT o_orderkey, number::INTEGER AS number, amount::DOUBLE AS amount FROM latest WHERE NOT held_back
    """,
)
def current_by_loads(spark, folder):
    state_folder, _ = _merged_orders(spark, folder)
    rows = maintained.current(spark, state_folder, ~F.col("held_back"))
    return rows.select("o_orderkey", "number", F.col("amount").cast("double").alias("amount"))


@query(
    "totals_by_loads",
    f"""
    WITH {VERSIONS_SQL}
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, COUNT(*) AS row_count, SUM(amount)::DOUBLE AS total_amount
    FROM latest WHERE NOT held_back GROUP BY 1
    """,
)
def totals_by_loads(spark, folder):
    """Daily totals from signed differences: changed orders are exchanged, those held back later are retracted."""
    _, totals_folder = _merged_orders(spark, folder)
    return maintained.totals(spark, totals_folder, ["o_orderdate"]).select(
        day_text(F.col("o_orderdate")).alias("order_date"),
        "row_count",
        F.col("total_amount").cast("double").alias("total_amount"),
    )


POINT_SQL = """
    WITH v AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey,
                      max_by(o_orderstatus, o_orderkey) AS o_orderstatus
               FROM orders GROUP BY o_custkey, o_orderdate)
    SELECT l_orderkey, l_linenumber, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
           COALESCE(o_orderkey, -1) AS o_orderkey, COALESCE(o_orderstatus, '') AS o_orderstatus
    FROM lineitem ASOF LEFT JOIN v ON l_suppkey = o_custkey AND l_shipdate >= o_orderdate
"""


def _point_in_time(spark, folder, hot_rows=None) -> DataFrame:
    facts = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    versions = table(spark, folder, "orders").withColumnRenamed("o_custkey", "l_suppkey")
    keys = ["l_suppkey"]
    hot = skew.hot_keys(facts, keys, hot_rows, sample=1.0) if hot_rows else skew.PROBE
    found = state.at_point_in_time(
        facts, versions, keys, "l_shipdate", "o_orderdate", ["o_orderkey", "o_orderstatus"],
        version_tie=["o_orderkey"], fact_tie=["l_orderkey", "l_linenumber", "l_partkey"],
        hot=hot,
    )
    return found.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        day_text(F.col("l_shipdate")).alias("ship_date"),
        F.coalesce("o_orderkey", F.lit(-1)).cast("bigint").alias("o_orderkey"),
        F.coalesce("o_orderstatus", F.lit("")).alias("o_orderstatus"),
    )


@query("point_in_time", POINT_SQL)
def point_in_time(spark, folder):
    return _point_in_time(spark, folder)


@query("point_in_time_merge", POINT_SQL)
def point_in_time_merge(spark, folder):
    return _point_in_time(spark, folder)


@query("point_in_time_split", POINT_SQL)
def point_in_time_split(spark, folder):
    return _point_in_time(spark, folder, hot_rows=200)


@query(
    "last_captured",
    """
    WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
               QUALIFY row_number() OVER (PARTITION BY o_custkey
                                          ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT r.o_orderkey AS refund_id, r.o_custkey AS order_id, p.o_orderkey AS captured_payment_id,
           p.o_totalprice AS captured_payment_method
    FROM orders r JOIN p USING (o_custkey) WHERE r.o_orderstatus = 'P'
    """,
)
def last_captured(spark, folder):
    rows = table(spark, folder, "orders").withColumnRenamed("o_custkey", "order_id")
    payments = rows.select(
        "order_id",
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderdate").alias("created_at"),
        F.lit(1).alias("payment_attempt_number"),
        F.col("o_totalprice").alias("payment_method"),
        F.when(F.col("o_orderstatus") == "F", "captured").otherwise("failed").alias("payment_status"),
    )
    refunds = rows.filter("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("refund_id"), "order_id"
    )
    return orders.refunds_with_payment(refunds, payments).drop("captured_attempt_number")


# --- order roll-ups, conversion, campaigns ---


def _line_amounts():
    """Gross and discount of a line, exact to the cent."""
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    return gross, F.round(gross * F.col("l_discount").cast("decimal(4,2)"), 2)


LINE_TOTALS_SQL = """
    SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS gross,
           SUM(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2))
               AS discount
    FROM lineitem GROUP BY l_orderkey
"""


@query(
    "order_rollup",
    f"""
    SELECT o_orderkey, o_custkey, CAST(gross AS DOUBLE) AS gross_amount,
           CAST(discount AS DOUBLE) AS discount_amount, CAST(gross - discount AS DOUBLE) AS net_amount
    FROM orders JOIN ({LINE_TOTALS_SQL}) ON l_orderkey = o_orderkey
    """,
)
def order_rollup(spark, folder):
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    totals = orders.order_totals(lines, "o_orderkey", *_line_amounts())
    headers = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    amounts = ["gross_amount", "discount_amount", "net_amount"]
    return headers.join(totals, "o_orderkey").select(
        "o_orderkey", "o_custkey", *[F.col(a).cast("double").alias(a) for a in amounts]
    )


@query(
    "items_with_order",
    """
    SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, o_custkey, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def items_with_order(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey"
    )
    headers = table(spark, folder, "orders")
    return orders.with_order(
        lines, headers, ["o_custkey", "o_orderpriority"], "o_orderkey", hot=None
    )


@query(
    "items_with_order_split",
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, s_name
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def items_with_order_split(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber")
    parents = table(spark, folder, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    hot = skew.hot_keys(lines, ["l_suppkey"], hot_rows=600, sample=1.0)
    return orders.with_order(lines, parents, ["s_name"], "l_suppkey", hot=hot)


def _orders_with_country(spark, folder) -> DataFrame:
    """Orders with a country code by the customer's nation."""
    headers = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    codes = F.array(F.lit("PL"), F.lit("DE"), F.lit("CZ"))
    country = F.element_at(codes, (F.col("c_nationkey") % 3 + 1).cast("int"))
    return headers.join(customers, "o_custkey").withColumn("country_code", country)


@query(
    "address_join",
    """
    SELECT o_orderkey, o_custkey, n_name AS delivery_country
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    """,
)
def address_join(spark, folder):
    placed = _orders_with_country(spark, folder)
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("delivery_country")
    )
    return placed.join(nations, "c_nationkey").select("o_orderkey", "o_custkey", "delivery_country")


@query(
    "currency_convert",
    """
    WITH o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
                      ['PLN', 'EUR', 'CZK'][c_nationkey % 3 + 1] AS currency,
                      [10000, 43200, 1700][c_nationkey % 3 + 1] AS rate
               FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT o_orderkey, currency,
           CAST((cents * 20000 + rate) // (2 * rate) AS DOUBLE) / 100 AS net_amount
    FROM o
    """,
)
def currency_convert(spark, folder):
    placed = _orders_with_country(spark, folder).withColumns(
        {"currency": currency_of(F.col("country_code")), "net_amount": F.col("o_totalprice")}
    )
    return orders.convert_from_pln(placed, ["net_amount"]).select(
        "o_orderkey", "currency", F.col("net_amount").cast("double").alias("net_amount")
    )


@query(
    "currency_convert_daily",
    """
    WITH o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
                      ['PLN', 'EUR', 'CZK'][c_nationkey % 3 + 1] AS currency,
                      CASE c_nationkey % 3 WHEN 0 THEN 10000
                           WHEN 1 THEN (43200 * (985 + dayofyear(o_orderdate) % 31) + 500) // 1000
                           ELSE (1700 * (985 + dayofyear(o_orderdate) % 31) + 500) // 1000 END AS rate
               FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT o_orderkey, currency,
           CAST((cents * 20000 + rate) // (2 * rate) AS DOUBLE) / 100 AS net_amount
    FROM o
    """,
)
def currency_convert_daily(spark, folder):
    placed = _orders_with_country(spark, folder).withColumns(
        {
            "currency": currency_of(F.col("country_code")),
            "net_amount": F.col("o_totalprice"),
            "order_date": F.to_date("o_orderdate"),
        }
    )
    drift = (985 + F.dayofyear("rate_date") % 31).cast("decimal(6,0)") / 1000
    codes = F.explode(F.array(F.lit("PLN"), F.lit("EUR"), F.lit("CZK"))).alias("currency")
    base = base_rate_to_pln(F.col("currency"))
    rates = (
        table(spark, folder, "orders")
        .select(F.to_date("o_orderdate").alias("rate_date"))
        .distinct()
        .select("rate_date", codes)
        .withColumn(
            "rate_to_pln",
            F.when(F.col("currency") == "PLN", base).otherwise(F.round(base * drift, 4)),
        )
    )
    # Rates are a landed table; here they are computed, so they are written before they are counted and joined.
    rates = checkpointed(rates)
    return orders.convert_from_pln(placed, ["net_amount"], rates=rates).select(
        "o_orderkey", "currency", F.col("net_amount").cast("double").alias("net_amount")
    )


CAMPAIGN_SQL = """
    (VALUES ('cmp_winter', 'paid_search', DATE '2026-01-01', DATE '2026-01-21'),
            ('cmp_student', 'social', DATE '2026-01-10', DATE '2026-02-15'),
            ('cmp_valentine', 'email', DATE '2026-02-01', DATE '2026-02-16'),
            ('cmp_spring', 'paid_search', DATE '2026-03-01', DATE '2026-03-31'),
            ('cmp_retention', 'email', DATE '2026-01-01', DATE '2026-03-31'))
        AS c(campaign_id, source_channel, start_date, end_date)
"""
IN_CAMPAIGN_SQL = "CAST(o_orderdate + INTERVAL 28 YEAR AS DATE) BETWEEN start_date AND end_date"


def _campaign_orders(spark, folder, mode: str) -> DataFrame:
    rows = table(spark, folder, "orders").withColumn(
        "order_date", campaign_day(F.col("o_orderdate"))
    )
    return orders.with_campaigns(rows, dims.campaigns(spark), mode=mode)


@query(
    "campaign_active",
    f"""
    SELECT o_orderkey, COALESCE(campaign_id, '') AS campaign_id
    FROM orders LEFT JOIN {CAMPAIGN_SQL} ON {IN_CAMPAIGN_SQL}
    """,
)
def campaign_active(spark, folder):
    return _campaign_orders(spark, folder, "all").select(
        "o_orderkey", F.coalesce("campaign_id", F.lit("")).alias("campaign_id")
    )


@query(
    "campaign_one",
    f"""
    SELECT o_orderkey, COALESCE(MIN(campaign_id), '') AS campaign_id
    FROM orders LEFT JOIN {CAMPAIGN_SQL} ON {IN_CAMPAIGN_SQL} GROUP BY o_orderkey
    """,
)
def campaign_one(spark, folder):
    return _campaign_orders(spark, folder, "one").select(
        "o_orderkey", F.coalesce("campaign_id", F.lit("")).alias("campaign_id")
    )


@query(
    "channel_fallback",
    f"""
    SELECT o_orderkey, COALESCE(source_channel, o_orderpriority) AS source_channel
    FROM (SELECT o_orderkey, o_orderpriority, MIN(campaign_id) AS campaign_id
          FROM orders LEFT JOIN {CAMPAIGN_SQL} ON {IN_CAMPAIGN_SQL} GROUP BY ALL)
    LEFT JOIN {CAMPAIGN_SQL} USING (campaign_id)
    """,
)
def channel_fallback(spark, folder):
    placed = _campaign_orders(spark, folder, "one")
    channels = orders.with_channel(placed, dims.campaigns(spark), F.col("o_orderpriority"))
    return channels.select("o_orderkey", "source_channel")


# --- lines, attempts, events ---

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
    "l_tax", "l_returnflag", "l_linestatus", "l_discount",
]
LINES_SQL = f"""
    SELECT l_orderkey, l_partkey, l_linenumber, n AS line_number, l_orderkey || '_' || n AS order_item_id
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)})
                    AS INTEGER) AS n FROM lineitem)
"""


def _numbered(spark, folder, hot) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return orders.numbered_lines(lines, "l_orderkey", LINE_ORDER, hot).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("line_number").cast("int").alias("line_number"),
        "order_item_id",
    )


@query("line_numbers", LINES_SQL)
def line_numbers(spark, folder):
    return _numbered(spark, folder, skew.PROBE)


@query("line_numbers_split", LINES_SQL)
def line_numbers_split(spark, folder):
    lines = table(spark, folder, "lineitem")
    return _numbered(spark, folder, skew.hot_keys(lines, ["l_orderkey"], hot_rows=6, sample=1.0))


@query(
    "attempt_numbers",
    """
    WITH p AS (SELECT *, CASE event_type WHEN 'purchase' THEN 'captured' WHEN 'error' THEN 'failed'
                              WHEN 'click' THEN 'authorized' ELSE 'refunded' END AS payment_status
               FROM events)
    SELECT event_id, user_id, payment_status,
           CASE payment_status WHEN 'authorized' THEN 1 ELSE
                CAST(SUM(CASE WHEN payment_status IN ('captured', 'failed') THEN 1 ELSE 0 END)
                     OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER)
           END AS payment_attempt_number
    FROM p
    """,
)
def attempt_numbers(spark, folder):
    kind = F.col("event_type")
    status = (
        F.when(kind == "purchase", "captured")
        .when(kind == "error", "failed")
        .when(kind == "click", "authorized")
        .otherwise("refunded")
    )
    payments = table(spark, folder, "events").select(
        "event_id", "user_id", "ts", status.alias("payment_status")
    )
    return orders.numbered_attempts(payments, "user_id", order=["ts", "event_id"]).drop("ts")


GATE_SQL = """
    WITH n AS (SELECT event_id, user_id, ts, event_type, row_number() OVER w AS i FROM events
               WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id)),
         s AS (SELECT *, COALESCE(bool_or(event_type = 'click' AND i > 1)
                      OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id), FALSE) AS c
               FROM n)
    SELECT event_id, event_type, c AS checkout_happened,
           CASE WHEN i = 1 THEN 'signup' WHEN event_type = 'purchase' AND NOT c THEN 'view'
                ELSE event_type END AS gated_type
    FROM s
"""


def _gate(spark, folder, hot_rows=None) -> DataFrame:
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    session = ["user_id", "day"]
    hot = skew.hot_keys(events, session, hot_rows, sample=1.0) if hot_rows else skew.PROBE
    gated = checkout_gate(
        events.select("event_id", "user_id", "day", "ts", "event_type"),
        session=session, order=["ts", "event_id"],
        opening="signup", checkout="click", purchase="purchase", instead="view", hot=hot,
    )
    return gated.select("event_id", "event_type", "checkout_happened", "gated_type")


@query("checkout_gate", GATE_SQL)
def gate(spark, folder):
    return _gate(spark, folder)


@query("checkout_gate_split", GATE_SQL)
def gate_split(spark, folder):
    return _gate(spark, folder, hot_rows=3)


def _clicks_and_purchases(spark, folder) -> tuple[DataFrame, DataFrame]:
    events = table(spark, folder, "events")
    clicks = events.filter("event_type = 'click'").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("clicked_at")
    )
    purchases = events.filter("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchased_at")
    )
    return clicks, purchases


PAIR_SQL = """
    FROM (SELECT user_id, event_id AS click_id, ts AS a FROM events WHERE event_type = 'click') c
    JOIN (SELECT user_id, event_id AS purchase_id, ts AS b FROM events WHERE event_type = 'purchase') p
         ON p.user_id = c.user_id AND b BETWEEN a + INTERVAL 1 MINUTE AND a + INTERVAL 360 MINUTE
"""


@query("purchase_interval_join", f"SELECT c.user_id, click_id, purchase_id {PAIR_SQL}")
def purchase_interval_join(spark, folder):
    clicks, purchases = _clicks_and_purchases(spark, folder)
    pairs = interval_pairs(clicks, purchases, ["user_id"], "clicked_at", "purchased_at", 1, 360)
    return pairs.select("user_id", "click_id", "purchase_id")


@query(
    "purchase_next_order",
    f"""
    WITH m AS (SELECT click_id, arg_min(purchase_id, (b, purchase_id)) AS purchase_id, MIN(b) AS b
               {PAIR_SQL} GROUP BY click_id)
    SELECT event_id AS click_id, COALESCE(purchase_id, -1) AS purchase_id,
           COALESCE(strftime(b, '%Y-%m-%d %H:%M:%S.%f'), '') AS purchased_at
    FROM events LEFT JOIN m ON click_id = event_id WHERE event_type = 'click'
    """,
)
def purchase_next_order(spark, folder):
    clicks, purchases = _clicks_and_purchases(spark, folder)
    nearest = next_in_interval(
        clicks, purchases, ["user_id"], "clicked_at", "purchased_at",
        ["purchase_id", "purchased_at"], ["click_id"], ["purchase_id"], 1, 360,
    )
    return nearest.select(
        "click_id",
        F.coalesce("purchase_id", F.lit(-1)).cast("bigint").alias("purchase_id"),
        F.coalesce(time_text(F.col("purchased_at")), F.lit("")).alias("purchased_at"),
    )


# --- lifecycle and outcomes ---

EVENT_TYPES = ["signup", "view", "click", "purchase", "error"]


@query(
    "lifecycle_pivot",
    f"""
    SELECT user_id,
           {", ".join(f"COALESCE(strftime(MIN(ts) FILTER (event_type = '{t}'), '%Y-%m-%d %H:%M:%S.%f'), '') AS {t}_at" for t in EVENT_TYPES)},
           max_by(event_type, (ts, event_id)) AS current_status,
           max_by(event_type, (ts, event_id)) IN ('purchase', 'error') AS is_closed
    FROM events GROUP BY user_id
    """,
)
def lifecycle_pivot(spark, folder):
    pivot = orders.lifecycle(
        table(spark, folder, "events"), "user_id", "event_type", "ts",
        EVENT_TYPES, closed=["purchase", "error"], tie=["event_id"],
    )
    firsts = {f"{t}_at": F.coalesce(time_text(F.col(f"{t}_at")), F.lit("")) for t in EVENT_TYPES}
    return pivot.withColumns(firsts)


@query(
    "status_transitions",
    """
    WITH s AS (SELECT o_orderstatus AS b, lag(o_orderstatus) OVER (PARTITION BY o_custkey
                      ORDER BY o_orderdate, o_orderkey) AS a FROM orders)
    SELECT a AS from_status, b AS to_status, (a || b) IN ('OP', 'PF', 'OF') AS is_allowed,
           COUNT(*) AS transition_count
    FROM s WHERE a IS NOT NULL GROUP BY ALL
    """,
)
def status_transitions(spark, folder):
    changes = orders.status_transitions(
        table(spark, folder, "orders"), "o_custkey", "o_orderstatus", ["o_orderdate", "o_orderkey"],
        allowed=[("O", "P"), ("P", "F"), ("O", "F")],
    )
    return orders.transition_counts(changes)


@query(
    "late_delivery",
    """
    WITH d AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS s,
                      CAST(o_orderdate AS DATE) + 30 AS e
               FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT l_orderkey, l_linenumber, s > e AS is_late, CAST(greatest(s - e, 0) AS INTEGER) AS days_late
    FROM d
    """,
)
def late_delivery(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    headers = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    placed = orders.with_order(lines, headers, ["o_orderdate"], "l_orderkey", hot=None)
    shipped = placed.withColumn("estimated", F.col("o_orderdate") + F.expr("interval 30 days"))
    delayed = orders.with_delivery_delay(shipped, "l_shipdate", "estimated")
    return delayed.select("l_orderkey", "l_linenumber", "is_late", "days_late")


@query(
    "payment_outcome",
    """
    WITH p AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'captured' WHEN 'P' THEN 'failed'
                                 ELSE 'authorized' END AS s, o_orderdate, o_orderkey FROM orders),
         n AS (SELECT *, CASE s WHEN 'authorized' THEN 1 ELSE
                         SUM(CASE WHEN s IN ('captured', 'failed') THEN 1 ELSE 0 END) OVER
                         (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) END AS i FROM p),
         g AS (SELECT o_custkey, MIN(i) FILTER (s = 'captured') AS c,
                      COUNT(*) FILTER (s = 'failed') AS f, COUNT(*) FILTER (s = 'captured') AS k
               FROM n GROUP BY o_custkey)
    SELECT c_custkey AS customer_id, COALESCE(f, 0) AS failed_count, COALESCE(k, 0) AS captured_count,
           CASE WHEN c = 1 THEN 'first_try' WHEN c > 1 THEN 'retried'
                WHEN COALESCE(f, 0) > 0 THEN 'cancelled' ELSE 'open' END AS payment_outcome
    FROM customer LEFT JOIN g ON o_custkey = c_custkey
    """,
)
def payment_outcome(spark, folder):
    kind = F.col("o_orderstatus")
    payments = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.when(kind == "F", "captured")
        .when(kind == "P", "failed")
        .otherwise("authorized")
        .alias("payment_status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderkey").alias("payment_id"),
    )
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    numbered = orders.numbered_attempts(payments, "customer_id")
    return orders.payment_outcome(customers, numbered, "customer_id").select(
        "customer_id", "failed_count", "captured_count", "payment_outcome"
    )


@query(
    "refund_class",
    """
    WITH r AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(12,2)))
                                  FILTER (l_returnflag = 'R') AS a, COUNT(*) AS n
               FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey)
    SELECT o_orderkey, COALESCE(CAST(a AS DOUBLE), 0) AS refunded_amount,
           COALESCE(n, 0) AS refund_count,
           CASE WHEN n IS NULL THEN 'none' WHEN a IS NULL THEN 'rejected'
                WHEN a < CAST(o_totalprice AS DECIMAL(12,2)) THEN 'partial' ELSE 'full' END
               AS refund_class
    FROM orders LEFT JOIN r ON l_orderkey = o_orderkey
    """,
)
def refund_class(spark, folder):
    refunds = (
        table(spark, folder, "lineitem")
        .filter("l_returnflag <> 'N'")
        .select(
            F.col("l_orderkey").alias("o_orderkey"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("refund_amount"),
            F.when(F.col("l_returnflag") == "R", "processed")
            .otherwise("rejected")
            .alias("refund_status"),
        )
    )
    headers = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("net_amount")
    )
    return orders.refund_class(headers, refunds, "o_orderkey").select(
        "o_orderkey",
        F.coalesce(F.col("refunded_amount").cast("double"), F.lit(0.0)).alias("refunded_amount"),
        "refund_count",
        "refund_class",
    )


@query(
    "shipment_outcome",
    """
    SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d') AS as_of,
           CASE WHEN l_returnflag = 'R' THEN 'returned' WHEN l_returnflag = 'A' THEN 'lost'
                WHEN l_linestatus = 'F' THEN 'delivered' ELSE 'in_transit' END AS shipment_outcome
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC,
                               l_partkey DESC, l_returnflag DESC, l_linestatus DESC) = 1
    """,
)
def shipment_outcome(spark, folder):
    flag = F.col("l_returnflag")
    status = (
        F.when(flag == "R", "returned")
        .when(flag == "A", "lost")
        .when(F.col("l_linestatus") == "F", "delivered")
        .otherwise("shipped")
    )
    version = ["l_shipdate", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"]
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", *version, status.alias("shipment_status")
    )
    return orders.shipment_outcome(lines, "l_orderkey", version).select(
        "l_orderkey", day_text(F.col("l_shipdate")).alias("as_of"), "shipment_outcome"
    )


@query(
    "collect_children",
    """
    SELECT l_orderkey, list_no, COUNT(*) AS child_count,
           string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY n) AS children
    FROM (SELECT l_orderkey, l_linenumber, n, (n - 1) // 3 + 1 AS list_no
          FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                       l_suppkey) AS n FROM lineitem))
    GROUP BY l_orderkey, list_no
    """,
)
def collect_children(spark, folder):
    lists = tables.child_lists(
        table(spark, folder, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"],
        F.col("l_linenumber").cast("string"), per_list=3,
    )
    return lists.select(
        "l_orderkey",
        F.col("list_no").cast("bigint").alias("list_no"),
        "child_count",
        F.array_join("children", ",").alias("children"),
    )


@query(
    "order_facts",
    f"""
    WITH r AS (SELECT l_orderkey AS k, SUM(CAST(l_extendedprice AS DECIMAL(12,2)))
                      FILTER (l_linestatus = 'F') AS a, COUNT(*) AS n
               FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
         p AS (SELECT l_orderkey AS k, MIN(l_linenumber) FILTER (l_returnflag = 'N') AS c,
                      COUNT(*) FILTER (l_returnflag = 'A') AS f
               FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey)
    SELECT o_orderkey AS order_id, COALESCE(CAST(gross - discount AS DOUBLE), 0) AS items_net_pln,
           CASE WHEN c = 1 THEN 'first_try' WHEN c > 1 THEN 'retried'
                WHEN COALESCE(f, 0) > 0 THEN 'cancelled' ELSE 'open' END AS payment_outcome,
           CASE WHEN n IS NULL THEN 'none' WHEN a IS NULL THEN 'rejected'
                WHEN a < CAST(o_totalprice AS DECIMAL(12,2)) THEN 'partial' ELSE 'full' END
               AS refund_class
    FROM orders LEFT JOIN ({LINE_TOTALS_SQL}) ON l_orderkey = o_orderkey
         LEFT JOIN r ON r.k = o_orderkey LEFT JOIN p ON p.k = o_orderkey
    """,
)
def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    feed = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_updated_at"),
        F.col("o_orderdate").alias("loaded_at"),
        money(F.col("o_totalprice")).alias("net_amount"),
    )
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "order_id")
    gross, discount = _line_amounts()
    items = lines.select(
        "order_id", gross.alias("unit_price"), F.lit(1).alias("quantity"),
        discount.alias("discount_amount"),
    )
    payments = lines.filter("l_returnflag <> 'R'").select(
        "order_id",
        F.col("l_linenumber").alias("payment_attempt_number"),
        F.when(F.col("l_returnflag") == "N", "captured").otherwise("failed").alias("payment_status"),
    )
    refunds = lines.filter("l_returnflag = 'R'").select(
        "order_id",
        gross.alias("refund_amount"),
        F.when(F.col("l_linestatus") == "F", "processed").otherwise("rejected").alias("refund_status"),
    )
    return orders.order_facts(feed, items, payments, refunds).select(
        "order_id",
        F.coalesce(F.col("items_net_pln").cast("double"), F.lit(0.0)).alias("items_net_pln"),
        "payment_outcome",
        "refund_class",
    )


# --- ranges that are long or open: a campaign per supplier, for the customers of its nation ---

RANGES_SQL = """
    c AS (SELECT s_suppkey, s_nationkey, DATE '1991-06-01' + CAST(s_suppkey % 2000 AS INTEGER) AS start_date,
                 CASE WHEN s_suppkey % 4 > 0 THEN DATE '1991-06-01' + CAST(s_suppkey % 2000 + s_suppkey % 3700 - 50 AS INTEGER)
                 END AS end_date
          FROM supplier)
"""


def _long_campaigns(spark: SparkSession, folder: str) -> DataFrame:
    """Some last ten years, some never end, some end before they begin."""
    key = F.col("s_suppkey")
    start = F.date_add(F.lit("1991-06-01").cast("date"), (key % 2000).cast("int"))
    end = F.when(key % 4 > 0, F.date_add(start, (key % 3700 - 50).cast("int")))
    return table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", start.alias("start_date"), end.alias("end_date"))


@query(
    "orders_in_ranges",
    f"""
    WITH {RANGES_SQL}
    SELECT o_orderkey, COUNT(*) AS campaigns, MIN(s_suppkey) AS first_campaign, MAX(s_suppkey) AS last_campaign
    FROM orders JOIN customer ON c_custkey = o_custkey
         JOIN c ON s_nationkey = c_nationkey AND o_orderdate >= start_date AND o_orderdate <= coalesce(end_date, DATE '9999-12-31')
    GROUP BY o_orderkey
    """,
)
def orders_in_ranges(spark, folder):
    campaigns = _long_campaigns(spark, folder).withColumnRenamed("s_nationkey", "c_nationkey")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    placed = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(customers, "o_custkey")
    low, high = ranges.day_number(F.col("start_date")), ranges.day_number(F.col("end_date"))
    placed_on = ranges.day_number(F.col("o_orderdate"))
    found = ranges.totals_in_ranges(placed, ["o_orderkey"], placed_on, campaigns, low, high, ["c_nationkey"], "s_suppkey")
    return found.withColumnsRenamed({"count": "campaigns", "least": "first_campaign", "greatest": "last_campaign"})


@query(
    "campaigns_active_on",
    f"""
    WITH {RANGES_SQL}
    SELECT s_suppkey, strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date
    FROM c WHERE DATE '1994-05-01' BETWEEN start_date AND end_date
    """,
)
def campaigns_active_on(spark, folder):
    running = dims.active_on(_long_campaigns(spark, folder), F.lit("1994-05-01").cast("date"))
    return running.select(
        "s_suppkey", day_text(F.col("start_date")).alias("start_date"), day_text(F.col("end_date")).alias("end_date")
    )


@query(
    "active_products",
    """
    WITH feed AS (
      SELECT p_partkey, v, CAST(p_retailprice AS DECIMAL(12,2)) + v AS unit_price, (p_partkey + v) % 3 <> 0 AS is_active
      FROM part, range(4) t(v) WHERE v <= p_partkey % 4)
    SELECT 'prod_' || CASE WHEN p_partkey < 100000 THEN lpad(p_partkey::VARCHAR, 5, '0') ELSE p_partkey::VARCHAR END AS product_id,
           v::INTEGER AS version, unit_price::DOUBLE AS unit_price
    FROM (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY v DESC) = 1) WHERE is_active
    """,
)
def active_products(spark, folder):
    """Products on sale after up to four versions each, which come in no order."""
    parts = table(spark, folder, "part")
    version = F.explode(F.sequence(F.lit(0), (F.col("p_partkey") % 4).cast("int"))).alias("version")
    feed = parts.select("p_partkey", money(F.col("p_retailprice")).alias("price"), version)
    updated = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("version"))
    feed = feed.select(
        padded_key("prod_", F.col("p_partkey")).alias("product_id"),
        "version",
        (F.col("price") + F.col("version")).alias("unit_price"),
        ((F.col("p_partkey") + F.col("version")) % 3 != 0).alias("is_active"),
        updated.alias("updated_at"),
        F.timestamp_seconds(F.lit(1_800_000_000) - F.col("version")).alias("loaded_at"),
    )
    rows = state.active_products(feed)
    return rows.select("product_id", "version", F.col("unit_price").cast("double").alias("unit_price"))


@query(
    "differing_rows",
    """
    WITH p AS (SELECT max(l_orderkey) AS last, min(l_orderkey) AS first FROM lineitem)
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, l_orderkey, l_linenumber,
           CASE WHEN l_orderkey = last THEN 'changed' ELSE 'left' END AS kind
    FROM lineitem, p WHERE l_orderkey = last AND l_linenumber = 1 OR l_orderkey = first AND l_linenumber = 1
    """,
)
def differing_rows(spark, folder):
    """Two runs of a table that differ in one cell and one row, found by comparing hashes by day and key."""
    lines = table(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    first, last = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    one = F.col("l_linenumber") == 1
    other = lines.filter(~((F.col("l_orderkey") == first) & one)).withColumn(
        "l_quantity", F.when((F.col("l_orderkey") == last) & one, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    found = tables.differing_rows(lines, other, "l_shipdate", ["l_orderkey", "l_linenumber"])
    return found.select(day_text(F.col("day")).alias("day"), "l_orderkey", "l_linenumber", "kind")


# --- tables kept in buckets of the order: two loads, then items with their order and totals by order ---


@query(
    "order_shares_bucketed",
    """
    WITH i AS (SELECT l_orderkey AS order_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
                      l_returnflag = 'R' AS returned, l_shipdate FROM lineitem)
    SELECT o_orderkey AS order_id, o_orderstatus AS order_status, COUNT(order_id) AS items,
           CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS amount, COUNT(*) FILTER (returned) AS returned,
           COUNT(*) FILTER (CAST(l_shipdate AS DATE) > CAST(o_orderdate AS DATE) + 30) AS shipped_late
    FROM orders LEFT JOIN i ON order_id = o_orderkey GROUP BY ALL
    """,
)
def order_shares_bucketed(spark, folder):
    """Items and orders land in two loads each; what follows reads bucket by bucket and moves no rows."""
    base, buckets = shared_folder(spark, "buckets"), bucketed.bucket_count(table(spark, folder, "lineitem").count())
    placed = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status"), "o_orderdate"
    )
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        money(F.col("l_extendedprice")).alias("amount"),
        (F.col("l_returnflag") == "R").alias("returned"),
        "l_shipdate",
    )

    def landed(rows: DataFrame, kind: str) -> DataFrame:
        name = f"{kind}_{base.rsplit('-', 1)[-1]}"
        early = F.coalesce(F.col("order_id") % 2 == 0, F.lit(True))
        bucketed.store(rows.filter(early), name, f"{base}/{kind}", "order_id", buckets)
        return bucketed.store(rows.filter(~early), name, f"{base}/{kind}", "order_id", buckets, append=True)

    placed, items = landed(placed, "orders"), landed(items, "items")
    late = F.to_date("l_shipdate") > F.date_add(F.to_date("o_orderdate"), 30)
    of_order = orders.with_order(items, placed, ["o_orderdate"], hot=None)
    sums = of_order.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("amount").cast("double").alias("amount"),
        F.count_if("returned").alias("returned"),
        F.count_if(late).alias("shipped_late"),
    )
    counted = ["items", "amount", "returned", "shipped_late"]
    return placed.join(sums, "order_id", "left").select("order_id", "order_status", *counted).fillna(0, counted)
