"""Queries on duplicates, fingerprints, samples and data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.scalars import money
from daybook.operators import dims, quality, skew, tables
from daybook.plans.registry import day_text, query, table

# --- batches and duplicates: two halves of the orders that share a third ---


def _halves(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "orders").withColumn(
        "o_orderdate", day_text(F.col("o_orderdate"))
    )
    return rows.filter(F.col("o_orderkey") % 3 != 0), rows.filter(F.col("o_orderkey") % 3 != 1)


@query(
    "union_batches",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 3 <> 0
    UNION ALL
    SELECT o_orderkey, o_orderstatus, '-' FROM orders WHERE o_orderkey % 3 <> 1
    """,
)
def union_batches(spark, folder):
    first, second = _halves(spark, folder)
    both = tables.union_batches(first, second.drop("o_orderpriority"))
    return both.select(
        "o_orderkey", "o_orderstatus", F.coalesce("o_orderpriority", F.lit("-")).alias("o_orderpriority")
    )


@query(
    "dedupe_exact",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders
    """,
)
def dedupe_exact(spark, folder):
    return tables.drop_copies(tables.union_batches(*_halves(spark, folder)))


@query(
    "dedupe_by_key",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1
    """,
)
def dedupe_by_key(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return tables.first_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query(
    "duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
    GROUP BY ALL HAVING COUNT(*) > 1
    """,
)
def duplicate_keys(spark, folder):
    return tables.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fingerprint",
    """
    WITH parts AS (
      SELECT o_orderstatus, [CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'),
             CAST(o_orderkey AS VARCHAR), o_orderpriority, o_orderstatus,
             CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)] AS p
      FROM orders)
    SELECT o_orderstatus, COUNT(*) AS row_count,
           CAST(SUM(CAST('0x' || substr(md5(array_to_string(list_transform(p,
                lambda x: COALESCE(length(x) || ':' || x, '-')), '')), 1, 15) AS BIGINT)) AS VARCHAR)
             AS hash_sum
    FROM parts GROUP BY o_orderstatus
    """,
)
def fingerprint(spark, folder):
    rows = table(spark, folder, "orders").withColumns(
        {"o_orderdate": day_text(F.col("o_orderdate")), "o_totalprice": money(F.col("o_totalprice"))}
    )
    return tables.fingerprint(rows, ["o_orderstatus"]).withColumn(
        "hash_sum", F.col("hash_sum").cast("string")
    )


@query(
    "distinct_quarter",
    """
    SELECT COUNT(DISTINCT l_orderkey) AS distinct_count,
           CAST(COUNT(DISTINCT l_orderkey) // 4 AS BIGINT) AS quarter_count
    FROM lineitem
    """,
)
def distinct_quarter(spark, folder):
    return tables.distinct_and_quarter(table(spark, folder, "lineitem"), "l_orderkey")


@query(
    "hash_sample",
    """
    SELECT o_orderkey, o_custkey FROM orders
    QUALIFY row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|7'), o_orderkey)
            <= COUNT(*) OVER () // 4
    """,
)
def hash_sample(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return tables.sample_share(rows, ["o_orderkey"], 0.25, seed="7")


# --- row rules ---


def _lines_and_rules(spark, folder) -> tuple[DataFrame, dict[str, Column]]:
    lines = table(spark, folder, "lineitem").withColumn("o_orderkey", F.col("l_orderkey"))
    headers = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(headers, "o_orderkey")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    quantity = F.col("l_quantity").cast("decimal(6,0)")
    unit = F.round(price / quantity, 2).cast("decimal(12,2)")
    none = F.lit("0").cast("decimal(12,2)")
    rules = {
        "quantity_above_one": quality.not_positive(F.col("l_quantity") - 1),
        "flag_known": quality.outside(F.col("l_returnflag"), ["A", "N"]),
        "ships_after_order": quality.before(F.col("l_shipdate"), F.col("o_orderdate")),
        "line_total": quality.wrong_line_total(unit, quantity, none, price),
    }
    return joined, rules


BROKEN_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity <= 1 AS b1,
           l_returnflag NOT IN ('A', 'N') AS b2, l_shipdate < o_orderdate AS b3,
           abs(((2 * cents + q) // (2 * q)) * q - cents) > 1 AS b4
    FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
                 CAST(l_quantity AS BIGINT) AS q FROM lineitem) l
    JOIN orders ON o_orderkey = l_orderkey
"""


@query(
    "dq_report",
    f"""
    WITH b AS ({BROKEN_SQL})
    SELECT 'quantity_above_one' AS rule, COUNT(*) AS checked, COUNT(*) FILTER (b1) AS failed FROM b
    UNION ALL SELECT 'flag_known', COUNT(*), COUNT(*) FILTER (b2) FROM b
    UNION ALL SELECT 'ships_after_order', COUNT(*), COUNT(*) FILTER (b3) FROM b
    UNION ALL SELECT 'line_total', COUNT(*), COUNT(*) FILTER (b4) FROM b
    """,
)
def dq_report(spark, folder):
    return quality.report(*_lines_and_rules(spark, folder))


@query(
    "dq_quarantine",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           concat_ws(',', CASE WHEN b1 THEN 'quantity_above_one' END, CASE WHEN b2 THEN 'flag_known' END,
                     CASE WHEN b3 THEN 'ships_after_order' END, CASE WHEN b4 THEN 'line_total' END)
               AS failed_rules
    FROM ({BROKEN_SQL}) WHERE b1 OR b2 OR b3 OR b4
    """,
)
def dq_quarantine(spark, folder):
    _, bad = quality.split(*_lines_and_rules(spark, folder))
    return bad.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@query(
    "dq_clean",
    f"SELECT l_orderkey, l_linenumber, l_partkey FROM ({BROKEN_SQL}) WHERE NOT (b1 OR b2 OR b3 OR b4)",
)
def dq_clean(spark, folder):
    good, _ = quality.split(*_lines_and_rules(spark, folder))
    return good.select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "dq_domains",
    """
    WITH c AS (SELECT c_custkey, ['PL', 'DE', 'CZ', 'SK', 'LT', 'XX'][c_nationkey % 6 + 1] AS country,
                      ['PLN', 'EUR', 'CZK'][c_nationkey % 3 + 1] AS currency,
                      ['Berlin', 'Brno', 'Vilnius', 'Kraków'][c_custkey % 4 + 1] AS city FROM customer)
    SELECT c_custkey, country, currency, city,
           concat_ws(',', CASE WHEN country = 'XX' THEN 'country_known' END,
               CASE WHEN country <> 'XX' AND currency <> CASE country WHEN 'PL' THEN 'PLN'
                         WHEN 'CZ' THEN 'CZK' ELSE 'EUR' END THEN 'currency_of_country' END,
               CASE WHEN country <> 'XX' AND country <> CASE city WHEN 'Berlin' THEN 'DE'
                         WHEN 'Brno' THEN 'CZ' WHEN 'Vilnius' THEN 'LT' ELSE 'PL' END
                    THEN 'city_in_country' END) AS failed_rules
    FROM c
    """,
)
def dq_domains(spark, folder):
    def pick(values: list[str], number) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))

    nation = F.col("c_nationkey")
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        pick(["PL", "DE", "CZ", "SK", "LT", "XX"], nation).alias("country"),
        pick(["PLN", "EUR", "CZK"], nation).alias("currency"),
        pick(["Berlin", "Brno", "Vilnius", "Kraków"], F.col("c_custkey")).alias("city"),
    )
    country = F.col("country")
    rules = {
        "country_known": quality.unknown_country(country),
        "currency_of_country": quality.wrong_currency(F.col("currency"), country),
        "city_in_country": quality.wrong_city(F.col("city"), country),
    }
    checked = quality.check_rows(customers, rules)
    return checked.withColumn("failed_rules", F.array_join("failed_rules", ","))


# --- checks against another table ---


@query(
    "fk_semi",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
    """,
)
def fk_semi(spark, folder):
    headers = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return quality.with_parent(headers, table(spark, folder, "lineitem"), "o_orderkey", "l_orderkey")


@query(
    "fk_anti",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def fk_anti(spark, folder):
    headers = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return quality.without_parent(
        headers, table(spark, folder, "lineitem"), "o_orderkey", "l_orderkey"
    )


@query(
    "fk_orphan_customer",
    """
    SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey ELSE -1 END AS customer_id
    FROM orders
    WHERE o_custkey % 7 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)
    """,
)
def fk_orphan_customer(spark, folder):
    known = F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))
    headers = table(spark, folder, "orders").select("o_orderkey", known.alias("customer_id"))
    customers = table(spark, folder, "customer").filter("c_nationkey <> 3")
    hot = skew.hot_keys(headers, ["customer_id"], hot_rows=100, sample=1.0)
    orphans = quality.without_parent(headers, customers, "customer_id", "c_custkey", hot)
    return orphans.select(
        "o_orderkey", F.coalesce("customer_id", F.lit(-1)).cast("bigint").alias("customer_id")
    )


@query(
    "payment_amounts",
    """
    SELECT l_orderkey AS order_id, l_linenumber,
           CASE l_returnflag WHEN 'N' THEN 'captured' WHEN 'A' THEN 'failed' END AS payment_status
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_returnflag <> 'R'
          AND abs(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(o_totalprice AS DECIMAL(12,2))) > 20000
    """,
)
def payment_amounts(spark, folder):
    flag = F.col("l_returnflag")
    payments = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.when(flag == "N", "captured").when(flag == "A", "failed").otherwise("refunded")
        .alias("payment_status"),
    )
    wrong = quality.wrong_payment_amount(
        payments, _net_amounts(spark, folder), tolerance="20000", hot=None
    )
    return wrong.select("order_id", "l_linenumber", "payment_status")


def _net_amounts(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("net_amount"),
    )


@query(
    "excessive_refunds",
    """
    SELECT l_orderkey AS order_id, l_linenumber, l_partkey
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_returnflag = 'R'
          AND CAST(l_extendedprice AS DECIMAL(12,2)) > CAST(o_totalprice AS DECIMAL(12,2))
    """,
)
def excessive_refunds(spark, folder):
    refunds = (
        table(spark, folder, "lineitem")
        .filter("l_returnflag = 'R'")
        .select(
            F.col("l_orderkey").alias("order_id"),
            "l_linenumber",
            "l_partkey",
            F.col("l_extendedprice").cast("decimal(12,2)").alias("refund_amount"),
        )
    )
    wrong = quality.excessive_refund(refunds, _net_amounts(spark, folder), hot=None)
    return wrong.select("order_id", "l_linenumber", "l_partkey")


# --- whole tables ---


@query(
    "dq_completeness",
    """
    WITH f AS (SELECT DISTINCT CAST(ts AS DATE) AS d, event_type AS t FROM events
               WHERE NOT (event_type = 'signup' AND CAST(ts AS DATE) = DATE '2024-01-10')),
         e AS (SELECT CAST(unnest(generate_series(MIN(CAST(ts AS DATE)), MAX(CAST(ts AS DATE)),
                      INTERVAL 1 DAY)) AS DATE) AS d FROM events),
         x AS (SELECT d, unnest(['signup', 'view', 'click', 'purchase', 'error', 'refund']) AS t FROM e)
    SELECT strftime(d, '%Y-%m-%d') AS load_date, t AS table_name FROM (FROM x EXCEPT FROM f)
    """,
)
def dq_completeness(spark, folder):
    events = table(spark, folder, "events").select(
        F.to_date("ts").alias("load_date"), F.col("event_type").alias("table_name")
    )
    gap = (F.col("table_name") == "signup") & (F.col("load_date") == F.lit("2024-01-10").cast("date"))
    days = dims.days_spanned(events, F.col("load_date"), "load_date")
    groups = ["signup", "view", "click", "purchase", "error", "refund"]
    missing = quality.missing_days(events.filter(~gap), days, groups, "table_name", "load_date")
    return missing.select(day_text(F.col("load_date")).alias("load_date"), "table_name")


@query(
    "dq_schema",
    """
    WITH r AS (SELECT * FROM (VALUES ('orders', 'o_orderkey', TRUE), ('orders', 'o_totalprice', TRUE),
                                     ('orders', 'net_amount', FALSE), ('lineitem', 'l_orderkey', TRUE),
                                     ('lineitem', 'order_item_id', FALSE), ('events', 'ts', TRUE))
                             AS v(table_name, column_name, is_present)),
         n AS (SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders
               UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
               UNION ALL SELECT 'events', COUNT(*) FROM events)
    SELECT * FROM r JOIN n USING (table_name)
    """,
)
def dq_schema(spark, folder):
    required = {
        "orders": ["o_orderkey", "o_totalprice", "net_amount"],
        "lineitem": ["l_orderkey", "order_item_id"],
        "events": ["ts"],
    }
    parts = [
        quality.column_report(table(spark, folder, name), name, columns)
        for name, columns in required.items()
    ]
    return tables.union_batches(*parts)


