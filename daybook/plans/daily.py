"""Queries on load metadata, daily totals, calendar, landing and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.dates import arrival_date, calendar_columns, demand_factor, expected_orders, shifted
from daybook.functions.scalars import (
    landing_path,
    money,
    padded_key,
    page_url,
    product_name,
    surrogate_key,
)
from daybook.operators import dims, maintained, metadata, tables
from daybook.operators.orders import daily_totals
from daybook.plans.registry import day_text, query, table, time_text
from daybook.session import shared_folder
from daybook.sources import bronze, landing
from daybook.streaming import feeds


def campaign_day(moment: Column) -> Column:
    """The same weekday and date 28 years later: orders of 1998 fall into the campaign year 2026."""
    return (moment + F.expr("interval 28 years")).cast("date")


def _dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select(
        F.to_date("o_orderdate").alias("order_date"),
        money(F.col("o_totalprice")).alias("order_amount"),
    )


@query(
    "daily_order_totals",
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, COUNT(*) AS order_count,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS daily_order_amount
    FROM orders GROUP BY 1 ORDER BY 1
    """,
)
def daily_order_totals(spark, folder):
    return daily_totals(_dated_orders(spark, folder)).select(
        day_text(F.col("order_date")).alias("order_date"),
        "order_count",
        F.col("daily_order_amount").cast("double").alias("daily_order_amount"),
    )


@query(
    "daily_order_totals_sql",
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, COUNT(*) AS order_count,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_order_amount
    FROM orders GROUP BY 1 ORDER BY 1
    """,
)
def daily_order_totals_sql(spark, folder):
    view = bronze.as_view(
        metadata.with_audit(_dated_orders(spark, folder), "orders"), "bronze_orders"
    )
    return bronze.daily_totals_sql(spark, view).select(
        day_text(F.col("order_date")).alias("order_date"),
        "order_count",
        F.col("total_order_amount").cast("double").alias("total_order_amount"),
    )


@query(
    "bronze_audit",
    """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
           TRUE AS is_ingested, 'order_system' AS _source_system, 'bronze' AS _source_layer
    FROM orders
    """,
)
def bronze_audit(spark, folder):
    audited = metadata.with_audit(table(spark, folder, "orders"), "order_system")
    return audited.select(
        "o_orderkey",
        "o_custkey",
        day_text(F.col("o_orderdate")).alias("order_date"),
        F.col("_ingested_at").isNotNull().alias("is_ingested"),
        "_source_system",
        "_source_layer",
    )


def loaded_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events landed 0 to 3 days after they happened."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    delay = (F.col("event_id") % 4).cast("int")
    day = arrival_date(F.col("ts"), F.to_date("ts"), delay)
    loaded_at = shifted(day.cast("timestamp"), hours=(F.col("event_id") % 24).cast("int"))
    return metadata.with_load_metadata(events, day, F.col("ts"), loaded_at)


LOADED_SQL = """
    SELECT *, CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS load_date FROM events
"""


@query(
    "load_metadata",
    f"""
    SELECT event_id, strftime(load_date, '%Y-%m-%d') AS load_date,
           strftime(CAST(load_date AS TIMESTAMP) + to_hours(CAST(event_id % 24 AS INTEGER)),
                    '%Y-%m-%d %H:%M:%S.%f') AS loaded_at,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS source_event_at
    FROM ({LOADED_SQL})
    """,
)
def load_metadata(spark, folder):
    return loaded_events(spark, folder).select(
        "event_id",
        day_text(F.col("load_date")).alias("load_date"),
        time_text(F.col("loaded_at")).alias("loaded_at"),
        time_text(F.col("source_event_at")).alias("source_event_at"),
    )


@query(
    "due_split",
    f"""
    SELECT event_id, strftime(greatest(load_date, DATE '2024-01-15'), '%Y-%m-%d') AS load_date,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS source_event_at,
           load_date <= DATE '2024-01-15' AS is_due
    FROM ({LOADED_SQL})
    """,
)
def due_split(spark, folder):
    day = F.lit("2024-01-15").cast("date")
    due, waiting = metadata.split_due(loaded_events(spark, folder), "load_date", day)
    due = metadata.land_deferred(due, day).withColumn("is_due", F.lit(True))
    both = tables.union_batches(due, waiting.withColumn("is_due", F.lit(False)))
    return both.select(
        "event_id",
        day_text(F.col("load_date")).alias("load_date"),
        time_text(F.col("source_event_at")).alias("source_event_at"),
        "is_due",
    )


@query(
    "due_today",
    f"""
    SELECT event_id, event_type FROM ({LOADED_SQL})
    WHERE event_id % 4 = 0 OR load_date = DATE '2024-01-15'
    """,
)
def due_today(spark, folder):
    defer = F.when(F.col("event_id") % 4 != 0, F.col("load_date"))
    rows = loaded_events(spark, folder).withColumn("__defer_until__", defer)
    kept = metadata.due_on(rows, "__defer_until__", F.lit("2024-01-15").cast("date"))
    return metadata.without_internal(kept).select("event_id", "event_type")


@query(
    "late_arrivals",
    f"""
    SELECT strftime(load_date, '%Y-%m-%d') AS load_date, COUNT(*) AS row_count,
           COUNT(*) FILTER (WHERE event_id % 4 > 1) AS late_count,
           MAX(event_id % 4) AS max_lag_days
    FROM ({LOADED_SQL}) GROUP BY 1
    """,
)
def late_arrivals(spark, folder):
    late = metadata.with_lateness(loaded_events(spark, folder), grace_days=1)
    return metadata.lateness_by_day(late).select(
        day_text(F.col("load_date")).alias("load_date"),
        "row_count",
        "late_count",
        F.col("max_lag_days").cast("bigint").alias("max_lag_days"),
    )


@query(
    "rows_per_load_date",
    f"""
    SELECT strftime(load_date, '%Y-%m-%d') AS load_date, COUNT(*) AS row_count
    FROM ({LOADED_SQL}) GROUP BY 1
    """,
)
def rows_per_load_date(spark, folder):
    counts = tables.rows_per_load_date(loaded_events(spark, folder))
    return counts.withColumn("load_date", day_text(F.col("load_date")))


HOLIDAY_SQL = """
    CASE strftime(date_day, '%Y-%m-%d')
         WHEN '2026-01-01' THEN 'New Year''s Day' WHEN '2026-01-06' THEN 'Epiphany'
         WHEN '2026-04-05' THEN 'Easter Sunday' WHEN '2026-04-06' THEN 'Easter Monday'
         WHEN '2026-05-01' THEN 'Labour Day' WHEN '2026-05-03' THEN 'Constitution Day'
         WHEN '2026-12-25' THEN 'Christmas Day' WHEN '2026-12-26' THEN 'Second Day of Christmas'
    END
"""


@query(
    "calendar_dim",
    f"""
    WITH o AS (SELECT CAST(o_orderdate + INTERVAL 28 YEAR AS DATE) AS d FROM orders),
         span AS (SELECT CAST(unnest(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE)
                  AS date_day FROM o),
         n AS (SELECT d, COUNT(*) AS c FROM o GROUP BY d)
    SELECT strftime(date_day, '%Y-%m-%d') AS date_day, CAST(year(date_day) AS INTEGER) AS year,
           CAST(quarter(date_day) AS INTEGER) AS quarter, CAST(month(date_day) AS INTEGER) AS month,
           CAST(day(date_day) AS INTEGER) AS day_of_month,
           CAST(isodow(date_day) AS INTEGER) AS day_of_week, dayname(date_day) AS day_name,
           CAST(weekofyear(date_day) AS INTEGER) AS week_of_year, isodow(date_day) >= 6 AS is_weekend,
           {HOLIDAY_SQL} IS NOT NULL AS is_polish_public_holiday,
           COALESCE({HOLIDAY_SQL}, '') AS holiday_name, COALESCE(c, 0) AS order_count
    FROM span LEFT JOIN n ON n.d = date_day
    """,
)
def calendar_dim(spark, folder):
    ordered = table(spark, folder, "orders").select(
        campaign_day(F.col("o_orderdate")).alias("date_day")
    )
    days = dims.calendar(dims.days_spanned(ordered, F.col("date_day")))
    counts = ordered.groupBy("date_day").agg(F.count(F.lit(1)).alias("order_count"))
    return (
        days.join(counts, "date_day", "left")
        .fillna({"order_count": 0, "holiday_name": ""})
        .withColumn("date_day", day_text(F.col("date_day")))
        .select("date_day", *calendar_columns(F.col("date_day")), "order_count")
    )


@query(
    "demand_factor",
    """
    WITH o AS (SELECT CAST(o_orderdate + INTERVAL 28 YEAR AS DATE) AS d FROM orders), f AS (
    SELECT strftime(d, '%Y-%m-%d') AS order_date, COUNT(*) AS order_count,
             (CAST(CASE WHEN isodow(d) >= 5 THEN 1.35 ELSE 1 END AS DECIMAL(6,4))
              * CAST(CASE WHEN month(d) = 1 AND day(d) <= 21 THEN 1.15 ELSE 1 END AS DECIMAL(6,4))
              * CAST(CASE WHEN month(d) = 2 AND day(d) <= 16 THEN 1.10 ELSE 1 END AS DECIMAL(6,4))
              * CAST(CASE WHEN month(d) = 3 THEN 1.20 ELSE 1 END AS DECIMAL(6,4))
              * CAST(CASE WHEN d IN (DATE '2026-01-01', DATE '2026-01-06') THEN 0.65 ELSE 1 END
                     AS DECIMAL(6,4))) AS factor
    FROM o GROUP BY d)
    SELECT order_date, order_count, CAST(factor AS DOUBLE) AS factor,
           CAST(floor(80 * factor) AS INTEGER) AS expected_orders
    FROM f
    """,
)
def demand_by_day(spark, folder):
    orders = table(spark, folder, "orders")
    days = orders.groupBy(campaign_day(F.col("o_orderdate")).alias("d")).agg(
        F.count(F.lit(1)).alias("order_count")
    )
    return days.select(
        day_text(F.col("d")).alias("order_date"),
        "order_count",
        demand_factor(F.col("d")).alias("factor"),
        expected_orders(F.col("d"), 80).alias("expected_orders"),
    )


@query(
    "page_urls",
    """
    WITH e AS (SELECT event_id, CASE event_type WHEN 'signup' THEN 'page_view'
                    WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
                    WHEN 'error' THEN 'checkout_started' ELSE 'purchase_completed' END AS event_type,
                 CASE WHEN event_id % 5 > 0 THEN printf('SKU-%05d', user_id) END AS sku FROM events)
    SELECT event_id, event_type,
           CASE WHEN event_type IN ('product_view', 'add_to_cart') AND sku IS NOT NULL
                     THEN '/product/' || sku
                WHEN event_type = 'checkout_started' THEN '/checkout'
                WHEN event_type = 'purchase_completed' THEN '/checkout/success'
                ELSE '/' END AS page_url
    FROM e
    """,
)
def page_urls(spark, folder):
    kind = F.col("event_type")
    web_type = (
        F.when(kind == "signup", "page_view")
        .when(kind == "view", "product_view")
        .when(kind == "click", "add_to_cart")
        .when(kind == "error", "checkout_started")
        .otherwise("purchase_completed")
    )
    sku = F.when(F.col("event_id") % 5 > 0, padded_key("SKU-", F.col("user_id")))
    return table(spark, folder, "events").select(
        "event_id", web_type.alias("event_type"), page_url(web_type, sku).alias("page_url")
    )


@query(
    "product_keys",
    """
    SELECT p_partkey, printf('prod_%05d', p_partkey) AS product_id,
           printf('SKU-%05d', p_partkey) AS sku,
           p_brand || ' ' || upper(p_type[1]) || lower(p_type[2:]) || ' ' ||
           array_to_string(list_transform(string_split(p_name, ' '),
                           lambda w: upper(w[1]) || lower(w[2:])), ' ') AS product_name
    FROM part
    """,
)
def product_keys(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        padded_key("prod_", F.col("p_partkey")).alias("product_id"),
        padded_key("SKU-", F.col("p_partkey")).alias("sku"),
        product_name(F.col("p_brand"), F.col("p_type"), F.col("p_name")).alias("product_name"),
    )


@query(
    "surrogate_keys",
    """
    WITH o AS (SELECT *, CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c FROM orders)
    SELECT o_orderkey, 'ord_' || substr(md5(length(k) || ':' || k), 1, 12) AS order_id,
           'evt_' || substr(md5(length(c) || ':' || c || length(o_orderstatus) || ':' || o_orderstatus), 1, 16)
             AS event_id,
           md5(length(k) || ':' || k) AS full_id
    FROM o
    """,
)
def surrogate_keys(spark, folder):
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        surrogate_key("ord_", key, length=12).alias("order_id"),
        surrogate_key("evt_", F.col("o_custkey"), F.col("o_orderstatus"), length=16).alias("event_id"),
        surrogate_key("", key).alias("full_id"),
    )


# --- landing: whole tables out to daily folders and back ---


def _landed_orders(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Write the orders as a landed table by month and return its root and schema."""
    orders = table(spark, folder, "orders")
    rows = orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        money(F.col("o_totalprice")).alias("net_amount"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
        F.col("o_orderstatus").alias("__status"),
        F.trunc("o_orderdate", "MM").alias("load_date"),
    )
    root = shared_folder(spark, "landing")
    landing.write_table(rows, root, "orders")
    return root, metadata.without_internal(rows).schema


LANDED_SQL = """
    SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
           CAST(o_totalprice AS DOUBLE) AS net_amount,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '-' END AS priority,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS load_date
    FROM orders
"""


def _read_landed(spark: SparkSession, root: str, schema) -> DataFrame:
    rows = landing.read_table(spark, root, "orders", schema, load_date_in_file=False)
    return rows.select(
        "o_orderkey",
        "o_custkey",
        time_text(F.col("created_at")).alias("created_at"),
        F.col("net_amount").cast("double").alias("net_amount"),
        F.coalesce("priority", F.lit("-")).alias("priority"),
        day_text(F.col("load_date")).alias("load_date"),
    )


@query("landing_roundtrip", LANDED_SQL)
def landing_roundtrip(spark, folder):
    return _read_landed(spark, *_landed_orders(spark, folder))


@query("landing_copy", LANDED_SQL)
def landing_copy(spark, folder):
    root, schema = _landed_orders(spark, folder)
    lake = shared_folder(spark, "lake")
    landing.land_files(spark, root, lake)
    return _read_landed(spark, f"{lake}/bronze/landing", schema)


@query(
    "landing_keep_days",
    f"""
    SELECT * REPLACE (CASE WHEN load_date >= '1998-01-01' THEN 'again' ELSE priority END AS priority)
    FROM ({LANDED_SQL})
    """,
)
def landing_keep_days(spark, folder):
    root, schema = _landed_orders(spark, folder)
    rows = landing.read_table(spark, root, "orders", schema, load_date_in_file=False)
    again = rows.filter("load_date >= '1998-01-01'").withColumn("priority", F.lit("again"))
    target = shared_folder(spark, "landing")
    landing.write_table(rows, target, "orders")
    landing.write_table(again, target, "orders", clean=False)
    return _read_landed(spark, target, schema)


def _raw_orders(spark: SparkSession, folder: str) -> str:
    """Write the orders as raw files by month, which carry load_date themselves, and return their root."""
    moment = shifted(F.col("o_orderdate").cast("timestamp"), minutes=90)
    amount = money(F.col("o_totalprice"))
    values = {
        "order_id": F.concat(F.lit("ord_"), F.col("o_orderkey").cast("string")),
        "customer_id": F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")),
        "order_status": F.lit("created"),
        "order_created_at": moment,
        "order_updated_at": moment,
        "country_code": F.lit("PL"),
        "currency": F.lit("PLN"),
        "gross_amount": amount,
        "discount_amount": amount - amount,
        "net_amount": amount,
        "source_channel": F.lit("direct"),
        "campaign_id": F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")),
        "load_date": F.trunc("o_orderdate", "MM"),
        "loaded_at": moment,
        "source_event_at": moment,
    }
    rows = table(spark, folder, "orders").select(*[v.alias(name) for name, v in values.items()])
    root = shared_folder(spark, "raw")
    (
        rows.withColumn("day", F.col("load_date"))
        .hint("rebalance", "day")
        .write.partitionBy("day")
        .option("header", True)
        .option("timestampFormat", landing.TIMESTAMP_FORMAT)
        .csv(f"{root}/orders")
    )
    return root


@query(
    "bronze_orders",
    """
    SELECT 'ord_' || o_orderkey AS order_id, 'cust_' || o_custkey AS customer_id,
           strftime(o_orderdate + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS source_event_at,
           CAST(o_totalprice AS DOUBLE) AS net_amount,
           COALESCE(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END, '') AS campaign_id,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS load_date,
           'landing' AS _source_system, TRUE AS is_readable
    FROM orders
    """,
)
def bronze_orders(spark, folder):
    """Raw order files that carry load_date themselves, taken to bronze Parquet."""
    root = _raw_orders(spark, folder)
    loaded = bronze.load_bronze(spark, root, shared_folder(spark, "bronze"), "orders")
    return loaded.select(
        "order_id",
        "customer_id",
        time_text(F.col("source_event_at")).alias("source_event_at"),
        F.col("net_amount").cast("double").alias("net_amount"),
        F.coalesce("campaign_id", F.lit("")).alias("campaign_id"),
        day_text(F.col("load_date")).alias("load_date"),
        "_source_system",
        F.col(landing.CORRUPT).isNull().alias("is_readable"),
    )


@query(
    "landing_manifest",
    """
    WITH m AS (SELECT date_trunc('month', o_orderdate) AS month,
                      octet_length(encode(o_orderkey || chr(10))) AS bytes FROM orders)
    SELECT 'bronze/landing/orders/load_date=' || strftime(month, '%Y-%m-%d') AS target_folder,
           COUNT(DISTINCT month) AS files, CAST(SUM(bytes) + length('o_orderkey') + 1 AS BIGINT) AS bytes
    FROM m GROUP BY month
    """,
)
def landing_manifest(spark, folder):
    """Files and bytes per folder; each month is one file with a header and a key per line."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.trunc("o_orderdate", "MM").alias("load_date"))
    root = shared_folder(spark, "landing")
    orders.repartition("load_date").write.partitionBy("load_date").option("header", True).csv(f"{root}/orders")
    files = landing.manifest(spark, root, prefix="bronze/landing/")
    return files.groupBy(F.regexp_replace("target_path", "/[^/]*$", "").alias("target_folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_length").alias("bytes")
    )


@query(
    "landing_paths",
    """
    SELECT page_id, 'bronze/landing/pages/' || page_id || '.csv' AS target_path FROM pages
    """,
)
def landing_paths(spark, folder):
    file = F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".csv"))
    return table(spark, folder, "pages").select(
        "page_id", landing_path("bronze/landing//", file).alias("target_path")
    )


@query(
    "deferred_by_runs",
    f"""
    WITH loaded AS ({LOADED_SQL}), runs(run, before) AS (
      VALUES (DATE '2024-01-05', DATE '1900-01-01'), (DATE '2024-01-12', DATE '2024-01-05'), (DATE '2024-02-05', DATE '2024-01-12'))
    SELECT event_id, strftime(run, '%Y-%m-%d') AS load_date, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS source_event_at
    FROM loaded JOIN runs ON greatest(load_date, CASE WHEN ts >= '2024-01-12' THEN DATE '2024-01-12' + 1 ELSE load_date END) <= run
         AND greatest(load_date, CASE WHEN ts >= '2024-01-12' THEN DATE '2024-01-12' + 1 ELSE load_date END) > before
    """,
)
def deferred_by_runs(spark, folder):
    """Events wait in a queue for their load day; three runs take them, the second one twice.

    Events from 12 January on are put in between the two takes of the second run, and wait for the third.
    """
    queue = shared_folder(spark, "queue")
    events = loaded_events(spark, folder)
    later = F.col("ts") >= "2024-01-12"
    taken = []
    maintained.defer(events.filter(~later), queue, "first", F.col("load_date"))
    for run in ("2024-01-05", "2024-01-12"):
        taken.append((run, maintained.take_due(spark, queue, run)))
    maintained.defer(events.filter(later), queue, "second", F.col("load_date"))
    for run in ("2024-01-12", "2024-02-05"):
        taken.append((run, maintained.take_due(spark, queue, run)))
    # Of the run that took twice, what it took the second time.
    rows = [metadata.land_deferred(due, F.lit(run)) for run, due in (taken[0], *taken[2:])]
    return tables.union_batches(*rows).select(
        "event_id",
        day_text(F.col("load_date")).alias("load_date"),
        time_text(F.col("source_event_at")).alias("source_event_at"),
    )


@query(
    "path_positions",
    """
    SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS load_date,
           row_number() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderkey) AS line_number,
           row_number() OVER (ORDER BY date_trunc('month', o_orderdate), o_orderkey) AS position
    FROM orders
    """,
)
def path_positions(spark, folder):
    """Where each landed line stands: in its file, and in all files one after the other in path order."""
    root = shared_folder(spark, "raw")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("source"), F.trunc("o_orderdate", "MM").alias("day")
    )
    cells = {name: F.lit(None).cast("string") for name in ("rate_date", "currency", "rate_to_pln")}
    cells |= {"source": F.col("source"), "load_date": F.col("day").cast("string"), "loaded_at": cells["currency"]}
    lines = orders.select(*[cell.alias(name) for name, cell in cells.items()], "day").repartition("day")
    lines = lines.sortWithinPartitions("day", F.col("source").cast("bigint"))
    lines.write.partitionBy("day").option("header", True).csv(f"{root}/exchange_rates")
    rows = landing.with_positions(spark, root, "exchange_rates")
    return rows.select(
        F.col("source").cast("bigint").alias("o_orderkey"),
        day_text(F.col("load_date")).alias("load_date"),
        "line_number",
        "position",
    )


# --- streams: each reads the events table as a file stream until it is caught up ---


def _event_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The events table as a stream of its files, be it one file or a folder of them."""
    # A stream takes a folder or a pattern, not the path of a file.
    path = f"{folder.rstrip('/')}/events.parque[t]"
    stream = spark.readStream.schema(table(spark, folder, "events").schema)
    rows = stream.option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("load_date", F.to_date("ts"))


@query(
    "stream_ingest",
    """
    SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS load_date,
           'event_system' AS _source_system
    FROM events
    """,
)
def stream_ingest(spark, folder):
    base = shared_folder(spark, "stream-ingest")
    stream = _event_stream(spark, folder)
    feeds.ingest(stream, f"{base}/table", f"{base}/checkpoint", "event_system").awaitTermination()
    return spark.read.parquet(f"{base}/table").select(
        "event_id",
        "user_id",
        "event_type",
        day_text(F.col("load_date")).alias("load_date"),
        "_source_system",
    )


@query(
    "stream_dedupe",
    "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events",
)
def stream_dedupe(spark, folder):
    base = shared_folder(spark, "stream-dedupe")
    stream = _event_stream(spark, folder)
    copies = F.when(F.col("event_id") % 10 == 0, 3).otherwise(1)
    repeated = stream.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")
    feeds.without_repeats(repeated, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{base}/table")
    return rows.select("event_id", "user_id", "event_type", time_text(F.col("ts")).alias("ts"))


@query(
    "stream_daily",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS order_date, COUNT(*) AS row_count,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM events GROUP BY 1
    """,
)
def stream_daily(spark, folder):
    base = shared_folder(spark, "stream-daily")
    stream = _event_stream(spark, folder).withColumn("value", money(F.col("value")))
    feeds.daily_totals(stream, "ts", "value", f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return feeds.totals(spark, f"{base}/table").select(
        day_text(F.col("order_date")).alias("order_date"),
        "row_count",
        F.col("total_amount").cast("double").alias("total_amount"),
    )


@query(
    "stream_closed_days",
    """
    WITH m AS (SELECT MAX(ts) - INTERVAL 4 DAY AS watermark FROM events)
    SELECT strftime(ts, '%Y-%m-%d') AS order_date, COUNT(*) AS row_count,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM events, m GROUP BY 1, watermark, CAST(ts AS DATE)
    HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= watermark
    """,
)
def stream_closed_days(spark, folder):
    base = shared_folder(spark, "stream-closed")
    stream = _event_stream(spark, folder).withColumn("value", money(F.col("value")))
    feeds.daily_totals(stream, "ts", "value", f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return feeds.closed_days(spark, f"{base}/table").select(
        day_text(F.col("order_date")).alias("order_date"),
        "row_count",
        F.col("total_amount").cast("double").alias("total_amount"),
    )


@query(
    "stream_landing",
    """
    SELECT 'ord_' || o_orderkey AS order_id, CAST(o_totalprice AS DOUBLE) AS net_amount,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS load_date, 'bronze' AS _source_layer
    FROM orders
    """,
)
def stream_landing(spark, folder):
    """Landed CSV files, some of them per batch, ingested once each."""
    base = shared_folder(spark, "stream-landing")
    stream = feeds.landing_stream(spark, _raw_orders(spark, folder), "orders", files_per_batch=20)
    feeds.ingest(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select(
        "order_id",
        F.col("net_amount").cast("double").alias("net_amount"),
        day_text(F.col("load_date")).alias("load_date"),
        "_source_layer",
    )


# Events landed 0 to 6 days after they happened; every tenth lands twice more, a day later each time.
WAVES = 3
LANDED_SQL = """
    landed AS (
      SELECT event_id, user_id, ts, CAST(ts AS DATE) AS order_date, CAST(value AS DECIMAL(18,2)) AS value,
             CAST(ts AS DATE) + CAST(event_id % 7 + k AS INTEGER) AS load_date
      FROM events, range(3) c(k) WHERE k = 0 OR event_id % 10 = 0),
    on_time AS (SELECT * FROM landed WHERE load_date - order_date <= 4),
    w AS (SELECT MAX(ts) - INTERVAL 4 DAY AS watermark FROM on_time)
"""


def _landed_in_waves(spark: SparkSession, folder: str, name: str, *runs) -> str:
    """Land events in waves of load days, run each stream after each wave; returns the base folder.

    ``runs`` take the stream, a target and a checkpoint, and return the started query.
    """
    base = shared_folder(spark, name)
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    copies = F.sequence(F.lit(0), F.when(F.col("event_id") % 10 == 0, 2).otherwise(0))
    rows = events.select("event_id", "user_id", "ts", money(F.col("value")).alias("value"), F.explode(copies).alias("copy"))
    delay = (F.col("event_id") % 7 + F.col("copy")).cast("int")
    rows = rows.withColumn("load_date", F.date_add(F.to_date("ts"), delay)).drop("copy")
    first, last = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    span = ((last - first).days + 9) // WAVES + 1 if first else 1
    wave = F.floor(F.datediff("load_date", F.lit(first)) / span)
    for number in range(WAVES):
        rows.filter(wave == number).write.mode("append").parquet(f"{base}/landed")
        for place, run in enumerate(runs):
            stream = spark.readStream.schema(rows.schema).parquet(f"{base}/landed")
            feeds.finished(run(stream, f"{base}/table{place}", f"{base}/checkpoint{place}"))
    return base


@query(
    "stream_first_copies",
    f"""
    WITH {LANDED_SQL}
    SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, strftime(MIN(load_date), '%Y-%m-%d') AS load_date
    FROM on_time, w WHERE order_date + INTERVAL 1 DAY <= watermark GROUP BY event_id, user_id, ts
    """,
)
def stream_first_copies(spark, folder):
    """Copies land in other batches than the first; each closed day's events are there once."""
    base = _landed_in_waves(
        spark, folder, "stream-first", lambda stream, target, state: feeds.first_copies(stream, target, state, "ts", ["event_id"])
    )
    rows = spark.read.parquet(f"{base}/table0")
    return rows.select(
        "event_id", "user_id", time_text(F.col("ts")).alias("ts"), day_text(F.col("load_date")).alias("load_date")
    )


@query(
    "stream_late_rows",
    f"""
    WITH {LANDED_SQL}
    SELECT event_id, strftime(load_date, '%Y-%m-%d') AS load_date, 'late' AS reason,
           CAST(load_date - order_date AS INTEGER) AS lag_days
    FROM landed WHERE load_date - order_date > 4
    """,
)
def stream_late_rows(spark, folder):
    base = _landed_in_waves(
        spark, folder, "stream-late", lambda stream, target, state: feeds.kept_aside(stream, target, state, "ts", key=["event_id"])
    )
    lag = F.datediff("load_date", F.to_date("ts"))
    rows = spark.read.parquet(f"{base}/table0")
    return rows.select("event_id", day_text(F.col("load_date")).alias("load_date"), "reason", lag.alias("lag_days"))


@query(
    "stream_late_counts",
    f"""
    WITH {LANDED_SQL}
    SELECT strftime(order_date, '%Y-%m-%d') AS order_date, COUNT(*) FILTER (load_date - order_date <= 4) AS row_count,
           CAST(SUM(value) FILTER (load_date - order_date <= 4) AS DOUBLE) AS total_amount,
           COUNT(*) FILTER (load_date - order_date > 4) AS late_count
    FROM landed GROUP BY 1
    """,
)
def stream_late_counts(spark, folder):
    """Totals by batch, with the late rows of each day counted apart."""
    base = _landed_in_waves(
        spark, folder, "stream-counts", lambda stream, target, state: feeds.daily_totals(stream, "ts", "value", target, state)
    )
    return feeds.totals(spark, f"{base}/table0").select(
        day_text(F.col("order_date")).alias("order_date"),
        "row_count",
        F.col("total_amount").cast("double").alias("total_amount"),
        "late_count",
    )


@query(
    "stream_window_totals",
    f"""
    WITH {LANDED_SQL},
    sums AS (SELECT order_date, COUNT(*) AS row_count, CAST(SUM(value) AS DOUBLE) AS total_amount FROM on_time GROUP BY 1)
    SELECT 'complete' AS mode, strftime(order_date, '%Y-%m-%d') AS order_date, row_count, total_amount FROM sums
    UNION ALL
    SELECT 'append', strftime(order_date, '%Y-%m-%d'), row_count, total_amount
    FROM sums, w WHERE order_date + INTERVAL 1 DAY <= watermark
    """,
)
def stream_window_totals(spark, folder):
    """Day windows of on-time rows: closed ones as appended once, and all of them as kept current."""
    base = _landed_in_waves(
        spark,
        folder,
        "stream-windows",
        lambda stream, target, state: feeds.closed_totals(stream, target, state, "ts", "value"),
        lambda stream, target, state: feeds.current_totals(stream, target, state, "ts", "value"),
    )
    closed = spark.read.parquet(f"{base}/table0").withColumn("mode", F.lit("append"))
    current = feeds.latest(spark, f"{base}/table1").withColumn("mode", F.lit("complete"))
    return tables.union_batches(closed, current).select(
        "mode",
        day_text(F.col("order_date")).alias("order_date"),
        "row_count",
        F.col("total_amount").cast("double").alias("total_amount"),
    )


@query(
    "landing_file_count",
    """
    SELECT count(DISTINCT date_trunc('month', o_orderdate)) AS files_found,
           count(DISTINCT date_trunc('month', o_orderdate)) AS files_landed
    FROM orders
    """,
)
def landing_file_count(spark, folder):
    """How many files the landing copy finds and lands; each month is written by one task as one file."""
    orders = table(spark, folder, "orders").withColumn("load_date", F.trunc("o_orderdate", "MM"))
    root = shared_folder(spark, "landing")
    orders.repartition("load_date").write.partitionBy("load_date").option("header", True).csv(f"{root}/orders")
    landed = landing.land_files(spark, root, shared_folder(spark, "lake"))
    found = landing.manifest(spark, root).agg(F.count(F.lit(1)).alias("files_found"))
    return found.withColumn("files_landed", F.lit(landed).cast("bigint"))


@query(
    "bronze_reload",
    """
    SELECT o_orderkey AS line, CASE WHEN o_orderkey % 2 = 0 THEN '2026-01-02' ELSE '2026-01-03' END AS landed_day,
           CASE WHEN o_orderkey % 7 = 0 THEN 'none'
                WHEN (o_orderkey % 7 = 1) = (o_orderkey % 2 = 0) THEN '2026-01-03' ELSE '2026-01-02' END AS load_date,
           o_orderkey % 7 = 0 AS is_broken
    FROM orders
    """,
)
def bronze_reload(spark, folder):
    """Two days loaded one after the other, each with broken lines and with lines of the other day."""
    root, target = shared_folder(spark, "raw"), shared_folder(spark, "bronze")
    orders = table(spark, folder, "orders").select("o_orderkey")
    key, days = F.col("o_orderkey"), ("2026-01-02", "2026-01-03")
    for rest, day in enumerate(days):
        said = F.when(key % 7 == 0, "broken").when(key % 7 == 1, days[1 - rest]).otherwise(day)
        cells = {
            "rate_date": F.lit(day),
            "currency": F.lit("EUR"),
            "rate_to_pln": F.lit("4.3200"),
            "source": key.cast("string"),
            "load_date": said,
            "loaded_at": F.lit(f"{day} 01:00:00"),
        }
        lines = orders.filter(key % 2 == rest).select(*[cell.alias(name) for name, cell in cells.items()])
        lines.write.option("header", True).csv(f"{root}/exchange_rates/load_date={day}")
        loaded = bronze.load_bronze(spark, root, target, "exchange_rates", days=[day])
    return loaded.select(
        F.col("source").cast("bigint").alias("line"),
        day_text(F.col("landed_day")).alias("landed_day"),
        F.coalesce(day_text(F.col("load_date")), F.lit("none")).alias("load_date"),
        F.col(landing.CORRUPT).isNotNull().alias("is_broken"),
    )
