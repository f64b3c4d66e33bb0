"""From the landing zone to daily totals: bronze, checks, current state, order facts, totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import orders as O
from daybook.operators import quality as Q
from daybook.operators.dims import days_spanned
from daybook.operators.metadata import lateness_by_day, usual_grace, with_lateness
from daybook.operators.orders import shipment_outcome, with_delivery_delay
from daybook.operators.skew import apart, hashed_side, hot_keys, latest_per_key, repeated_keys
from daybook.operators.state import item_prices, version_history
from daybook.operators.tables import count_copies, duplicate_keys, first_per_key, union_batches
from daybook.schemas import KEYS, REQUIRED, TABLES, VERSIONED
from daybook.session import STEPWISE, STORED, held, side_by_side
from daybook.sources.bronze import load_bronze
from daybook.sources.landing import CORRUPT, FILES, LANDED_DAY

# child, its key, parent, the parent's key
REFERENCES = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("refunds", "payment_id", "payments", "payment_id"),
]
UNIQUE = {
    "payments": ["payment_id"],
    "web_events": ["event_id"],
    "orders": ["order_id", "order_updated_at"],
}
FACTS = ["orders", "order_items", "payments", "shipments", "refunds", "web_events"]
# Campaigns come with the first load only.
DAILY = [t for t in TABLES if t != "marketing_campaigns"]
AUDIT = ["_ingested_at", "_source_system", "_source_layer"]
NATURAL_KEYS = KEYS | {t: keys for t, (keys, _) in VERSIONED.items()}
# Attributes whose changes open a new version.
HISTORY = {
    "customers": ["country_code", "city", "customer_status", "marketing_consent"],
    "products": ["product_name", "category", "brand", "unit_price", "currency", "is_active"],
}
# Prices of twice as many items and more are found in several runs, each with a share of them.
ITEMS_AT_ONCE = 25_000_000
MOST_RUNS = 4
ROW_RULES = {
    "order_items": Q.item_rules,
    "orders": Q.order_rules,
    "customers": Q.customer_rules,
    "shipments": Q.shipment_rules,
}


def bronze_tables(
    spark: SparkSession, landing: str, bronze: str, days: Sequence[str] | None = None, files: str = FILES
) -> dict[str, DataFrame]:
    load = partial(load_bronze, spark, landing, bronze, days=days, files=files)
    return side_by_side(spark, {t: partial(load, t) for t in TABLES})


def repeated(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame | None]:
    """Natural keys that several rows of a table have, by their hashes; None where they are many."""
    return side_by_side(spark, {t: partial(repeated_keys, df, NATURAL_KEYS[t]) for t, df in tables.items()})


def row_rules(table: str) -> dict[str, Column]:
    """The row rules of a table; every table has to have readable lines."""
    rules = ROW_RULES[table]() if table in ROW_RULES else {}
    other_day = F.coalesce(F.col("load_date") != F.col(LANDED_DAY), F.lit(False))
    return rules | {"line_readable": F.col(CORRUPT).isNotNull(), "load_date_of_folder": other_day}


def checked_table(bronze: DataFrame, table: str, repeated: DataFrame | None = None) -> DataFrame:
    """Distinct bronze rows with copy_count and the rules each one breaks."""
    rows = count_copies(bronze.drop(*AUDIT), keys=NATURAL_KEYS[table], repeated=repeated)
    return Q.check_rows(rows, row_rules(table))


def quality_report(
    checked: dict[str, DataFrame],
    clean: dict[str, DataFrame],
    repeated: dict[str, DataFrame | None] | None = None,
) -> DataFrame:
    """table_name, rule, checked, failed over row rules, copies, keys, references and amounts.

    Payments and refunds are compared with the latest version of their order, be it in quarantine or
    not; those of an order that was never landed count as not comparable.
    """
    no_copies = {"no_copies": F.col("copy_count") > 1}
    row_reports = [
        Q.report(rows, Q.as_rules(list(row_rules(t))) | no_copies).select(
            F.lit(t).alias("table_name"), "*"
        )
        for t, rows in checked.items()
    ]
    repeated = repeated or {}
    count = F.count(F.lit(1))
    # A parent in quarantine is still a parent. Payments meet their orders below.
    failures = {
        (child, f"{key}_exists"): Q.without_parent(
            clean[child], hashed_side(checked[parent].select(parent_key)), key, parent_key
        )
        for child, key, parent, parent_key in REFERENCES
        if (child, parent) != ("payments", "orders")
    }
    counted = {key: rows.agg(count.alias("failed")) for key, rows in failures.items()}
    landed_orders = latest_per_key(
        checked["orders"].select("order_id", "order_updated_at", "loaded_at", "net_amount"),
        *VERSIONED["orders"],
        repeated.get("orders"),
    )
    wrong_amount = Q.is_due() & Q.differs(F.col("amount"), F.col("net_amount"))
    excessive = F.col("refund_amount") > F.col("net_amount")
    # An order without any row is missing for either rule, so each table is joined once.
    for t, rule, broken, missing in (
        ("payments", "amount_of_order", wrong_amount, ["order_id_exists", "order_comparable"]),
        ("refunds", "within_order", excessive, ["order_comparable"]),
    ):
        compared = Q.against_order(clean[t], landed_orders, broken)
        named = {rule: "broken"} | {name: "without" for name in missing}
        lines = [F.struct(F.lit(r).alias("rule"), F.col(c).alias("failed")) for r, c in named.items()]
        counted[t, None] = compared.select(F.inline(F.array(*lines)))
    for t, keys in UNIQUE.items():
        rows = F.coalesce(F.sum("row_count"), F.lit(0)).alias("failed")
        # Rows of one of these keys have one natural key as well.
        several = clean[t] if repeated.get(t) is None else apart(clean[t], NATURAL_KEYS[t], repeated[t])[1]
        counted[t, "unique_key"] = duplicate_keys(several, keys).agg(rows)
    failed = [
        rows.select(F.lit(t).alias("table_name"), (F.lit(rule) if rule else F.col("rule")).alias("rule"), "failed")
        for (t, rule), rows in counted.items()
    ]
    sizes = [
        clean[t].agg(count.alias("checked")).select(F.lit(t).alias("table_name"), "checked")
        for t in dict.fromkeys(t for t, _ in counted)
    ]
    across = union_batches(*failed).join(union_batches(*sizes), "table_name")
    return union_batches(*row_reports, across)


def lateness_report(clean: dict[str, DataFrame]) -> DataFrame:
    """Rows, late rows and longest lag per fact table and load date."""
    return union_batches(
        *[
            lateness_by_day(with_lateness(clean[t], usual_grace(t))).withColumn("table_name", F.lit(t))
            for t in FACTS
        ]
    )


def column_report(bronze: dict[str, DataFrame]) -> DataFrame:
    """Required columns of each table that has some, with the table's row count."""
    return union_batches(*[Q.column_report(bronze[t], t, names) for t, names in REQUIRED.items()])


def missing_days(bronze: dict[str, DataFrame], expected: Sequence[str] | None = None) -> DataFrame:
    """Expected days on which a daily table has no rows.

    ``expected`` lists the days (ISO dates) that should have landed. Without it they are those from the
    first to the last day found, which cannot tell that the last one is missing.
    """
    found = union_batches(
        *[
            bronze[t].select(F.col(LANDED_DAY).alias("load_date")).distinct().withColumn("table_name", F.lit(t))
            for t in DAILY
        ]
    )
    if expected is None:
        days = days_spanned(found, F.col("load_date"), "load_date")
    else:
        listed = found.sparkSession.createDataFrame([(day,) for day in expected], "load_date string")
        days = listed.select(F.col("load_date").cast("date"))
    return Q.missing_days(found, days, DAILY, "table_name", "load_date")


def current_tables(
    clean: dict[str, DataFrame],
    checked: dict[str, DataFrame],
    repeated: dict[str, DataFrame | None] | None = None,
) -> dict[str, DataFrame]:
    """One row per natural key: the latest version, or the first landing of a single-version row.

    ``newer_in_quarantine`` tells of a versioned row that a later version of its key was held back.
    """
    repeated = repeated or {}
    current = dict(clean)
    for name, (keys, version) in VERSIONED.items():
        landed, rows = checked[name].select(*keys, *version, "failed_rules"), clean[name]
        if (known := repeated.get(name)) is not None:
            landed, (single, rows) = apart(landed, keys, known)[1], apart(rows, keys, known)
        landed = latest_per_key(landed, keys, version)
        held_back = landed.select(*keys, (F.size("failed_rules") > 0).alias("newer_in_quarantine"))
        current[name] = latest_per_key(rows, keys, version).join(held_back, keys)
        if known is not None:
            # The only row of its key is in quarantine or current.
            single = single.dropna(subset=keys).withColumn("newer_in_quarantine", F.lit(False))
            current[name] = single.select(*current[name].columns).unionByName(current[name])
    for name, keys in KEYS.items():
        current[name] = first_per_key(clean[name], keys, ["load_date", "loaded_at"], repeated.get(name))
    return current


def prices_in_runs(
    items: DataFrame, products: DataFrame, repeated: DataFrame | None = None
) -> Iterator[DataFrame]:
    """``item_prices`` of shares of the stored items, which together are all of them.

    Items are wide and go to their products by a shuffle. Run one after the other, only one share of them is in
    shuffle files at a time. A share is a number of files, so each is read once; the products are read in each run,
    of which there are at most ``MOST_RUNS``.
    """
    runs = min(MOST_RUNS, max(1, items.count() // ITEMS_AT_ONCE))
    hot = hot_keys(items, ["product_id"])
    for number in range(runs):
        run_of = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(runs))
        share = items.filter(run_of == number) if runs > 1 else items
        yield item_prices(share, products, hot, repeated)


def run(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    days: Sequence[str] | None = None,
    expected_days: Sequence[str] | None = None,
    files: str = FILES,
    loaded: Callable[[], None] | None = None,
) -> dict[str, DataFrame]:
    """Build the warehouse below ``warehouse`` and return its result tables.

    With ``days`` only those days are taken from the landing zone, checked and written; earlier ones
    are in bronze and in ``checked`` already and stay as they are. ``expected_days`` are the days that
    should have landed by now, by default ``days``, and without both all from the first to the last.
    ``files`` is the pattern of the landed files' names. ``loaded`` is called once bronze is written; from then on
    nothing is read from the landing zone.

    Every step that feeds several others is a written table, so a lost executor repeats a
    task and not the chain before it. Shuffle files go with the query that made them.
    """
    with held(spark, STEPWISE):
        return _run(spark, landing, warehouse, days, expected_days, files, loaded)


def _run(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    days: Sequence[str] | None,
    expected_days: Sequence[str] | None,
    files: str,
    loaded: Callable[[], None] | None,
) -> dict[str, DataFrame]:
    base = warehouse.rstrip("/")

    def stored(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        df.write.mode(mode).options(**STORED).parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    def stored_days(df: DataFrame, name: str) -> DataFrame:
        """Rewrite the days that landed now and return all."""
        touched = df if days is None else df.filter(F.col(LANDED_DAY).isin(*map(date.fromisoformat, days)))
        writer = touched.write.mode("overwrite").options(**STORED).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(LANDED_DAY).parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    bronze = bronze_tables(spark, landing, f"{base}/bronze", days, files)
    if loaded is not None:
        loaded()
    several = repeated(spark, bronze)
    checked = side_by_side(
        spark, {t: partial(stored_days, checked_table(df, t, several[t]), f"checked/{t}") for t, df in bronze.items()}
    )
    if days is not None:
        # Checked rows of earlier days need not be those of bronze.
        several = repeated(spark, checked)
    pieces = {t: Q.split_checked(df) for t, df in checked.items()}
    clean = {t: good.drop(CORRUPT, "copy_count", LANDED_DAY) for t, (good, _) in pieces.items()}
    current = side_by_side(
        spark, {t: partial(stored, df, f"current/{t}") for t, df in current_tables(clean, checked, several).items()}
    )
    facts = stored(
        O.order_facts(
            clean["orders"], current["order_items"], current["payments"], current["refunds"],
            repeated=several["orders"],
        ).withColumn("order_date", F.to_date("order_created_at")),
        "order_facts",
    )

    def stored_prices() -> DataFrame:
        runs = prices_in_runs(current["order_items"], clean["products"], several["products"])
        return [stored(df, "item_prices", "append" if n else "overwrite") for n, df in enumerate(runs)][-1]

    def history(table: str) -> DataFrame:
        return version_history(clean[table], *VERSIONED[table], HISTORY[table], strategy="check")

    # Building some of them runs jobs of its own.
    results = {
        "quality_report": lambda: quality_report(checked, clean, several),
        "shipment_outcome": lambda: shipment_outcome(
            with_delivery_delay(clean["shipments"]), repeated=several["shipments"]
        ),
        "order_lifecycle": lambda: O.lifecycle(clean["orders"], repeated=several["orders"]),
        "column_report": lambda: column_report(bronze),
        "missing_days": lambda: missing_days(bronze, expected_days or days),
        "lateness_report": lambda: lateness_report(clean),
        "customer_history": lambda: history("customers"),
        "product_history": lambda: history("products"),
        # Amounts are in the currency of the order's country: no sum over several of them.
        "daily_totals": lambda: O.daily_totals(facts, "order_date", "net_amount", ["currency"]),
    }
    steps = {name: lambda n=name, df=df: stored(df(), n) for name, df in results.items()}
    written = side_by_side(spark, {"item_prices": stored_prices} | steps)
    return {
        **written,
        "order_facts": facts,
        **{f"quarantine_{t}": bad for t, (_, bad) in pieces.items()},
        **{f"clean_{t}": good for t, good in clean.items()},
    }
