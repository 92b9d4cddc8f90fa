"""Checks of a star schema and of the way from staging to it."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.functions.dates import CALENDAR_FIRST_DAY, CALENDAR_LAST_DAY, parse_date
from retailmart.functions.text import not_blank
from retailmart.operators.quality import duplicates, null_counts, orphans, too_large, too_long
from retailmart.operators.ranking import table_counts
from retailmart.plans.marts import MART_PLANS
from retailmart.plans.star import StagingReader, Star, primary_key
from retailmart.schemas import MART_WISHES, PRECISIONS, REFERENCES, REQUIRED, STAR, TEXT_LENGTHS, UNIQUE

EMPTY, FILLED = 0, 1  # keys of a required cell


def _named(df: DataFrame, **labels: str) -> DataFrame:
    return df.select(*[F.lit(v).alias(k) for k, v in labels.items()], "*")


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unique_keys(star: Star) -> DataFrame:
    """``table_name, distinct_keys, repeated_keys`` of every natural key."""
    return _all([_named(duplicates(star.table(t, *k), k), table_name=t) for t, k in UNIQUE.items()])


def references(star: Star) -> DataFrame:
    """``table_name, column_name, checked, orphans`` of every foreign key.

    The fact's references are taken from its totals: one row per key.
    """
    parts = []
    for child, column, parent in REFERENCES:
        key = primary_key(parent)
        if child == "fact_sales":
            rows = star.totals(column).where(F.col(column).isNotNull()).select(column, "sales")
            found = star.table(parent, key).distinct().withColumn("_found", F.lit(True))
            counted = rows.join(found, key, "left").agg(
                F.coalesce(F.sum("sales"), F.lit(0)).alias("checked"),
                F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("sales"))), F.lit(0)).alias("orphans"),
            )
        else:
            counted = orphans(star.table(child, column), column, star.table(parent, key), key)
        parts.append(_named(counted, table_name=child, column_name=column))
    return _all(parts)


def at_once(star: Star, kinds: tuple[str, ...] = ("unique", "reference", "required")) -> DataFrame:
    """``kind, table_name, column_name, checked, broken``: keys, references and required columns of all tables in one pass.

    Each table is read once, with the columns that its checks need. A row gives one (check, key) per check,
    a parent's row one for each reference to it, and all go through one shuffle, summed per task before, so that a
    hot key weighs one row per task. Per check, ``broken`` counts repeated keys of ``checked`` distinct ones, orphans of
    filled references, or empty cells of rows. A unique key has no column name.
    """
    checks = [("unique", t, None, k) for t, k in UNIQUE.items()]
    checks += [("reference", child, column, parent) for child, column, parent in REFERENCES]
    checks += [("required", t, c, None) for t, columns in REQUIRED.items() for c in columns]
    checks = [c for c in checks if c[0] in kinds]

    def seen(number: int, held: int, key: Column | None = None, text: Column | None = None) -> Column:
        # references and empty cells are numbers, so that only a few small dimensions make texts
        key = F.lit(None) if key is None else key
        text = F.lit(None) if text is None else text
        return F.struct(F.lit(number).alias("check"), key.cast("bigint").alias("key"), text.cast("string").alias("text"), F.lit(held).cast("bigint").alias("held"))

    found: dict[str, list[Column]] = {}
    needed: dict[str, list[str]] = {}
    for number, (kind, table, column, more) in enumerate(checks):
        if kind == "unique":
            found.setdefault(table, []).append(seen(number, 1, text=_as_text(*more)))
            needed.setdefault(table, []).extend(more)
        elif kind == "required":
            found.setdefault(table, []).append(seen(number, 1, F.when(F.col(column).isNull(), EMPTY).otherwise(FILLED)))
            needed.setdefault(table, []).append(column)
        else:
            key = primary_key(more)
            found.setdefault(table, []).append(seen(number, 1, F.col(column)))
            needed.setdefault(table, []).append(column)
            found.setdefault(more, []).append(seen(number, 0, F.col(key)))
            needed.setdefault(more, []).append(key)
    rows = [
        star.table(t, *dict.fromkeys(needed[t])).select(F.inline(F.array(*seen_here))).where("key is not null or text is not null")
        for t, seen_here in found.items()
    ]
    keys = _all(rows).groupBy("check", "key", "text").agg(F.sum("held").alias("held"), F.min("held").alias("least"))
    # a key that a parent's row has shows by the row's zero
    orphan = F.sum(F.when(F.col("least") > 0, F.col("held")))
    sums = keys.groupBy("check").agg(
        F.count("*").alias("distinct"), F.count_if(F.col("held") > 1).alias("repeated"), F.sum("held").alias("held"),
        orphan.alias("orphans"), F.sum(F.when(F.col("key") == EMPTY, F.col("held"))).alias("empty"),
    )
    names = F.array(*[
        F.struct(F.lit(n).alias("check"), F.lit(kind).alias("kind"), F.lit(t).alias("table_name"), F.lit(c).cast("string").alias("column_name"))
        for n, (kind, t, c, _) in enumerate(checks)
    ])
    labels = sums.sparkSession.range(1).select(F.inline(names))
    unique = F.col("kind") == "unique"
    broken = F.when(unique, F.col("repeated")).when(F.col("kind") == "reference", F.col("orphans")).otherwise(F.col("empty"))
    return labels.join(sums, "check", "left").select(
        "kind", "table_name", "column_name",
        F.coalesce(F.when(unique, F.col("distinct")).otherwise(F.col("held")), F.lit(0)).alias("checked"),
        F.coalesce(broken, F.lit(0)).alias("broken"),
    )


def _as_text(*columns) -> Column:
    """A key as text that tells NULL from empty and one part from the next."""
    return F.to_json(F.struct(*columns))


def references_at_once(star: Star) -> DataFrame:
    """As ``references``, each table read once."""
    return at_once(star, ("reference",)).select("table_name", "column_name", "checked", F.col("broken").alias("orphans"))


def unique_keys_at_once(star: Star) -> DataFrame:
    """As ``unique_keys``, all tables through one shuffle."""
    found = at_once(star, ("unique",))
    return found.select("table_name", F.col("checked").alias("distinct_keys"), F.col("broken").alias("repeated_keys"))


def required_columns(star: Star) -> DataFrame:
    """``table_name, column_name, checked, nulls`` of every column that must be filled."""
    return _all([_named(null_counts(star.table(t, *c), c), table_name=t) for t, c in REQUIRED.items()])


def text_lengths(star: Star) -> DataFrame:
    """``table_name, column_name, max_length, too_long`` of every text column with a declared length."""
    return _all([_named(too_long(star.table(t, *c), c), table_name=t) for t, c in TEXT_LENGTHS.items()])


def overflows(star: Star) -> DataFrame:
    """``table_name, column_name, checked, too_large``: amounts that the declared precision cannot hold."""
    parts = []
    for table, columns in PRECISIONS.items():
        limits = {c: Decimal(10) ** (precision - scale) for c, (precision, scale) in columns.items()}
        parts.append(_named(too_large(star.table(table, *columns), limits), table_name=table))
    return _all(parts)


def counts(star: Star, read: StagingReader) -> DataFrame:
    """Rows of staging and of every star table."""
    keyless = {t: star.table(t, *[c for c in s.names if not c.endswith("_key")]) for t, s in STAR.items()}
    # Pets are distinct rows that hold a breed key, and a day is its date key.
    keyless["dimension_pets"] = star.table("dimension_pets", "pet_name", "breed_key", "pet_type")
    return table_counts({"staging": read("id"), **keyless})


def mart_counts(star: Star) -> DataFrame:
    """Rows of every mart."""
    return table_counts({name: plan(star) for name, plan in MART_PLANS.items()})


def mart_gaps(star: Star) -> DataFrame:
    """``table_name, column_name, checked, nulls`` of mart columns that should be filled and need not be."""
    return _all([_named(null_counts(MART_PLANS[m](star), c), table_name=m) for m, c in MART_WISHES.items()])


# Reasons why a staging row gives no sale, in the order they are charged.
def _reasons() -> dict:
    return {
        "no sale date": F.col("sale_date").isNull(),
        "no quantity": F.col("sale_quantity").isNull(),
        "no total price": F.col("sale_total_price").isNull(),
        "no customer email": ~F.coalesce(not_blank("customer_email"), F.lit(False)),
        "no seller email": ~F.coalesce(not_blank("seller_email"), F.lit(False)),
        "no product name": ~F.coalesce(not_blank("product_name"), F.lit(False)),
        "no product price": F.col("product_price").isNull(),
        "no store name": ~F.coalesce(not_blank("store_name"), F.lit(False)),
    }


def reconcile(read: StagingReader) -> DataFrame:
    """``reason, having, charged``: staging rows kept and dropped, in one scan.

    A dropped row has every reason that applies and is charged to the first, so
    the charged rows add up to staging. ``kept, not in the calendar`` are sales that
    appear in every report but those over time: their date cannot be read, or
    the calendar does not have it.
    """
    reasons = _reasons()
    rows = read(
        "sale_date", "sale_quantity", "sale_total_price", "customer_email", "seller_email", "product_name",
        "product_price", "store_name",
    )
    first = F.coalesce(*[F.when(c, F.lit(n)) for n, c in reasons.items()], F.lit("kept"))
    readable = F.coalesce(parse_date("sale_date").between(F.lit(CALENDAR_FIRST_DAY).cast("date"), F.lit(CALENDAR_LAST_DAY).cast("date")), F.lit(False))
    rows = rows.select(first.alias("_first"), readable.alias("_readable"), *[c.alias(n) for n, c in reasons.items()])
    kept = F.col("_first") == "kept"
    counted = {n: (F.count_if(F.col(n)), F.count_if(F.col("_first") == n)) for n in reasons}
    counted["kept"] = (F.count_if(kept), F.count_if(kept & F.col("_readable")))
    counted["kept, not in the calendar"] = (F.count_if(kept & ~F.col("_readable")), F.count_if(kept & ~F.col("_readable")))
    lines = [
        F.struct(F.lit(n).alias("reason"), having.alias("having"), charged.alias("charged"))
        for n, (having, charged) in counted.items()
    ]
    return rows.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines"))


def lost_in_reports(star: Star) -> DataFrame:
    """``report, sales, lost``: sales that a report leaves out, as they find no parent.

    The parent key may be empty, or the parent missing: the calendar does not have
    every date that a sale can have.
    """
    cases = [
        ("report_products_sales", star.sold("product_key", "category_key"), "category_key", "dimension_product_categories"),
        ("report_stores_sales", star.sold("store_key", "location_key"), "location_key", "dimension_store_locations"),
        ("report_suppliers_sales", star.sold("product_key", "supplier_key"), "supplier_key", "dimension_suppliers"),
        ("report_time_sales", star.totals("date_key"), "date_key", "dimension_dates"),
    ]

    def counted(name: str, rows: DataFrame, key: str, parent: str) -> DataFrame:
        # one row per key before the join, so that a key with many products or stores weighs no more than another
        rows = rows.groupBy(F.col(key).alias("_key")).agg(F.sum("sales").alias("sales"))
        known = star.table(parent, key).select(F.col(key).alias("_key"), F.lit(True).alias("_found"))
        lost = F.sum(F.when(F.col("_found").isNull(), F.col("sales")))
        return rows.join(known, "_key", "left").agg(
            F.lit(name).alias("report"), F.sum("sales").alias("sales"), F.coalesce(lost, F.lit(0)).alias("lost")
        )

    return _all([counted(*case) for case in cases])
