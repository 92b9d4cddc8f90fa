"""Queries over the trial tables, one per operator, report or check."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmart.functions.dates import calendar_parts, date_key, parse_date
from retailmart.functions.numbers import MONEY_SUM, mean_money
from retailmart.functions.text import blank_to_null, clean, email, full_name, not_blank, or_unknown
from retailmart.operators.dedup import first_non_null, insert_new
from retailmart.operators.joins import lookup
from retailmart.operators.keys import number_rows
from retailmart.operators.ranking import table_counts
from retailmart.plans import audits
from retailmart.plans.adhoc import ADHOC
from retailmart.plans.jobs import add_staging, read_mart, read_star, run, update
from retailmart.plans.marts import BREAKDOWNS, MART_PLANS, SHOWN_KEYS, best_selling_rows, preview
from retailmart.plans.star import (
    KEY_ORDER,
    DerivedStar,
    StagingReader,
    StoredStar,
    complete_sale,
    known_parties,
    primary_key,
    store_locations,
    stores,
)
from retailmart.schemas import STAGING, STAR
from retailmart.session import wide_steps
from retailmart.sources.csv_files import ingest_csv, ingest_tolerant, offset_ids
from retailmart.sources.scratch import removed_at_end, shared_folder
from retailmart.sources.store import Store
from retailmart.trial.staging import staging, trial_tables

Query = Callable[[SparkSession, str], DataFrame]
# CSV files of the ingest queries: a file for each task and number, so none is large. They are read once, so they are packed fast rather than small.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
LEFT_OUT = ("pet_category", "product_description", "supplier_contact")  # columns that one header lacks


def reader(spark: SparkSession, sf_dir: str) -> StagingReader:
    tables = trial_tables(spark, sf_dir)
    return lambda *columns: staging(tables, columns)


def read(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return reader(spark, sf_dir)(*columns)


def derived(spark: SparkSession, sf_dir: str, *dense: str) -> DerivedStar:
    """A star with numbered keys in the given dimensions only."""
    return DerivedStar(spark, reader(spark, sf_dir), dense)


def _tally(df: DataFrame, *columns) -> DataFrame:
    """Distinct combinations and their number of rows."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count"))


# --- ingest -----------------------------------------------------------------


def _ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging written as three numbered groups of CSV files, read back by the ingest."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    rows = read(spark, sf_dir).withColumn("file", F.col("sale_seller_id") % 3)
    with wide_steps(spark):
        rows.write.partitionBy("file").options(header=True, **PACKED).csv(folder)
    removed_at_end(spark, folder)
    return ingest_csv(spark, folder, pattern="file=*", number="file=([0-9]+)")


# a line with a cell too many, and cells that their column cannot hold, by remainders of the identifier
FAULTY_LINES, FAULTY_CELLS = (107, 3), {"product_price": (103, 5, "1.2.3"), "sale_quantity": (101, 7, "many")}


def _faulty_files(spark: SparkSession, sf_dir: str) -> str:
    """Staging as three numbered groups of CSV files with faulty lines; their folder."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    rows = read(spark, sf_dir)
    cells = [F.col(c).cast("string").alias(c) for c in STAGING.names]
    for name, (of, left, text) in FAULTY_CELLS.items():
        cells[STAGING.names.index(name)] = F.when(F.col("id") % of == left, text).otherwise(F.col(name).cast("string")).alias(name)
    line = F.to_csv(F.struct(*cells), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    of, left = FAULTY_LINES
    line = F.concat(line, F.when(F.col("id") % of == left, ",more").otherwise(""))
    # the whole line is one cell under the whole header
    rows = rows.select(line.alias(",".join(STAGING.names)), (F.col("sale_seller_id") % 3).alias("file"))
    with wide_steps(spark):
        rows.write.partitionBy("file").options(header=True, sep="\u0001", quote="", **PACKED).csv(folder)
    removed_at_end(spark, folder)
    return folder


def _ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept and lines rejected, by reason, with the sum of their identifiers (kept ones moved by their file)."""
    found = ingest_tolerant(spark, _faulty_files(spark, sf_dir), pattern="file=*", number="file=([0-9]+)")
    kept = found.rows.agg(F.lit("kept").alias("reason"), F.count("*").alias("row_count"), F.sum("id").alias("ids"))
    own = F.split("record", ",")[0].cast("bigint")
    lines = found.rejects.groupBy("reason", "file_path", "line").agg(F.count("*").alias("n"), F.sum(own).alias("ids"))
    # a line that had two numbers, or a number that two lines had, would show in the counts
    return kept.unionByName(lines.groupBy("reason").agg(F.count_if(F.col("n") == 1).alias("row_count"), F.sum("ids").alias("ids")))


def _ingest_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging written with three headers (all columns, reversed, some left out), read back by name."""
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    names = STAGING.names
    headers = (names, names[::-1], [c for c in names if c not in LEFT_OUT])
    for number, header in enumerate(headers):
        rows = read(spark, sf_dir).where(F.col("sale_seller_id") % 3 == number).select(*header)
        with wide_steps(spark):
            rows.write.options(header=True, **PACKED).csv(f"{folder}/file={number}")
    removed_at_end(spark, folder)
    return ingest_csv(spark, folder, pattern="file=*", number="file=([0-9]+)", mixed_headers=True)


def _ingest_id_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("sale_seller_id") % 4
    name = F.when(number == 0, "MOCK_DATA.csv").otherwise(F.concat(F.lit("MOCK_DATA ("), number, F.lit(").csv")))
    rows = read(spark, sf_dir, "id", "sale_customer_id", "sale_seller_id", "sale_product_id")
    return offset_ids(rows.withColumn("_file", name)).drop("_file")


# --- cleaning ---------------------------------------------------------------


def _clean_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer_country", "product_brand")
    return _tally(rows, "customer_country", clean("customer_country").alias("country"), clean("product_brand").alias("brand"))


def _clean_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer_email")
    return _tally(rows, "customer_email", email("customer_email").alias("email"))


def _clean_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "product_color", "product_size")
    return _tally(
        rows, "product_color", "product_size", blank_to_null("product_color").alias("color"),
        blank_to_null("product_size").alias("size"),
    )


def _clean_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "store_city", "store_country")
    return _tally(
        rows, "store_city", "store_country", or_unknown("store_city").alias("city"),
        or_unknown("store_country").alias("country"),
    )


BLANKABLE = (
    "customer_email", "seller_email", "supplier_email", "product_name", "product_category", "store_name", "store_country",
    "customer_pet_name", "customer_pet_breed",
)


def _clean_not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, *BLANKABLE)
    return rows.agg(*[F.count_if(not_blank(c)).alias(c) for c in BLANKABLE], F.count("*").alias("row_count"))


def _fact_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "sale_date", "sale_quantity", "sale_total_price")
    rows = rows.groupBy(complete_sale().alias("complete"))
    return rows.agg(F.count("*").alias("row_count"), F.sum("sale_quantity").alias("quantity"))


def _parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "sale_date", "product_release_date", "product_expiry_date")
    return _tally(
        rows, parse_date("sale_date").alias("sale_day"), parse_date("product_release_date").alias("release_day"),
        parse_date("product_expiry_date").alias("expiry_day"),
    )


def _date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _tally(read(spark, sf_dir, "sale_date"), parse_date("sale_date").alias("sale_day"))
    return days.select("sale_day", date_key(F.col("sale_day")).alias("date_key"), *calendar_parts("sale_day"), "row_count")


def _concat_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "seller_first_name", "seller_last_name")
    return _tally(
        rows, "seller_first_name", "seller_last_name", full_name("seller_first_name", "seller_last_name").alias("full_name")
    )


# --- deduplication ----------------------------------------------------------


def _dedup_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_locations(reader(spark, sf_dir))


def _dedup_first_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores(reader(spark, sf_dir))


def _dedup_first_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "id", "customer_pet_breed", "customer_pet_type").where(not_blank("customer_pet_breed"))
    rows = rows.select("id", clean("customer_pet_breed").alias("breed_name"), clean("customer_pet_type").alias("pet_type"))
    return first_non_null(rows, ["breed_name"], "pet_type", "id")


def _dedup_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers first seen from 2014 on, next to those already known before."""
    rows = read(spark, sf_dir, "id", "sale_customer_id", "customer_email", "sale_date").where(not_blank("customer_email"))
    rows = rows.select(
        "id", F.col("sale_customer_id").alias("customer_id"), email("customer_email").alias("email"),
        parse_date("sale_date").alias("day"),
    )
    known = rows.where("day < date '2014-01-01'").select("email").distinct()
    return insert_new(rows.where("day >= date '2014-01-01'").drop("day"), known, ["email"], ["id"])


# --- joins ------------------------------------------------------------------


def _join_left_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer_pet_name", "customer_pet_breed").where(not_blank("customer_pet_name"))
    rows = rows.select(clean("customer_pet_name").alias("pet_name"), clean("customer_pet_breed").alias("pet_breed"))
    breeds = derived(spark, sf_dir, "dimension_pet_breeds").table("dimension_pet_breeds", "breed_key", "breed_name")
    return lookup(_tally(rows, "pet_name", "pet_breed"), breeds, {"pet_breed": "breed_name"}, ["breed_key"], "left")


def _join_left_prededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "dimension_pets").table("dimension_customers", "email", "pet_key")


def _join_left_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "dimension_store_locations").table("dimension_stores", "store_name", "location_key")


def _join_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = derived(spark, sf_dir, "dimension_products")
    rows = star.sold("product_key", "product_name", "color", "size", "price")
    return rows.select("product_key", "product_name", "color", "size", "price", "sales")


def _join_star_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = derived(spark, sf_dir)
    # Each dimension is joined to its parent first, so that sales never shuffle by a key of a few values.
    products = star.table("dimension_products", "product_key", "category_key")
    products = products.join(star.table("dimension_product_categories", "category_key", "category_name"), "category_key")
    stores = star.table("dimension_stores", "store_key", "location_key")
    stores = stores.join(star.table("dimension_store_locations", "location_key", "country"), "location_key")
    rows = (
        star.totals("date_key", "product_key", "store_key")
        .join(star.table("dimension_dates", "date_key", "year"), "date_key")
        .join(products.select("product_key", "category_name"), "product_key")
        .join(stores.select("store_key", "country"), "store_key")
    )
    return rows.groupBy("year", "category_name", "country").agg(
        F.sum("sales").alias("sales_count"), F.sum("revenue").cast(MONEY_SUM).alias("total_revenue")
    )


def _join_left_keep_unsold(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = derived(spark, sf_dir)
    customers = star.table("dimension_customers", "customer_key", "email")
    rows = customers.join(star.totals("customer_key"), "customer_key", "left")
    return rows.select(
        "email", F.coalesce("sales", F.lit(0)).alias("purchases_count"), F.col("revenue").cast(MONEY_SUM).alias("total_spent")
    )


# --- aggregates -------------------------------------------------------------


def _sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(
        spark, sf_dir, "customer_email", "customer_country", "seller_email", "product_name", "product_price", "store_name",
        "sale_date", "sale_quantity", "sale_total_price",
    )
    return rows.where(complete_sale() & known_parties())


def _agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold(spark, sf_dir).groupBy(clean("customer_country").alias("country")).agg(
        F.countDistinct(email("customer_email")).alias("customer_count"),
        F.countDistinct(clean("store_name")).alias("store_count"),
    )


def _agg_mixed_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, count = F.sum("sale_total_price"), F.count("*")
    return _sold(spark, sf_dir).groupBy(clean("store_name").alias("store_name")).agg(
        count.alias("sales_count"),
        F.sum("sale_quantity").alias("total_quantity"),
        total.cast(MONEY_SUM).alias("total_revenue"),
        mean_money(total, count).alias("avg_check"),
        F.countDistinct(email("customer_email")).alias("customer_count"),
        F.countDistinct(clean("product_name")).alias("product_count"),
    )


# --- keys, calendar ---------------------------------------------------------


def _surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys over nullable composite natural keys, blank and NULL kept apart."""
    rows = read(spark, sf_dir, "product_name", "product_color", "product_size", "product_price")
    distinct = rows.where(not_blank("product_name")).distinct()
    return number_rows(distinct, ["product_name", "product_color", "product_size", "product_price"], "row_key")


def _dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole calendar, each day with its number of sales."""
    star = derived(spark, sf_dir)
    sold = star.totals("date_key").select("date_key", "sales")
    days = star.table("dimension_dates").join(sold, "date_key", "left")
    return days.select(*STAR["dimension_dates"].names, F.coalesce("sales", F.lit(0)).alias("sales_count"))


def _on_star(plan: Callable, *dense: str) -> Query:
    return lambda spark, sf_dir: plan(derived(spark, sf_dir, *dense))


def _dimension(name: str) -> Query:
    """A whole star table, with numbers in all the keys it holds."""
    keys = {primary_key(d): d for d in KEY_ORDER}
    dense = [keys[c] for c in STAR[name].names if c in keys]
    return lambda spark, sf_dir: derived(spark, sf_dir, *dense).table(name)


def _preview(mart: str) -> Query:
    return _on_star(lambda star: preview(star, mart), *SHOWN_KEYS.get(mart, ()))


MART_KEYS = [dimension for mart in MART_PLANS for dimension in SHOWN_KEYS.get(mart, ())]

# --- the stored path --------------------------------------------------------


_TARGETS: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str) -> str:
    """Run both jobs once per application into a folder of their own; its name. Staging is stored first, as in production."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TARGETS:
        _TARGETS[key] = _run_jobs(spark, sf_dir)
    return _TARGETS[key]


def _run_jobs(spark: SparkSession, sf_dir: str) -> str:
    target = f"{shared_folder(spark)}/target-{uuid.uuid4().hex}"
    run(spark, add_staging(spark, reader(spark, sf_dir)(), target), target)
    removed_at_end(spark, target)
    return target


_GROWN: dict[tuple[str, str], str] = {}


def grown(spark: SparkSession, sf_dir: str) -> str:
    """A target that was loaded with the lower half of the identifiers and then with the rest, once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GROWN:
        target = f"{shared_folder(spark)}/grown-{uuid.uuid4().hex}"
        rows = reader(spark, sf_dir)()
        middle = F.lit(reader(spark, sf_dir)("id").agg(F.max("id")).first()[0] // 2)
        for half in (F.col("id") < middle, F.col("id") >= middle):
            add_staging(spark, rows.where(half), target)
            update(spark, target)
        removed_at_end(spark, target)
        _GROWN[key] = target
    return _GROWN[key]


def _grown_mart(name: str) -> Query:
    return lambda spark, sf_dir: read_mart(spark, grown(spark, sf_dir), name)


def _grown_table(name: str) -> Query:
    columns = [c for c in STAR[name].names if c != "sale_key"]
    return lambda spark, sf_dir: read_star(spark, grown(spark, sf_dir)).table(name, *columns)


def _grown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first load's tables that the second load changed or lost."""
    target = grown(spark, sf_dir)
    store, now = Store(spark, target, "star"), read_star(spark, target)
    first = store.before(store.commit())
    counts = []
    for name, schema in STAR.items():
        old = store.read_parts(first.parts[name], schema)
        counts.append(old.exceptAll(now.table(name)).agg(F.lit(name).alias("table_name"), F.count("*").alias("changed")))
    return reduce(DataFrame.unionAll, counts)


def _stored_mart(name: str) -> Query:
    return lambda spark, sf_dir: read_mart(spark, stored(spark, sf_dir), name)


def _stored_star(plan: Callable) -> Query:
    return lambda spark, sf_dir: plan(read_star(spark, stored(spark, sf_dir)))


def _table_sizes(star: StoredStar) -> DataFrame:
    return table_counts({name: star.table(name) for name in STAR})


def _sale_keys(star: StoredStar) -> DataFrame:
    """Sales, distinct sale keys, and sales whose key is empty or not positive."""
    key = F.col("sale_key")
    return star.table("fact_sales", "sale_key").agg(
        F.count("*").alias("sales"), F.count_distinct(key).alias("distinct_keys"), F.count_if(key.isNull() | (key < 1)).alias("bad_keys")
    )


def faulty(star: StoredStar) -> StoredStar:
    """The star with faults: repeated sellers, orphaned and empty references, empty and overlong texts, too large amounts."""
    tables = {name: star.table(name) for name in STAR}
    sellers, stores, products, fact = (tables[n] for n in ("dimension_sellers", "dimension_stores", "dimension_products", "fact_sales"))
    tables["dimension_sellers"] = sellers.union(sellers.where("seller_key % 3 = 0"))
    tables["dimension_stores"] = stores.withColumn("phone", F.when(F.col("store_key") % 2 == 0, F.lpad("phone", 51, "0")).otherwise(F.col("phone")))
    nameless = F.when(F.col("product_key") % 5 != 0, F.col("product_name"))
    tables["dimension_products"] = products.withColumn("product_name", nameless).withColumn("supplier_key", F.col("supplier_key") + F.when(F.col("product_key") % 7 == 0, 1_000_000).otherwise(0))
    dates = tables["dimension_dates"]
    tables["dimension_dates"] = dates.withColumn("day_name", F.when(F.col("day") == 1, F.lpad("day_name", 21, " ")).otherwise(F.col("day_name")))
    raised = F.when(F.col("quantity") % 10 == 0, F.lit("100000000").cast("decimal(18,2)")).otherwise(F.col("total_price").cast("decimal(18,2)"))
    tables["fact_sales"] = fact.withColumn("total_price", raised).withColumn("store_key", F.when(F.col("quantity") % 10 == 1, -F.col("store_key")).otherwise(F.col("store_key")))
    return StoredStar(tables)


def _on_faulty(plan: Callable) -> Query:
    return _stored_star(lambda star: plan(faulty(star)))


QUERIES: dict[str, Query] = {
    "ingest_csv": _ingest_csv,
    "ingest_id_offset": _ingest_id_offset,
    "ingest_mixed_headers": _ingest_mixed_headers,
    "ingest_rejects": _ingest_rejects,
    "clean_trim": _clean_trim,
    "clean_email": _clean_email,
    "clean_blank_to_null": _clean_blank_to_null,
    "clean_default": _clean_default,
    "clean_not_blank": _clean_not_blank,
    "fact_filter": _fact_filter,
    "parse_dates": _parse_dates,
    "date_parts": _date_parts,
    "concat_name": _concat_name,
    "dedup_distinct": _dedup_distinct,
    "dedup_first_by_id": _dedup_first_by_id,
    "dedup_first_nonnull": _dedup_first_nonnull,
    "dedup_insert_new": _dedup_insert_new,
    "join_left_dim": _join_left_dim,
    "join_left_prededup": _join_left_prededup,
    "join_left_composite": _join_left_composite,
    "join_null_safe": _join_null_safe,
    "join_star_multi": _join_star_multi,
    "join_left_keep_unsold": _join_left_keep_unsold,
    "agg_count_distinct": _agg_count_distinct,
    "agg_mixed_distinct": _agg_mixed_distinct,
    "surrogate_key": _surrogate_key,
    **{f"dim_{name.removeprefix('dimension_')}": _dimension(name) for name in KEY_ORDER},
    "dim_dates": _dim_dates,
    "fact_sales": _dimension("fact_sales"),
    **{n: _on_star(plan, *SHOWN_KEYS.get(n, ())) for n, plan in {**MART_PLANS, **BREAKDOWNS, **ADHOC}.items()},
    **{f"preview_{name.removeprefix('report_')}": _preview(name) for name in MART_PLANS},
    "best_selling_rows": _on_star(best_selling_rows),
    "table_counts": lambda spark, sf_dir: audits.counts(derived(spark, sf_dir), reader(spark, sf_dir)),
    "mart_counts": _on_star(audits.mart_counts, *MART_KEYS),
    "dq_mart_nulls": _on_star(audits.mart_gaps, *MART_KEYS),
    "dq_unique": _on_star(audits.unique_keys),
    "dq_fk": _stored_star(audits.references_at_once),
    "dq_at_once": _stored_star(audits.at_once),
    "dq_not_null": _on_star(audits.required_columns),
    "dq_length": _on_star(audits.text_lengths),
    "dq_overflow": _on_star(audits.overflows),
    "dq_reconcile": lambda spark, sf_dir: audits.reconcile(reader(spark, sf_dir)),
    "dq_lost_in_reports": _on_star(audits.lost_in_reports),
    **{f"stored_{name.removeprefix('report_')}": _stored_mart(name) for name in MART_PLANS},
    "stored_counts": _stored_star(_table_sizes),
    "stored_sale_keys": _stored_star(_sale_keys),
    **{f"grown_{name.removeprefix('dimension_')}": _grown_table(name) for name in [*KEY_ORDER, "fact_sales"]},
    **{f"grown_{name.removeprefix('report_')}": _grown_mart(name) for name in MART_PLANS},
    "grown_keys": _grown_keys,
    "faulty_unique": _on_faulty(audits.unique_keys_at_once),
    "faulty_fk": _on_faulty(audits.references_at_once),
    "faulty_at_once": _on_faulty(audits.at_once),
    "faulty_not_null": _on_faulty(audits.required_columns),
    "faulty_length": _on_faulty(audits.text_lengths),
    "faulty_overflow": _on_faulty(audits.overflows),
}
