"""The ten analytical questions asked of the star directly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.functions.numbers import MONEY_SUM, mean_money, ratio
from retailmart.functions.text import full_name
from retailmart.operators.ranking import top_k
from retailmart.plans.marts import categorised_sales, store_sales
from retailmart.plans.star import Star

# fixed values: lengths of the ranked answers
BEST_CUSTOMERS = 10
BEST_SELLERS = 10
POPULAR_PRODUCTS = 20

REVENUE = "total_revenue"


def _count_and_revenue(sales: str = "sales_count", revenue: str = REVENUE) -> list:
    return [F.sum("sales").alias(sales), F.sum("revenue").cast(MONEY_SUM).alias(revenue)]


def q_overview(star: Star) -> DataFrame:
    return star.totals().select(
        F.col("sales").alias("total_sales"),
        F.col("quantity").alias("total_items_sold"),
        F.col("revenue").cast(MONEY_SUM).alias("total_revenue"),
        mean_money(F.col("revenue"), F.col("sales")).alias("avg_sale_amount"),
    )


def q_by_category(star: Star) -> DataFrame:
    rows = categorised_sales(star, category=("category_name", "pet_category"))
    rows = rows.groupBy("category_name", "pet_category").agg(*_count_and_revenue())
    return rows.orderBy(F.desc(REVENUE), "category_name")


def q_top_customers(star: Star) -> DataFrame:
    rows = star.sold("customer_key", "first_name", "last_name", "email", "country")
    best = top_k(rows, "revenue", BEST_CUSTOMERS, ["customer_key"])
    return best.select(
        full_name("first_name", "last_name").alias("customer_name"),
        "email",
        "country",
        F.col("sales").alias("purchase_count"),
        F.col("revenue").cast(MONEY_SUM).alias("total_spent"),
    )


def q_top_sellers(star: Star) -> DataFrame:
    rows = star.sold("seller_key", "first_name", "last_name", "country")
    best = top_k(rows, "revenue", BEST_SELLERS, ["seller_key"])
    return best.select(
        full_name("first_name", "last_name").alias("seller_name"),
        "country",
        F.col("sales").alias("sales_count"),
        F.col("revenue").cast(MONEY_SUM).alias("total_revenue"),
    )


def q_popular_products(star: Star) -> DataFrame:
    """Ranked per product, not per name."""
    best = top_k(categorised_sales(star, "product_name", "brand"), "sales", POPULAR_PRODUCTS, ["product_key"])
    return best.select(
        "product_name",
        "category_name",
        "brand",
        F.col("sales").alias("times_sold"),
        F.col("revenue").cast(MONEY_SUM).alias("total_revenue"),
    )


def q_by_store(star: Star) -> DataFrame:
    groups = ["store_name", "city", "country"]
    rows = store_sales(star, "store_name").groupBy(*groups).agg(*_count_and_revenue())
    return rows.orderBy(F.desc(REVENUE), *groups)


def q_by_month(star: Star) -> DataFrame:
    rows = star.sold("date_key", "year", "month", "month_name").groupBy("year", "month", "month_name")
    return rows.agg(*_count_and_revenue()).orderBy("year", "month")


def q_by_customer_country(star: Star) -> DataFrame:
    rows = star.sold("customer_key", "country").groupBy("country")
    rows = rows.agg(F.count("*").alias("customer_count"), *_count_and_revenue())
    return rows.orderBy(F.desc(REVENUE), "country")


def q_by_breed(star: Star) -> DataFrame:
    """Customers with a pet of a known breed, also those who bought nothing."""
    customers = star.table("dimension_customers", "customer_key", "pet_key")
    pets = star.table("dimension_pets", "pet_key", "breed_key")
    breeds = star.table("dimension_pet_breeds", "breed_key", "breed_name", "pet_type")
    owners = customers.join(pets, "pet_key").join(breeds, "breed_key")
    rows = owners.join(star.totals("customer_key"), "customer_key", "left").groupBy("breed_name", "pet_type")
    rows = rows.agg(
        F.count("*").alias("customer_count"),
        F.coalesce(F.sum("sales"), F.lit(0)).alias("purchases_count"),
        F.sum("revenue").cast(MONEY_SUM).alias("total_spent"),
    )
    return rows.orderBy(F.desc("customer_count"), "breed_name")


def q_age_by_category(star: Star) -> DataFrame:
    """The age is averaged over sales, so a customer counts once per purchase."""
    # Products get their category's name first: one row per product, so no sale is dealt out by category.
    products = star.table("dimension_products", "product_key", "category_key")
    categories = star.table("dimension_product_categories", "category_key", "category_name")
    named = products.join(categories, "category_key").select("product_key", "category_name")
    customers = star.table("dimension_customers", "customer_key", "age")
    rows = star.totals("customer_key", "product_key").join(named, "product_key")
    # One row per customer and category from here on.
    rows = rows.groupBy("category_name", "customer_key").agg(F.sum("sales").alias("sales"), F.sum("revenue").alias("revenue"))
    aged = F.when(F.col("age").isNotNull(), F.col("sales"))
    rows = rows.join(customers, "customer_key").groupBy("category_name").agg(
        ratio(F.sum(F.col("age") * F.col("sales")), F.sum(aged), 6, 14).alias("avg_customer_age"),
        F.count("*").alias("customer_count"),
        F.sum("revenue").cast(MONEY_SUM).alias(REVENUE),
    )
    return rows.orderBy(F.desc(REVENUE), "category_name")


ADHOC = {
    "q_overview": q_overview,
    "q_by_category": q_by_category,
    "q_top_customers": q_top_customers,
    "q_top_sellers": q_top_sellers,
    "q_popular_products": q_popular_products,
    "q_by_store": q_by_store,
    "q_by_month": q_by_month,
    "q_by_customer_country": q_by_customer_country,
    "q_by_breed": q_by_breed,
    "q_age_by_category": q_age_by_category,
}
