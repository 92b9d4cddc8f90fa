"""The six stored marts and the reports that break them down.

Every function takes a star and returns a DataFrame. Sales come summed per
surrogate key (``Star.totals``); the joins and group-bys here work on one row
per customer, product, store or day. Averages are sums over counts, never
averages of averages. Top-k reports break ties by their group key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailmart.functions.numbers import MONEY_SUM, mart_mean, mean_money, ratio
from retailmart.operators.contract import enforce
from retailmart.operators.ranking import top_k
from retailmart.plans.star import Star
from retailmart.schemas import MARTS

# fixed values: lengths of the ranked reports
TOP_PRODUCTS = 10
TOP_CUSTOMERS = 10
TOP_STORES = 5
TOP_SUPPLIERS = 5
RATED_PRODUCTS = 10


def _revenue(alias: str = "total_revenue") -> Column:
    return F.sum("revenue").cast(MONEY_SUM).alias(alias)


def _quantity(alias: str = "total_quantity") -> Column:
    return F.sum("quantity").alias(alias)


def _sales(alias: str = "sales_count") -> Column:
    return F.sum("sales").alias(alias)


def _mean(alias: str) -> Column:
    return mean_money(F.sum("revenue"), F.sum("sales")).alias(alias)


def _mart_mean(alias: str) -> Column:
    return mart_mean(F.sum("revenue"), F.sum("sales")).alias(alias)


# --- products ---------------------------------------------------------------


def categorised_sales(star: Star, *attributes: str, category: tuple[str, ...] = ("category_name",)) -> DataFrame:
    """Sales of products that have a category."""
    categories = star.table("dimension_product_categories", "category_key", *category)
    return star.sold("product_key", "category_key", *attributes).join(categories, "category_key")


def report_products_sales(star: Star) -> DataFrame:
    groups = ("product_name", "category_name", "rating", "reviews_count")
    rows = categorised_sales(star, "product_name", "rating", "reviews_count").groupBy(*groups)
    return enforce(rows.agg(_quantity("total_quantity_sold"), _revenue(), _sales()), MARTS["report_products_sales"])


def top_products(star: Star) -> DataFrame:
    rows = categorised_sales(star, "product_name").groupBy("product_name", "category_name")
    rows = rows.agg(_quantity(), _revenue(), _sales())
    return top_k(rows, "total_quantity", TOP_PRODUCTS, ["product_name", "category_name"])


def revenue_by_category(star: Star) -> DataFrame:
    return categorised_sales(star).groupBy("category_name").agg(_revenue(), _quantity())


def _rated_products(star: Star, variants: str) -> DataFrame:
    rows = star.table("dimension_products", "product_name", "rating", "reviews_count")
    return rows.groupBy("product_name").agg(
        ratio(F.sum("rating"), F.count("rating"), 5, 7).alias("avg_rating"),
        F.sum("reviews_count").alias("total_reviews"),
        F.count("*").alias(variants),
    )


def product_ratings(star: Star) -> DataFrame:
    return _rated_products(star, "product_variants")


# --- customers --------------------------------------------------------------


def report_customers_sales(star: Star) -> DataFrame:
    """One row per customer already: nothing is left to group."""
    rows = star.sold("customer_key", "first_name", "last_name", "country").select(
        "customer_key",
        "first_name",
        "last_name",
        "country",
        F.col("revenue").alias("total_purchases"),
        F.col("quantity").alias("total_items"),
        F.col("sales").alias("order_count"),
        mart_mean(F.col("revenue"), F.col("sales")).alias("avg_check"),
    )
    return enforce(rows, MARTS["report_customers_sales"])


def _customer_columns(*measures: Column) -> list:
    return ["customer_key", "first_name", "last_name", "country", *measures]


def top_customers(star: Star) -> DataFrame:
    rows = star.sold("customer_key", "first_name", "last_name", "country").select(
        *_customer_columns(
            F.col("revenue").cast(MONEY_SUM).alias("total_purchases"),
            F.col("quantity").alias("total_items"),
            F.col("sales").alias("order_count"),
            mean_money(F.col("revenue"), F.col("sales")).alias("avg_order_value"),
        )
    )
    return top_k(rows, "total_purchases", TOP_CUSTOMERS, ["customer_key"])


def customers_by_country(star: Star) -> DataFrame:
    """Rows are one per customer, so counting them counts distinct customers."""
    rows = star.sold("customer_key", "country").groupBy("country")
    return rows.agg(F.count("*").alias("customer_count"), _revenue(), _mean("avg_order_value"))


def customer_avg_check(star: Star) -> DataFrame:
    return star.sold("customer_key", "first_name", "last_name", "country").select(
        *_customer_columns(
            mean_money(F.col("revenue"), F.col("sales")).alias("avg_check"),
            F.col("revenue").cast(MONEY_SUM).alias("total_spent"),
            F.col("sales").alias("orders_count"),
        )
    )


# --- time: only sales with a date in the calendar, summed per day first -------------------------------------------------------------------


def report_time_sales(star: Star) -> DataFrame:
    groups = ("date_key", "full_date", "year", "month", "quarter", "month_name")
    rows = star.sold("date_key", *groups[1:]).groupBy(*groups)
    rows = rows.agg(_revenue("daily_revenue"), _quantity("daily_quantity"), _sales(), _mart_mean("avg_order_size"))
    return enforce(rows, MARTS["report_time_sales"])


def monthly_trends(star: Star) -> DataFrame:
    rows = star.sold("date_key", "year", "month", "month_name").groupBy("year", "month", "month_name")
    rows = rows.agg(_revenue("monthly_revenue"), _quantity("monthly_quantity"), _sales(), _mean("avg_order_size"))
    return rows.orderBy("year", "month")


def quarterly_trends(star: Star) -> DataFrame:
    rows = star.sold("date_key", "year", "quarter").groupBy("year", "quarter")
    rows = rows.agg(_revenue("quarterly_revenue"), _quantity("quarterly_quantity"), _sales())
    return rows.orderBy("year", "quarter")


def yearly_trends(star: Star) -> DataFrame:
    rows = star.sold("date_key", "year").groupBy("year")
    rows = rows.agg(_revenue("yearly_revenue"), _quantity("yearly_quantity"), _sales(), _mean("avg_order_size"))
    return rows.orderBy("year")


def period_comparison(star: Star) -> DataFrame:
    """Each month against the month with sales before it.

    The window is over one row per calendar month, 252 at most.
    """
    months = monthly_trends(star).select("year", "month", "month_name", "monthly_revenue")
    before = F.lag("monthly_revenue").over(Window.partitionBy(F.lit(0)).orderBy("year", "month"))
    change = F.col("monthly_revenue") - F.col("previous_revenue")
    return months.withColumn("previous_revenue", before).select(
        "*",
        change.cast(MONEY_SUM).alias("revenue_change"),
        ratio(change * 100, F.col("previous_revenue"), 2, 18).alias("change_percent"),
    )


# --- stores -----------------------------------------------------------------


def store_sales(star: Star, *attributes: str) -> DataFrame:
    """Sales of stores that have a location."""
    places = star.table("dimension_store_locations", "location_key", "city", "country")
    return star.sold("store_key", "location_key", *attributes).join(places, "location_key")


def report_stores_sales(star: Star) -> DataFrame:
    rows = store_sales(star, "store_name").groupBy("store_key", "store_name", "city", "country")
    rows = rows.agg(_revenue(), _quantity(), _sales(), _mart_mean("avg_check"))
    return enforce(rows, MARTS["report_stores_sales"])


def top_stores(star: Star) -> DataFrame:
    groups = ["store_name", "city", "country"]
    rows = store_sales(star, "store_name").groupBy(*groups).agg(_revenue(), _quantity(), _sales())
    return top_k(rows, "total_revenue", TOP_STORES, groups)


def sales_by_location(star: Star) -> DataFrame:
    """Rows are one per store, so counting them counts distinct stores."""
    rows = store_sales(star).groupBy("city", "country")
    return rows.agg(_revenue(), _quantity(), _sales(), F.count("*").alias("store_count"))


def store_avg_check(star: Star) -> DataFrame:
    rows = store_sales(star, "store_name").groupBy("store_name", "city", "country")
    return rows.agg(_mean("avg_check"), _revenue(), _sales())


# --- suppliers --------------------------------------------------------------


def supplier_sales(star: Star, *attributes: str) -> DataFrame:
    """Sales of products that have a supplier, one row per product."""
    suppliers = star.table("dimension_suppliers", "supplier_key", *attributes)
    return star.sold("product_key", "supplier_key", "price").join(suppliers, "supplier_key")


def report_suppliers_sales(star: Star) -> DataFrame:
    """The average price is over sales, so each price counts once per sale."""
    rows = supplier_sales(star, "supplier_name", "country").groupBy("supplier_key", "supplier_name", "country")
    price = mart_mean(F.sum(F.col("price") * F.col("sales")), F.sum("sales")).alias("avg_product_price")
    return enforce(rows.agg(_revenue(), _quantity(), _sales(), price), MARTS["report_suppliers_sales"])


def top_suppliers(star: Star) -> DataFrame:
    groups = ["supplier_name", "country"]
    rows = supplier_sales(star, *groups).groupBy(*groups).agg(_revenue(), _quantity(), _sales())
    return top_k(rows, "total_revenue", TOP_SUPPLIERS, groups)


def supplier_avg_price(star: Star) -> DataFrame:
    """The average price is over products, sold or not."""
    products = star.table("dimension_products", "supplier_key", "price")
    suppliers = star.table("dimension_suppliers", "supplier_key", "supplier_name", "country")
    rows = products.join(suppliers, "supplier_key").groupBy("supplier_name", "country")
    return rows.agg(
        mean_money(F.sum("price"), F.count("price")).alias("avg_product_price"), F.count("*").alias("product_count")
    )


def sales_by_supplier_country(star: Star) -> DataFrame:
    rows = supplier_sales(star, "country").groupBy("country")
    return rows.agg(_revenue(), _quantity(), _sales(), F.countDistinct("supplier_key").alias("supplier_count"))


# --- product quality --------------------------------------------------------


def report_product_quality(star: Star) -> DataFrame:
    """The average rating of one rating is that rating."""
    rows = star.sold("product_key", "product_name", "rating", "reviews_count").groupBy("product_name", "rating", "reviews_count")
    rows = rows.agg(_quantity("total_quantity_sold"), _revenue(), _sales()).withColumn("avg_rating", F.col("rating"))
    return enforce(rows, MARTS["report_product_quality"])


def products_by_rating(star: Star) -> DataFrame:
    return _rated_products(star, "variants_count")


def products_by_reviews(star: Star) -> DataFrame:
    rows = _rated_products(star, "variants_count").select("product_name", "total_reviews", "avg_rating", "variants_count")
    return rows.orderBy(F.col("total_reviews").desc_nulls_last(), "product_name")


def rating_sales(star: Star) -> DataFrame:
    rows = star.sold("product_key", "product_name", "rating").groupBy("product_name", "rating")
    rows = rows.agg(_quantity("total_quantity_sold"), _revenue(), _sales())
    return rows.withColumn("avg_rating", F.col("rating").cast("decimal(7,5)"))


def rating_sales_corr(star: Star) -> DataFrame:
    """Correlation of rating and quantity sold, over rated product and rating pairs."""
    rows = rating_sales(star).where(F.col("rating").isNotNull())
    rating, sold = F.col("rating").cast("double"), F.col("total_quantity_sold").cast("double")
    return rows.agg(F.round(F.corr(rating, sold), 6).alias("rating_quantity_corr"), F.count("*").alias("pairs"))


def best_and_worst_rated(star: Star) -> DataFrame:
    """The highest and the lowest rated products, side by side as two short lists."""
    rated = products_by_rating(star).where(F.col("avg_rating").isNotNull())
    best = top_k(rated, "avg_rating", RATED_PRODUCTS, ["product_name"])
    worst = top_k(rated, "avg_rating", RATED_PRODUCTS, ["product_name"], descending=False)
    return best.withColumn("list", F.lit("best")).unionByName(worst.withColumn("list", F.lit("worst")))


MART_PLANS = {
    "report_products_sales": report_products_sales,
    "report_customers_sales": report_customers_sales,
    "report_time_sales": report_time_sales,
    "report_stores_sales": report_stores_sales,
    "report_suppliers_sales": report_suppliers_sales,
    "report_product_quality": report_product_quality,
}

# Dimensions whose surrogate key a report shows.
SHOWN_KEYS = {
    "report_customers_sales": ("dimension_customers",),
    "report_stores_sales": ("dimension_stores",),
    "report_suppliers_sales": ("dimension_suppliers",),
    "top_customers": ("dimension_customers",),
    "customer_avg_check": ("dimension_customers",),
}

BREAKDOWNS = {
    "top_products": top_products,
    "revenue_by_category": revenue_by_category,
    "product_ratings": product_ratings,
    "top_customers": top_customers,
    "customers_by_country": customers_by_country,
    "customer_avg_check": customer_avg_check,
    "monthly_trends": monthly_trends,
    "yearly_trends": yearly_trends,
    "quarterly_trends": quarterly_trends,
    "top_stores": top_stores,
    "sales_by_location": sales_by_location,
    "store_avg_check": store_avg_check,
    "top_suppliers": top_suppliers,
    "supplier_avg_price": supplier_avg_price,
    "sales_by_supplier_country": sales_by_supplier_country,
    "products_by_rating": products_by_rating,
    "rating_sales": rating_sales,
    "products_by_reviews": products_by_reviews,
    "best_and_worst_rated": best_and_worst_rated,
    "rating_sales_corr": rating_sales_corr,
    "period_comparison": period_comparison,
}


def preview(star: Star, mart: str, rows: int = 5) -> DataFrame:
    """The first rows of a mart in its stored order, made total by its other columns."""
    df = MART_PLANS[mart](star)
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(rows)


def best_selling_rows(star: Star, rows: int = 10) -> DataFrame:
    """The rows of the product mart with the highest revenue."""
    df = report_products_sales(star)
    ties = [c for c in df.columns if c != "total_revenue"]
    return top_k(df, "total_revenue", rows, ties)
