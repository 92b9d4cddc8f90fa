"""Declared schemas: staging, star and marts.

Identifiers and surrogate keys are ``bigint``: at the intended scale a table may
hold more rows than a 32-bit integer counts.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

LONG, INT, SHORT, TEXT = LongType(), IntegerType(), ShortType(), StringType()
DATE, FLAG = DateType(), BooleanType()
PRICE, RATING, MONEY = DecimalType(10, 2), DecimalType(3, 1), DecimalType(18, 2)


def table(required: tuple[str, ...] = (), **columns: DataType) -> StructType:
    """Columns in the given order; those in ``required`` may not be NULL."""
    return StructType([StructField(name, kind, name not in required) for name, kind in columns.items()])


# fixed values: the 50 staging columns, in file order
STAGING = table(
    id=LONG, customer_first_name=TEXT, customer_last_name=TEXT, customer_age=INT, customer_email=TEXT,
    customer_country=TEXT, customer_postal_code=TEXT, customer_pet_type=TEXT, customer_pet_name=TEXT,
    customer_pet_breed=TEXT, seller_first_name=TEXT, seller_last_name=TEXT, seller_email=TEXT, seller_country=TEXT,
    seller_postal_code=TEXT, product_name=TEXT, product_category=TEXT, product_price=PRICE, product_quantity=INT,
    sale_date=TEXT, sale_customer_id=LONG, sale_seller_id=LONG, sale_product_id=LONG, sale_quantity=INT,
    sale_total_price=PRICE, store_name=TEXT, store_location=TEXT, store_city=TEXT, store_state=TEXT,
    store_country=TEXT, store_phone=TEXT, store_email=TEXT, pet_category=TEXT, product_weight=PRICE,
    product_color=TEXT, product_size=TEXT, product_brand=TEXT, product_material=TEXT, product_description=TEXT,
    product_rating=RATING, product_reviews=INT, product_release_date=TEXT, product_expiry_date=TEXT,
    supplier_name=TEXT, supplier_contact=TEXT, supplier_email=TEXT, supplier_phone=TEXT, supplier_address=TEXT,
    supplier_city=TEXT, supplier_country=TEXT,
)

# fixed values: identifiers shifted by the file number at ingest
OFFSET_COLUMNS = ("id", "sale_customer_id", "sale_seller_id", "sale_product_id")

# fixed values: star tables, primary key first
STAR = {
    "dimension_pet_breeds": table(
        breed_key=LONG, breed_name=TEXT, pet_type=TEXT,
        required=("breed_key", "breed_name", "pet_type"),
    ),
    "dimension_pets": table(
        pet_key=LONG, pet_name=TEXT, breed_key=LONG, pet_type=TEXT,
        required=("pet_key",),
    ),
    "dimension_customers": table(
        customer_key=LONG, customer_id=LONG, first_name=TEXT, last_name=TEXT, age=INT, email=TEXT, country=TEXT,
        postal_code=TEXT, pet_key=LONG,
        required=("customer_key", "email"),
    ),
    "dimension_sellers": table(
        seller_key=LONG, seller_id=LONG, first_name=TEXT, last_name=TEXT, email=TEXT, country=TEXT, postal_code=TEXT,
        required=("seller_key", "email"),
    ),
    "dimension_store_locations": table(
        location_key=LONG, city=TEXT, state=TEXT, country=TEXT,
        required=("location_key", "country"),
    ),
    "dimension_stores": table(
        store_key=LONG, store_name=TEXT, location=TEXT, location_key=LONG, phone=TEXT, email=TEXT,
        required=("store_key", "store_name"),
    ),
    "dimension_product_categories": table(
        category_key=LONG, category_name=TEXT, pet_category=TEXT,
        required=("category_key", "category_name"),
    ),
    "dimension_suppliers": table(
        supplier_key=LONG, supplier_name=TEXT, contact_name=TEXT, email=TEXT, phone=TEXT, address=TEXT, city=TEXT,
        country=TEXT,
        required=("supplier_key", "email"),
    ),
    "dimension_products": table(
        product_key=LONG, product_id=LONG, product_name=TEXT, category_key=LONG, supplier_key=LONG, price=PRICE,
        weight=PRICE, color=TEXT, size=TEXT, brand=TEXT, material=TEXT, description=TEXT, rating=RATING,
        reviews_count=INT, release_date=DATE, expiry_date=DATE,
        required=("product_key", "product_name"),
    ),
    "dimension_dates": table(
        date_key=INT, full_date=DATE, day=INT, month=INT, year=INT, quarter=INT, day_of_week=INT, day_name=TEXT,
        month_name=TEXT, is_weekend=FLAG,
        required=("date_key", "full_date", "day", "month", "year", "quarter", "day_of_week"),
    ),
    "fact_sales": table(
        sale_key=LONG, date_key=INT, customer_key=LONG, seller_key=LONG, product_key=LONG, store_key=LONG,
        quantity=INT, unit_price=PRICE, total_price=PRICE,
        required=("sale_key", "quantity", "unit_price", "total_price"),
    ),
}

# sums of sales per key, stored with the marts
SUMS = {
    key: table(**{key: kind, "quantity": LONG, "revenue": DecimalType(20, 2), "sales": LONG})
    for key, kind in (("product_key", LONG), ("customer_key", LONG), ("store_key", LONG), ("date_key", INT))
}

# fixed values: the six stored marts
MARTS = {
    "report_products_sales": table(
        product_name=TEXT, category_name=TEXT, total_quantity_sold=LONG, total_revenue=MONEY, sales_count=LONG,
        rating=RATING, reviews_count=LONG,
        required=("product_name", "category_name", "total_quantity_sold", "total_revenue", "sales_count"),
    ),
    "report_customers_sales": table(
        customer_key=LONG, first_name=TEXT, last_name=TEXT, country=TEXT, total_purchases=MONEY, total_items=LONG,
        order_count=LONG, avg_check=MONEY,
        required=("customer_key", "total_purchases", "total_items", "order_count", "avg_check"),
    ),
    "report_time_sales": table(
        date_key=INT, full_date=DATE, year=INT, month=SHORT, quarter=SHORT, month_name=TEXT, daily_revenue=MONEY,
        daily_quantity=LONG, sales_count=LONG, avg_order_size=MONEY,
        required=(
            "date_key", "full_date", "year", "month", "quarter", "month_name", "daily_revenue", "daily_quantity",
            "sales_count", "avg_order_size",
        ),
    ),
    "report_stores_sales": table(
        store_key=LONG, store_name=TEXT, city=TEXT, country=TEXT, total_revenue=MONEY, total_quantity=LONG,
        sales_count=LONG, avg_check=MONEY,
        required=(
            "store_key", "store_name", "city", "country", "total_revenue", "total_quantity", "sales_count",
            "avg_check",
        ),
    ),
    "report_suppliers_sales": table(
        supplier_key=LONG, supplier_name=TEXT, country=TEXT, total_revenue=MONEY, total_quantity=LONG,
        sales_count=LONG, avg_product_price=MONEY,
        required=("supplier_key", "total_revenue", "total_quantity", "sales_count", "avg_product_price"),
    ),
    "report_product_quality": table(
        product_name=TEXT, rating=RATING, reviews_count=LONG, total_quantity_sold=LONG, total_revenue=MONEY,
        sales_count=LONG, avg_rating=RATING,
        required=("product_name", "total_quantity_sold", "total_revenue", "sales_count"),
    ),
}

# fixed values: row order inside the stored mart files
MART_ORDER = {
    "report_products_sales": ("product_name", "category_name"),
    "report_customers_sales": ("customer_key",),
    "report_time_sales": ("date_key",),
    "report_stores_sales": ("store_key",),
    "report_suppliers_sales": ("supplier_key",),
    "report_product_quality": ("product_name",),
}

# fixed values: mart columns meant to be filled whose source in the star may be NULL
MART_WISHES = {
    "report_customers_sales": ("first_name", "last_name", "country"),
    "report_suppliers_sales": ("supplier_name", "country"),
    "report_product_quality": ("avg_rating",),
}

# fixed values: declared text lengths of the star tables
TEXT_LENGTHS = {
    "dimension_pet_breeds": {"breed_name": 100, "pet_type": 50},
    "dimension_pets": {"pet_name": 100, "pet_type": 50},
    "dimension_customers": {
        "first_name": 100, "last_name": 100, "email": 200, "country": 100, "postal_code": 50,
    },
    "dimension_sellers": {
        "first_name": 100, "last_name": 100, "email": 200, "country": 100, "postal_code": 50,
    },
    "dimension_store_locations": {"city": 100, "state": 100, "country": 100},
    "dimension_stores": {"store_name": 200, "location": 200, "phone": 50, "email": 200},
    "dimension_product_categories": {"category_name": 100, "pet_category": 100},
    "dimension_suppliers": {
        "supplier_name": 200, "contact_name": 200, "email": 200, "phone": 50, "address": 200,
        "city": 100, "country": 100,
    },
    "dimension_products": {
        "product_name": 200, "color": 50, "size": 50, "brand": 100, "material": 100,
    },
    "dimension_dates": {"day_name": 20, "month_name": 20},
}

# fixed values: declared precision and scale of the star's amounts
PRECISIONS = {
    "dimension_products": {"price": (10, 2), "weight": (10, 2), "rating": (3, 1)},
    "fact_sales": {"unit_price": (10, 2), "total_price": (10, 2)},
}

# fixed values: columns that must be filled, and natural keys that must be unique
REQUIRED = {
    "dimension_pet_breeds": ("breed_name", "pet_type"),
    "dimension_pets": ("pet_type",),
    "dimension_customers": ("customer_id", "email"),
    "dimension_sellers": ("seller_id", "email"),
    "dimension_store_locations": ("country",),
    "dimension_stores": ("store_name",),
    "dimension_product_categories": ("category_name",),
    "dimension_suppliers": ("supplier_name", "email"),
    "dimension_products": ("product_id", "product_name"),
    "dimension_dates": ("full_date", "day", "month", "year", "quarter", "day_of_week"),
    "fact_sales": ("quantity", "unit_price", "total_price"),
}
UNIQUE = {
    "dimension_pet_breeds": ("breed_name",),
    "dimension_customers": ("email",),
    "dimension_sellers": ("email",),
    "dimension_store_locations": ("city", "state", "country"),
    "dimension_stores": ("store_name",),
    "dimension_product_categories": ("category_name",),
    "dimension_suppliers": ("email",),
    "dimension_products": ("product_name", "color", "size", "price"),
    "dimension_dates": ("full_date",),
}

# fixed values: foreign keys as child table, column, parent table
REFERENCES = (
    ("dimension_pets", "breed_key", "dimension_pet_breeds"),
    ("dimension_customers", "pet_key", "dimension_pets"),
    ("dimension_stores", "location_key", "dimension_store_locations"),
    ("dimension_products", "category_key", "dimension_product_categories"),
    ("dimension_products", "supplier_key", "dimension_suppliers"),
    ("fact_sales", "date_key", "dimension_dates"),
    ("fact_sales", "customer_key", "dimension_customers"),
    ("fact_sales", "seller_key", "dimension_sellers"),
    ("fact_sales", "product_key", "dimension_products"),
    ("fact_sales", "store_key", "dimension_stores"),
)
