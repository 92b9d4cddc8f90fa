import datetime
import os
import sys
from decimal import Decimal

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from retailmart.schemas import STAGING  # noqa: E402

SMALL = "/root/testdata/sf0.001"

COMPLETE = {
    "id": 1,
    "customer_first_name": "Ann",
    "customer_last_name": "Lee",
    "customer_age": 30,
    "customer_email": "ann@mail.test",
    "customer_country": "Peru",
    "customer_postal_code": "01234",
    "customer_pet_type": "dog",
    "customer_pet_name": "Rex",
    "customer_pet_breed": "Husky",
    "seller_first_name": "Sam",
    "seller_last_name": "Roe",
    "seller_email": "sam@shop.test",
    "seller_country": "Chile",
    "seller_postal_code": "02000",
    "product_name": "Ball",
    "product_category": "Toy",
    "product_price": Decimal("5.00"),
    "product_quantity": 9,
    "sale_date": "1/5/2021",
    "sale_customer_id": 11,
    "sale_seller_id": 21,
    "sale_product_id": 31,
    "sale_quantity": 2,
    "sale_total_price": Decimal("10.00"),
    "store_name": "Main",
    "store_location": "Unit 1",
    "store_city": "Lima",
    "store_state": "ST",
    "store_country": "Peru",
    "store_phone": "555",
    "store_email": "main@store.test",
    "pet_category": "Dogs",
    "product_weight": Decimal("1.50"),
    "product_color": "red",
    "product_size": "M",
    "product_brand": "Acme",
    "product_material": "Wool",
    "product_description": "A ball",
    "product_rating": Decimal("4.5"),
    "product_reviews": 7,
    "product_release_date": "2/3/2015",
    "product_expiry_date": "2/3/2027",
    "supplier_name": "Sup",
    "supplier_contact": "Con",
    "supplier_email": "sup@sup.test",
    "supplier_phone": "556",
    "supplier_address": "Street 1",
    "supplier_city": "Town",
    "supplier_country": "Peru",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        # Tiny tables and hundreds of plans: room for the code, small stacks of deep plans aside.
        .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=512m -Xss8m")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def database():
    """The smallest trial tables in the checking database."""
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return connection


@pytest.fixture
def staged(spark):
    """``staged({...}, {...})``: a reader of staging rows, complete but for what is given."""

    def make(*rows):
        filled = [{**COMPLETE, "id": n, **row} for n, row in enumerate(rows, 1)]
        df = spark.createDataFrame([tuple(r[c] for c in STAGING.names) for r in filled], STAGING)
        return lambda *columns: df.select(*(columns or STAGING.names))

    return make


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def day(year, month, number):
    return datetime.date(year, month, number)
