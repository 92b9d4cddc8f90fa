"""Rules on which row, key or parent a star takes, one small staging table each."""

from decimal import Decimal

from conftest import day, rows_of

from retailmart.plans import audits
from retailmart.plans.adhoc import q_by_breed
from retailmart.plans.marts import report_products_sales, report_time_sales
from retailmart.plans.star import KEY_ORDER, DerivedStar, sales


def star(spark, read, dense=tuple(KEY_ORDER)):
    return DerivedStar(spark, read, dense)


def test_row_with_the_lowest_id_is_kept(spark, staged):
    read = staged(
        {"id": 7, "customer_email": " ANN@mail.test", "customer_age": 50},
        {"id": 3, "customer_age": 20},
        {"id": 5, "customer_email": "  ", "customer_age": 90},
    )
    assert rows_of(star(spark, read).table("dimension_customers", "customer_key", "email", "age")) == [(1, "ann@mail.test", 20)]


def test_breed_without_type_is_left_out(spark, staged):
    read = staged(
        {"customer_pet_breed": "A", "customer_pet_type": None},
        {"customer_pet_breed": "A", "customer_pet_type": " cat "},
        {"customer_pet_breed": "B", "customer_pet_type": None},
        {"customer_pet_breed": " ", "customer_pet_type": "dog"},
    )
    assert rows_of(star(spark, read).table("dimension_pet_breeds")) == [(1, "A", "cat")]


def test_pets_are_distinct_after_the_breed_lookup(spark, staged):
    read = staged(
        {"customer_pet_name": "Rex", "customer_pet_breed": None},
        {"customer_pet_name": "Rex ", "customer_pet_breed": ""},
        {"customer_pet_name": "Rex", "customer_pet_breed": "Husky"},
        {"customer_pet_name": " ", "customer_pet_breed": "Husky"},
    )
    assert rows_of(star(spark, read).table("dimension_pets")) == [(1, "Rex", None, "dog"), (2, "Rex", 1, "dog")]


def test_shared_pet_name_takes_the_lowest_pet(spark, staged):
    read = staged(
        {"customer_email": "b@x", "customer_pet_breed": "Husky"},
        {"customer_email": "a@x", "customer_pet_breed": "Akita"},
        {"customer_email": "c@x", "customer_pet_name": "Tom", "customer_pet_breed": "Husky"},
        {"customer_email": "d@x", "customer_pet_name": None},
    )
    found = rows_of(star(spark, read).table("dimension_customers", "customer_key", "email", "pet_key"))
    assert found == [(1, "a@x", 1), (2, "b@x", 1), (3, "c@x", 3), (4, "d@x", None)]


def test_locations_keep_null_and_blank_state_apart_but_a_store_takes_one(spark, staged):
    places = [("C", None, "X"), ("C", "", "X"), ("C", "ST", "X"), (None, "ST", "X"), ("", "ST", "X"), ("C", "ST", None)]
    read = staged(
        *[{"store_name": f"S{n}", "store_city": c, "store_state": s, "store_country": k} for n, (c, s, k) in enumerate(places)]
    )
    s = star(spark, read)
    assert rows_of(s.table("dimension_store_locations")) == [
        (1, "", "ST", "X"), (2, "C", None, "X"), (3, "C", "", "X"), (4, "C", "ST", "X"), (5, "Unknown", "ST", "X"),
    ]
    found = rows_of(s.table("dimension_stores", "store_name", "location_key"))
    assert found == [("S0", 2), ("S1", 2), ("S2", 4), ("S3", 5), ("S4", 1), ("S5", None)]


def test_product_variants_and_their_parents(spark, staged):
    read = staged(
        {"product_color": None, "product_size": "", "supplier_email": "b@s"},
        {"product_color": " ", "product_size": None, "supplier_email": "a@s"},
        {"product_price": None, "product_category": " ", "supplier_email": " "},
        {"product_name": "", "supplier_email": None},
        {"product_expiry_date": "13/45/2021", "product_color": "blue"},
    )
    s = star(spark, read)
    found = s.table(
        "dimension_products", "product_key", "product_name", "color", "size", "price", "category_key", "supplier_key",
        "release_date", "expiry_date",
    )
    five, release, expiry = Decimal("5.00"), day(2015, 2, 3), day(2027, 2, 3)
    assert rows_of(found) == [
        (1, "Ball", None, None, five, 1, 2, release, expiry),
        (2, "Ball", "blue", "M", five, 1, 3, release, None),
        (3, "Ball", "red", "M", None, None, None, release, expiry),
    ]


def test_sales_that_miss_a_party_or_a_value_are_dropped_and_explained(spark, staged):
    read = staged(
        {},
        {"sale_date": "13/45/2021"},
        {"sale_date": None},
        {"sale_quantity": None, "store_name": None},
        {"sale_total_price": None},
        {"customer_email": " "},
        {"seller_email": None},
        {"product_name": ""},
        {"product_price": None},
        {"store_name": " "},
    )
    fact = star(spark, read).table("fact_sales")
    assert rows_of(fact, "date_key", "quantity") == [(20210105, 2), (None, 2)]
    lines = {r.reason: (r.having, r.charged) for r in audits.reconcile(read).collect()}
    assert lines["no quantity"] == (1, 1)
    assert lines["no store name"] == (2, 1)
    assert lines["kept"] == (2, 1)
    assert lines["kept, not in the calendar"] == (1, 1)
    assert sum(charged for _, charged in lines.values()) == 10


def test_predicates_equal_the_lookup_joins(spark, staged):
    """A sale is kept exactly when each of its natural keys is found in the dimensions."""
    dirt = [None, "", " ", "x"]
    read = staged(
        *[
            {"customer_email": dirt[n % 4], "seller_email": dirt[n // 4 % 4], "store_name": dirt[n // 16 % 4],
             "product_name": dirt[n // 64 % 4], "product_price": None if n % 5 == 1 else Decimal("1.00"),
             "product_color": dirt[n % 3], "product_size": dirt[n % 4]}
            for n in range(256)
        ]
    )
    assert star(spark, read).table("fact_sales").count() == sales(read).count() == 1


def test_natural_and_dense_keys_give_the_same_report(spark, staged):
    read = staged({}, {"product_color": None}, {"product_color": " ", "sale_quantity": 5}, {"product_category": None})
    dense, natural = star(spark, read), star(spark, read, ())
    for report in (report_products_sales, report_time_sales, audits.lost_in_reports, audits.references):
        assert rows_of(report(dense)) == rows_of(report(natural))


def test_null_colour_sells_once(spark, staged):
    read = staged({"product_color": None, "product_size": None}, {"product_color": "", "product_size": " "})
    assert rows_of(star(spark, read).totals("product_key")) == [(1, 4, Decimal("20.00"), 2)]


def test_breeds_count_customers_without_sales(spark, staged):
    read = staged({}, {"customer_email": "b@x", "sale_quantity": None}, {"customer_email": "c@x", "customer_pet_name": None})
    assert rows_of(q_by_breed(star(spark, read, ()))) == [("Husky", "dog", 2, 1, Decimal("10.00"))]
    idle = staged({"sale_quantity": None})
    assert rows_of(q_by_breed(star(spark, idle, ()))) == [("Husky", "dog", 1, 0, None)]


def test_dates_outside_the_calendar_leave_the_time_reports(spark, staged):
    read = staged({}, {"sale_date": "1/5/2009"}, {"sale_date": "13/45/2021"})
    s = star(spark, read, ())
    assert rows_of(report_time_sales(s), "date_key", "sales_count") == [(20210105, 1)]
    dates = [r for r in audits.references(s).collect() if r.column_name == "date_key"]
    assert [(r.checked, r.orphans) for r in dates] == [(2, 1)]


def test_same_star_from_shuffled_input_and_other_partition_counts(spark, staged):
    read = staged(*[{"id": n // 2, "customer_email": f"c{n % 7}@x", "customer_age": n % 5} for n in range(60)])
    shuffled = read().repartition(5, "customer_age")
    expected = rows_of(star(spark, read).table("dimension_customers"))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows_of(star(spark, lambda *c: shuffled.select(*c)).table("dimension_customers")) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
