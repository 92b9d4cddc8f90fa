"""Batches that add to a stored star, the commit log, the layout of the fact."""

from decimal import Decimal

import pytest
from conftest import COMPLETE, rows_of

from retailmart.plans.jobs import add_staging, build_marts, read_mart, read_star, update, update_star
from retailmart.plans.marts import MART_PLANS
from retailmart.schemas import SUMS, STAGING, STAR
from retailmart.sources.store import Conflict, Store

FIRST = (
    {"id": 1}, {"id": 2, "customer_email": "Bob@mail.test ", "customer_pet_name": "Tom", "product_color": None, "sale_date": "2/7/2021"},
    {"id": 3, "store_name": "Second", "store_state": None, "sale_date": "2/9/2021", "sale_quantity": 5}, {"id": 4, "product_category": " "},
)
SECOND = (
    {"id": 11, "customer_first_name": "Changed", "sale_date": "2/7/2021"}, {"id": 12, "customer_email": "aaa@mail.test", "store_name": "Aaa", "sale_date": "x"},
    {"id": 13, "product_name": "Aaa", "supplier_email": "aaa@sup.test", "product_category": "Aaa"}, {"id": 14, "product_color": "", "product_price": Decimal("5.00")},
    {"id": 15, "customer_pet_name": "Aaa", "customer_pet_breed": "Aaa", "customer_email": "zzz@mail.test", "store_state": "", "store_name": "Zzz"},
)


def batch(spark, rows):
    return spark.createDataFrame([tuple({**COMPLETE, **r}[c] for c in STAGING.names) for r in rows], STAGING)


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("grown"))
    add_staging(spark, batch(spark, FIRST), target)
    update(spark, target)
    before = {n: rows_of(read_star(spark, target).table(n)) for n in STAR}
    add_staging(spark, batch(spark, SECOND), target)
    return target, before, update(spark, target)


def test_stored_rows_stay_and_new_keys_follow(spark, grown):
    target, before, written = grown
    star = read_star(spark, target)
    for name in STAR:
        after = rows_of(star.table(name))
        assert set(before[name]) <= set(after) and len(after) == len(set(after))
        if name != "dimension_dates":
            assert len(after) - len(before[name]) == written[name]
    keys = {r.email: r.customer_key for r in star.table("dimension_customers").collect()}
    assert keys == {"ann@mail.test": 1, "bob@mail.test": 2, "aaa@mail.test": 3, "zzz@mail.test": 4}
    assert rows_of(star.table("dimension_customers").where("customer_key = 1"), "first_name") == [("Ann",)]
    names = {(r.product_name, r.color): r.product_key for r in star.table("dimension_products").collect()}
    assert names == {("Ball", None): 1, ("Ball", "red"): 2, ("Aaa", "red"): 3}
    sales = star.table("fact_sales")
    assert sales.count() == sales.select("sale_key").distinct().count() == 9
    assert rows_of(sales.where("customer_key = 2"), "product_key", "date_key") == [(1, 20210207)]
    # a customer of the second batch finds a pet of its own
    pets = {r.pet_key: r.pet_name for r in star.table("dimension_pets").collect()}
    assert [pets[r.pet_key] for r in star.table("dimension_customers").where("customer_key = 4").collect()] == ["Aaa"]


def test_parts_of_the_fact_have_its_columns(spark, grown):
    """The folders of months are no column of the fact, so that two loads can be compared row by row."""
    target, before, _ = grown
    store = Store(spark, target, "star")
    old = store.read_parts(store.before(store.commit()).parts["fact_sales"], STAR["fact_sales"])
    assert old.columns == STAR["fact_sales"].names and rows_of(old) == before["fact_sales"]
    assert old.exceptAll(read_star(spark, target).table("fact_sales")).isEmpty()


def test_marts_of_added_sums_equal_marts_of_the_fact(spark, grown):
    target, _, _ = grown
    star, marts = Store(spark, target, "star").commit(), Store(spark, target, "marts").commit()
    assert marts.notes == {"star": star.number, "sales": star.parts["fact_sales"]}
    assert {len(marts.parts[f"sums_{key}"]) for key in SUMS} == {2}
    for name, plan in MART_PLANS.items():
        assert rows_of(read_mart(spark, target, name)) == rows_of(plan(read_star(spark, target)))


def test_nothing_new_is_nothing_to_do(spark, grown):
    target, _, _ = grown
    number = Store(spark, target, "star").commit().number
    assert update_star(spark, target) == {} and Store(spark, target, "star").commit().number == number


def test_many_parts_of_sums_are_merged(spark, grown, monkeypatch):
    target, _, _ = grown
    monkeypatch.setattr("retailmart.plans.jobs.MOST_PARTS", 2)
    add_staging(spark, batch(spark, [{"id": 21, "customer_email": "late@mail.test"}]), target)
    update_star(spark, target)
    build_marts(spark, target)
    marts = Store(spark, target, "marts").commit()
    assert {len(marts.parts[f"sums_{key}"]) for key in SUMS} == {1}
    for name in ("report_customers_sales", "report_time_sales"):
        assert rows_of(read_mart(spark, target, name)) == rows_of(MART_PLANS[name](read_star(spark, target)))


def test_a_month_reads_its_folder_only(spark, grown):
    star = read_star(spark, grown[0]).during(20210201, 20210228)
    assert rows_of(star.totals("date_key"), "date_key", "sales") == [(20210207, 2), (20210209, 1)]
    plan = MART_PLANS["report_time_sales"](star)._jdf.queryExecution().executedPlan().toString()
    assert "sale_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    months = {r.f.split("sale_month=")[1].split("/")[0] for r in star.table("fact_sales").selectExpr("input_file_name() as f").distinct().collect()}
    assert months == {"202102"}


def test_racing_writers(spark, tmp_path):
    """Two writers that build on one commit: one is told of the other. Whole rebuilds take the next number."""
    one, two = (Store(spark, str(tmp_path), "kind", keep=5) for _ in range(2))
    run = one.new_run()
    one.write(spark.range(3), run, "rows")
    first = one.publish(run, notes={"by": "one"})
    a, b = one.new_run(first), two.new_run(two.commit())
    one.write(spark.range(3, 5), a, "rows")
    two.write(spark.range(5, 9), b, "rows")
    second = two.publish(b, first)
    with pytest.raises(Conflict):
        one.publish(a, first)
    schema = spark.range(1).schema
    assert one.commit() == second and one.read(second.run, "rows", schema).count() == 7
    assert one.before(second) == first and one.read(first.run, "rows", schema).count() == 3
    assert one.publish(a).number == 3
    assert two.read(two.latest(), "rows", schema).count() == 5


def test_an_unfinished_commit_is_not_seen(spark, tmp_path):
    store = Store(spark, str(tmp_path), "kind")
    run = store.new_run()
    store.write(spark.range(3), run, "rows")
    done = store.publish(run)
    (tmp_path / "kind" / "runs" / "000000000002.json").write_text('{"run": "half')
    assert Store(spark, str(tmp_path), "kind").commit() == done


def test_parts_in_use_are_kept(spark, tmp_path):
    store = Store(spark, str(tmp_path), "kind", keep=2)
    commit = None
    for n in range(4):
        run = store.new_run(commit)
        store.write(spark.range(n + 1), run, "grows")
        store.write(spark.range(n + 1), run, "replaced", replace=True)
        commit = store.publish(run, commit)
    schema = spark.range(1).schema
    assert store.read(commit.run, "grows", schema).count() == 10 and store.read(commit.run, "replaced", schema).count() == 4
    assert len(commit.parts["grows"]) == 4 and len(commit.parts["replaced"]) == 1
