"""Shapes of physical plans that must hold at scale."""

import pytest
from conftest import SMALL, rows_of

from retailmart.operators.dedup import first_by
from retailmart.operators.joins import lookup
from retailmart.plans.star import customers, products, sales
from retailmart.plans.jobs import add_staging, update
from retailmart.schemas import STAR
from retailmart.session import hashed_joins
from retailmart.sources.store import Store
from retailmart.trial.queries import QUERIES, reader
from retailmart.trial.staging import _fast


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = ("report_products_sales", "report_time_sales", "report_product_quality", "top_products", "q_by_customer_country",
        "q_age_by_category", "q_by_breed", "dq_reconcile", "agg_mixed_distinct", "sales_by_location")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonEval", "MapInPandas", "ArrowEval"):
        assert bad not in text


def test_sales_are_summed_before_any_dimension_joins(spark):
    """The first exchange above the sales scan carries partial sums."""
    text = plan(QUERIES["report_products_sales"](spark, SMALL))
    assert "partial_sum(total_price" in text
    above = text[: text.index("partial_sum(total_price")]
    assert "Join" in above and "Window" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["clean_email"](spark, SMALL))
    assert "part.parquet" not in text and "supplier.parquet" not in text and "nation.parquet" not in text
    assert "l_extendedprice" not in text
    rows = sales(reader(spark, SMALL)).select("quantity")
    assert "p_brand" not in plan(rows) and "l_tax" not in plan(rows)


def test_distinct_counts_stay_hash_aggregates(spark):
    text = plan(QUERIES["agg_mixed_distinct"](spark, SMALL))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


@pytest.mark.parametrize("table", [customers, products])
def test_first_rows_are_found_by_hash(spark, table):
    """No sort over staging: only the few rows that hold a smallest identifier are sorted, above the joins that find them."""
    read = reader(spark, SMALL)
    plan = table(read)._jdf.queryExecution().sparkPlan().toString()
    sorted_at = [i for i, line in enumerate(plan.split("\n")) if "SortAggregate" in line]
    joined_at = [i for i, line in enumerate(plan.split("\n")) if "LeftSemi" in line]
    assert len(joined_at) >= 2 and max(sorted_at) < min(joined_at)


@pytest.mark.parametrize("table", [customers, products])
def test_rows_are_not_shuffled_to_find_the_first(spark, table):
    """Rows with attributes meet the marks of the smallest identifiers in their own task, however many there are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = table(reader(spark, SMALL))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("LeftSemi, BuildRight") == 1 and text.index("SortMergeJoin") < text.index("BroadcastHashJoin")


def test_steps_of_staging_are_small(spark):
    """Line items shuffle by order and part only, and no step works out all columns: such code is interpreted."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = reader(spark, SMALL)()._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    line = [t for t in text.split("\n") if "SortMergeJoin" in t and "l_suppkey" in t]
    assert not line and "s_suppkey" in text
    assert max(t.count(" AS ") for t in text.split("\n") if "Project" in t) < 25


def test_first_rows_with_ties_and_nulls(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("a", 1, "y"), (None, 3, "q"), (None, None, "s"), (None, None, None), ("b", None, "t"), ("c", 1, None)]
    df = spark.createDataFrame(rows, "k string, id int, v string").repartition(3)
    assert rows_of(first_by(df, ["k"], ["id"])) == sorted([("a", 1, "y"), (None, None, None), ("b", None, "t"), ("c", 1, None)], key=repr)
    assert rows_of(first_by(df, ["k"], ["v", "id"])) == sorted([("a", 2, "x"), (None, None, None), ("b", None, "t"), ("c", 1, None)], key=repr)


@pytest.mark.parametrize("name", ["dq_fk", "dq_at_once"])
def test_checks_read_each_stored_table_once(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert text.count("FileScan parquet") == len(STAR) and "Batched: true" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_references_are_compared_as_numbers(spark):
    """Sales are many: no text is made of their keys."""
    text = plan(QUERIES["dq_fk"](spark, SMALL))
    assert "to_json" not in text and "StructsToJson" not in text


def test_texts_of_parts_and_suppliers_are_passed_on_as_one_value(spark):
    """Joins of line items copy each column they pass on: what a part or a supplier decides alone is a single one."""
    text = reader(spark, SMALL)()._jdf.queryExecution().optimizedPlan().toString()
    assert text.count(" AS _part#") == 1 and text.count(" AS _supplier#") == 1


def test_sales_are_shuffled_with_the_numbers_of_small_dimensions(spark):
    """Sellers and stores are looked up below customers and products, which are many: no text of theirs is shuffled for those."""
    text = QUERIES["fact_sales"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # from the last join to the first: by descending size
    names = ("customer_email", "seller_email", "product_name", "store_name")
    order = [n for t in text.split("\n") if "Join Inner, " in t for n in names if f"({n}#" in t]
    assert set(order[:2]) == {"customer_email", "product_name"} and set(order[2:]) == {"seller_email", "store_name"}


def test_known_keys_are_dropped_before_rows_are_looked_for(spark):
    """Of a batch only the first rows of new keys come back, also where keys are NULL."""
    rows = [("a", 2, "x"), ("a", 1, "z"), (None, 3, "q"), (None, None, "s"), ("b", None, "t"), ("c", 1, None)]
    df, known = spark.createDataFrame(rows, "k string, id int, v string"), spark.createDataFrame([("a",), (None,)], "k string")
    new = first_by(df, ["k"], ["id"], known)
    assert rows_of(new) == sorted([("b", None, "t"), ("c", 1, None)], key=repr)
    assert first_by(df, ["k"], ["id"], df.select("k")).isEmpty()
    text = new._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("LeftSemi") < text.index("LeftAnti")  # below the joins that find the rows


HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def test_rows_are_looked_up_in_hash_tables_and_not_sorted(spark):
    """A lookup by text that is too large to broadcast sorts neither side, and finds the same."""
    before = spark.conf.get(HASHED)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(3000).selectExpr("concat('key ', id % 70) as k", "id")
        dimension = spark.range(60).selectExpr("concat('key ', id) as name", "id as number")
        sorted_rows = rows_of(lookup(rows, dimension, {"k": "name"}, ["number"]))
        with hashed_joins(spark):
            found = lookup(rows, dimension, {"k": "name"}, ["number"])
            assert rows_of(found) == sorted_rows
            found.collect()
            final = plan(found).split("Initial Plan")[0]
            assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.conf.get(HASHED) == before


def test_star_loads_look_up_by_hash_and_staging_keeps_small_dictionaries(spark, staged, tmp_path, monkeypatch):
    seen, write = {}, Store.write

    def noted(store, df, run, name, *args, **options):
        seen[name] = (spark.conf.get(HASHED), options.get("options"))
        return write(store, df, run, name, *args, **options)

    monkeypatch.setattr(Store, "write", noted)
    before = spark.conf.get(HASHED)
    add_staging(spark, staged({}, {"customer_email": "b@mail.test"})(), str(tmp_path))
    for extra in ({"customer_email": "c@mail.test"}, {}):
        update(spark, str(tmp_path), "transform")
        assert seen["fact_sales"][0] == seen["dimension_customers"][0] == spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != before
        assert seen["rows"] == (before, {"parquet.dictionary.page.size": 65536}) and spark.conf.get(HASHED) == before
        seen.clear()
        add_staging(spark, staged(extra)(), str(tmp_path))


def test_parts_of_texts_are_found_without_regular_expressions(spark):
    assert "stringsplitsql" not in plan(reader(spark, SMALL)()).lower()
    texts = ["a#b#c", "a#b", "#b", "a#", "#", "##", "a", "", None, " # x", "é#ü#"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 2):
        whole = f"split_part(t, '#', {n})"
        assert _fast(whole) != whole and df.selectExpr(whole).collect() == df.selectExpr(f"{_fast(whole)} as `{df.selectExpr(whole).columns[0]}`").collect()
