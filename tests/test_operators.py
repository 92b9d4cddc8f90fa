from decimal import Decimal

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailmart.operators.contract import enforce
from retailmart.operators.dedup import first_by, first_non_null, insert_new
from retailmart.operators.joins import lookup, lowest_key
from retailmart.operators.keys import number_rows
from retailmart.operators.quality import duplicates, null_counts, orphans, too_long
from retailmart.operators.ranking import table_counts, top_k
from retailmart.schemas import INT, PRICE, TEXT, table

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_first_by_takes_the_lowest_id(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, None, "z"), (5, None, "w")], "id int, k string, v string")
    assert rows_of(first_by(df, ["k"], ["id"])) == [(1, "a", "y"), (2, None, "z")]


def test_first_by_breaks_ties_by_the_rest_null_first(spark):
    rows = [(1, "a", "y", 1), (1, "a", "x", 9), (1, "b", "x", 1), (1, "b", None, 5)]
    df = spark.createDataFrame(rows, "id int, k string, v string, n int")
    assert rows_of(first_by(df, ["k"], ["id"])) == [(1, "a", "x", 9), (1, "b", None, 5)]


@few
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]), st.sampled_from([None, "", "x", "y"])),
        min_size=1, max_size=30,
    ),
    parts=st.sampled_from([1, 3, 7]),
)
def test_first_by_equals_brute_force(spark, rows, parts):
    expected = {}
    for row in rows:
        rank = (row[0], row[2] is not None, row[2] or "")
        if row[1] not in expected or rank < expected[row[1]][0]:
            expected[row[1]] = (rank, row)
    df = spark.createDataFrame(rows, "id int, k string, v string").repartition(parts)
    assert rows_of(first_by(df, ["k"], ["id"])) == sorted((r for _, r in expected.values()), key=repr)


def test_first_by_on_one_hot_key(spark):
    hot = spark.range(200_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") * 7).alias("v"),
    )
    assert first_by(hot, ["k"], ["id"]).where("k = 'hot'").collect() == [(1, "hot", 7)]


def test_first_non_null(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, "a", "y"), (4, "b", None)], "id int, k string, v string")
    assert rows_of(first_non_null(df, ["k"], "v", "id")) == [("a", "x"), ("b", None)]


def test_insert_new_skips_known_and_repeated_keys(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], "id int, k string")
    target = spark.createDataFrame([(9, "a")], "id int, k string")
    assert rows_of(insert_new(batch, target, ["k"], ["id"]), "id", "k") == [(2, "b"), (4, "c")]


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_numbers_are_dense_and_follow_the_order(spark, parts):
    texts = [None, "", "a"] + [f"Customer#{n:06d}" for n in range(400)]
    rows = [(t, n) for t in texts for n in (None, 1, 2)]
    df = spark.createDataFrame(rows, "t string, n int").repartition(parts)
    first = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0)
    expected = [(k, *r) for k, r in enumerate(sorted(rows, key=first), 1)]
    assert sorted(tuple(r) for r in number_rows(df, ["t", "n"], "key").collect()) == expected


def test_numbers_over_many_written_partitions(spark):
    """Without merging of small partitions, every partition needs its own offset."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
        numbered = number_rows(df, ["v"], "key")
        assert numbered.where("key = v + 1").count() == 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbers_of_nothing(spark):
    assert number_rows(spark.range(0).select(F.col("id").alias("v")), ["v"], "key").collect() == []


def test_lookup_null_safe_only_where_asked(spark):
    rows = spark.createDataFrame([("a", None), ("a", "x"), (None, None)], "n string, c string")
    dimension = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, None)], "key int, n string, c string")
    on = {"n": "n", "c": "c"}
    assert rows_of(lookup(rows, dimension, on, ["key"], null_safe=["c"])) == [("a", "x", 2), ("a", None, 1)]
    assert rows_of(lookup(rows, dimension, on, ["key"], "left"), "n", "key") == [("a", 2), ("a", None), (None, None)]


def test_lowest_key_makes_the_join_single(spark):
    pets = spark.createDataFrame([(4, "Rex"), (2, "Rex"), (3, "Tom")], "key int, name string")
    assert rows_of(lowest_key(pets, ["name"], "key")) == [("Rex", 2), ("Tom", 3)]


def test_top_k_breaks_ties_and_plans_as_a_heap(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", None)], "n string, v int")
    best = top_k(df, "v", 2, ["n"])
    assert [tuple(r) for r in best.collect()] == [("c", 9), ("a", 5)]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()
    assert [r.n for r in top_k(df, "v", 2, ["n"], descending=False).collect()] == ["a", "b"]


def test_table_counts(spark):
    counts = table_counts({"one": spark.range(3), "two": spark.range(0)})
    assert rows_of(counts) == [("one", 3), ("two", 0)]


def test_enforce_casts_orders_and_guards(spark):
    schema = table(b=INT, a=PRICE, c=TEXT, required=("b",))
    df = spark.createDataFrame([(Decimal("1.2"), 3, None)], "a decimal(20,1), b bigint, c string")
    assert enforce(df, schema).collect() == [(3, Decimal("1.20"), None)]
    assert [f.dataType for f in enforce(df, schema).schema] == [f.dataType for f in schema]
    with pytest.raises(Exception, match="b must not be NULL"):
        enforce(df.withColumn("b", F.lit(None).cast("bigint")), schema).collect()


def test_quality_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("bbb", 9), (None, None)], "t string, r int")
    assert rows_of(null_counts(df, ["t", "r"])) == [("r", 4, 1), ("t", 4, 1)]
    assert rows_of(too_long(df, {"t": 2})) == [("t", 3, 1)]
    assert rows_of(duplicates(df, ["t"])) == [(3, 1)]
    parent = spark.createDataFrame([(1,), (2,)], "key int")
    assert rows_of(orphans(df, "r", parent, "key")) == [(3, 1)]
