from pyspark.sql import functions as F

from conftest import plan, rows
from martloom.operators import quality as Q


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "c")], "n long, s string")
    expected = [("n", 3, 0, 2, "1", "2"), ("s", 3, 1, 2, "a", "c")]
    assert rows(Q.profile(df)) == expected
    assert rows(Q.profile(df, exact=False)) == expected


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], "n long")
    assert rows(Q.profile(df)) == rows(Q.profile(df, exact=False)) == [("n", 0, 0, 0, None, None)]


def test_numbers_are_compared_as_numbers(spark):
    df = spark.createDataFrame([(9,), (10,)], "n long")
    assert rows(Q.profile(df), "min_value", "max_value") == [("9", "10")]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,)], "fk long")
    parent = spark.createDataFrame([(1,), (4,)], "pk long")
    assert rows(Q.orphans(child, "fk", parent, "pk")) == [(2,)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k long, v string")
    assert rows(Q.duplicates(df, ["k", "v"])) == [(1, "a", 2), (None, "c", 2)]


def test_bag_difference_sees_both_directions_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k long, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k long, v string")
    assert rows(Q.bag_difference(a, b)) == [(1, None, 1), (3, "y", -1)]
    assert rows(Q.bag_difference(a, a)) == []


def test_digests_find_the_same_differences(spark):
    a = [(i, None if i % 3 else f"v{i}", float(i)) for i in range(60)] + [(1, None, 1.0), (None, "x", None), (None, None, 2.0)]
    b = [r for r in a if r[0] != 7] + [(8, None, 8.0), (None, "x", None)]
    schema = "k long, v string, d double"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    for buckets in (1, 7, 1024):
        assert rows(Q.bag_difference_by_digest(left, right, buckets)) == rows(Q.bag_difference(left, right))
    assert rows(Q.bag_difference_by_digest(left, left.repartition(5))) == []
    # A null moved to another column is another row.
    moved = spark.createDataFrame([("a", None)], "x string, y string"), spark.createDataFrame([(None, "a")], "x string, y string")
    assert Q.bag_difference_by_digest(*moved).count() == 2
    none = left.filter("false")
    assert rows(Q.bag_difference_by_digest(none, none)) == []
    assert Q.bag_difference_by_digest(left, none).count() == Q.bag_difference(left, none).count()


def test_equal_tables_group_no_whole_rows(spark):
    left = spark.range(100).select("id", F.lit("x").alias("v"))
    assert "HashAggregate" not in plan(Q.bag_difference_by_digest(left, left.repartition(3)))
