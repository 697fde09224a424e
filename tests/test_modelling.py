from pyspark.sql import functions as F

from conftest import plan, rows
from martloom.operators.modelling import SplitSpec, decompose, dimension, recompose, with_key
from martloom.operators.quality import bag_difference
from martloom.session import stored

SPEC = SplitSpec(
    dims={"user": ["user_id", "user_name"], "dish": ["dish_id", "dish_name", "category"]},
    measures=["order_id", "price", "qty"],
)
SCHEMA = "order_id long, user_id long, user_name string, dish_id long, dish_name string, category string, price decimal(18,2), qty int"


def _wide(spark):
    from decimal import Decimal as D

    return spark.createDataFrame([
        (1, 1, "ann", 10, "soup", "hot", D("3.00"), 1),
        (1, 1, "ann", 10, "soup", "hot", D("3.00"), 1),
        (2, 2, None, 11, "cake", None, D("4.50"), 2),
        (3, 1, "ann b.", 10, "soup", "hot", D("3.20"), 1),
    ], SCHEMA)


def test_split_is_lossless_with_nulls_and_equal_rows(spark):
    wide = _wide(spark)
    tables = decompose(wide, SPEC)
    assert tables["user"].count() == 3 and tables["dish"].count() == 2 and tables["fact"].count() == 4
    assert rows(bag_difference(wide.select(*recompose(tables, SPEC).columns), recompose(tables, SPEC))) == []


def test_fact_keeps_no_attributes(spark):
    assert decompose(_wide(spark), SPEC)["fact"].columns == ["user_sk", "dish_sk", "order_id", "price", "qty"]


def test_keys_agree_between_runs_and_layouts(spark):
    wide = _wide(spark)
    a = rows(decompose(wide, SPEC)["user"])
    b = rows(decompose(wide.repartition(3), SPEC)["user"])
    assert a == b


def test_dimension_and_key(spark):
    out = with_key(dimension(_wide(spark), ["dish_id", "category"]), ["dish_id"], "k")
    assert out.count() == 2 and len({r[0] for r in rows(out, "k")}) == 2


def test_fact_refers_to_dimensions_by_short_keys(spark):
    tables = decompose(_wide(spark), SPEC)
    for name in SPEC.dims:
        held = tables[name].select(SPEC.key(name), SPEC.text(name)).collect()
        assert {bytes(k).hex() for k, _ in held} == {text[:32] for _, text in held} and {len(text) for _, text in held} == {64}
        assert {bytes(r[0]) for r in tables["fact"].select(SPEC.key(name)).collect()} == {bytes(k) for k, _ in held}
    assert recompose(tables, SPEC).columns == [*SPEC.dims["user"], *SPEC.dims["dish"], *SPEC.measures]


def test_the_fact_is_shuffled_once_for_all_dimensions(spark):
    wide = stored(spark.range(300_000).select(
        F.col("id").alias("order_id"), (F.col("id") % 500).alias("user_id"), F.concat(F.lit("u"), F.col("id") % 500).alias("user_name"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 300).alias("dish_id"), F.lit("dish").alias("dish_name"), F.lit(None).cast("string").alias("category"),
        (F.col("id") % 7).alias("price"), F.lit(1).alias("qty")), "wide")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        rebuilt = recompose(decompose(wide, SPEC), SPEC)
        assert plan(rebuilt).count("Exchange") == 1 + len(SPEC.dims)
        assert rows(bag_difference(wide.select(*rebuilt.columns), rebuilt)) == []
    finally:
        spark.conf.set(limit, before)
