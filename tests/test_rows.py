import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from conftest import plan, rows
from martloom.functions import scalars as S
from martloom.operators import rows as R
from martloom.schema import AMOUNT, LONG, TEXT, TS, record


def test_statuses_are_filtered_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "F"), (2, "O"), (3, None)], "id long, status string").write.parquet(path)
    kept = R.with_statuses(spark.read.parquet(path), "status", ["F", "P"])
    assert rows(kept, "id") == [(1,)]
    assert "PushedFilters: [In(status" in plan(kept)


def test_refunds_are_negative(spark):
    df = spark.createDataFrame([(1, Decimal("5.00"), "P"), (2, Decimal("7.00"), "F")], "id long, amount decimal(18,2), s string")
    out = R.signed_amount(df, "amount", F.col("s") == "P")
    assert rows(out, "id", "signed_amount") == [(1, Decimal("-5.00")), (2, Decimal("7.00"))]


def test_broken_messages_are_set_aside(spark):
    schema = record(a=LONG, items=ArrayType(record(b=TEXT)))
    texts = ['{"a": 1, "items": [{"b": "x"}]}', '{"a": "no number"}', "{", None, "{}", '{"a": 2}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    good, bad = R.parse_events(df, schema)
    assert rows(good, "i", "event.a") == [(0, 1), (4, None), (5, 2)]
    assert rows(bad, "i") == [(1,), (2,), (3,)]
    assert bad.columns == df.columns and good.columns == [*df.columns, "event"]


def test_text_is_parsed_once(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',)], "value string")
    good, _ = R.parse_events(df, record(a=LONG, b=TEXT))
    assert plan(good.select("event.a", "event.b")).count("from_json(") == 1


def test_promotion_interval_is_half_open(spark):
    t = dt.datetime(2024, 1, 1, 12)
    hour = dt.timedelta(hours=1)
    df = spark.createDataFrame(
        [(1, t, t + hour), (2, t - hour, t), (3, t + hour, t + 2 * hour), (4, t - hour, t + hour)],
        "id long, s timestamp, e timestamp")
    live = R.active_at(df, "s", "e", F.lit(t))
    assert rows(live, "id") == [(1,), (4,)]


def test_views_expand_to_the_logical_tables(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    R.create_views(spark, {"v_base": base, "v_named": "SELECT id, upper(name) AS name FROM v_base WHERE id > 1"})
    assert rows(spark.table("v_named")) == [(2, "B")]


def test_conform_sets_order_and_types(spark):
    df = spark.createDataFrame([("7", "x", 1.5)], "a string, extra string, b double")
    out = R.conform(df, record(b=AMOUNT, a=LONG))
    assert out.dtypes == [("b", "decimal(18,2)"), ("a", "bigint")]
    assert rows(out) == [(Decimal("1.50"), 7)]


def test_history_gets_the_default(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "id long").write.parquet(path)
    spark.createDataFrame([(2, "P")], "id long, status string").write.mode("append").parquet(path)
    feed = spark.read.schema(record(id=LONG, status=TEXT)).parquet(path)
    assert rows(R.add_with_default(feed, "status", "F", "string")) == [(1, "F"), (2, "P")]
    bare = spark.createDataFrame([(1,)], "id long")
    assert rows(R.add_with_default(bare, "status", "F", "string")) == [(1, "F")]


def test_weeks_start_on_monday(spark):
    days = [dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 1, 14)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select("d", S.week_start("d").alias("w"), S.month_start("d").alias("m"))
    assert rows(out, "w") == [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 8),), (dt.date(2024, 1, 8),)]


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 2), (1, 0)], "a long, b long")
    assert rows(df.select(S.ratio(F.col("a"), F.col("b")).alias("r"))) == [(0.5,), (None,)]


def test_keys_tell_null_from_empty_and_shifted_values(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("ab", "c"), ("a", "bc"), ("a", None)], "x string, y string")
    keys = [r[0] for r in df.select(S.stable_key("x", "y")).collect()]
    assert len(set(keys)) == 4 and keys[0] == keys[4] and all(len(k) == 64 for k in keys)


def test_money_sums_exactly(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("x"))
    assert df.agg(S.total(S.money("x")).alias("t")).first()[0] == Decimal("100.00")


def test_great_circle(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0)], "a double, b double, c double, d double")
    out = [r[0] for r in df.select(S.great_circle_km(*map(F.col, "abcd"))).collect()]
    assert abs(out[0] - 20015.087) < 0.01 and out[1] == 0.0


def test_message_keeps_microseconds(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    df = spark.createDataFrame([(1, t)], "id long, t timestamp")
    back = df.select(F.from_json(S.message("id", "t"), record(id=LONG, t=TS)).alias("m")).select("m.*")
    assert rows(back) == [(1, t)]
