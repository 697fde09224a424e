import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W, functions as F

from conftest import plan, rows
from martloom.operators import ranking as K, selection as S


def test_latest_row_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (2, 1, 1, "d")], "k long, t long, id long, v string")
    assert rows(K.latest_per_key(df, ["k"], ["t", "id"]), "k", "v") == [(1, "b"), (2, "d")]
    assert rows(K.first_per_key(df, ["k"], ["t", "id"]), "k", "v") == [(1, "c"), (2, "d")]


def test_latest_row_is_cut_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    text = plan(K.latest_per_key(df, ["k"], ["t"]))
    assert text.count("WindowGroupLimit") == 2


def test_modal_value_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (1, 8), (1, 3), (2, 5)], "u long, z long")
    assert rows(K.modal_value(df, ["u"], "z", "modal")) == [(1, 3), (2, 5)]


def test_oldest_is_a_top_k(spark):
    df = spark.createDataFrame([(g, 1 if g in (3, 4) else 10 + g) for g in range(20)], "g long, first_ts long")
    out = K.oldest(df, "first_ts", "g", 3)
    assert rows(out, "g") == [(0,), (3,), (4,)]
    assert "TakeOrderedAndProject" in plan(out)


def _values(n, seed):
    rng = random.Random(seed)
    # A third of the rows share one value, some are null.
    return [(i, None if i % 11 == 0 else 0 if rng.random() < 0.33 else rng.randrange(50)) for i in range(n)]


def test_parallel_ntile_equals_the_window_function(spark):
    for n_rows, n in ((1, 5), (4, 5), (23, 5), (1000, 5), (999, 7)):
        df = spark.createDataFrame(_values(n_rows, n_rows), "u long, v long").repartition(5)
        order = [F.col("v").asc_nulls_first(), F.col("u").asc()]
        got = rows(K.with_quantile(df, order, n, "q"), "u", "q")
        expected = rows(df.withColumn("q", F.ntile(n).over(W.orderBy(*order))), "u", "q")
        assert got == expected


def test_exact_rank_has_no_single_task_sort(spark):
    df = spark.createDataFrame(_values(500, 2), "u long, v long")
    ranked = K.with_exact_rank(df, [F.col("v").asc(), F.col("u").asc()], "r", "n")
    assert sorted(x[0] for x in rows(ranked, "r")) == list(range(1, 501))
    assert ranked.first()["n"] == 500


def test_group_sizes_differ_by_at_most_one(spark):
    df = spark.createDataFrame(_values(103, 5), "u long, v long")
    sizes = [r[1] for r in K.with_quantile(df, [F.col("v").asc(), F.col("u").asc()], 5, "q").groupBy("q").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 103


def test_empty_input_has_no_ranks(spark):
    df = spark.createDataFrame([], "u long, v long")
    assert rows(K.with_quantile(df, [F.col("v").asc(), F.col("u").asc()], 5, "q")) == []


def test_approximate_scores_are_close(spark):
    df = spark.range(1000).select(F.col("id").alias("u"), (F.col("id") * 3).alias("v"))
    out = K.with_quantile_approx(df, {"v": "q"}, 5)
    sizes = [r[1] for r in out.groupBy("q").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 10


def test_dense_ranks_equal_the_window_functions(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.choice("abc"), rng.randrange(12)) for i in range(200)], "dish long, cat string, n long")
    got = K.with_dense_ranks(df, "n", "r_all", "r_cat", "cat")
    down = F.col("n").desc()
    expected = df.withColumns({
        "r_all": F.dense_rank().over(W.orderBy(down)), "r_cat": F.dense_rank().over(W.partitionBy("cat").orderBy(down))})
    cols = ("dish", "cat", "n", "r_all", "r_cat")
    assert rows(got, *cols) == rows(expected, *cols)


def test_top_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "dish string, n long")
    assert [r[0] for r in K.top(df, "n", "dish", 2).collect()] == ["c", "a"]


def _ntiles(df, measures, tie, n):
    out = df
    for c, name in measures.items():
        out = out.withColumn(name, F.ntile(n).over(W.orderBy(F.col(c).asc_nulls_first(), F.col(tie).asc_nulls_first())))
    return out


def test_selected_quantiles_equal_the_window_function(spark):
    measures = {"v": "a", "d": "b", "m": "c", "t": "e"}
    for n_rows, n in ((1, 5), (4, 5), (23, 5), (700, 5), (999, 7)):
        rng = random.Random(n_rows)
        data = [(i * 1_000_003 - 40, v, dt.date(1900, 1, 1) + dt.timedelta(days=rng.randrange(60_000)) if i % 9 else None,
                 Decimal(rng.randrange(-10**24, 10**24)) / 100, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(50)))
                for i, v in _values(n_rows, n_rows)]
        df = spark.createDataFrame(data, "u long, v long, d date, m decimal(28,2), t timestamp_ntz").repartition(5)
        got = S.with_quantiles(df, measures, "u", n)
        assert got.columns == [*df.columns, *measures.values()]
        assert rows(got) == rows(_ntiles(df, measures, "u", n))


def test_selection_neither_sorts_nor_shuffles_rows(spark):
    df = spark.createDataFrame(_values(500, 3), "u long, v long")
    text = plan(S.with_quantiles(df, {"v": "q"}, "u", 5))
    assert "Exchange" not in text and "Sort" not in text and "Window" not in text


def test_selection_with_few_parts_takes_more_passes(spark, monkeypatch):
    monkeypatch.setattr(S, "PARTS", 8)
    df = spark.createDataFrame(_values(400, 4), "u long, v long")
    assert rows(S.with_quantiles(df, {"v": "q"}, "u", 5)) == rows(_ntiles(df, {"v": "q"}, "u", 5))


def test_selection_of_nothing_and_of_one_value(spark):
    none = spark.createDataFrame([], "u long, v long")
    assert rows(S.with_quantiles(none, {"v": "q"}, "u", 5)) == []
    flat = spark.createDataFrame([(i, None) for i in range(10)], "u long, v long")
    assert rows(S.with_quantiles(flat, {"v": "q"}, "u", 5), "q") == [(q,) for q in (1, 1, 2, 2, 3, 3, 4, 4, 5, 5)]
    for bad in ("double", "string"):
        with pytest.raises(ValueError):
            S.with_quantiles(spark.createDataFrame([], f"u long, v {bad}"), {"v": "q"}, "u", 5)
