import json

import pytest

from conftest import rows
from martloom.schema import LONG, TEXT, record
from martloom.session import cut_lineage, fresh_path, shared_dir, stored
from martloom.sources.database import jdbc_options
from martloom.sources.paged import page_runs, paged_payloads, read_paged, stored_pages

SCHEMA = record(id=LONG, name=TEXT)


def test_jdbc_options():
    opts = jdbc_options("jdbc:postgresql://db/x", "subscribers", "user_id", 0, 1000, 16, user="u")
    assert opts["numPartitions"] == "16" and opts["partitionColumn"] == "user_id"
    assert (opts["lowerBound"], opts["upperBound"], opts["user"]) == ("0", "1000", "u")
    with pytest.raises(ValueError):
        jdbc_options("u", "t", "c", 0, 1, 0)


def test_page_runs_cover_every_page_once():
    assert page_runs(0, 3) == []
    assert page_runs(7, 3) == [(0, 3), (3, 6), (6, 7)]


PAGES = [
    ['{"id": 1, "name": "a"}', '{"id": 2, "name": "b"}'],
    [],
    ['{"id": 2, "name": "b"}', "broken", '{"id": 3}'],
]


def test_pages_are_read_in_parallel_tasks(spark):
    df = read_paged(spark, lambda i: PAGES[i], 3, SCHEMA)
    assert df.rdd.getNumPartitions() == 3
    assert rows(df, "page_no", "id", "payload") == [(0, 1, None), (0, 2, None), (2, 2, None), (2, 3, None), (2, None, "broken")]
    assert read_paged(spark, lambda i: PAGES[i], 3, SCHEMA, pages_per_task=2).count() == 5


def test_no_pages(spark):
    assert read_paged(spark, lambda i: PAGES[i], 0, SCHEMA).count() == 0


def test_long_page_is_streamed_in_batches(spark):
    df = paged_payloads(spark, lambda i: (json.dumps({"id": n}) for n in range(10_001)), 1)
    assert df.count() == 10_001


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_saved_pages(spark, tmp_path, prefix):
    base = str(tmp_path / "pages")
    records = [(json.dumps({"id": i, "name": "é" * i}, ensure_ascii=False), i % 3) for i in range(10)]
    spark.createDataFrame(records, "value string, page int").write.partitionBy("page").text(base)
    df = read_paged(spark, stored_pages(prefix + base), 4, SCHEMA)
    assert [r[0] for r in rows(df.orderBy("id"), "id")] == list(range(10))
    assert df.filter("length(name) = id").count() == 10


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    df = spark.range(5)
    assert stored(df, "five").count() == 5
    assert "Scan ExistingRDD" in cut_lineage(df)._jdf.queryExecution().executedPlan().toString()


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master, applicationId = "yarn", "a"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_a_page_may_be_one_payload(spark):
    pages = ['[{"id": 1, "name": "a"}, {"id": 2}]', "[]", '[{"id": 3}', '{"id": 4}']
    df = read_paged(spark, lambda i: [pages[i]], 4, SCHEMA)
    assert rows(df, "page_no", "id", "payload") == [(0, 1, None), (0, 2, None), (2, None, '[{"id": 3}'), (3, 4, None)]
