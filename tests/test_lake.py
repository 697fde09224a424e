"""Clustered and compacted layouts, and documents of open shape."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import plan, rows
from martloom.catalog import clustered_counts
from martloom.sources import variants
from martloom.sources.lake import cluster, compact, file_sizes


def _files(root):
    return sorted(p.relative_to(root).parts[0] for p in root.glob("*/*.parquet"))


def test_compaction_in_place(spark, tmp_path):
    path = tmp_path / "lake"
    schema = "id long, day date, v string"
    days = [dt.date(2024, 1, k) for k in (1, 2, 3)]
    for k in range(6):
        spark.createDataFrame([(i, d, "x" * 50) for i in range(k * 50, k * 50 + 50) for d in days[:2]] + [(k, None, "n")], schema).write.mode(
            "append").partitionBy("day").parquet(str(path))
    spark.createDataFrame([(1, days[2], "one")], schema).coalesce(1).write.mode("append").partitionBy("day").parquet(str(path))
    df = spark.read.schema(schema).parquet(str(path))
    before, kept = rows(df), {p.name for p in path.glob("day=2024-01-03/*.parquet")}
    crowded = compact(spark, str(path), df.schema, ["day"], ["id"])
    assert {r.day for r in crowded.collect()} == {*days[:2], None}
    assert _files(path) == ["day=2024-01-01", "day=2024-01-02", "day=2024-01-03", "day=__HIVE_DEFAULT_PARTITION__"]
    assert {p.name for p in path.glob("day=2024-01-03/*.parquet")} == kept
    after = spark.read.schema(schema).parquet(str(path))
    assert rows(after) == before
    ids = [r.id for r in spark.read.parquet(str(path / "day=2024-01-01")).collect()]
    assert ids == sorted(ids)
    assert compact(spark, str(path), df.schema, ["day"], ["id"]).count() == 0


def test_a_large_folder_keeps_several_files(spark, tmp_path):
    path = str(tmp_path / "lake")
    spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("a").alias("part")).repartition(40).write.partitionBy(
        "part").parquet(path)
    schema = spark.read.parquet(path).schema
    total = file_sizes(spark, path, schema, ["part"]).first()
    compact(spark, path, schema, ["part"], file_bytes=total.bytes // 4)
    files = file_sizes(spark, path, schema, ["part"]).first().files
    assert 2 <= files <= 5 < total.files
    assert spark.read.parquet(path).count() == 4000


def test_clustered_join_has_no_exchange(spark, tmp_path):
    events = spark.range(500).select((F.col("id") % 40).alias("user_id"), F.col("id").alias("event_id"), (F.col("id") % 7).alias("group_id"))
    subscribed = spark.range(80).select((F.col("id") % 40).alias("user_id"), (F.col("id") % 7).alias("group_id")).groupBy("user_id").agg(
        F.collect_set("group_id").alias("favourites"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = [cluster(df, name, str(tmp_path / name), ["user_id"], 4) for df, name in ((events, "t_events"), (subscribed, "t_subscribed"))]
        joined = clustered_counts(*tables)
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert rows(joined) == rows(clustered_counts(events, subscribed))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("t_events", "t_subscribed"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_fields_of_open_documents(spark):
    texts = ['{"a": 1, "b": {"c d": "x", "l": [1, 2]}}', '{"a": "one", "b": {"c d": "y"}}', '{"a": null, "q\'s": 1.5}', "[1]", "broken", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.try_parse_json("t").alias("doc"))
    objects = df.filter("schema_of_variant(doc) LIKE 'OBJECT%'")
    found = variants.fields(objects, "doc")
    assert [f.path for f in found] == ["$['a']", "$['b']['c d']", "$['b']['l']", "$[\"q's\"]"]
    values = objects.select(*[variants.value("doc", f).cast("string").alias(f"v{i}") for i, f in enumerate(found)])
    assert rows(values, "v0", "v1") == [("1", "x"), ("one", "y"), (None, None)]
    counted = rows(variants.kinds(objects, "doc", found))
    assert ("$['a']", "BIGINT", 1) in counted and ("$['a']", "STRING", 1) in counted and ("$['a']", "VOID", 1) in counted
    assert variants.fields(df.filter("false"), "doc") == []
    assert variants.fields(df.filter("schema_of_variant(doc) LIKE 'ARRAY%'"), "doc") == []
    assert rows(variants.kinds(df, "doc", [])) == []
