"""A paged API as a table, through a Python data source.

Pages are fetched on the executors, a run of pages per task. Only the transport
is Python: payloads travel to the JVM as Arrow batches and are parsed there.
"""

from __future__ import annotations

import io
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, StructType

from martloom.operators.rows import computed_once

_BATCH_ROWS = 4096

# The reader travels to the Python workers by value, so they need no copy of this
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PageRun(InputPartition):
    """Consecutive page numbers ``first`` to ``last - 1``."""

    def __init__(self, first: int, last: int):
        super().__init__((first, last))


def page_runs(n_pages: int, pages_per_task: int) -> list[tuple[int, int]]:
    return [(i, min(i + pages_per_task, n_pages)) for i in range(0, n_pages, pages_per_task)]


def _batches(pages: range, fetch_page: Callable[[int], Iterable[str]]) -> Iterator[pa.RecordBatch]:
    numbers: list[int] = []
    payloads: list[str] = []

    def flush() -> pa.RecordBatch:
        batch = pa.record_batch(
            [pa.array(numbers, pa.int64()), pa.array(payloads, pa.string())],
            names=["page_no", "payload"],
        )
        numbers.clear()
        payloads.clear()
        return batch

    for page in pages:
        for payload in fetch_page(page):
            numbers.append(page)
            payloads.append(payload)
            if len(numbers) >= _BATCH_ROWS:
                yield flush()
    if numbers:
        yield flush()


def paged_payloads(spark: SparkSession, fetch_page: Callable[[int], Iterable[str]],
                   n_pages: int, pages_per_task: int = 1) -> DataFrame:
    """Raw rows ``(page_no, payload)``; ``fetch_page(i)`` yields JSON strings.

    ``fetch_page`` runs again when a task is retried, so it must be a plain read.
    """
    source_name = f"paged_{uuid.uuid4().hex}"

    class Reader(DataSourceReader):
        def partitions(self):
            return [PageRun(a, b) for a, b in page_runs(n_pages, pages_per_task)]

        def read(self, partition):
            if partition is None:
                return iter(())
            first, last = partition.value
            return _batches(range(first, last), fetch_page)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return source_name

        def schema(self):
            return "page_no bigint, payload string"

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format(source_name).load()


def read_paged(spark: SparkSession, fetch_page: Callable[[int], Iterable[str]],
               n_pages: int, schema: StructType | str, pages_per_task: int = 1) -> DataFrame:
    """Records of all pages with the declared columns, plus ``page_no`` and ``payload``.

    A payload is a record or an array of records, so a page may come as one payload and
    is taken apart in the JVM. One that is neither gives a row with ``payload`` as it was
    received, for the caller to set aside; it is null for records.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    rows = paged_payloads(spark, fetch_page, n_pages, pages_per_task)
    parsed = computed_once(rows, "records", F.from_json("payload", ArrayType(schema)))
    parsed = parsed.filter("records IS NULL OR size(records) > 0")
    return parsed.select("page_no", F.when(F.col("records").isNull(), F.col("payload")).alias("payload"),
                         F.explode_outer("records").alias("r")).select("page_no", "payload", "r.*")


def stored_pages(base: str) -> Callable[[int], Iterable[str]]:
    """``fetch_page`` over saved responses ``base/page=N/``, one payload per line.

    The folder of a page follows from its number, so no list of pages is built
    or shipped; lines are streamed and never held together.
    """
    for spark_scheme, arrow_scheme in {"s3a://": "s3://", "s3n://": "s3://", "file:/": "file:///"}.items():
        if base.startswith(spark_scheme):
            base = arrow_scheme + base[len(spark_scheme):].lstrip("/")

    def fetch(page: int) -> Iterator[str]:
        filesystem, folder = pafs.FileSystem.from_uri(f"{base}/page={page}")
        for info in filesystem.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if info.is_file and not info.base_name.startswith(("_", ".")):
                with filesystem.open_input_stream(info.path) as raw:
                    for line in io.TextIOWrapper(raw, encoding="utf-8"):
                        yield line.rstrip("\n")

    return fetch
