"""Helpers shared by the operators: Arrow passes over a table, row keys, column names."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
#: Rows and bytes of one Arrow batch: texts are long, and a batch is held in a worker's memory.
BATCH_ROWS, BATCH_BYTES = 500, "16m"
#: Rows turned into Python objects at once.
SLICE_ROWS = 200

HELD_OUT = "CAST(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 AS BOOLEAN)"

_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
          "array<double>": pa.list_(pa.float64()), "array<float>": pa.list_(pa.float32()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
          "array<array<long>>": pa.list_(pa.list_(pa.int64()))}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches; workers on this machine find the package where the driver
    did, whatever folder they start in (a cluster installs or ships it)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


#: Tables that a worker keeps for later tasks of the same operator, by its name.
WORKER_TABLES: dict[str, object] = {}


def _release(but: str | None) -> None:
    """A worker serves all operators in turn; what another one has left goes first."""
    for name in [n for n in WORKER_TABLES if n != but]:
        del WORKER_TABLES[name]


def map_columns(df: DataFrame, columns: list[str], fields: list[tuple[str, str]],
                make: Callable[[], Callable[..., Iterable]], slice_rows: int = SLICE_ROWS,
                keeps: str | None = None) -> DataFrame:
    """A new table with ``fields`` (name, type) from ``columns`` of ``df``.

    ``make()`` runs once per task; what it returns gets the values of some rows, one
    list per column, and returns or yields one list per field. It may return more or
    fewer rows than it got. ``keeps`` names what the worker may hold for its next task.
    """
    prepare(df.sparkSession)
    kinds, names = [_ARROW[k] for _, k in fields], [n for n, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release(keeps)
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                out = work(*[c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=k) for v, k in zip(out, kinds, strict=True)], names=names)

    schema = ", ".join(f"`{n}` {k}" for n, k in fields)
    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)


def keep_rows(df: DataFrame, column: str, make: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """The rows of ``df``, all columns, for whose ``column`` the made function says true."""
    prepare(df.sparkSession)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release(None)
        keep = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores in front until no column of ``df`` has it
    (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def text_hash(column: str = "text") -> Column:
    """Tells rows that share an id but not the text apart. Null and empty are equal."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def share_below(column: Column, share: float, seed: int) -> Column:
    """True for about ``share`` of the values, the same ones in every run."""
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
