"""Chained streams: raw messages, then order lines and running counters.

The raw layer uses the append file sink, whose log keeps half-written files out of the
next stream. The second stream writes each batch into folders of its own, which a replay
replaces. It holds no state: what was seen before is looked up in the stored lines of the
months a batch touches, so neither the age of a message nor a watermark loses a row.

Lines are stored by month first, and the job merges them as it goes, level by level: so
many folders of one level become one of the next, which stands for all batches up to its
number. A batch lists and opens the folders of its months alone, their number grows with
the logarithm of the batches, and a line is written again once a level.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DateType

from martloom.functions.scalars import stable_key
from martloom.operators.joins import without_known
from martloom.operators.ranking import first_per_key
from martloom.operators.rows import conform, with_event
from martloom.schema import AMOUNT, LONG, TEXT, TS, record
from martloom.session import entries, remove
from martloom.sources.sinks import read_or_empty, relayout
from martloom.streaming.sources import DRAIN, file_stream

ORDER = record(
    order_id=LONG, user_id=LONG,
    items=ArrayType(record(dish_id=LONG, category=TEXT, price=AMOUNT)),
)
RAW = record(key=TEXT, value=TEXT, topic=TEXT, timestamp=TS)
LINE = record(line_key=TEXT, order_id=LONG, user_id=LONG, dish_id=LONG, category=TEXT, price=AMOUNT, timestamp=TS)
STORED_LINE = record(**{f.name: f.dataType for f in LINE.fields}, month=DateType(), level=LONG, upto=LONG)
COUNTER = record(user_id=LONG, kind=TEXT, item=TEXT, orders=LONG)
STORED_COUNTER = record(**{f.name: f.dataType for f in COUNTER.fields}, batch_id=LONG)


def start_raw(stream: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN) -> StreamingQuery:
    """Messages as received."""
    return (
        conform(stream, RAW).writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start()
    )


def order_lines(good: DataFrame) -> DataFrame:
    """One row per order and dish with a stable key and the month of its message."""
    exploded = good.select(
        "timestamp", "event.order_id", "event.user_id", F.explode("event.items").alias("item")
    ).select("timestamp", "order_id", "user_id", "item.*")
    keyed = conform(exploded.withColumn("line_key", stable_key("order_id", "dish_id")), LINE)
    return keyed.withColumn("month", F.trunc("timestamp", "month"))


def near_months(lines: DataFrame, days: int) -> DataFrame:
    """Months from which a row of ``lines`` may be a repeat, up to ``days`` away."""
    day = F.col("timestamp").cast("date")
    return lines.select(F.explode(F.sequence(
        F.trunc(F.date_sub(day, days), "month"), F.trunc(F.date_add(day, days), "month"), F.expr("interval 1 month"))).alias("month")).distinct()


def counter_steps(new: DataFrame, known: DataFrame) -> DataFrame:
    """What the new lines add: orders per user and dish, and per user and category. An
    order counts once for a category, whichever of its lines came first."""
    dishes = new.select("user_id", F.lit("dish").alias("kind"), F.col("dish_id").cast("string").alias("item"))
    pairs = new.select("order_id", "user_id", "category").distinct()
    fresh = without_known(pairs, known, ["order_id", "category"])
    categories = fresh.select("user_id", F.lit("category").alias("kind"), F.col("category").alias("item"))
    return dishes.unionAll(categories).groupBy("user_id", "kind", "item").agg(F.count(F.lit(1)).alias("orders"))


Folder = tuple[int, int]


def valid_folders(folders: list[Folder]) -> list[Folder]:
    """Of ``(level, upto)``, those that no folder of a higher level stands for already."""
    return [(level, upto) for level, upto in folders if not any(k > level and b >= upto for k, b in folders)]


@dataclass(frozen=True)
class LineJob:
    """Raw messages to lines, counters and rejects, all stored under ``path``.

    A repeat of a message is found within ``lookback_days`` of the first. ``merge_every``
    folders of a level are merged into one, and the counters of four times as many batches
    are summed up."""

    path: str
    lookback_days: int = 7
    merge_every: int = 16

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def folders(self, spark: SparkSession, month: dt.date) -> list[Folder]:
        root = f"{self.folder('lines')}/month={month}"
        return [(int(level.split("=")[1]), int(upto.split("=")[1])) for level in entries(spark, root) if level.startswith("level=")
                for upto in entries(spark, f"{root}/{level}") if upto.startswith("upto=")]

    def _read(self, spark: SparkSession, folders: list[tuple[dt.date, Folder]]) -> DataFrame:
        """Stored lines of the folders; no other one is listed."""
        root = self.folder("lines")
        if not folders:
            return spark.createDataFrame([], STORED_LINE)
        paths = [f"{root}/month={month}/level={level}/upto={upto}" for month, (level, upto) in folders]
        return spark.read.option("basePath", root).schema(STORED_LINE).parquet(*paths)

    def lines(self, spark: SparkSession, months: list[dt.date] | None = None, but: Folder | None = None) -> DataFrame:
        """Stored lines of ``months`` (all without), without those of the folder ``but``."""
        if months is None:
            names = entries(spark, self.folder("lines"))
            months = [dt.date.fromisoformat(n.split("=")[1]) for n in names if n.startswith("month=") and "HIVE" not in n]
        return self._read(spark, [(m, f) for m in months for f in valid_folders(self.folders(spark, m)) if f != but])

    def on_batch(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        """``spark`` is the session that started the stream: that of the micro-batch has
        adaptive execution switched off."""
        work, own = f"{self.folder('work')}/batch_id={batch_id}", (0, batch_id)
        # Parsed once, for the three readers below. Of a message that fits, the text goes.
        parsed = with_event(batch, ORDER)
        parsed = parsed.withColumn("value", F.when(F.col("event").isNull(), F.col("value")))
        parsed.write.mode("overwrite").parquet(work)
        parsed = spark.read.schema(parsed.schema).parquet(work)
        bad = parsed.filter("event IS NULL").select(*batch.columns)
        bad.write.mode("overwrite").parquet(f"{self.folder('rejects')}/batch_id={batch_id}")
        lines = order_lines(parsed.filter("event IS NOT NULL"))
        # A few months of the calendar.
        near = [r[0] for r in near_months(lines, self.lookback_days).collect()]
        known = self.lines(spark, near, but=own)
        # A line's key is never null: joined by plain equality, both sides stay where they
        # were grouped by it.
        new = first_per_key(lines, ["line_key"], ["timestamp", "user_id"]).join(
            known.select("line_key").distinct(), "line_key", "left_anti")
        numbered = new.withColumns({"level": F.lit(0).cast("long"), "upto": F.lit(batch_id).cast("long")})
        relayout(numbered.select(*STORED_LINE.names), self.folder("lines"), ["month", "level", "upto"])
        written = self._read(spark, [(m, own) for m in near if own in self.folders(spark, m)])
        counter_steps(written, known).write.mode("overwrite").parquet(f"{self.folder('counters')}/batch_id={batch_id}")
        remove(spark, work)
        # The batch itself may be replayed; those before it are closed.
        for month in near:
            self.merge(spark, month, batch_id - 1)
        if len(entries(spark, self.folder("counters"))) > 4 * self.merge_every:
            self.fold_counters(spark, batch_id - 1)

    def merge(self, spark: SparkSession, month: dt.date, closed: int) -> None:
        """Merge the folders of a month, level by level, where there are enough of batches
        up to ``closed``. What a merge has read is removed when its result is stored; a job
        that dies in between leaves folders that no reader takes and the next merge removes."""
        root = f"{self.folder('lines')}/month={month}"
        level = 0
        while True:
            there = self.folders(spark, month)
            valid = valid_folders(there)
            for stale in set(there) - set(valid):
                remove(spark, f"{root}/level={stale[0]}/upto={stale[1]}")
            ready = sorted(f for f in valid if f[0] == level and f[1] <= closed)
            if len(ready) < self.merge_every:
                return
            merged = self._read(spark, [(month, f) for f in ready]).drop("month", "level", "upto")
            merged.hint("rebalance").write.mode("overwrite").parquet(f"{root}/level={level + 1}/upto={ready[-1][1]}")
            for _, upto in ready:
                remove(spark, f"{root}/level={level}/upto={upto}")
            level += 1

    def start(self, spark: SparkSession, raw_path: str, checkpoint: str, trigger: dict = DRAIN, **batches) -> StreamingQuery:
        return (
            file_stream(spark, raw_path, RAW, **batches).writeStream.foreachBatch(lambda batch, batch_id: self.on_batch(spark, batch, batch_id))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )

    def _parts(self, spark: SparkSession) -> tuple[DataFrame, int]:
        """Counters of the last fold and of the batches after it, and that fold's batch."""
        folded = read_or_empty(spark, self.folder("folded"), STORED_COUNTER)
        upto = folded.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]
        later = read_or_empty(spark, self.folder("counters"), STORED_COUNTER).filter(F.col("batch_id") > upto)
        return folded.filter(F.col("batch_id") == upto).unionByName(later), upto

    def counters(self, spark: SparkSession) -> DataFrame:
        """Current counters: what all batches added."""
        return self._parts(spark)[0].groupBy("user_id", "kind", "item").agg(F.sum("orders").alias("orders"))

    def fold_counters(self, spark: SparkSession, closed: int | None = None) -> None:
        """Sum up the counters of all batches so far, or of those up to ``closed``, for
        readers to start from. Without ``closed``, run it between batches; what it has
        summed up is removed afterwards."""
        parts, upto = self._parts(spark)
        if closed is not None:
            parts = parts.filter(F.col("batch_id") <= closed)
        last = parts.agg(F.max("batch_id")).first()[0]
        if last is None or last == upto:
            return
        summed = parts.groupBy("user_id", "kind", "item").agg(F.sum("orders").alias("orders"))
        summed.write.mode("overwrite").parquet(f"{self.folder('folded')}/batch_id={last}")
        for batch_id in range(upto + 1, last + 1):
            remove(spark, f"{self.folder('counters')}/batch_id={batch_id}")
        if upto >= 0:
            remove(spark, f"{self.folder('folded')}/batch_id={upto}")
