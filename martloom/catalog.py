"""Registered queries: each takes (spark, sf_dir) and returns a result frame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, IntegerType, StructType

from martloom import standins as src
from martloom.functions.scalars import message, unique_list, week_start
from martloom.operators.joins import enrich, nearest_zone as zone_of_point
from martloom.operators.modelling import SplitSpec, decompose, recompose
from martloom.operators.quality import bag_difference_by_digest, duplicates, orphans, profile
from martloom.operators.rows import (
    add_with_default, conform, create_views, signed_amount,
)
from martloom.plans import community, courier, lake, popularity, retention, segmentation
from martloom.plans.layers import LayerTable, Mart, backfill, promote, refresh, refresh_by_digest, stored_days
from martloom.schema import LONG, TEXT, TS_NTZ, record
from martloom.session import fresh_path, stored
from martloom.sources import variants
from martloom.sources.files import read_documents, read_files, read_lake
from martloom.sources.lake import cluster, compact, file_sizes
from martloom.sources.paged import read_paged, stored_pages
from martloom.sources.sinks import (
    drop_periods, extract_new, land_raw, read_mark, read_or_empty, relayout, save_mark, source_changes, upsert,
)
from martloom.streaming import layers as stream_layer
from martloom.streaming.notify import JOINED, PROMOTION, NotificationJob, batch_file_writer
from martloom.streaming.sources import ENVELOPE, as_envelopes, file_stream, stage_in_time_order

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that another engine prints alike. Amounts are exact up to here."""
    def plain(field):
        col = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return col.cast("string").alias(field.name)
        if isinstance(field.dataType, IntegerType):
            return col.cast("bigint").alias(field.name)
        return col

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))

    REGISTRY[fn.__name__] = run
    return run


# --- checks on sources ---------------------------------------------------------

@query
def source_profile(spark, sf_dir):
    return profile(src.table(spark, sf_dir, "orders"))


@query
def orphan_orders(spark, sf_dir):
    return orphans(src.table(spark, sf_dir, "orders"), "o_orderkey",
                   src.table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def duplicate_keys(spark, sf_dir):
    return duplicates(src.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- segmentation ----------------------------------------------------------------

def _measures(spark, sf_dir):
    return segmentation.user_measures(src.users(spark, sf_dir), src.orders(spark, sf_dir), src.CLOSED)


@query
def segment_scores(spark, sf_dir):
    return segmentation.segment_scores(_measures(spark, sf_dir))


@query
def segment_summary(spark, sf_dir):
    return segmentation.segment_summary(segmentation.segment_scores(_measures(spark, sf_dir)))


@query
def segment_scores_approx(spark, sf_dir):
    """Per user and measure: is the approximate score one that a rank within the promised
    error of the user's ranks has?"""
    measures = stored(_measures(spark, sf_dir), "measures")
    scored = stored(segmentation.segment_scores_approx(measures), "approximate")
    return segmentation.within_rank_error(scored)


# --- one wide table and its split ---------------------------------------------------

WIDE_SPLIT = SplitSpec(dims=src.WIDE_DIMS, measures=src.WIDE_MEASURES)


@query
def wide_split_dims(spark, sf_dir):
    tables = decompose(stored(src.wide_orders(spark, sf_dir), "wide"), WIDE_SPLIT)
    parts = [
        tables[name].select(
            F.lit(name).alias("dim"), F.col(WIDE_SPLIT.text(name)).alias("dim_key"),
            F.col(cols[0]).alias("natural_id"), F.col(cols[1]).alias("name"),
        )
        for name, cols in src.WIDE_DIMS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def wide_split_lossless(spark, sf_dir):
    wide = stored(src.wide_orders(spark, sf_dir), "wide")
    rebuilt = recompose(decompose(wide, WIDE_SPLIT), WIDE_SPLIT)
    return bag_difference_by_digest(wide, rebuilt).agg(
        F.coalesce(F.sum(F.greatest("surplus", F.lit(0))), F.lit(0)).alias("lost_rows"),
        F.coalesce(F.sum(F.greatest(-F.col("surplus"), F.lit(0))), F.lit(0)).alias("invented_rows"),
    )


@query
def wide_view(spark, sf_dir):
    tables = decompose(stored(src.wide_orders(spark, sf_dir), "wide"), WIDE_SPLIT)
    create_views(spark, {
        **{f"split_{name}": df for name, df in tables.items()},
        "order_overview": """
            SELECT f.order_id, f.order_date, f.line_no, f.qty, f.price, c.customer_name, c.customer_segment,
                   c.customer_country, d.dish_name, d.dish_category, v.vendor_name
            FROM split_fact f
            JOIN split_customer c ON f.customer_sk = c.customer_sk
            JOIN split_dish d ON f.dish_sk = d.dish_sk
            JOIN split_vendor v ON f.vendor_sk = v.vendor_sk
        """,
    })
    return spark.table("order_overview").groupBy("customer_country", "dish_category").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("price").alias("revenue"),
        F.min("order_date").alias("first_order"),
    )


# --- retention -----------------------------------------------------------------------

@query
def weekly_retention(spark, sf_dir):
    return retention.weekly_retention(src.orders(spark, sf_dir), src.STATUSES, src.REFUNDED)


@query
def cohort_retention(spark, sf_dir):
    return retention.cohort_retention(src.orders(spark, sf_dir))


@query
def refresh_changed(spark, sf_dir):
    """The weekly mart when refunds come very late: first some orders of any age are still
    closed and others are not yet cancelled, then the source says otherwise. Only weeks
    with a changed day are computed again; a week that lost all its orders is gone."""
    lake_path = fresh_path(spark, "orders-lake")
    orders = src.orders(spark, sf_dir)
    refunded_later = (F.col("status") == src.REFUNDED) & (F.col("order_id") % 101 == 0)
    cancelled = orders.filter("order_id % 500 = 0").withColumn("order_date", F.add_months("order_date", 120))
    mart = Mart(lake_path, orders.schema, "order_date",
                lambda df: retention.weekly_retention(df, src.STATUSES, src.REFUNDED), fresh_path(spark, "weeks"), "week", "week")
    before = orders.withColumn("status", F.when(refunded_later, src.CLOSED).otherwise(F.col("status")))
    for seen in (before.unionByName(cancelled), orders, orders):
        seen.write.mode("overwrite").parquet(lake_path)
        refresh_by_digest(spark, mart)
    weeks = mart.build(orders).schema
    return read_or_empty(spark, mart.path, weeks)


# The day the status column was added to the order feed.
STATUS_SINCE = dt.date(1998, 1, 1)


@query
def status_backfill(spark, sf_dir):
    """Orders from before the column was added have none; neither have undated ones."""
    rows = src.orders(spark, sf_dir)
    path = fresh_path(spark, "orders-feed")
    with_status = F.coalesce(F.col("order_date") >= F.lit(STATUS_SINCE), F.lit(False))
    rows.filter(~with_status).drop("status").write.mode("append").parquet(path)
    rows.filter(with_status).write.mode("append").parquet(path)
    feed = add_with_default(read_files(spark, path, "parquet", rows.schema), "status", src.CLOSED, "string")
    return signed_amount(feed, "amount", F.col("status") == src.REFUNDED).select(
        "order_id", "user_id", "status", "signed_amount", "order_date"
    )


# --- courier settlement -----------------------------------------------------------------

@query
def courier_ledger(spark, sf_dir):
    return courier.courier_ledger(src.deliveries(spark, sf_dir), src.tiers(spark), src.FEE)


# --- layers and loads ---------------------------------------------------------------------

@query
def upsert_counters(spark, sf_dir):
    """Order counters as of mid-1998, then the counters of later-touched years. Orders
    that are refunded have no year here, and only their odd users come with a change."""
    rows = src.orders(spark, sf_dir).withColumn(
        "order_year", F.when(F.col("status") != src.REFUNDED, F.year("order_date")))
    early = F.coalesce(F.col("order_date") < F.lit(dt.date(1998, 7, 1)), F.lit(True))

    def counters(df, version):
        return df.groupBy("user_id", "order_year").agg(F.count(F.lit(1)).alias("orders")).withColumn(
            "version", F.lit(version))

    path = fresh_path(spark, "counters")
    relayout(counters(rows.filter(early | F.col("order_year").isNull()), 1), path, ["order_year"])
    changed = counters(rows.filter("order_year >= 1998 OR order_year IS NULL AND user_id % 2 = 1"), 2)
    upsert(path, changed, ["user_id", "order_year"], "version", "order_year")
    return read_files(spark, path, "parquet", changed.schema)


EVENT_RECORD = record(event_id=LONG, user_id=LONG, event_type=TEXT, group_id=LONG)
PAGE_ROWS = 10_000


def _event_records(spark, sf_dir):
    return src.events(spark, sf_dir).select(*EVENT_RECORD.names)


@query
def paged_extract(spark, sf_dir):
    """Events saved as API responses of about PAGE_ROWS records, one payload a page, read
    back page by page. Pages that are cut off are kept as they came."""
    path = fresh_path(spark, "api-pages")
    records = _event_records(spark, sf_dir)
    # The count comes from the files' footers.
    n_pages = max(8, -(-records.count() // PAGE_ROWS))
    page = F.pmod("event_id", F.lit(n_pages)).alias("page")
    saved = records.groupBy(page).agg(F.to_json(F.collect_list(F.struct(*EVENT_RECORD.names))).alias("value"))
    cut = F.when(F.col("page") == 3, F.rtrim("value", F.lit("]"))).otherwise(F.col("value"))
    saved.select(cut.alias("value"), "page").write.partitionBy("page").text(path)
    rows = read_paged(spark, stored_pages(path), n_pages, EVENT_RECORD)
    good = rows.filter("payload IS NULL").drop("page_no", "payload").dropDuplicates(["event_id"])
    aside = rows.filter("payload IS NOT NULL").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT_RECORD.fields], "page_no")
    return good.withColumn("cut_page", F.lit(None).cast("bigint")).unionByName(aside.withColumnRenamed("page_no", "cut_page"))


@query
def document_landing(spark, sf_dir):
    """Events as documents; those of type error are cut off and must be set aside."""
    path = fresh_path(spark, "documents")
    text = message(*EVENT_RECORD.names)
    broken = F.col("event_type") == src.LEAVE
    _event_records(spark, sf_dir).select(
        F.when(broken, F.rtrim(text, F.lit("}"))).otherwise(text).alias("value")
    ).write.text(path)
    documents = read_documents(spark, path, EVENT_RECORD)
    landed = conform(documents.filter("doc IS NOT NULL").select("doc.*"), EVENT_RECORD).withColumn("state", F.lit("landed"))
    aside = documents.filter("doc IS NULL").agg(F.count(F.lit(1)).alias("event_id")).select(
        "event_id", F.lit(0).cast("bigint").alias("user_id"), F.lit("").alias("event_type"),
        F.lit(0).cast("bigint").alias("group_id"), F.lit("set aside").alias("state"),
    )
    return landed.unionByName(aside)


FIRST_LOAD, SECOND_LOAD = dt.date(2024, 1, 16), dt.date(2024, 1, 31)


# The late rows of the source come within this time.
OVERLAP = "2 days"


def staged_schema(rows: DataFrame) -> StructType:
    """Schema of the landing table that holds ``rows``."""
    return StructType([*rows.schema.fields, *record(
        payload=TEXT, load_source=TEXT, loaded_at=TS_NTZ, load_date=DateType(), load_seq=IntegerType()).fields])


def _with_gaps(events: DataFrame) -> DataFrame:
    """Some events come without a time, and some of the last day before the first load
    come late: the next time the source is read."""
    ts = F.when(F.col("event_id") % 11 != 0, F.col("ts"))
    start = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    return events.withColumn("ts", ts).withColumn(
        "late", F.coalesce((F.col("event_id") % 7 == 0) & (F.col("ts") < start) & (F.col("ts") >= start - F.expr("interval 1 day")),
                           F.lit(False)))


def _changed(events: DataFrame) -> DataFrame:
    """The source by the last load: some early events have another type and the time of
    their change, an hour before the first load."""
    start = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    edited = F.coalesce((F.col("event_id") % 13 == 0) & (F.col("ts") < start), F.lit(False))
    return events.withColumn("event_type", F.when(edited, "edited").otherwise(F.col("event_type"))).withColumn(
        "ts", F.when(edited, start - F.expr("interval 1 hour")).otherwise(F.col("ts")))


def _land_in_parts(spark, events, source_name, last=lambda rows: rows):
    """Loads of a growing source: two on the first day, one later, when the source is what
    ``last`` makes of it. Each picks up what no load before it has brought, whatever its time."""
    landing, marks = fresh_path(spark, "landing"), fresh_path(spark, "marks")
    rows = events.drop("late")
    schema = staged_schema(rows)
    first = F.coalesce(F.col("ts") < F.lit(FIRST_LOAD).cast("timestamp_ntz"), F.col("event_id") % 2 == 0) & ~F.col("late")
    visible = [events.filter(first).drop("late"), events.filter(first | F.col("late")).drop("late"), last(rows)]
    for seq, (known, day) in enumerate(zip(visible, (FIRST_LOAD, FIRST_LOAD, SECOND_LOAD), strict=True)):
        landed = read_or_empty(spark, landing, schema)
        new = stored(extract_new(known, "ts", read_mark(spark, marks, source_name), landed, ["event_id"], OVERLAP), "increment")
        land_raw(new, landing, day, dt.datetime.combine(day, dt.time()), source_name, load_seq=seq)
        save_mark(new, marks, source_name, "ts", seq)
    return landing, schema


@query
def raw_increment(spark, sf_dir):
    """Events with gaps, late rows and changed rows, and the same events from a source that
    has no times at all: each version is landed once."""
    events = read_files(spark, f"{sf_dir}/events.parquet", "parquet", src.SCHEMAS["events"])
    untimed = events.withColumn("ts", F.lit(None).cast("timestamp_ntz")).withColumn("late", F.lit(False))
    parts = [_land_in_parts(spark, _with_gaps(events), "events", _changed), _land_in_parts(spark, untimed, "untimed")]
    rows = [read_files(spark, landing, "parquet", schema) for landing, schema in parts]
    return rows[0].unionByName(rows[1]).select("load_date", "load_seq", "event_id", "user_id", "event_type", "ts", "load_source")


@query
def change_capture(spark, sf_dir):
    """Four loads of a whole source without times: half of the orders, then all, then with
    other states, without some and with rows that have no key, then without any change."""
    landing = fresh_path(spark, "landing")
    orders = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    half = orders.filter("o_orderkey % 2 = 0")
    state = F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus"))
    later = orders.filter("o_orderkey % 7 <> 0").withColumn("o_orderstatus", state).unionByName(
        orders.filter("o_orderkey = 7").withColumn("o_orderkey", F.lit(None).cast("bigint")))
    schema = staged_schema(orders.withColumn("change", F.lit("")))
    for seq, seen in enumerate((half, orders, later, later)):
        changes = stored(source_changes(seen, read_or_empty(spark, landing, schema), ["o_orderkey"]), "changes")
        land_raw(changes, landing, SECOND_LOAD, dt.datetime.combine(SECOND_LOAD, dt.time()), "orders", orders.columns, seq)
    return read_files(spark, landing, "parquet", schema).select(
        "load_seq", "change", "o_orderkey", "o_custkey", "o_orderstatus", F.coalesce(F.col("o_totalprice"), F.lit(0.0)).alias("o_totalprice"))


MEMBER = record(group_id=LONG, user_id=LONG, event_id=LONG, event=TEXT, ts=TS_NTZ)


@query
def insert_new_keys(spark, sf_dir):
    """Membership keys promoted from the staged loads into the persistent layer, one of
    them again. Some members have no community; null is a key as well."""
    log = src.group_log(spark, sf_dir).withColumn("group_id", F.when(F.col("group_id") != 0, F.col("group_id")))
    landing, schema = _land_in_parts(spark, log.withColumn("late", F.lit(False)), "group_log")
    target = fresh_path(spark, "members")
    step = LayerTable(landing, schema, target, MEMBER, lambda df: df, ["group_id", "user_id"], ["ts", "event_id"], buckets=16)
    for day in (FIRST_LOAD, SECOND_LOAD, SECOND_LOAD):
        promote(spark, [step], day)
    return read_files(spark, target, "parquet", MEMBER).select(*MEMBER.names)


WEEKLY = record(event_id=LONG, user_id=LONG, event_type=TEXT, week=DateType())


@query
def promote_weeks(spark, sf_dir):
    """Weeks replaced as a whole, from loads that bring rows of each other's weeks: late
    ones after their time, and a day that is landed anew with fewer rows."""
    landing, target = fresh_path(spark, "landing"), fresh_path(spark, "weeks")
    events = src.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    start = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    late, early = F.col("event_id") % 5 == 0, F.col("ts") < start
    days = [FIRST_LOAD, SECOND_LOAD, SECOND_LOAD + dt.timedelta(days=1)]
    loads = [(0, events.filter(early & ~late)), (1, events.filter(~early)), (2, events.filter(early & late)),
             (1, events.filter(~early & (F.col("event_type") != src.LEAVE)))]
    step = LayerTable(landing, staged_schema(events), target, WEEKLY,
                      lambda df: df.withColumn("week", week_start("ts")), period_col="week")
    for k, rows in loads:
        land_raw(rows, landing, days[k], dt.datetime.combine(days[k], dt.time()), "events")
        promote(spark, [step], days[k])
    return read_files(spark, target, "parquet", WEEKLY).groupBy("week", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("user_id").alias("user_sum"))


# --- communities ---------------------------------------------------------------------------

@query
def community_conversion(spark, sf_dir):
    return community.community_conversion(
        src.group_log(spark, sf_dir), src.group_messages(spark, sf_dir), src.ENTER)


@query
def current_members(spark, sf_dir):
    return community.current_members(src.group_log(spark, sf_dir), src.ENTER, src.LEAVE)


# --- event lake --------------------------------------------------------------------------------

@query
def lake_relayout(spark, sf_dir):
    path = fresh_path(spark, "lake")
    dated = src.table(spark, sf_dir, "events").withColumn("event_date", F.col("ts").cast("date"))
    relayout(dated, path, ["event_date", "event_type"])
    first, last = read_files(spark, path, "parquet", dated.schema).agg(F.min("event_date"), F.max("event_date")).first()
    last = last or dt.date.today()
    days = (last - (first or last)).days + 1
    return read_lake(spark, path, dated.schema, last, days, undated=True).groupBy("event_date", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.countDistinct("user_id").alias("users"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


def _dated_events(spark, sf_dir):
    return src.table(spark, sf_dir, "events").withColumn("event_date", F.col("ts").cast("date"))


@query
def lake_compaction(spark, sf_dir):
    """A lake that many small loads have written, before and after its days are compacted:
    the rows stay, and a day is one file."""
    path = fresh_path(spark, "lake")
    dated = _dated_events(spark, sf_dir)
    for part in range(4):
        dated.filter(F.col("event_id") % 4 == part).write.mode("append").partitionBy("event_date").parquet(path)
    crowded = compact(spark, path, dated.schema, ["event_date"], ["user_id", "event_id"])
    after = file_sizes(spark, path, dated.schema, ["event_date"]).select("event_date", F.col("files").alias("files_after"))
    days = read_files(spark, path, "parquet", dated.schema).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("id_sum"), F.sum("user_id").alias("user_sum"))
    before = crowded.select("event_date", (F.col("files") > 1).alias("was_crowded"))
    return days.join(after, "event_date").join(before, "event_date", "left").withColumn(
        "was_crowded", F.coalesce("was_crowded", F.lit(False)))


LAKE_BUCKETS = 16


@query
def clustered_activity(spark, sf_dir):
    """Events and subscribers, both clustered by user, joined and counted per user without
    a shuffle."""
    tag = uuid.uuid4().hex
    events = cluster(src.events(spark, sf_dir).select("user_id", "event_id", "group_id"), f"events_{tag}", fresh_path(spark, "clustered"),
                     ["user_id"], LAKE_BUCKETS)
    favourites = src.subscriptions(spark, sf_dir).groupBy("user_id").agg(unique_list("restaurant_id").alias("favourites"))
    subscribers = cluster(favourites, f"subscribers_{tag}", fresh_path(spark, "clustered"), ["user_id"], LAKE_BUCKETS)
    return clustered_counts(events, subscribers)


def clustered_counts(events: DataFrame, subscribers: DataFrame) -> DataFrame:
    """Per subscriber: events, those in communities that they subscribe to, and the first one."""
    liked = F.array_contains("favourites", F.col("group_id"))
    return events.join(subscribers, "user_id").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(liked).alias("liked"), F.min(F.when(liked, F.col("event_id"))).alias("first_liked"))


@query
def open_fields(spark, sf_dir):
    """Events as documents of open shape: a number that is sometimes text, null or missing,
    a nested object, and documents that are cut off. Which types each field has, and its
    values by path."""
    path = fresh_path(spark, "open-documents")
    k = F.col("group_id").cast("string")
    number = (F.when(F.col("event_id") % 11 == 0, "null").when(F.col("event_id") % 3 == 0, F.concat(F.lit('"'), k, F.lit('"')))
              .otherwise(k))
    text = F.concat(
        F.lit("{"), F.when(F.col("event_id") % 5 != 0, F.concat(F.lit('"k": '), number, F.lit(", "))).otherwise(""),
        F.lit('"who": {"id": '), F.col("user_id").cast("string"), F.lit(', "the type": "'), F.col("event_type"), F.lit('"}}'))
    text = F.when(F.col("event_id") % 13 == 0, F.rtrim(text, F.lit("}"))).otherwise(text)
    src.events(spark, sf_dir).select(text.alias("value")).write.text(path)
    documents = read_documents(spark, path)
    found = variants.fields(documents, "doc")
    values = [F.struct(F.lit(f.path).alias("path"), variants.value("doc", f).cast("string").alias("v")) for f in found]
    by_path = documents.select(F.explode(F.array(*values)).alias("e")).groupBy("e.path").agg(
        F.count_distinct("e.v").alias("distinct_values"), F.sum(F.expr("try_cast(e.v AS bigint)")).alias("number_sum"))
    return variants.kinds(documents, "doc", found).join(by_path, "path").withColumn("number_sum", F.coalesce("number_sum", F.lit(0)))


@query
def user_mart(spark, sf_dir):
    return lake.user_mart(src.lake_events(spark, sf_dir), src.EVENT_TYPES)


@query
def zone_mart(spark, sf_dir):
    return lake.zone_mart(src.lake_events(spark, sf_dir), src.EVENT_TYPES)


@query
def rerun_safe_mart(spark, sf_dir):
    """Full run, then one day again, then a look-back of ten days: equals one run. A week
    that the lake does not hold any more is gone after the next run over it."""
    lake_path = fresh_path(spark, "lake")
    dated = src.lake_events(spark, sf_dir).withColumn("event_date", F.col("ts").cast("date"))
    gone = dated.filter("event_id % 100 = 0").withColumn("event_date", F.date_add("event_date", 70))
    relayout(dated.unionByName(gone.withColumn("ts", F.col("ts") + F.expr("interval 70 days"))), lake_path, ["event_date"])
    mart = Mart(lake_path, dated.schema, "event_date", lambda df: lake.zone_weeks(df, src.EVENT_TYPES),
                fresh_path(spark, "zone-weeks"), "week", "week")
    bounds = stored_days(spark, mart)
    if bounds:
        first, last = bounds
        backfill(spark, mart, first, last)
        extra = [first + dt.timedelta(days=70 + k) for k in range((last - first).days - 69)]
        drop_periods(spark, lake_path, "event_date", extra)
        refresh(spark, mart, last, (last - first).days - 60)
        refresh(spark, mart, first + dt.timedelta(days=16))
        refresh(spark, mart, first + dt.timedelta(days=23), 10)
    weeks = mart.build(dated).schema
    return lake.with_month_totals(read_or_empty(spark, mart.path, weeks), src.EVENT_TYPES)


@query
def nearest_zone(spark, sf_dir):
    return zone_of_point(src.user_points(spark, sf_dir), "user_id", src.zone_centres(spark, sf_dir))


# As much as three communities that a pair of the zone shares on average.
FRIEND_TIMES = 3


@query
def friend_recommendations(spark, sf_dir):
    sent, received = src.direct_messages(spark, sf_dir)
    members = stored(src.zone_members(spark, sf_dir), "zone-members")
    return lake.friend_recommendations(members, lake.undirected(sent, received), lake.zone_thresholds(members, FRIEND_TIMES))


# --- streams ---------------------------------------------------------------------------------------

PROMO_NOW = dt.datetime(2024, 1, 16)
# Promotions live for a day; what is repeated later than this is expired.
REPEAT_DELAY = "2 days"


def _twice(df: DataFrame) -> DataFrame:
    """Every row delivered two times, as an at-least-once sender may do."""
    return df.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")


def _run_notifications(spark, sf_dir):
    """Every purchase is a one-day promotion of its community, delivered twice. Those of
    every 50th event are cut off on the way."""
    source, checkpoint = fresh_path(spark, "promotions"), fresh_path(spark, "checkpoint")
    messages, feedback, rejects = (fresh_path(spark, n) for n in ("messages", "feedback", "rejects"))
    promos = src.events(spark, sf_dir).filter(F.col("event_type") == src.WRITE).select(
        F.col("event_id").alias("promo_id"), F.col("group_id").alias("restaurant_id"),
        F.col("ts").cast("timestamp").alias("promo_start"),
        (F.col("ts").cast("timestamp") + F.expr("interval 1 day")).alias("promo_end"),
    )
    text = message(*PROMOTION.names)
    sent = F.when(F.col("promo_id") % 50 == 0, F.rtrim(text, F.lit("}"))).otherwise(text)
    once = as_envelopes(promos, F.col("promo_id"), sent, F.col("promo_start"), "promotions")
    stage_in_time_order(_twice(once), source)
    job = NotificationJob(
        read_subscriptions=lambda: src.subscriptions(spark, sf_dir),
        now=F.lit(PROMO_NOW).cast("timestamp"),
        send_messages=batch_file_writer(messages),
        store_feedback=batch_file_writer(feedback),
        store_rejects=batch_file_writer(rejects),
        repeat_delay=REPEAT_DELAY,
        work_path=fresh_path(spark, "notifications"),
    )
    job.start(file_stream(spark, source), checkpoint).awaitTermination()
    return messages, feedback, rejects


MESSAGE_ROW = record(key=TEXT, value=TEXT)
FEEDBACK_ROW = StructType([*JOINED.fields, *record(feedback=TEXT).fields])


@query
def stream_notifications(spark, sf_dir):
    sent, _, _ = _run_notifications(spark, sf_dir)
    body = StructType([
        *PROMOTION.fields,
        *record(user_id=LONG, favourites=ArrayType(LONG), message_id=TEXT).fields,
    ])
    return read_files(spark, sent, "parquet", MESSAGE_ROW).select(F.from_json("value", body).alias("m")).select(
        "m.promo_id", "m.restaurant_id", "m.user_id",
        F.col("m.promo_start").cast("timestamp_ntz").alias("promo_start"),
        F.concat_ws(",", F.transform("m.favourites", lambda k: k.cast("string"))).alias("favourites"),
        "m.message_id",
    )


@query
def stream_feedback(spark, sf_dir):
    _, feedback, _ = _run_notifications(spark, sf_dir)
    return read_files(spark, feedback, "parquet", FEEDBACK_ROW).select(
        "promo_id", "restaurant_id", "user_id", "message_id", F.coalesce("feedback", F.lit("none")).alias("feedback")
    )


@query
def stream_rejects(spark, sf_dir):
    """Broken messages, each kept once, with the key they came under."""
    _, _, rejects = _run_notifications(spark, sf_dir)
    return read_files(spark, rejects, "parquet", ENVELOPE).select(
        F.col("key").cast("string").cast("bigint").alias("promo_id"), "topic",
        F.col("timestamp").cast("timestamp_ntz").alias("sent"), F.length(F.col("value").cast("string")).alias("n_chars"),
    ).withColumn("n_chars", (F.col("n_chars") > 0).cast("bigint")).withColumnRenamed("n_chars", "has_text")


@query
def stream_layers(spark, sf_dir):
    """Order lines as messages, delivered twice, through chained streams."""
    source, raw, work = (fresh_path(spark, n) for n in ("orders-topic", "raw", "order-lines"))
    line = src.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    order = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sold = enrich(line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
                  .withColumnRenamed("l_partkey", "dish_id"), src.dishes(spark, sf_dir), "dish_id").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), "o_orderdate",
        F.array(F.struct("dish_id", "category", F.col("l_extendedprice").cast("decimal(18,2)").alias("price")))
        .alias("items"),
    )
    once = as_envelopes(sold, F.col("order_id"), message("order_id", "user_id", "items"), F.col("o_orderdate"), "orders")
    # Their size and their ranges are measured before they are written.
    stage_in_time_order(_twice(stored(once, "order-messages")), source)
    checkpoint = fresh_path(spark, "checkpoint")
    stream_layer.start_raw(file_stream(spark, source), raw, f"{checkpoint}/raw").awaitTermination()
    job = stream_layer.LineJob(work)
    job.start(spark, raw, f"{checkpoint}/lines").awaitTermination()
    return job.counters(spark)


# --- popularity ---------------------------------------------------------------------------------------

def _popularity(spark, sf_dir):
    return popularity.dish_popularity(src.order_dishes(spark, sf_dir), src.dishes(spark, sf_dir))


@query
def dish_popularity(spark, sf_dir):
    return _popularity(spark, sf_dir)


TOP_DISHES = 20


@query
def top_dishes(spark, sf_dir):
    return popularity.top_dishes(_popularity(spark, sf_dir), TOP_DISHES)


@query
def user_dish_counts(spark, sf_dir):
    by_dish = popularity.user_item_counts(src.order_dishes(spark, sf_dir), "dish_id")
    by_category = popularity.user_item_counts(src.order_dishes(spark, sf_dir, "category"), "category")
    return by_dish.select("user_id", F.lit("dish").alias("kind"), F.col("dish_id").cast("string").alias("item"), "orders") \
        .unionByName(by_category.select("user_id", F.lit("category").alias("kind"), F.col("category").alias("item"), "orders"))
