"""Every operator as a query over the given tables.

A query takes the session and the folder of the tables and returns a frame. Queries of
writers and streams write to a fresh folder below the shared one and return what they
read back. ``REGISTRY`` maps names to queries; results are shown in a form that does
not depend on an engine's date and float types.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse import jobs
from tillhouse import schemas as S
from tillhouse.functions.columns import moment
from tillhouse.operators import governance
from tillhouse.operators.merging import merge_frames
from tillhouse.operators.profiling import profile, row_counts
from tillhouse.operators.screening import failing, passing
from tillhouse.operators.timelines import gap_sessions
from tillhouse.plans import marketing, operations, sales, silver, support
from tillhouse.plans.periods import Period
from tillhouse.session import prepare, working_folder
from tillhouse.sinks import landing
from tillhouse.sinks.reports import load_mart, mart_violations, read_mart, write_csv
from tillhouse.sinks.tables import upsert, write_partitioned
from tillhouse.sources import envelopes, feeds, json_files, tables
from tillhouse.streaming import event_time
from tillhouse.streaming import landing as live_landing
from tillhouse.streaming import support as live_support

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# The dates the reports are made for.
SALES_DATE = dt.date(1998, 6, 15)
SALES_MONTH = Period(1998, 6)
EVENTS_DATE = dt.date(2024, 1, 31)
SUPPORT_DATE = dt.date(2024, 1, 20)
EVENTS_MONTH = Period(2024, 1)
BATCH_STAMP = "2024-01-31 00:00:00"
SALT = "till-house-salt"
LATENESS = "10 minutes"
LANES = 16
ARRIVALS = ("2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01")


def tabular(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, numbers as doubles, computed
    ones rounded to six decimals."""
    shown = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType | T.TimestampType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.FloatType | T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        shown.append(column.alias(field.name))
    return df.select(*shown)


def query(build: Query) -> Query:
    """Register a query under the name of its function."""

    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tabular(build(prepare(spark), sf_dir))

    REGISTRY[build.__name__] = run
    return run


# --- inputs ------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_some_ids(sold: DataFrame) -> DataFrame:
    """Sales as they come in when some tills name no transaction."""
    return sold.withColumn(
        "transaction_id", F.when(F.col("product_id") % 50 != 0, F.col("transaction_id"))
    )


def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_pos(feeds.pos_feed(table(spark, sf_dir, "lineitem")))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_inventory(feeds.inventory_feed(table(spark, sf_dir, "part")))


def crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_crm(feeds.crm_feed(table(spark, sf_dir, "events")))


def wtl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_wtl(feeds.wtl_feed(table(spark, sf_dir, "events")))


def decoded(events: DataFrame) -> DataFrame:
    return envelopes.decode_envelopes(
        feeds.live_envelopes(events, keep=["event_id"]), S.LIVE_CRM, envelopes.REQUIRED_CRM
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream. The braces make the path a glob, which the file
    source needs to accept a single file as well as a folder of files."""
    schema = table(spark, sf_dir, "events").schema
    return live_landing.stream_files(spark, f"{sf_dir}/{{events}}.parquet", schema, "parquet")


def caught_up(spark: SparkSession, stream: DataFrame, name: str, **options) -> str:
    folder = working_folder(spark, name)
    live_landing.run_until_caught_up(stream, f"{folder}/data", f"{folder}/checkpoint", **options)
    return f"{folder}/data"


# --- sources -----------------------------------------------------------------------


@query
def bronze_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interaction feed as gzip JSON lines and as JSON array files, read back."""
    rows = feeds.crm_feed(table(spark, sf_dir, "events"))
    folder = working_folder(spark, "json-scan")
    feed_columns = S.BRONZE_CRM.names
    rows.write.option("compression", "gzip").json(f"{folder}/lines")
    # Arrays of at most 50,000 neighbouring records, one per file.
    arrays = (
        rows.withColumn("chunk", F.floor(F.monotonically_increasing_id() / 50_000))
        .groupBy("chunk")
        .agg(F.concat_ws(",", F.collect_list(F.to_json(F.struct(*feed_columns)))).alias("body"))
        .select(F.concat(F.lit("["), "body", F.lit("]")).alias("value"))
    )
    arrays.write.option("maxRecordsPerFile", 1).text(f"{folder}/arrays")
    lines = json_files.read_json_lines(spark, f"{folder}/lines", S.BRONZE_CRM)
    elements = json_files.read_json_arrays(spark, f"{folder}/arrays", S.BRONZE_CRM)
    return lines.withColumn("layout", F.lit("lines")).unionByName(
        elements.withColumn("layout", F.lit("array"))
    )


@query
def bronze_catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interaction feed in folders by day, registered with its partitions and read
    by name."""
    rows = feeds.crm_feed(table(spark, sf_dir, "events"))
    at = moment("timestamp")
    dated = rows.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})
    folder = working_folder(spark, "catalog")
    write_partitioned(dated, folder, silver.DAILY)
    name = f"bronze_crm_{uuid.uuid4().hex}"
    tables.register_folder(spark, "default", name, folder, dated.schema, silver.DAILY)
    return tables.read_catalog(spark, "default", name)


@query
def landing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock count files landed in one hour, again in the same hour, and in the next."""
    part = table(spark, sf_dir, "part").select("*", landing.file_name().alias("source_file"))
    rows = feeds.inventory_feed(part, keep=["source_file"])
    folder = working_folder(spark, "landing")
    for minute in (15, 40, 65):
        arrived = dt.datetime(2024, 5, 8, 10) + dt.timedelta(minutes=minute)
        landing.land(spark, rows, folder, arrived, hourly=True)
    return spark.read.parquet(folder)


@query
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields and outcome of every stream envelope."""
    return decoded(table(spark, sf_dir, "events"))


@query
def keyed_json_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last interaction to arrive per customer and time, stored as JSON, read back."""
    rows = feeds.crm_feed(table(spark, sf_dir, "events"), keep=["event_id"])
    latest = landing.latest_objects(rows, ["customer_id", "timestamp"], "event_id")
    folder = working_folder(spark, "objects")
    latest.write.json(folder)
    return json_files.read_json_lines(spark, folder, latest.schema)


@query
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the stages of the interaction load."""
    raw = feeds.crm_feed(table(spark, sf_dir, "events"))
    folder = working_folder(spark, "audit")
    silver.survivors(raw, silver.CRM).write.parquet(folder)
    rows = spark.read.parquet(folder)
    checks = silver.CRM.checks()
    return row_counts(
        {
            "bronze": raw,
            "deduplicated": rows,
            "silver": passing(rows, checks),
            "rejected": failing(rows, checks),
        }
    )


# --- silver ------------------------------------------------------------------------


@query
def silver_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos(spark, sf_dir)


@query
def silver_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(spark, sf_dir)


@query
def silver_crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crm(spark, sf_dir)


@query
def silver_wtl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wtl(spark, sf_dir)


@query
def silver_pos_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.rejects(feeds.pos_feed(table(spark, sf_dir, "lineitem")), silver.POS)


@query
def silver_inventory_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.rejects(feeds.inventory_feed(table(spark, sf_dir, "part")), silver.INVENTORY)


@query
def silver_crm_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.rejects(feeds.crm_feed(table(spark, sf_dir, "events")), silver.CRM)


@query
def silver_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver interactions stored by day, one month of them read from the root."""
    folder = working_folder(spark, "silver-crm")
    write_partitioned(crm(spark, sf_dir), folder, silver.CRM.partitions)
    return tables.read_table(spark, folder, S.SILVER_CRM, EVENTS_MONTH)


@query
def silver_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver interactions stored by day, one day of them read from its folder alone."""
    folder = working_folder(spark, "silver-crm-days")
    upsert(spark, folder, crm(spark, sf_dir), silver.CRM)
    return tables.read_table(spark, folder, S.SILVER_CRM, Period.day_of(SUPPORT_DATE))


@query
def merge_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled sales updated by open ones."""
    lines = table(spark, sf_dir, "lineitem")
    settled, still_open = (
        silver.silver_pos(feeds.pos_feed(lines.where(F.col("l_linestatus") == status)))
        for status in ("F", "O")
    )
    return merge_frames(settled, still_open, silver.POS.keys)


@query
def merge_inventory_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored stock counts upserted by those of the next day, which move to its folder."""
    counts = feeds.inventory_feed(table(spark, sf_dir, "part"), keep=["generation"])
    folder = working_folder(spark, "silver-inventory")
    for generation in (1, 0):
        update = counts.where(F.col("generation") == generation).drop("generation")
        upsert(spark, folder, silver.silver_inventory(update), silver.INVENTORY)
    return tables.read_table(spark, folder, S.SILVER_INVENTORY)


@query
def merge_crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored contacts of browsing customers upserted by those of buying ones; the key
    holds the time, so only the days of the update are looked at."""
    events = table(spark, sf_dir, "events")
    buying = F.col("event_type").isin("purchase", "signup")
    folder = working_folder(spark, "silver-contacts")
    for contacts in (events.where(~buying), events.where(buying)):
        upsert(spark, folder, silver.silver_crm(feeds.crm_feed(contacts)), silver.CRM)
    return tables.read_table(spark, folder, S.SILVER_CRM)


@query
def merge_wtl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored web traffic upserted by a second delivery of half of it on other devices."""
    hits = feeds.wtl_feed(table(spark, sf_dir, "events"))
    again = hits.where(F.col("timestamp") % 2 == 0).withColumn("device_type", F.lit("tv"))
    folder = working_folder(spark, "silver-traffic")
    for delivery in (hits, again):
        upsert(spark, folder, silver.silver_wtl(delivery), silver.WTL)
    return tables.read_table(spark, folder, S.SILVER_WTL)


@query
def merge_pos_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored sales upserted by corrections that move a third of them to another day."""
    sold = feeds.pos_feed(table(spark, sf_dir, "lineitem"))
    moved = sold.where(F.col("product_id") % 3 == 0).withColumn(
        "timestamp", F.col("timestamp") + 40 * 86_400
    )
    folder = working_folder(spark, "silver-sales")
    for delivery in (sold, moved):
        upsert(spark, folder, silver.silver_pos(delivery), silver.POS, unique=True)
    return tables.read_table(spark, folder, S.SILVER_POS)


# --- jobs --------------------------------------------------------------------------


@query
def job_rejects_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that two runs of the sales job on one date refuse, the first run twice;
    some sales come without a transaction id."""
    lines = table(spark, sf_dir, "lineitem")
    lake = jobs.Lake(working_folder(spark, "lake"))
    for status in ("F", "O", "F"):
        sold = feeds.pos_feed(lines.where(F.col("l_linestatus") == status))
        jobs.refresh_silver(spark, lake, without_some_ids(sold), silver.POS, SALES_DATE, run=status)
    found = jobs.read_rejects(spark, lake, silver.POS)
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("store_id", "product_id", "quantity")]
    return found.select("transaction_id", *numbers, "reject_reason", "run")


@query
def job_support_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The support mart that the job of a day publishes, with times to resolution since
    interactions of earlier days."""
    lake = jobs.Lake(working_folder(spark, "lake"))
    contacts = feeds.crm_feed(table(spark, sf_dir, "events"))
    jobs.refresh_silver(spark, lake, contacts, silver.CRM, SUPPORT_DATE)
    jobs.refresh_support(spark, lake, SUPPORT_DATE)
    return read_mart(spark, lake.mart(S.SUPPORT_MART), S.SUPPORT_MART)


@query
def job_marketing_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marketing mart that the job of a day publishes, from silver tables filled by jobs."""
    lake = jobs.Lake(working_folder(spark, "lake"))
    events = table(spark, sf_dir, "events")
    jobs.refresh_silver(spark, lake, feeds.crm_feed(events), silver.CRM, SUPPORT_DATE)
    jobs.refresh_silver(spark, lake, feeds.wtl_feed(events), silver.WTL, SUPPORT_DATE)
    jobs.refresh_marketing(spark, lake, SUPPORT_DATE)
    return read_mart(spark, lake.mart(S.MARKETING_MART), S.MARKETING_MART)


@query
def job_sales_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales mart that the job of a month publishes, from silver tables filled by jobs."""
    lake = jobs.Lake(working_folder(spark, "lake"))
    sold, counted = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    jobs.refresh_silver(spark, lake, feeds.pos_feed(sold), silver.POS, SALES_DATE)
    jobs.refresh_silver(spark, lake, feeds.inventory_feed(counted), silver.INVENTORY, SALES_DATE)
    jobs.refresh_sales(spark, lake, SALES_DATE, SALES_MONTH, SALES_MONTH)
    return read_mart(spark, lake.mart(S.SALES_MART), S.SALES_MART)


@query
def job_operations_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operations mart that the job of a day publishes (``stock`` counted), and the one of
    a lake whose stock counts never came, where the silver table is an empty typed frame. The
    sales of both are filled by jobs."""
    sold, counted = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    lake = jobs.Lake(working_folder(spark, "lake"))
    jobs.refresh_silver(spark, lake, feeds.pos_feed(sold), silver.POS, SALES_DATE)
    marts = []
    for stock in ("missing", "counted"):
        if stock == "counted":
            jobs.refresh_silver(
                spark, lake, feeds.inventory_feed(counted), silver.INVENTORY, SALES_DATE
            )
        jobs.refresh_operations(spark, lake, SALES_DATE)
        found = read_mart(spark, lake.mart(S.OPERATIONS_MART), S.OPERATIONS_MART)
        folder = working_folder(spark, "mart")
        found.withColumn("stock", F.lit(stock)).write.parquet(folder)
        marts.append(spark.read.parquet(folder))
    return marts[0].unionByName(marts[1])


# --- gold --------------------------------------------------------------------------


@query
def feedback_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return support.feedback_score(crm(spark, sf_dir))


@query
def interaction_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return support.interaction_volume(crm(spark, sf_dir))


@query
def feedback_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return support.feedback_trend(crm(spark, sf_dir))


@query
def time_to_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return support.time_to_resolution(crm(spark, sf_dir))


@query
def support_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support figures of all live records as one batch."""
    live = envelopes.valid_records(decoded(table(spark, sf_dir, "events")))
    return support.support_snapshot(live.withColumn("kpi_date", F.lit(BATCH_STAMP)))


@query
def customer_support_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return support.customer_support_mart(crm(spark, sf_dir), EVENTS_DATE)


@query
def web_session_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marketing.web_session_rates(wtl(spark, sf_dir))


@query
def crm_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marketing.crm_engagement(crm(spark, sf_dir))


@query
def marketing_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marketing.marketing_mart(wtl(spark, sf_dir), crm(spark, sf_dir), EVENTS_DATE)


@query
def marketing_mart_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketing mart with the real mean session length."""
    return marketing.marketing_mart(
        wtl(spark, sf_dir), crm(spark, sf_dir), EVENTS_DATE, measured_sessions=True
    )


@query
def click_through_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marketing.click_through_daily(wtl(spark, sf_dir))


@query
def sales_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sales_mart(pos(spark, sf_dir), inventory(spark, sf_dir), SALES_DATE)


@query
def sales_mart_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales mart of one month, the span the daily job reads."""
    return sales.sales_mart(
        pos(spark, sf_dir), inventory(spark, sf_dir), SALES_DATE, SALES_MONTH, SALES_MONTH
    )


@query
def sales_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sales_by_store(pos(spark, sf_dir), inventory(spark, sf_dir), SALES_DATE)


@query
def daily_net_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.daily_net_sales(pos(spark, sf_dir))


@query
def store_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.store_revenue(pos(spark, sf_dir))


@query
def inventory_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operations.inventory_turnover(pos(spark, sf_dir), inventory(spark, sf_dir))


@query
def inventory_turnover_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnover of one day, the span the daily job reports."""
    return operations.inventory_turnover(pos(spark, sf_dir), inventory(spark, sf_dir), SALES_DATE)


@query
def restock_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operations.restock_frequency(inventory(spark, sf_dir))


@query
def stockout_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operations.stockout_alerts(inventory(spark, sf_dir))


@query
def operations_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operations.operations_mart(pos(spark, sf_dir), inventory(spark, sf_dir), SALES_DATE)


@query
def gold_csv_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction volumes as one CSV file in the folder of the date, read back."""
    folder = working_folder(spark, "gold")
    csv = write_csv(
        support.interaction_volume(crm(spark, sf_dir)),
        folder, "interaction_volume", EVENTS_DATE, single_file=True,
    )
    return spark.read.schema(S.INTERACTION_VOLUME).option("header", True).csv(csv)


def _roundtrip(spark: SparkSession, gold: DataFrame, mart: S.Mart, date: dt.date) -> DataFrame:
    folder = working_folder(spark, mart.name)
    csv = write_csv(gold, f"{folder}/gold", mart.name, date)
    load_mart(spark, csv, mart, f"{folder}/mart")
    return read_mart(spark, f"{folder}/mart", mart)


@query
def mart_roundtrip_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales mart through its CSV into the typed table."""
    gold = sales.sales_mart(pos(spark, sf_dir), inventory(spark, sf_dir), SALES_DATE)
    return _roundtrip(spark, gold, S.SALES_MART, SALES_DATE)


@query
def mart_roundtrip_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marketing mart through its CSV into the typed table."""
    gold = marketing.marketing_mart(wtl(spark, sf_dir), crm(spark, sf_dir), EVENTS_DATE)
    return _roundtrip(spark, gold, S.MARKETING_MART, EVENTS_DATE)


@query
def mart_roundtrip_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations mart through its CSV into the typed table."""
    gold = operations.operations_mart(pos(spark, sf_dir), inventory(spark, sf_dir), SALES_DATE)
    return _roundtrip(spark, gold, S.OPERATIONS_MART, SALES_DATE)


@query
def mart_roundtrip_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support mart through its CSV into the typed table."""
    gold = support.customer_support_mart(crm(spark, sf_dir), EVENTS_DATE)
    return _roundtrip(spark, gold, S.SUPPORT_MART, EVENTS_DATE)


@query
def mart_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys the raw sales feed would break if it were loaded without deduplication,
    checked with the rules of a mart keyed by transaction; some sales come without one."""
    raw = without_some_ids(feeds.pos_feed(table(spark, sf_dir, "lineitem")))
    by_transaction = S.Mart("raw_sales", S.BRONZE_POS, ("transaction_id",), "timestamp")
    return mart_violations(raw, by_transaction)


# --- streams -----------------------------------------------------------------------


@query
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live records screened and landed in folders of their arrival hour, refused ones
    apart, both read back. The hour is that of the run and not part of the result."""
    records = feeds.live_records(event_stream(spark, sf_dir), keep=["event_id"])
    read = landed_by_outcome(spark, records, envelopes.REQUIRED_CRM, "customer_id")
    return read.withColumn("accepted", F.col("outcome") == "accepted").drop("outcome")


def landed_by_outcome(spark: SparkSession, records: DataFrame, required, key: str) -> DataFrame:
    """Live records landed in one pass by outcome and hour, read back without the hour."""
    judged = live_landing.with_outcome(records, required)
    hourly = live_landing.with_arrival_hour(live_landing.with_partition_key(judged, key))
    path = caught_up(spark, hourly, "live", partitions=live_landing.OUTCOME_HOURLY)
    return json_files.read_json_lines(spark, path, hourly.schema).drop(*live_landing.HOURLY)


@query
def stream_landing_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live web records landed by outcome and hour; their fields, read back."""
    records = feeds.live_web_records(event_stream(spark, sf_dir), keep=["event_id"])
    read = landed_by_outcome(spark, records, envelopes.REQUIRED_WTL, "session_id")
    fields = F.when(F.col("outcome") != "bad_json", F.from_json("value", S.LIVE_WTL))
    return read.select("event_id", "outcome", "partition_key", fields.alias("f")).select(
        "event_id", "outcome", "partition_key", "f.*"
    )


@query
def stream_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live records landed in lanes by customer: lane, number and order of the records of
    each customer as a reader of the lane meets them."""
    records = feeds.live_records(event_stream(spark, sf_dir), keep=["event_id"])
    keyed = live_landing.with_lane(live_landing.with_partition_key(records, "customer_id"), LANES)
    timed = live_landing.with_batch_time(keyed)
    path = caught_up(spark, timed, "lanes", file_format="parquet", partitions=("lane",))
    lanes = spark.read.schema(timed.schema).parquet(path)
    met = F.struct("batch_time", "event_id")
    return lanes.groupBy("lane", "partition_key").agg(
        F.count("*").alias("records"), F.min(met)["event_id"].alias("first_event"),
        F.max(met)["event_id"].alias("last_event"),
    )


@query
def stream_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes landed by outcome and hour in one pass: fields of the valid ones, and the
    refused ones as they came."""
    folder = working_folder(spark, "envelopes")
    sent = feeds.live_envelopes(event_stream(spark, sf_dir), keep=["event_id"])
    live_support.start_envelope_landing(
        sent, f"{folder}/landed", f"{folder}/checkpoint", trigger=live_landing.UNTIL_CAUGHT_UP
    ).awaitTermination()
    landed = spark.read.parquet(f"{folder}/landed")
    return landed.select(
        "event_id", "outcome", *S.LIVE_CRM.names, F.col("raw").isNotNull().alias("kept_raw")
    )


def arrivals(spark: SparkSession, sf_dir: str, folder: str):
    """Thirds of the month of events, which arrive one after the other in a folder; the
    stream of that folder after each."""
    events = table(spark, sf_dir, "events")
    for low, high in zip(ARRIVALS, ARRIVALS[1:], strict=False):
        some = events.where((F.col("ts") >= low) & (F.col("ts") < high))
        some.write.mode("append").parquet(f"{folder}/source")
        yield live_landing.stream_files(spark, f"{folder}/source", events.schema, "parquet")


@query
def stream_support_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support figures of three micro-batches. A Resolution may answer an interaction of an
    earlier batch."""
    folder = working_folder(spark, "support-arrivals")
    store = live_support.BatchStore(spark, f"{folder}/store")
    for stream in arrivals(spark, sf_dir, folder):
        live_support.start_live_landing(
            feeds.live_envelopes(stream), f"{folder}/landed", f"{folder}/checkpoint",
            trigger=live_landing.UNTIL_CAUGHT_UP,
        ).awaitTermination()
        store.add(spark.read.parquet(f"{folder}/landed"))
    shown = support.volumes_as_json(store.read("volumes"), "version")
    return store.read("figures").join(shown, "version", "left").drop("version", "batch_time")


@query
def stream_support_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions of each customer taken as a type of its own, one row per batch and type:
    many types need no large row."""
    live = envelopes.valid_records(decoded(table(spark, sf_dir, "events")))
    many = live.withColumns(
        {"interaction_type": F.concat_ws("-", "interaction_type", "customer_id"),
         "kpi_date": F.lit(BATCH_STAMP)}
    )
    return support.type_volumes(support.support_records(many, "kpi_date"), "kpi_date")


@query
def stream_late_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web traffic landed from a stream in two deliveries, the second of which repeats half
    of the first on other devices, long after the watermark; merged by key after each."""
    folder = working_folder(spark, "late-merge")
    lake = jobs.Lake(folder)
    events = table(spark, sf_dir, "events")
    for again in (False, True):
        source = events.withColumn("again", F.lit(again))
        source = source.where(F.unix_seconds(F.col("ts").cast("timestamp")) % 2 == 0) if again else source
        source.write.mode("append").parquet(f"{folder}/source")
        stream = live_landing.stream_files(spark, f"{folder}/source", source.schema, "parquet")
        hits = feeds.wtl_feed(stream, keep=["again"])
        device = F.when(F.col("again"), "tv").otherwise(F.col("device_type"))
        landed = live_landing.with_batch_time(hits.withColumn("device_type", device).drop("again"))
        live_landing.run_until_caught_up(
            landed, f"{folder}/landed", f"{folder}/checkpoint", file_format="parquet", partitions=()
        )
        records = spark.read.schema(landed.schema).parquet(f"{folder}/landed")
        jobs.merge_landed(spark, lake, records, silver.WTL, "batch_time")
    return jobs.read_silver(spark, lake, silver.WTL)


@query
def stream_support_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support figures of each micro-batch of the envelope stream, stored once each."""
    folder = working_folder(spark, "support-batches")
    envelope_stream = feeds.live_envelopes(event_stream(spark, sf_dir))
    live_support.start_live_landing(
        envelope_stream, f"{folder}/landed", f"{folder}/checkpoint",
        trigger=live_landing.UNTIL_CAUGHT_UP,
    ).awaitTermination()
    for _ in range(2):
        live_support.store_batch_figures(spark, f"{folder}/landed", f"{folder}/figures")
    return spark.read.parquet(f"{folder}/figures").drop("batch_time")


def _timed(stream: DataFrame) -> DataFrame:
    return stream.withColumn("timestamp", moment("timestamp"))


@query
def stream_volume_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed ten-minute windows of interactions by type."""
    interactions = _timed(feeds.crm_feed(event_stream(spark, sf_dir))).withColumn(
        "interaction_type", F.upper("interaction_type")
    )
    windows = event_time.volume_windows(interactions, lateness=LATENESS)
    path = caught_up(spark, windows, "volume-windows", file_format="parquet", partitions=())
    return spark.read.parquet(path)


@query
def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web records, one per session and second, up to the watermark."""
    records = _timed(feeds.wtl_feed(event_stream(spark, sf_dir)))
    single = event_time.one_per_key(records, lateness=LATENESS)
    path = caught_up(spark, single, "stream-dedup", file_format="parquet", partitions=())
    return spark.read.parquet(path)


@query
def stream_web_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed sessions of each user, from the stream."""
    records = _timed(feeds.wtl_feed(event_stream(spark, sf_dir)))
    sessions = event_time.web_sessions(records, lateness=LATENESS)
    path = caught_up(spark, sessions, "stream-sessions", file_format="parquet", partitions=())
    return spark.read.parquet(path)


@query
def stream_volume_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows: the closed ones of the stream, and those still open from the records."""
    def interactions(events: DataFrame) -> DataFrame:
        return _timed(feeds.crm_feed(events)).withColumn("interaction_type", F.upper("interaction_type"))

    folder = working_folder(spark, "volume-complete")
    windows = event_time.volume_windows(interactions(event_stream(spark, sf_dir)), lateness=LATENESS)
    run = live_landing.run_until_caught_up(
        windows, f"{folder}/data", f"{folder}/checkpoint", file_format="parquet", partitions=()
    )
    closed = spark.read.schema(windows.schema).parquet(f"{folder}/data")
    records = interactions(table(spark, sf_dir, "events"))
    return event_time.with_open_windows(closed, records, live_landing.final_watermark(run))


@query
def stream_sessions_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions: the closed ones of the stream, and those still open from the records."""
    sessions = event_time.web_sessions(
        _timed(feeds.wtl_feed(event_stream(spark, sf_dir))), lateness=LATENESS
    )
    path = caught_up(spark, sessions, "sessions-complete", file_format="parquet", partitions=())
    closed = spark.read.schema(sessions.schema).parquet(path)
    records = _timed(feeds.wtl_feed(table(spark, sf_dir, "events")))
    return event_time.with_open_sessions(closed, records)


@query
def web_sessions_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, from the silver table."""
    return gap_sessions(wtl(spark, sf_dir))


# --- quality and governance --------------------------------------------------------


@query
def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, wrong types and repeated keys of the live records."""
    live = envelopes.valid_records(decoded(table(spark, sf_dir, "events")))
    return profile(live, S.BRONZE_CRM, ("customer_id", "timestamp"))


@query
def hashed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web traffic with salted user hashes and no raw id."""
    return governance.hash_users(wtl(spark, sf_dir), SALT)


@query
def team_view_sales_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sales team of one region sees of the sales table."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").where(F.col("r_name") == "EUROPE"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    stores = (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").cast("bigint").alias("store_id"))
    )
    return governance.team_view(pos(spark, sf_dir), "sales", "pos", allowed=stores)


@query
def retention_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions of the last three weeks without customers who closed their account
    (a negative balance stands for that here)."""
    closed = (
        table(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") < 0)
        .select(F.col("c_custkey").cast("bigint").alias("customer_id"))
    )
    return governance.retain(crm(spark, sf_dir), EVENTS_DATE, 21, closed)


@query
def retention_purge_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same deletion from the stored table, which opens only folders that are old or
    hold one of the closed accounts."""
    closed = (
        table(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") < 0)
        .select(F.col("c_custkey").cast("bigint").alias("customer_id"))
    )
    lake = jobs.Lake(working_folder(spark, "lake"))
    upsert(spark, lake.silver(silver.CRM), crm(spark, sf_dir), silver.CRM)
    jobs.purge_users(spark, lake, silver.CRM, EVENTS_DATE, 21, closed, "customer_id")
    return jobs.read_silver(spark, lake, silver.CRM)


@query
def team_view_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the marketing team sees of the web traffic: salted digests, no raw ids."""
    return governance.team_view(wtl(spark, sf_dir), "marketing", "wtl", salt=SALT)
