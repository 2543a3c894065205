"""Support figures of the live stream, one row per micro-batch.

The stream itself only lands records with the time of their batch. The figures are a
batch job over what has landed: batches that already have a row are left alone, so the
job may run as often as one likes, and a crash loses nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillhouse.plans.support import batch_figures, support_records, support_snapshot, type_volumes
from tillhouse.session import working_folder
from tillhouse.sinks import folders
from tillhouse.sources.envelopes import REQUIRED_CRM, decode_envelopes, valid_records
from tillhouse.schemas import LIVE_CRM
from tillhouse.streaming.landing import (
    OUTCOME_HOURLY,
    start_landing,
    with_arrival_hour,
    with_batch_time,
)

BATCH_DAY = "batch_date"


def start_live_landing(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    required: Sequence[str] = REQUIRED_CRM,
) -> StreamingQuery:
    """Land the valid records of an envelope stream by batch, in folders by batch date."""
    live = valid_records(decode_envelopes(envelopes, LIVE_CRM, required))
    dated = with_batch_time(live).withColumn(BATCH_DAY, F.to_date("batch_time"))
    return start_landing(
        dated, path, checkpoint, file_format="parquet", partitions=(BATCH_DAY,), trigger=trigger
    )


def start_envelope_landing(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    required: Sequence[str] = REQUIRED_CRM,
) -> StreamingQuery:
    """Land every envelope in one pass, in folders by outcome and hour: the valid ones as
    their fields, the refused ones as they came (``raw``). Together they are the input."""
    raw = envelopes.withColumn("raw", F.col("data"))
    judged = decode_envelopes(raw, LIVE_CRM, required)
    kept = judged.withColumn("raw", F.when(F.col("outcome") != "valid", F.col("raw")))
    timed = with_arrival_hour(with_batch_time(kept), F.col("batch_time"))
    return start_landing(
        timed, path, checkpoint, file_format="parquet", partitions=OUTCOME_HOURLY, trigger=trigger
    )


#: Tables of last interactions that are kept before they are made into one.
MOST_DELTAS = 60


class BatchStore:
    """Figures of landed batches, one batch after the other, with what is known of customers
    from the batches before.

    Below ``path`` lie, by batch, ``figures`` (score and time), ``volumes`` (one row per
    type) and ``last`` (second of the last interaction of each customer of the batch).
    ``figures`` are written last and mark a batch as done: one that was interrupted is
    computed again, with the same result. Every ``MOST_DELTAS`` batches ``last`` becomes one
    table of all customers.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, table: str, batch: int) -> str:
        return f"{self.path}/{table}/version={batch}"

    def done(self) -> list[int]:
        return sorted(folders.finished_versions(self.spark, f"{self.path}/figures"))

    def read(self, table: str) -> DataFrame:
        """``figures`` or ``volumes`` of all finished batches; ``version`` is the batch."""
        root = f"{self.path}/{table}"
        named = [self._folder(table, batch) for batch in self.done()]
        return self.spark.read.option("basePath", root).parquet(*named)

    def last_interactions(self) -> DataFrame:
        """``customer_id`` and ``known_second`` from the newest whole table and the batches
        after it. A customer may have several rows."""
        schema = "customer_id string, known_second bigint"
        done = self.done()
        whole = max((b for b in folders.finished_versions(self.spark, f"{self.path}/whole") if b in done), default=0)
        named = [self._folder("last", batch) for batch in done if batch > whole]
        named += [self._folder("whole", whole)] if whole else []
        if not named:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*named)

    def add(self, landed: DataFrame) -> None:
        """Bring in all batches of ``landed`` records that are not done, in order of their
        ``batch_time``. Each is read once."""
        number = F.unix_micros("batch_time")
        new = landed.select(number.alias("batch")).distinct().collect()
        for batch in sorted({row.batch for row in new} - set(self.done())):
            self._add_one(landed.where(number == batch), batch)

    def _add_one(self, live: DataFrame, batch: int) -> None:
        typed = working_folder(self.spark, "batch")
        support_records(live, "batch_time").write.parquet(typed)
        records = self.spark.read.parquet(typed)
        clean = records.where("is_clean")
        here = clean.select("customer_id").distinct()
        known = (
            self.last_interactions()
            .join(here, "customer_id", "left_semi")
            .groupBy("customer_id")
            .agg(F.max("known_second").alias("known_second"))
        )
        stamped = known.withColumn("batch_time", F.timestamp_micros(F.lit(batch)))
        latest = clean.groupBy("customer_id").agg(
            F.max(F.unix_seconds("timestamp")).alias("known_second")
        )
        latest.write.mode("overwrite").parquet(self._folder("last", batch))
        type_volumes(records, "batch_time").write.mode("overwrite").parquet(
            self._folder("volumes", batch)
        )
        batch_figures(records, "batch_time", stamped).write.mode("overwrite").parquet(
            self._folder("figures", batch)
        )
        done = self.done()
        if len(done) % MOST_DELTAS == 0:
            self.last_interactions().groupBy("customer_id").agg(
                F.max("known_second").alias("known_second")
            ).write.mode("overwrite").parquet(self._folder("whole", batch))
        folders.remove(self.spark, typed)


def store_batch_figures(
    spark: SparkSession, landed: str, store: str, day: dt.date | None = None
) -> None:
    """Append the figures of landed batches that have none yet, of one day or of all."""
    batches = spark.read.parquet(landed)
    if day is not None:
        batches = batches.where(F.col(BATCH_DAY) == F.lit(day))
    if folders.exists(spark, store):
        done = spark.read.parquet(store).select("batch_time")
        batches = batches.join(done, "batch_time", "left_anti")
    support_snapshot(batches, stamp="batch_time").write.mode("append").parquet(store)
