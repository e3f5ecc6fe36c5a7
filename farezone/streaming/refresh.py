"""Incremental monthly refresh with Structured Streaming.

The reference re-reads every monthly trip file on each monthly run. Here new
files are picked up by a file-source stream (``trigger(availableNow=True)``: run
on the schedule, process what arrived, stop). Each micro-batch of new files is
filtered and aggregated to partial origin/destination counts, written under its
own ``batch=<epoch>`` folder. A replayed epoch (after a failure) overwrites its
own folder, so the table stays exactly-once; the stream's checkpoint remembers
which files were processed.

Readers sum the partial counts per key (:func:`read_od`), so a month whose files
arrive over several runs is still counted once per trip.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farezone.config import Industry
from farezone.operators.aggregates import OD_KEYS, filtered_trips, od_counts
from farezone.sources.readers import TRIP_SCHEMAS


def default_od(industry: Industry, start: int, end: int) -> Callable[[DataFrame], DataFrame]:
    """A1 (or A3 by licence for the hv table) on a batch of trips."""
    extra = (industry.company_col,) if industry.company_col else ()

    def build(batch: DataFrame) -> DataFrame:
        return od_counts(filtered_trips(batch, industry, start, end), *extra)

    return build


def traditional_od(bases: DataFrame, start: int, end: int) -> Callable[[DataFrame], DataFrame]:
    """A2 on a batch of fhv trips, joined to the (static) base list."""
    from farezone.operators.aggregates import od_counts_traditional

    def build(batch: DataFrame) -> DataFrame:
        return od_counts_traditional(batch, bases, start, end)

    return build


def start_od_refresh(spark: SparkSession, trips_path: str, table: str, industry: Industry,
                     start: int, end: int, out_root: str, checkpoint: str,
                     od: Callable[[DataFrame], DataFrame] | None = None,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the refresh stream over ``trips_path`` (trip files of ``table``:
    ``yellow``, ``green``, ``fhv`` or ``hvfhv``) and return the running query.

    ``od`` turns a batch of trips into OD rows (default :func:`default_od`; pass
    a function closing over the base list for fhv). ``checkpoint`` must be on
    shared storage.
    """
    build = od or default_od(industry, start, end)
    reader = spark.readStream.schema(TRIP_SCHEMAS[table])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(trips_path)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{out_root}/batch={epoch_id}")

    return (stream.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def read_od(spark: SparkSession, out_root: str, extra_keys=()) -> DataFrame:
    """The refreshed OD table: partial counts of all batches summed per key."""
    parts = spark.read.parquet(out_root)
    return parts.groupBy(*OD_KEYS, *extra_keys).agg(F.sum("count").alias("count"))
